"""DuckDB SQL of the queries that SQL can express."""

_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_REST = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) ELSE '' END"


def _address(url: str, prefix: str) -> str:
    """Host, path and key (host, path, query) of an address."""
    rest = _REST.format(url)
    host = _ASCII_LOWER.format(f"regexp_extract({rest}, '^([^/?#]*)', 1)")
    path = f"regexp_extract({rest}, '(?s)^[^/?#]*([^?#]*)', 1)"
    query = f"regexp_extract({rest}, '(?s)^[^?#]*(\\?[^#]*)', 1)"
    key = f"CASE WHEN {host} <> '' THEN {host} || CASE WHEN {path} = '' THEN '/' ELSE {path} END || {query} END"
    return f"coalesce({host}, '') AS {prefix}host, coalesce({path}, '') AS {prefix}path, {key} AS {prefix}key"


def _attribute(tag: str, name: str) -> str:
    pattern = f"""(?is)[\\s"''/]{name}\\s*=\\s*(?:"([^"]*)"|''([^'']*)''|([^\\s"''<>]+))"""
    parts = " || ".join(f"regexp_extract({tag}, '{pattern}', {i})" for i in (1, 2, 3))
    return f"trim({parts}, ' ' || chr(9) || chr(10) || chr(13) || chr(12))"


def _against(p: str) -> str:
    """Target ``t`` resolved against the address with the columns {p}host and {p}path."""
    return (
        f"CASE WHEN t IS NULL OR t = '' OR t LIKE '#%' THEN NULL WHEN instr(t, '://') > 0 THEN t WHEN t LIKE '//%' THEN 'http:' || t "
        f"WHEN t LIKE '/%' THEN 'http://' || {p}host || t WHEN regexp_matches(t, '(?i)^[a-z][a-z0-9+.-]*:') THEN NULL "
        f"WHEN t LIKE '?%' THEN 'http://' || {p}host || {p}path || t "
        f"ELSE 'http://' || {p}host || regexp_extract(CASE WHEN {p}path = '' THEN '/' ELSE {p}path END, '(?s)^(.*/)', 1) || t END"
    )


OP2 = f"""
WITH RECURSIVE
rules(verdict, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                                ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
own AS (SELECT page_id, {_address('url', '')} FROM pages),
shown AS (SELECT url, regexp_replace(html, '(?s)<!--.*?(?:-->|\\z)', ' ', 'g') AS html FROM pages),
declared AS (
  SELECT url, list_filter(list_transform(regexp_extract_all(html, '(?is)<base\\b[^<>]*>'), lambda t: {_attribute('t', 'href')}), lambda h: h <> '')[1] AS base,
    list_concat(
      list_transform(list_filter(regexp_extract_all(html, '(?is)<link\\b[^<>]*>'),
        lambda t: list_contains(string_split_regex(lower({_attribute('t', 'rel')}), '\\s+'), 'canonical')), lambda t: {_attribute('t', 'href')}),
      list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\\b[^<>]*>'), lambda t: lower({_attribute('t', 'http-equiv')}) = 'refresh'),
        lambda t: regexp_extract(t, '(?is)\\burl\\s*=\\s*["'']?\\s*([^"''\\s<>]+)', 1))) AS targets FROM shown),
rooted AS (SELECT url, {_address('url', 'p_')}, replace(base, '&amp;', '&') AS t, targets FROM declared WHERE len(targets) > 0),
based AS (SELECT url, targets, coalesce({_against('p_')}, url) AS base FROM rooted),
raw AS (SELECT {_address('url', 'f_')}, {_address('base', 's_')}, replace(unnest(targets), '&amp;', '&') AS t FROM based),
resolved AS (SELECT f_key AS s_key, {_against('s_')} AS url FROM raw),
edges AS (SELECT DISTINCT s_key AS a, b_key AS b FROM (SELECT s_key, {_address('url', 'b_')} FROM resolved) WHERE s_key <> b_key),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
nodes AS (SELECT DISTINCT a AS node, {_address("('x://' || a)", 'n_')} FROM both_ways),
judged AS (
  SELECT node, arg_max(verdict, length(h) + length(p) + CASE verdict WHEN 'allow' THEN 0.5 ELSE 0 END) AS verdict
  FROM nodes JOIN rules ON (n_host = h OR suffix(n_host, '.' || h)) AND starts_with(n_path, p) GROUP BY node),
alias AS (SELECT r.a AS key, max(CASE verdict WHEN 'allow' THEN 1 ELSE 0 END) AS allow FROM reach r JOIN judged j ON r.b = j.node GROUP BY r.a),
best AS (
  SELECT page_id, max(struct_pack(n := length(h) + length(p), allow := CASE verdict WHEN 'allow' THEN 1 ELSE 0 END, rule := h || p)) AS m
  FROM own JOIN rules ON (host = h OR suffix(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT o.page_id, o.host, o.path, m.rule AS rule, CASE coalesce(m.allow, alias.allow, 1) WHEN 1 THEN 'allow' ELSE 'block' END AS verdict,
  CASE WHEN m IS NOT NULL THEN 'rule' WHEN alias.allow IS NOT NULL THEN 'alias' ELSE 'default' END AS reason
FROM own o LEFT JOIN best USING (page_id) LEFT JOIN alias ON alias.key = o.key
"""

OP5 = f"""
WITH n AS (SELECT doc_id, sha256({_ASCII_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
"""

OP8 = """
WITH RECURSIVE
v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda c: c IS NULL OR NOT isfinite(c))) = 0
        AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
          WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(least.b, vec_id)) AS kept
FROM embeddings LEFT JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""

OP9 = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
windows AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS h FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w)),
least AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (SELECT doc_id, list(i) AS starts FROM windows JOIN least USING (h) WHERE doc_id > least GROUP BY doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS pos FROM (SELECT doc_id, unnest(starts) AS s FROM gone)),
removed AS (SELECT doc_id, list(pos) AS pos, count(*) AS n FROM covered GROUP BY doc_id),
flat AS (SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM w),
kept AS (SELECT f.doc_id, sha256(string_agg(word, ' ' ORDER BY f.pos)) AS h FROM flat f ANTI JOIN covered c ON f.doc_id = c.doc_id AND f.pos = c.pos GROUP BY f.doc_id)
SELECT w.doc_id, len(words) AS n_words, coalesce(n, 0) AS n_removed, coalesce(h, sha256('')) AS kept_sha256
FROM w LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def _license_values() -> tuple[str, str]:
    """VALUES rows of the template k-grams (no, k, position, words) and of the templates (no, label, base, share, slack, words)."""
    import re

    from faregrid.llm.license_scan import GRAM_WORDS, SLACK, TEMPLATES

    grams, facts = [], []
    for no, t in enumerate(TEMPLATES):
        words = re.findall("[a-z0-9]+", t.text.lower())
        k = min(GRAM_WORDS, len(words))
        grams += [f"({no}, {k}, {i}, '{' '.join(words[i:i + k])}')" for i in range(len(words) - k + 1)]
        facts.append(f"({no}, '{t.label}', {t.base}, {t.share}, {0 if t.share >= 1 else SLACK}, {len(words)})")
    return ", ".join(grams), ", ".join(facts)


_GRAMS, _FACTS = _license_values()

OP11 = rf"""
WITH grams(no, k, tpos, gram) AS (VALUES {_GRAMS}), facts(no, label, base, needed, slack, m) AS (VALUES {_FACTS}),
t AS (SELECT row_number() OVER () AS r, doc_id,
      regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
flat AS (SELECT r, unnest(range(len(w))) AS pos, unnest(w) AS word FROM t),
runs AS (SELECT r, pos, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4 FROM flat WINDOW o AS (PARTITION BY r ORDER BY pos)),
spelled AS (SELECT r, pos, 1 AS k, word AS gram FROM runs UNION ALL SELECT r, pos, 2, word || ' ' || w2 FROM runs
            UNION ALL SELECT r, pos, 3, word || ' ' || w2 || ' ' || w3 FROM runs UNION ALL SELECT r, pos, 4, word || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs),
hits AS (SELECT r, no, k, tpos, pos, pos - tpos AS diagonal FROM spelled JOIN grams USING (k, gram)),
marked AS (SELECT r, no, diagonal, coalesce(CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, no ORDER BY diagonal) > slack THEN 1 ELSE 0 END, 1) AS apart
           FROM (SELECT DISTINCT r, no, diagonal FROM hits) JOIN facts USING (no)),
spans AS (SELECT r, no, diagonal, sum(apart) OVER (PARTITION BY r, no ORDER BY diagonal) AS span FROM marked),
ends AS (SELECT r, no, span, min(pos) AS first, max(pos + k) - min(pos) AS words FROM hits JOIN spans USING (r, no, diagonal) GROUP BY r, no, span),
covered AS (SELECT r, no, span, count(DISTINCT p) AS n
            FROM (SELECT r, no, span, unnest(range(tpos, tpos + k)) AS p FROM hits JOIN spans USING (r, no, diagonal)) GROUP BY r, no, span),
found AS (SELECT r, label, base, first, n / greatest(m, words) AS share FROM ends JOIN covered USING (r, no, span) JOIN facts USING (no)
          WHERE n / greatest(m, words) >= needed),
by_text AS (SELECT r, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
            FROM found GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
       coalesce(labels, '') AS labels, coalesce(score, 0) AS score
FROM t LEFT JOIN by_text USING (r)
"""


def _step(state: int, after: dict[str, int]) -> str:
    """Cheapest completions of a turn read in a state of ``(s?(ua)+)?`` (0 start, 1 after s, 2 after u, 3 after a), no insert first."""
    options = [f"{{c: s{state}.c + 2, a: 'D' || s{state}.a}}"]
    for letter, to in after.items():
        options.append(f"{{c: CASE WHEN fault IN ('blank', 'duplicate') OR initial <> '{letter}' THEN 1000000 ELSE s{to}.c + paid END, a: 'K' || s{to}.a}}")
        if letter != "s":
            options.append(f"{{c: CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 ELSE s{to}.c + paid + 1 END, a: 'R' || s{to}.a}}")
    return f"list_min([{', '.join(options)}])"


def _inserts(state: int, after: dict[str, int], then: int) -> str:
    """The same with up to two inserts first: more never pay."""
    one = after.get("u", after.get("a"))
    return f"list_min([g{state}, {{c: g{one}.c + 5, a: 'I' || g{one}.a}}, {{c: g{then}.c + 10, a: 'II' || g{then}.a}}])"


_GRAMMAR = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
_THEN = {0: 3, 1: 3, 2: 2, 3: 3}  # the state after two inserts
_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

# Suffix by suffix over the states of the grammar, not by target lengths.
OP12 = f"""
WITH RECURSIVE
crc AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
keyed AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
          list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT) AS b FROM conversations),
kinds AS (SELECT keyed.* EXCLUDE (b), xor(list_reduce(list_concat([4294967295], b), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 20 AS kind FROM keyed, crc),
damaged AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
            CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds WHERE kind <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS initial, rtrim(text, {_WHITE}) AS body FROM damaged),
judged AS (SELECT *, coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS bad,
           CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
           WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM placed),
rows_of AS (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS paid FROM judged),
facts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
          count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (bad) AS illegal, count(*) AS n
          FROM rows_of GROUP BY conv_id),
f(conv_id, i, s0, s1, s2, s3) AS (
  SELECT conv_id, n + 1, {{c: 0, a: ''}}, {{c: 10, a: 'II'}}, {{c: 5, a: 'I'}}, {{c: 0, a: ''}} FROM facts
  UNION ALL
  SELECT conv_id, i, {', '.join(_inserts(s, a, _THEN[s]) for s, a in _GRAMMAR.items())}
  FROM (SELECT f.conv_id, r.i, {', '.join(f'{_step(s, a)} AS g{s}' for s, a in _GRAMMAR.items())}
        FROM f JOIN rows_of r ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND r.i = f.i - 1)),
audits AS (SELECT conv_id, s0.c AS cost, s0.a AS audit FROM f WHERE i = 1),
letters AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS k, unnest(string_split(audit, '')) AS e FROM audits WHERE audit <> ''),
puts AS (SELECT conv_id, k, e, count(*) FILTER (e <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i,
            count(*) FILTER (e <> 'D') OVER (PARTITION BY conv_id ORDER BY k DESC) AS ahead FROM letters),
mended AS (SELECT p.conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN ahead % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END,
           chr(10) ORDER BY k) AS body FROM puts p JOIN rows_of r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = greatest(p.i, 1) WHERE e <> 'D' GROUP BY p.conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN facts ON facts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits ON audits.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN mended ON mended.conv_id IS NOT DISTINCT FROM o.conv_id
"""

ORACLES: dict[str, str] = {
    "op2_url_filters": OP2,
    "op5_exact_dedup": OP5,
    "op8_embedding_dedup": OP8,
    "op9_substring_dedup": OP9,
    "op11_license_scan": OP11,
    "op12_turn_repair": OP12,
}
