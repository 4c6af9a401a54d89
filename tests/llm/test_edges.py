"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from faregrid.llm import (components, embedding_dedup, exact_dedup, language_id, lm, mixing, packing, simhash_dedup, substring_dedup, textops, toxicity,
                          url_filter)
from faregrid.llm.common import fold
from faregrid.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, label string, size long, taken long, _text string"
LONG = " ".join(f"word{i % 997}" for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))


def row(i, text, lang="en", source="a"):
    return (i, text, lang, source, 1, 5, "x", 9, 9, "t")


ROWS = [
    row(1, None), row(2, ""), row(3, " \t\n"), row(4, "One two three four"), row(5, "ONE two three four"), row(5, "ONE two three four"),
    row(None, "one two three four"), row(None, "nothing else like it here", None, None), row(6, LONG, "de", "b"), row(7, f"before {PASSAGE} after", None, None),
    row(8, f"other {PASSAGE}", "fr", "b"), row(9, "É é", "fr", "b"), row(10, "é É", "fr", "b"), row(11, "word"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def got(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def test_exact_dedup(docs, none):
    rows = got(exact_dedup.decide(docs))
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert (by[1]["keep_id"], by[2]["kept"], by[2]["group_size"]) == (2, True, 2)
    assert (by[4]["keep_id"], by[4]["group_size"], by[5]["kept"]) == (5, 4, True)
    assert by[9]["keep_id"] == 9  # only A-Z is lower-cased
    assert sorted(r["kept"] for r in rows if r["doc_id"] is None) == [False, True]
    kept = got(exact_dedup.keep_one(docs))
    assert sorted(r["doc_id"] or 0 for r in kept) == [0, 2, 3, 5, 6, 7, 8, 9, 10, 11] and set(kept[0]) == set(docs.columns)
    assert got(exact_dedup.decide(none)) == [] and got(exact_dedup.keep_one(none)) == []


def test_exact_dedup_compares_contents_of_equal_digests(docs):
    same = [(r["doc_id"], r["keep_id"], r["group_size"]) for r in got(exact_dedup.decide(docs))]
    clash = [(r["doc_id"], r["keep_id"], r["group_size"]) for r in got(exact_dedup.decide(docs, digest=lambda t: F.unhex(F.substring(F.sha2(t, 256), 1, 1))))]
    key = lambda x: tuple(v or -1 for v in x)
    assert sorted(same, key=key) == sorted(clash, key=key)


def test_simhash_dedup(docs, none):
    rows = got(simhash_dedup.near_duplicates(docs))
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by[1]["fingerprint"] == by[3]["fingerprint"] == "0" * 16 and by[3]["component_id"] == 1
    assert by[5]["component_id"] == 4
    kept = got(simhash_dedup.keep_one(docs))
    assert {1, 4, 6, 9, 11} <= {r["doc_id"] for r in kept} and not {2, 3, 5} & {r["doc_id"] for r in kept}
    assert got(simhash_dedup.near_duplicates(none)) == [] and got(simhash_dedup.keep_one(none)) == []


def test_simhash_keeps_one_row_of_each_component(spark, docs):
    assert [r["text"] for r in got(simhash_dedup.keep_one(docs)) if r["doc_id"] is None] == ["nothing else like it here"]
    rows = [(None, "alpha beta gamma delta"), (None, "ALPHA beta gamma delta"), (None, "one two three four"), (4, "ONE two three four"),
            (5, "red green blue white"), (5, "one TWO three four"), (6, "sun moon star sky"), (6, "SUN moon star sky"), (6, "SUN moon star sky"),
            (9, "oak elm ash yew"), (9, "oak elm ash yew")]
    kept = got(simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted((r["doc_id"] or 0, r["text"].lower()) for r in kept) == [
        (0, "alpha beta gamma delta"), (4, "one two three four"), (5, "red green blue white"), (6, "sun moon star sky"), (9, "oak elm ash yew")]


@pytest.mark.parametrize("bits", [0, 1, 2, 3])
def test_simhash_links_connect_as_all_pairs_do(spark, bits):
    import numpy as np

    rng = np.random.default_rng(bits)
    base = rng.integers(0, 2**63, 20, dtype=np.uint64)
    fps = {int(b) ^ sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 6), replace=False)) for b in base for _ in range(30)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    found = components.connected_components(simhash_dedup.links(spark.createDataFrame([(x,) for x in signed], "fp long"), bits))
    label = {r["node"]: r["component"] for r in found.collect()}
    up = {x: x for x in signed}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= bits:
                x, y = sorted((root(a), root(b)))
                up[y] = x
    assert all(label.get(x, x) == root(x) for x in signed)


def test_substring_dedup(docs, none):
    rows = got(substring_dedup.remove_repeats(docs))
    assert len(rows) == len(ROWS)
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    assert by[8]["n_removed"] == 60 and by[8]["repeats"] == [{"start": 1, "words": 60}] and by[7]["n_removed"] == 0
    assert by[6]["n_words"] == 30_000 and by[6]["n_removed"] == 0 and by[1]["n_words"] == 0
    assert got(substring_dedup.remove_repeats(none)) == []


def test_substring_dedup_of_one_id_with_two_texts(spark):
    clean = " ".join(f"c{i}" for i in range(200))
    rows = [(1, PASSAGE), (2, f"{clean} {PASSAGE} end"), (2, clean), (2, "short"), (2, f"{clean} {PASSAGE} end")]
    found = got(substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert sorted((r["doc_id"], r["n_words"], r["n_removed"], str(r["repeats"])) for r in found) == [
        (1, 60, 0, "[]"), (2, 1, 0, "[]"), (2, 200, 0, "[]"), *[(2, 261, 60, "[{'start': 200, 'words': 60}]")] * 2]


def test_packing(docs, none):
    rows = got(packing.pack(docs, tokenizer_path()))
    assert sum(r["doc_id"] == 1 for r in rows) == 1 and sum(r["doc_id"] == 5 for r in rows) == 2
    ends = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 4096 and len(ends) == -(-sum(r["length"] for r in rows) // 4096)
    assert got(packing.pack(none, tokenizer_path())) == []


def test_stages_keep_columns_of_any_name(spark):
    names = ["col", "_id", "_times", "_d", "_k", "_kept", "_kept_text", "_rows", "_scored", "_source", "own_0", "OWN_1", "own_2"]
    rows = [(1, "one two three four five", "a", *range(13)), (2, "ONE two three four five", "a", *range(13, 26)), (2, "ONE two three four five", "a", *range(13, 26)),
            (None, "another text altogether it is", None, *range(13))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` long" for n in names))
    sure = toxicity.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    for kept in (mixing.repeat_taken(docs), exact_dedup.keep_one(docs), simhash_dedup.keep_one(docs), toxicity.keep_clean(docs, sure)):
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.collect()} <= set(rows) and kept.count() > 0


def test_word_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    whole, words = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())
    for text in ["Don't stop, it's 5.5% <|endoftext|>x", "Été été ÉTÉ, naïve. İstanbul ΟΔΟΣ, ½ ²x", "a b\x1cc ... ,, .,", "Kelvin ﬁ. 中文, 日本."]:
        assert [i for w in text.encode().split() for i in words[w.decode()]] == whole.encode(text, add_special_tokens=False).ids


def test_mixing(docs, none):
    rows = got(mixing.mix_by_source(docs))
    assert len(rows) == len(ROWS) and all(0 <= r["taken"] <= 2 * r["size"] for r in rows)
    assert rows == got(mixing.mix_by_source(docs))
    assert got(mixing.mix_by_source(none)) == [] and got(mixing.repeat_taken(none)) == []
    assert set(got(mixing.repeat_taken(docs))[0]) == set(docs.columns)


def test_mixing_overlapping_sources(spark):
    sized = spark.createDataFrame([(i, ["x", "y"] if i % 3 == 0 else ["x"] if i % 3 == 1 else ["y"], 10) for i in range(300)], "doc_id long, sources array<string>, size long")
    mixed, _, _ = mixing.mix(sized, targets={"x": 1500.0, "y": 1500.0})
    assert mixed.agg(F.sum("taken")).first()[0] == 3000 and mixed.filter("taken > 20").count() == 0
    # y can only be met from the shared documents, so all of x comes from x alone
    flow = mixing.min_cost_flow([10, 10], [[0, 1], [0]], [10, 10])
    assert flow == [{1: 10}, {0: 10}]


@pytest.mark.parametrize("seed", range(3))
def test_mixing_goes_on_past_a_row_that_does_not_fit(spark, seed):
    sizes = [600_000, *(100 + i * 37 % 301 for i in range(999))]
    sized = spark.createDataFrame([(i, ["x"], n) for i, n in enumerate(sizes)], "doc_id long, sources array<string>, size long")
    mixed, _, _ = mixing.mix(sized, targets={"x": 200_000.0}, max_repeats=1, seed=seed)
    rows = got(mixed)
    assert all(r["taken"] in (0, r["size"]) for r in rows)
    assert abs(sum(r["taken"] for r in rows) - 200_000) <= 50  # half the smallest row


def test_mixing_rounds_are_few_and_end_with_no_row_that_fits(spark):
    # in any order small rows stand between ones that almost fill the gap; an id that repeats counts with all its rows
    sizes = {i: 1 if i % 2 else 4000 - i for i in range(200)}
    rows = [(i, ["x"], n) for i, n in sizes.items()] + [(1000, ["x"], 30)] * 5 + [(None, ["x"], 7)] * 4
    sized = spark.createDataFrame(rows, "doc_id long, sources array<string>, size long")
    for want, off in ((150, 25), (3950, 25), (50_000, 2000)):  # at the last, half of a large row
        mixed, _, _ = mixing.mix(sized, targets={"x": float(want)}, max_repeats=1)
        found = got(mixed)
        assert abs(sum(r["taken"] for r in found) - want) <= off
        for same in (1000, None):
            assert len({r["taken"] > 0 for r in found if r["doc_id"] == same}) == 1


def test_lm(docs, none):
    part = fold("doc_id", 10)
    rows = got(lm.score(docs, part != 0, part == 1))
    assert len(rows) == len(ROWS) and {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert all(r["score"] < 0 for r in rows)
    assert got(lm.score(none, part != 0, part == 1)) == []


def test_lm_blocks_follow_the_text(spark, monkeypatch):
    """A large partition is several blocks, and its n-grams fall in many ranges; the scores are those of one block."""
    rows = [(None if i % 50 == 0 else i % 170, None if i % 41 == 0 else " ".join(f"w{(i * k) % (7 + i % 90)}" for k in range(60))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    part, made = fold("doc_id", 10), []
    real = lm.materialize
    monkeypatch.setattr(lm, "materialize", lambda df, name, **options: made.append(real(df, name, **options)) or made[-1])
    key = lambda r: (r["doc_id"] or -1, r["n_tokens"], r["score"])
    whole = sorted(got(lm.score(df, part != 0, part == 1)), key=key)
    assert made[0].filter("kind = 2").count() == 1
    made.clear()
    monkeypatch.setattr(lm, "BLOCK_BYTES", 5_000)
    monkeypatch.setattr(lm, "RANGE_BYTES", 1_000)
    split = sorted(got(lm.score(df, part != 0, part == 1)), key=key)
    assert made[0].filter("kind = 2").count() >= 8 and made[0].filter("kind = 1").groupBy("block").max("n").agg({"max(n)": "max"}).first()[0] < 200
    assert len(whole) == len(split) == 300
    for a, b in zip(whole, split):
        assert a == b


def test_lm_probabilities_sum_to_one():
    import numpy as np

    w = lm.learn_weights(np.array([3, 3]), np.array([[0.5, 0.1, 1e-3], [0.0, 0.2, 1e-3]]), np.array([10.0, 5.0]))
    assert np.allclose(w.sum(1), 1) and (w[:, 2] > 0).all() and w[0, 0] == 0


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(4, 1), (4, 0), (9, 0), (None, 1), (11, None)], "doc_id long, toxic int")
    for source in (docs, none):
        model = toxicity.fit(source, labels)
        assert len(got(toxicity.score(source, model))) == source.count()
        assert set(toxicity.keep_clean(source, model).columns) == set(docs.columns)
    many = spark.createDataFrame([(i, f"Plain words here. {'You utter scoundrel' if i % 4 == 0 else 'A kind remark'} today.\nThe end {i}") for i in range(400)], "doc_id long, text string")
    model = toxicity.fit(many, many.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    for r in got(toxicity.score(many.union(spark.createDataFrame([(None, None), (None, "")], "doc_id long, text string")), model)):
        toxic = r["doc_id"] is not None and r["doc_id"] % 4 == 0
        assert (r["score"] >= 0.7) == toxic and [s["sentence"] for s in r["offending"]] == [1] * toxic and (r["n_sentences"] > 0 or r["score"] == 0)


DECLARED = [
    # (address, html, targets as resolved)
    ("http://a.net/x/1", '<link rel="nofollow canonical" href="/one"><LINK href=two REL=canonical>', ["a.net/one", "a.net/x/two"]),
    ("http://a.net/x/2", "<base target=_top><base href='http://b.com/de/'><base href=/no><link rel=canonical href='3'>", ["b.com/de/3"]),
    ("http://a.net/x/3", "<base href='/y/z'><meta http-equiv=\"refresh\" content=\"0; url=w\"><meta content='1;URL=v?a=1&amp;b=2' http-equiv=Refresh>",
     ["a.net/y/w", "a.net/y/v?a=1&b=2"]),
    ("http://a.net/x/4", "<!-- <link rel=canonical href=/no> --><link rel='canonical' href=' /yes '><!-- <link rel=canonical href=/open>", ["a.net/yes"]),
    ("http://a.net/x/5", "<link rel=canonicals href=/no><link data-rel=canonical href=/no><link rel=alternate href=/no><a rel=canonical href=/no>", []),
    ("http://a.net/x/6", "<link rel=canonical href='?q'><link rel=canonical href='#top'><link rel=canonical href='mailto:x'><link rel=canonical>", ["a.net/x/6?q"]),
]


def test_every_declared_link_counts(spark):
    pages = spark.createDataFrame([(u, h) for u, h, _ in DECLARED] + [("none", None), (None, "<link rel=canonical href='http://q.org/'>")], "url string, html string")
    found = url_filter.declared_links(pages)
    for url, _, targets in DECLARED:
        got_ = sorted(r["to_url"].split("://")[1] for r in found.filter(F.col("from_url") == url).collect() if r["to_url"])
        assert got_ == sorted(targets), url
    # a block carried over the second canonical link, and over a base address
    pages = spark.createDataFrame([(1, "http://m.io/1", '<link rel=canonical href=/o><link rel="x canonical" href="http://s.com/de/9">'),
                                   (2, "http://m.io/2", "<base href=http://s.com/de/><link rel=canonical href=7>"), (3, "http://m.io/3", "<!--<link rel=canonical href=http://s.com/de/>-->")],
                                  "page_id long, url string, html string")
    assert {r["page_id"]: (r["verdict"], r["reason"]) for r in got(url_filter.judge(pages))} == {1: ("block", "alias"), 2: ("block", "alias"), 3: ("allow", "default")}


def test_declared_links_against_sql(spark, tmp_path):
    """The query's SQL over pages that declare links."""
    import duckdb

    from faregrid.llm.oracles import ORACLES

    pages = spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(DECLARED)] + [(90, "http://b.com/de/3", ""), (91, "http://a.net/one", "<link rel=canonical href=http://k.com/fr/1>")],
                                  "page_id long, url string, html string")
    mine = {tuple(r[c] for c in ("page_id", "host", "path", "rule", "verdict", "reason")) for r in got(url_filter.judge(pages))}
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", [tuple(r) for r in pages.collect()])
    assert mine == {tuple(r) for r in con.execute(f"SELECT page_id, host, path, rule, verdict, reason FROM ({ORACLES['op2_url_filters']})").fetchall()}
    assert {r[0] for r in mine if r[4] == "block"} == {1, 90}


def test_url_filter_aliases(spark):
    page = lambda i, url, html="": (i, url, html, "extra")
    pages = spark.createDataFrame([
        page(1, "http://a.example.org/es/1", "<link href='http://MIRROR.net/x?a=1&amp;b=2#f' rel=canonical>"), page(2, "https://mirror.net/x?a=1&b=2"),
        page(3, "http://m.net/y", '<meta http-equiv="Refresh" content="0; url=/z">'), page(4, "http://m.net/z", '<link rel="canonical" href="//shop.com/de/1">'),
        page(5, "http://n.net/", '<link rel="canonical" href="http://shop.com/de/2">'), page(6, "http://n.net", '<link rel="canonical" href="http://good.org/a">'),
        page(7, None), page(8, "no scheme"), page(9, "http://example.org", None), page(9, "http://example.org", None), page(None, "http://x.com:80/fr/"),
    ], "page_id long, url string, html string, verdict string")
    by = {r["page_id"]: r for r in got(url_filter.judge(pages))}
    said = {i: (r["verdict"], r["reason"]) for i, r in by.items()}
    assert said[1] == ("block", "rule") and said[2] == ("block", "alias")
    assert said[3] == ("block", "alias") and said[4] == ("block", "alias")
    assert said[5] == ("allow", "alias") and said[6] == ("allow", "alias")  # an explicit allow comes first
    assert said[7] == said[8] == said[9] == ("allow", "default") and by[7]["host"] == by[8]["path"] == ""
    assert by[None]["host"] == "x.com:80" and said[None] == ("allow", "default")
    assert len(got(url_filter.judge(pages))) == 11 and got(url_filter.judge(pages.limit(0))) == []
    more = spark.createDataFrame([("http://u.net/", "http://b.example.org/es/")], "from_url string, to_url string")
    extra = spark.createDataFrame([page(1, "http://u.net/")], pages.schema)
    assert got(url_filter.judge(extra, redirects=more))[0]["verdict"] == "block"


def test_embeddings(spark):
    unit = lambda *x: [float(v) for v in x]
    rows = [(1, unit(1, 0, 0, 0), 1), (2, unit(2, 0, 0, 0), 1), (2, unit(2, 0, 0, 0), 1), (3, unit(1, 0, 0, 0.05), 1), (4, unit(1, 0, 0, 0), 2), (5, unit(0, 0, 0, 0), 1),
            (6, None, 1), (7, unit(1, 0, 0, 0), None), (8, [1.0, None, 0.0, 0.0], 1), (9, unit(float("nan"), 0, 0, 1), 1), (10, unit(1, 0), 1), (11, [], 1), (None, unit(1, 0, 0, 0), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("class", F.lit(3))
    found = got(embedding_dedup.near_duplicates(df))
    by = {r["vec_id"]: r for r in found}
    assert len(found) == len(rows) and by[1]["n_links"] == by[2]["n_links"] == by[3]["n_links"] == 4
    assert by[3]["component_id"] == 1 and by[1]["kept"] and not by[2]["kept"]
    assert all(by[i]["n_links"] == 0 and by[i]["component_id"] == i for i in (4, 5, 6, 7, 8, 9, 10, 11))
    assert got(embedding_dedup.near_duplicates(df.limit(0))) == []


def test_embedding_cells_visited_nearest_first():
    rng = np.random.default_rng(3)
    unit = embedding_dedup._units(rng.standard_normal((300, 8)))
    index = embedding_dedup.fit_index(unit, 4000, 0.9, 0.99)
    first, second = index.moves(unit)
    far = first[:, :, None] + second[:, None]  # every cell of the grid
    rows, cells = index.visits(unit)
    for v in range(len(unit)):
        mine = cells[rows == v]
        assert sorted(mine) == sorted(np.flatnonzero(far[v].ravel() <= index.reach))
        assert (np.diff(far[v].ravel()[mine]) >= 0).all() and index.homes(unit[v : v + 1])[0] in mine


def test_embedding_hot_cell_in_blocks(spark):
    rng = np.random.default_rng(4)
    hot = np.eye(6)[0] + 0.05 * rng.standard_normal((150, 6))  # nearly all in one cell
    vectors = np.concatenate([hot, rng.standard_normal((50, 6))])
    df = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, label int")
    unit = embedding_dedup._units(vectors)
    want = ((unit @ unit.T >= 0.98).sum(1) - 1).tolist()
    by = {r["vec_id"]: r["n_links"] for r in got(embedding_dedup.near_duplicates(df, recall=1.0, block_rows=16))}
    whole = {r["vec_id"]: r["n_links"] for r in got(embedding_dedup.near_duplicates(df, recall=1.0))}
    assert by == whole and sum(want) > 1000
    assert sum(by.values()) >= 0.99 * sum(want) and all(by[i] <= n for i, n in enumerate(want))


def test_language_id(docs, none, spark):
    names, table = language_id.fit_text(docs)
    assert names == ["de", "en", "fr"]
    found = got(language_id.identify(docs.select("doc_id", "text").withColumns({"host": F.lit(None).cast("string"), "markup": F.lit(None).cast("string")}), names, table))
    assert len(found) == len(ROWS) and all(r["lang"] in names for r in found)
    pages = spark.createDataFrame([(1, None, None), (2, "http://x.de/", "<html lang='fr'><p>"), (2, "", "")], "page_id long, url string, html string")
    assert len(got(language_id.identify_tables(docs, pages))) == len(ROWS) + 3
    assert got(language_id.identify_tables(none, pages.limit(0))) == []


def test_language_id_learns_from_all_labelled_rows(spark, none):
    texts = [("de", "der Hund und die Katze schlafen noch"), ("en", "the dog and the cat are asleep")] * 40
    # only documents that a fold by ten would leave out have a label
    held = spark.range(2000).select(F.col("id").alias("doc_id")).filter(fold("doc_id", 10) == 0).limit(80).collect()
    few = spark.createDataFrame([(r["doc_id"], text, lang, "a") for r, (lang, text) in zip(held, texts)], "doc_id long, text string, lang string, source string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    said = {r["doc_id"]: r["text_lang"] for r in got(language_id.identify_tables(few, pages))}
    assert said == {r["doc_id"]: lang for r, (lang, _) in zip(held, texts)}
    assert {r["lang"] for r in got(language_id.identify_tables(few, pages, held_out=fold("doc_id", 10) == 0))} == {None}


def test_components(spark):
    chain = [(i, i + 1) for i in range(200)] + [(300 + i, 299) for i in range(1, 50)] + [(7, 7), (None, 3), (500, 501), (500, 501)]
    found = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert {found[i] for i in range(201)} == {0} and {found[300 + i] for i in range(1, 50)} == {299} and found[501] == 500 and len(found) == 201 + 50 + 2


def test_hash_spans():
    import numpy as np
    import xxhash

    data = bytes(range(256)) * 3
    starts, ends = np.arange(300), np.arange(300) + np.arange(300) % 70
    assert textops.hash_spans(np.frombuffer(data, np.uint8), starts, ends).tolist() == [xxhash.xxh64_intdigest(data[a:b], 42) for a, b in zip(starts, ends)]


def test_pipeline_stages_keep_the_columns(spark, docs, none):
    labels = "/root/testdata/sf0.001"
    for frame in (docs, none):
        now = frame
        for name, stage in corpus_pipeline.STAGES:
            now = stage(spark, now, labels)
            if name != "best_fit_packing":
                assert now.columns == frame.columns
        now.count()


@pytest.fixture(scope="module")
def clustered(spark):
    """2,000 vectors in single precision, of which 400 lie around one and 300 around others; some come twice."""
    rng = np.random.default_rng(11)
    x = rng.standard_normal((2000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    of = np.concatenate([np.zeros(400, int), np.repeat(np.arange(1, 101), 3)])
    x[1300:] = x[of] + rng.standard_normal((700, 32)) * 0.012
    x = np.concatenate([x, x[1290:1310]]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), f"l{i % 2}") for i, v in enumerate(x)], "vec_id long, embedding array<float>, label string")
    unit = embedding_dedup._units(x)
    same = (unit @ unit.T >= embedding_dedup.MIN_COSINE) & (np.arange(len(x))[:, None] % 2 == np.arange(len(x)) % 2)
    return df, same.sum(1) - 1


def test_embedding_tables_hold_a_few_copies_of_the_vectors(clustered, monkeypatch):
    df, want = clustered
    written = []
    real = embedding_dedup.materialize

    def spy(frame, name, **options):
        out = real(frame, name, **options)
        cells = [f.name for f in out.schema if f.dataType.simpleString().startswith("array<")]
        written.append((name, out.count() if cells else 0))
        return out

    monkeypatch.setattr(embedding_dedup, "materialize", spy)
    found = got(embedding_dedup.near_duplicates(df, recall=1.0))
    assert [r["n_links"] for r in sorted(found, key=lambda r: r["vec_id"])] == want.tolist()
    assert sum(n for _, n in written) <= 2 * df.count(), written


def test_embedding_rounds_and_equal_hashes(clustered, monkeypatch):
    df, want = clustered
    monkeypatch.setattr(embedding_dedup, "ROUND_COPIES", 0.5)
    monkeypatch.setattr(embedding_dedup, "_TILE", 7)
    monkeypatch.setattr(embedding_dedup, "_digest", lambda vec: F.size(vec).cast("long"))
    found = got(embedding_dedup.near_duplicates(df, recall=1.0, block_rows=64))
    assert [r["n_links"] for r in sorted(found, key=lambda r: r["vec_id"])] == want.tolist()
