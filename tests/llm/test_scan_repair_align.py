"""License scan, conversation repair and token alignment against brute force, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from faregrid.llm import license_scan, queries, token_alignment, turn_repair
from faregrid.llm.common import materialize
from faregrid.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, tokenizer_path

SF = "/root/testdata/sf0.001"
NAMES = "licenses string, id long, key long, t_no int, pos int, turns string, row long, pair long, copy int, at int, c long, n long"
CLASH = ("x", 1, 2, 3, 4, "y", 5, 6, 7, 8, 9, 10)


def got(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def docs_of(spark, rows):
    return spark.createDataFrame([(*r, *CLASH) for r in rows], f"doc_id long, text string, {NAMES}")


# --- license scan ------------------------------------------------------------

SCAN_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return SCAN_WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def places(text):
    w = words(text)
    out = []
    for t in license_scan.PHRASES:
        p = t.text.split()
        out += [(i, t.label) for i in range(len(w)) if w[i : i + len(p)] == p]
    return sorted(out)


def check_base(rows, texts):
    for r, text in zip(rows, texts):
        found = places(text)
        assert r["n_words"] == len(words(text)) and r["n_base"] == len(found)
        assert r["first_word"] == (found[0][0] if found else None) and r["last_word"] == (found[-1][0] if found else None)
        assert r["base_labels"] == ",".join(sorted({label for _, label in found}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
        assert (r["score"] > 0) == bool(r["labels"])


def test_license_query(spark):
    texts = {d["doc_id"]: d["text"] for d in pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pylist()}
    rows = got(queries.QUERIES["op11_license_scan"](spark, "/root/testdata/sf0.01"))
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    check_base(rows, [texts[r["doc_id"]] for r in rows])
    assert sum(r["n_base"] for r in rows) > 20


def notice(label):
    return next(t.text for t in license_scan.NOTICES if t.label == label and t.share < 1)


def test_license_notices_with_changes(spark):
    bsd = notice("bsd").split()
    texts = [
        "x " * 50 + " ".join(bsd),  # word for word
        " ".join([*bsd[:9], "changed", *bsd[10:]]),  # one word changed
        " ".join([*bsd[:9], "three", "more", "words", *bsd[9:]]) + " y" * 9,  # words put in: a neighbouring diagonal
        " ".join(bsd[:9]) + " z" * 60 + " " + " ".join(bsd[9:]),  # too far apart
        "\n * ".join(" ".join(bsd[i : i + 4]) for i in range(0, len(bsd), 4)),  # wrapped in a comment
        " ".join(bsd[:12]),  # too short a part
        f"{' '.join(bsd)}\n\n{' '.join(bsd)}",  # twice
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ]
    rows = {r["doc_id"]: r for r in got(license_scan.scan(docs_of(spark, list(enumerate(texts)))))}
    spans = {i: [(s["label"], s["first"]) for s in r["licenses"]] for i, r in rows.items()}
    assert spans[0] == [("bsd", 50)] and spans[4] == [("bsd", 0)] and spans[6] == [("bsd", 0), ("bsd", len(words(notice("bsd"))))]
    assert spans[1] == spans[2] == [("bsd", 0)] and spans[3] == spans[5] == []
    n = len(words(notice("bsd")))
    assert rows[1]["licenses"][0]["share"] == pytest.approx((n - 1) / n) and rows[2]["licenses"][0]["share"] == pytest.approx(n / (n + 3))
    assert [label for label, _ in spans[7]] == ["lgpl"]  # the gpl notice is taken word for word only


def test_license_edges(spark):
    long = "mit license " * 700 + "é" * 3000 + " apache  license"
    texts = [None, "", " \n", "MIT", "MIT License", "MIT-LICENSE mit\x00license MITé license", "mit license", "mit license", "cc by cc by by cc", long, "GNU general\npublic LICENSE."]
    ids = [1, 2, 3, 4, 5, 6, 7, 7, None, 9, None]
    docs = docs_of(spark, list(zip(ids, texts)))
    rows = got(license_scan.digest(license_scan.scan(docs)))
    key = lambda i, n: (i or 0, n)
    assert sorted(key(r["doc_id"], r["n_words"]) for r in rows) == sorted(key(i, len(words(t))) for i, t in zip(ids, texts))
    by = {r["doc_id"]: r for r in rows if r["doc_id"]}
    check_base([by[i] for i in (1, 2, 3, 4, 5, 6, 7, 9)], [texts[ids.index(i)] for i in (1, 2, 3, 4, 5, 6, 7, 9)])
    assert sum(r["doc_id"] == 7 and r["n_base"] == 1 for r in rows) == 2
    assert sorted(r["labels"] for r in rows if r["doc_id"] is None) == ["cc-by", "gpl"]
    # a long text by stretches: spans reach over their borders
    cut = {r["doc_id"]: r for r in got(license_scan.digest(license_scan.scan(docs.filter("doc_id is not null"), stretch=64)))}
    assert cut == by
    assert got(license_scan.digest(license_scan.scan(docs.limit(0)))) == []
    assert {r["labels"] for r in got(license_scan.digest(license_scan.scan(docs, [])))} == {""}


def test_license_hash_collisions_are_no_hits(spark, monkeypatch):
    import numpy as np

    docs = docs_of(spark, [(1, "one two three four five six"), (2, "mit license")])
    known, sizes = license_scan.template_grams(spark, license_scan.PHRASES)
    same = known.withColumn("t_gram", F.lit(7).cast("long"))
    grams = license_scan.text_grams(docs, sizes).withColumn("gram", F.when(F.col("gram").isNotNull(), F.lit(7).cast("long")))
    monkeypatch.setattr(license_scan, "template_grams", lambda *a: (same, sizes))
    monkeypatch.setattr(license_scan, "text_grams", lambda *a: grams)
    rows = {r["doc_id"]: r for r in got(license_scan.digest(license_scan.scan(docs, license_scan.PHRASES)))}
    assert rows[1]["labels"] == "" and rows[2]["labels"] == "mit" and np.isclose(rows[2]["score"], 1)


# --- conversation repair -----------------------------------------------------


def cheapest(turns):
    """Least (cost, audit), by completions over the states of the grammar: start, after s, after u, after a."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "")] if i == len(turns) and state in (0, 3) else []
        if inserts < 3:
            for letter, to in after[state].items():
                if letter != "s":
                    c, a = best(i, to, inserts + 1)
                    found.append((c + 5, "I" + a))
        if i < len(turns):
            t = turns[i]
            c, a = best(i + 1, state, 0)
            found.append((c + 2, "D" + a))
            for letter, to in after[state].items() if t != "x" else ():
                c, a = best(i + 1, to, 0)
                paid = 5 * t.isupper()
                if t.lower() == letter:
                    found.append((c + paid, "K" + a))
                if letter != "s":
                    found.append((c + paid + 1, "R" + a))
        return min(found, default=(10**6, ""))

    return best(0, 0, 0)


def test_align_is_the_cheapest_repair():
    rng = random.Random(3)
    cases = ["", "s", "S", "u", "a", "x", "su", "sa", "ss", "oo", "uuuu", "aaaa", "sasasa", "UAUA", "xsxux", "uaxxua"]
    cases += ["".join(rng.choice("suaoSUAOxuaua") for _ in range(rng.randrange(1, 13))) for _ in range(3000)]
    for t in cases:
        assert turn_repair.align(t) == cheapest(t), t


def test_align_long_conversations():
    rng = random.Random(5)
    for n in (200, 400):
        turns = ["ua"[i % 2] for i in range(n)]
        for _ in range(n // 8):
            turns[rng.randrange(n)] = rng.choice("xUAuas")
        t = "s" + "".join(t for t in turns if rng.random() > 0.05)
        import sys

        sys.setrecursionlimit(20_000)
        assert turn_repair.align(t) == cheapest(t)


def brute_repair(rows):
    """Contract of the query, written out for the damaged rows of one conversation."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, codes, count = set(), "", Counter()
    for _, role, text in rows:
        body = text.rstrip(" \t\n\v\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        count[fault] += 1
        kind = role[0] if role[:1] in ("s", "u", "a") else "o"
        codes += "x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
    illegal = sum(x[1][:1] + y[1][:1] not in ("su", "ua", "au") for x, y in zip(rows, rows[1:]))
    cost, audit = cheapest(codes)
    lines, i, left = [], 0, sum(a != "D" for a in audit)
    for a in audit:
        role, text = (None, "") if a == "I" else rows[i][1:]
        if a != "D":
            lines.append(f"{role if a == 'K' else ('assistant', 'user')[left % 2 == 0]}:{text}")
        left -= a != "D"
        i += a != "I"
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return {"gaps": gaps, **{f: count[f] for f in ("blank", "duplicate", "truncated")}, "illegal": illegal, "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest()}


def brute_damage(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        conv_, turn_, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        kind = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[conv] += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def check_repair(rows, found):
    damaged = brute_damage(rows)
    assert {r["conv_id"] for r in found} == {r[0] for r in rows} and len(found) == len({r[0] for r in rows})
    for r in found:
        assert {k: v for k, v in r.items() if k != "conv_id"} == brute_repair(damaged[r["conv_id"]])


def test_repair_query(spark):
    rows = [tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in pq.read_table("/root/testdata/sf0.01/conversations.parquet").to_pylist()]
    check_repair(rows, got(queries.QUERIES["op12_turn_repair"](spark, "/root/testdata/sf0.01")))


def test_repair_edges(spark):
    rows = [(1, None, "user", "a."), (1, None, "assistant", "b."), (1, 3, "user", None), (1, 3, "user", None), (2, 1, None, "x."), (2, 2, "", "y."),
            (2, 2, "", "y."), (3, 1, "system", "only one"), (None, 1, "user", "q?"), (None, 2, "assistant", "r! \n"), (None, 9, "user", ""),
            (5, 1, "user", "long " * 50_000), (5, 2, "assistant", "."), (6, 7, "assistant", "."), (6, 7, "user", "é."), (6, 8, "tool", "t."),
            (7, 1, "user", "same."), (7, 1, "user", "same."), (7, 1, "user", "same.")]
    rows += [(8, i, ("user", "assistant")[i % 2], f"turn {i}.") for i in range(60)]
    frame = spark.createDataFrame([(*r, *CLASH) for r in rows], f"conv_id long, turn long, role string, text string, {NAMES}")
    check_repair(rows, got(turn_repair.repair_all(frame, turn_repair.damage(frame))))
    empty = frame.limit(0)
    assert got(turn_repair.repair_all(empty, turn_repair.damage(empty))) == [] and got(turn_repair.repair(empty)) == []
    # every row dropped
    gone = got(turn_repair.repair_all(frame, turn_repair.damage(empty)))
    assert {(r["gaps"], r["cost"], r["audit"], r["repaired_sha256"]) for r in gone} == {(0, 0, "", hashlib.sha256(b"").hexdigest())}
    # the operator's own output: edits and turns
    fixed = {r["conv_id"]: r for r in got(turn_repair.repair(frame))}
    assert [t["role"] for t in fixed[8]["repaired"]] == ["user", "assistant"] * 30 and fixed[8]["audit"] == "K" * 60
    assert fixed[3]["repaired"] == [] and [e["edit"] for e in fixed[3]["edits"]] == ["D"]


# --- token alignment ---------------------------------------------------------


@pytest.fixture(scope="module")
def models():
    a = Tokenizer.from_file(tokenizer_path(BYTE_TOKENIZER))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(PIECE_TOKENIZER))


def brute_tokens(models, text):
    """Ids and byte ranges of both sides by decoded bytes alone, or None."""
    a, b = models
    alphabet = token_alignment._byte_alphabet()
    sides = []
    for ids, read in (
        (a.encode(" " + (text or ""), add_special_tokens=False).ids, lambda i: bytes(alphabet[c] for c in a.id_to_token(i))),
        (b.encode(text or ""), lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        pieces = [read(i) for i in ids]
        if not text or b"".join(pieces) != b" " + text.encode():
            return None
        at, out = 0, []
        for i, p in zip(ids, pieces):
            out.append((i, at, at + len(p)))
            at += len(p)
        sides.append(out)
    return sides


def brute_alignment(models, texts):
    tokens = [brute_tokens(models, t) for t in texts]
    links = [[(i, j) for i, s, e in t[0] for j, u, v in t[1] if s < v and u < e] if t else [] for t in tokens]
    count = Counter(x for l in links for x in l)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for t, l in zip(tokens, links):
        if not t:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted({e for _, _, e in t[0]} & {e for _, _, e in t[1]})
        groups, start = [], 0
        for end in common:
            groups.append("|".join(",".join(str(i) for i, s, e in side if start < e <= end) for side in t))
            start = end
        out.append((len(t[0]), len(t[1]), len(common), len(l), sum(count[x] == top[x[1]] for x in l), sum(count[x] for x in l),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_alignment_query(spark, models):
    docs = sorted(pq.read_table(f"{SF}/documents.parquet").to_pylist(), key=lambda d: d["doc_id"])
    rows = sorted(got(queries.QUERIES["op13_token_alignment"](spark, SF)), key=lambda r: r["doc_id"])
    want = {d["doc_id"]: v for d, v in zip(docs, brute_alignment_fast(models, [d["text"] for d in docs]))}
    assert [r["doc_id"] for r in rows] == [d["doc_id"] for d in docs]
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == want[r["doc_id"]]


def brute_alignment_fast(models, texts):
    """``brute_alignment`` with the pairs of a text found byte by byte."""
    tokens = [brute_tokens(models, t) for t in texts]
    links = []
    for t in tokens:
        at = [[k for k, (_, s, e) in enumerate(side) for _ in range(s, e)] for side in t] if t else [[], []]
        links.append([(t[0][x][0], t[1][y][0]) for x, y in sorted(set(zip(*at)))])
    count = Counter(x for l in links for x in l)
    top = defaultdict(int)
    for (_, j), n in count.items():
        top[j] = max(top[j], n)
    out = []
    for t, l in zip(tokens, links):
        if not t:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        common = sorted({e for _, _, e in t[0]} & {e for _, _, e in t[1]})
        place = {e: k for k, e in enumerate(common)}
        groups = [([], []) for _ in common]
        for k, side in enumerate(t):
            g = 0
            for i, _, e in side:
                groups[g][k].append(str(i))
                g = place.get(e, g - 1) + 1 if e in place else g
        text = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in groups)
        out.append((len(t[0]), len(t[1]), len(common), len(l), sum(count[x] == top[x[1]] for x in l), sum(count[x] for x in l), hashlib.sha256(text.encode()).hexdigest()))
    return out


TEXTS = [None, "", " ", "\n", "plain words, here.", "É ñandú 😀𐍈 日本語 ỹ́", "a▁b", "<|endoftext|> <s> </s> <unk>", "  two  spaces \t tab ", "x" * 300, "\x00\x01 control", "同じ 同じ",
         "é", "same text", "same text", "we'll don't 123 4567 3.14", "﷽ ﬁ Å ①", "tail "]


def test_alignment_edges(spark, models):
    ids = [i if i % 5 else None for i in range(len(TEXTS))]
    docs = docs_of(spark, list(zip(ids, TEXTS)))
    paths = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    rows = sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in got(token_alignment.align_and_score(docs, *paths))), key=key)
    want = sorted(((i, *v) for i, v in zip(ids, brute_alignment(models, TEXTS))), key=key)
    assert rows == want and sum(r[1] > 0 for r in rows) > 8
    assert got(token_alignment.align_and_score(docs.limit(0), *paths)) == []


def test_units_give_the_tokens_of_whole_texts(models):
    a, b = token_alignment.ByteSide(tokenizer_path(BYTE_TOKENIZER)), token_alignment.PieceSide(tokenizer_path(PIECE_TOKENIZER))
    assert a.may_cut and b.may_cut
    rng = random.Random(2)
    letters = "ab é日'. 1\n\t\u00a0\u2003\u3000\x1f☃" + " " * 12
    texts = [d["text"] for d in pq.read_table(f"{SF}/documents.parquet").to_pylist() if d["text"]] + [t for t in TEXTS if t]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 40))) for _ in range(2000)]
    both = token_alignment.Aligner(a, b, units=500)  # most units are dropped and come again
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        *found, stops = both.encode([t.encode() for t in part])
        start = 0
        for text, stop in zip(part, stops):
            whole = token_alignment.align_text(text, a, b) or [[]] * 4
            for k in (0, 2):
                mine = (found[k + 1] > start) & (found[k + 1] <= stop)
                assert found[k][mine].tolist() == list(whole[k]) and (found[k + 1][mine] - start).tolist() == list(whole[k + 1]), repr(text)
            start = stop


def test_hot_pairs_change_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    paths = tokenizer_path(BYTE_TOKENIZER), tokenizer_path(PIECE_TOKENIZER)
    aligned = materialize(token_alignment.align(docs, *paths), "aligned")
    counts = token_alignment.pair_counts(aligned)
    results = [sorted(map(tuple, token_alignment.score(aligned, counts, n).collect())) for n in (1, 100, 1 << 16)]
    assert results[0] == results[1] == results[2] and results[0]


def test_alignment_encodes_new_units_in_short_texts(monkeypatch):
    both = token_alignment.aligner(queries.tokenizer_path(queries.BYTE_TOKENIZER), queries.tokenizer_path(queries.PIECE_TOKENIZER))
    words = [f"w{i}x{i * 7919 % 1009}" for i in range(5000)]
    text = " ".join(words)
    whole = token_alignment.align_text(text, both.a, both.b)
    sizes = []
    align_text = token_alignment.align_text
    monkeypatch.setattr(token_alignment, "align_text", lambda t, a, b: sizes.append(len(t)) or align_text(t, a, b))
    fresh = token_alignment.Aligner(both.a, both.b, units=700)  # generations change within the text
    for _ in range(2):
        found = fresh.encode([text.encode(), b"", "\u2581 a".encode(), b"a"])
        n = [len(x) for x in whole]
        for got, want in zip(found[:4], whole):
            assert got[: len(want)].tolist() == want.tolist()
        assert [len(x) - y for x, y in zip(found[:4], n)] == [1, 1, 1, 1]  # the last text's token alone follows
    assert 1000 < max(sizes) <= 1 << 12
