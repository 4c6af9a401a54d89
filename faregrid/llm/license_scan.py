"""License scan by diagonal voting.

1. Every text is cut into words (ASCII letters and digits, lower-cased, and all other
   characters beyond ASCII); all its rolling word k-grams are rows (text, position, hash, words).
2. A Spark join meets them with the k-grams of the templates. Hashes find the partners,
   the words themselves are compared: a hash collision is no hit.
3. A hit votes for the diagonal ``position in the text - position in the template``. Votes are
   aggregated by text, template and diagonal; a diagonal holds each template position once.
4. Neighbouring diagonals (words put in or left out move the rest by a few places) are merged.
5. A merged span is verified: the template words that its k-grams cover, as a share of the
   longer of template and span, reach the template's ``share`` (1: word for word).

The corpus is read once and its texts are never shuffled: only hits and one row for each text
leave the join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import materialize, python_ready

GRAM_WORDS = 4
SLACK = 8  # diagonals at most so far apart belong to one span, where a template allows changes
SHARE = 0.8
STRETCH_BYTES = 1 << 20  # longer texts are cut into words by stretches of about this size
BROADCAST_GRAMS = 100_000  # more template k-grams than this meet the texts in a shuffled join


@dataclass(frozen=True)
class Template:
    """A license text. ``share`` 1 asks for every word in its place; ``base`` marks plain phrases."""

    label: str
    text: str
    share: float = 1.0
    base: bool = False


# Phrases whose places are counted, and their labels.
PHRASES = (
    Template("gpl", "gnu general public license", base=True),
    Template("apache", "apache license", base=True),
    Template("cc-by", "cc by", base=True),
    Template("mit", "mit license", base=True),
)

# Notices of well-known public licenses.
NOTICES = (
    Template("all-rights-reserved", "All rights reserved"),
    Template("cc-by-nc", "CC BY-NC"),
    Template("cc-by-nd", "CC BY-ND"),
    Template("cc-by-sa", "CC BY-SA"),
    Template("cc0", "CC0 1.0 Universal"),
    Template("lgpl", "GNU Lesser General Public License"),
    Template("agpl", "GNU Affero General Public License"),
    Template("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", SHARE),
    Template("unlicense", "This is free and unencumbered software released into the public domain", SHARE),
    Template("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", SHARE),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
             "the following conditions are met", SHARE),
    Template("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
             "provided that the above copyright notice and this permission notice appear in all copies", SHARE),
    Template("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
             "http://www.apache.org/licenses/LICENSE-2.0", SHARE),
    Template("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
             "merge, publish, distribute, sublicense, and/or sell copies of the Software", SHARE),
    Template("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
             "Foundation"),
)
TEMPLATES = PHRASES + NOTICES

# Every ASCII byte that is no letter or digit separates words; A-Z become a-z.
_WORDS_ONLY = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def stretches(text: bytes, limit: int) -> Iterator[bytes]:
    """``text`` (separated by spaces) in parts of at least ``limit`` bytes that end between words."""
    start = 0
    while start < len(text):
        stop = text.find(b" ", start + limit)
        stop = len(text) if stop < 0 else stop
        yield text[start:stop]
        start = stop


def _slices(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``buf[start:end]`` of each pair, as binary values (slices may overlap)."""
    size = ends - starts
    stop = np.cumsum(size)
    at = np.repeat(starts - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)
    offsets = np.concatenate([[0], stop]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(buf[at])]).cast(pa.binary())


def rolling(words: textops.Words, k: int) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """First word, hash and words of every run of ``k`` words that lies in one text."""
    first = np.arange(max(0, len(words.starts) - k + 1))
    first = first[words.doc[first] == words.doc[first + k - 1]]
    starts, ends = words.starts[first], words.ends[first + k - 1]
    hashes = textops.hash_spans(words.buf, starts, ends).view(np.int64)
    return first, hashes, _slices(words.buf, starts, ends)


def template_grams(spark: SparkSession, templates: Sequence[Template], k: int = GRAM_WORDS) -> tuple[DataFrame, list[int]]:
    """k-grams of the templates with their positions, and the k-gram lengths in use.

    Templates shorter than ``k`` words are one gram of their own length. Templates without words are left out.
    """
    rows, sizes = [], set()
    for no, t in enumerate(templates):
        words = textops.split_words([t.text.encode().translate(_WORDS_ONLY)])
        n = len(words.starts)
        if n:
            size = min(k, n)
            sizes.add(size)
            first, hashes, grams = rolling(words, size)
            rows += [(no, n, size, a, h, g) for a, h, g in zip(first.tolist(), hashes.tolist(), grams.to_pylist())]
    schema = "t_no int, t_words int, t_size int, t_pos int, t_gram long, t_text binary"
    frame = spark.createDataFrame(rows, schema)
    return F.broadcast(frame) if len(rows) <= BROADCAST_GRAMS else frame, sorted(sizes)


def text_grams(docs: DataFrame, sizes: Sequence[int], id_col: str = "doc_id", text_col: str = "text", stretch: int = STRETCH_BYTES) -> DataFrame:
    """(id, key, pos, gram, words, n_words): all rolling word k-grams of every text, for each k of ``sizes``.

    One more row for each text has no gram, ``pos`` -1 and the number of words. ``key`` tells texts with one id apart.
    """
    rows = python_ready(docs).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    names = ["id", "key", "pos", "gram", "words", "n_words"]

    def batch_of(ids: pa.Array, keys: np.ndarray, row: np.ndarray, pos: np.ndarray, gram: pa.Array, words: pa.Array, n_words: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(row)), pa.array(keys[row]), pa.array(pos, pa.int32()), gram, words, n_words], names
        )

    def grams_of(ids: pa.Array, keys: np.ndarray, words: textops.Words, row: np.ndarray, before: int) -> Iterator[pa.RecordBatch]:
        for k in sizes:
            first, hashes, grams = rolling(words, k)
            text = words.doc[first]
            yield batch_of(ids, keys, row[text], before + first - words.first[text], pa.array(hashes), grams, pa.nulls(len(first), pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = max(sizes, default=1)
        for batch in batches:
            for part, texts in textops.chunks(batch, limit=stretch):
                ids = part.column(0)
                keys = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], np.uint64).view(np.int64)
                n_words = np.zeros(len(texts), np.int64)
                if len(texts) > 1 or len(texts[0]) <= stretch:
                    words = textops.split_words([t.translate(_WORDS_ONLY) for t in texts])
                    n_words += words.counts()
                    yield from grams_of(ids, keys, words, np.arange(len(texts)), 0)
                else:  # one long text: each stretch begins with the last words of the one before
                    tail = b""
                    for piece in stretches(texts[0].translate(_WORDS_ONLY), stretch):
                        held = len(tail.split())
                        words = textops.split_words([tail + piece])
                        new = words.counts()[0] - held
                        for k in sizes:  # grams that end in the new words
                            first, hashes, grams = rolling(words, k)
                            fresh = np.flatnonzero(first + k > held)
                            row = np.zeros(len(fresh), np.int64)
                            yield batch_of(ids, keys, row, n_words[0] - held + first[fresh], pa.array(hashes[fresh]), grams.take(pa.array(fresh)), pa.nulls(len(fresh), pa.int64()))
                        n_words += new
                        keep = min(longest - 1, int(words.counts()[0]))
                        tail = words.buf[words.starts[-keep] :].tobytes() if keep else b""
                every = np.arange(len(texts))
                yield batch_of(ids, keys, every, np.full(len(texts), -1), pa.nulls(len(texts), pa.int64()), pa.nulls(len(texts), pa.binary()), pa.array(n_words))

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, key long, pos int, gram long, words binary, n_words long")


def scan(docs: DataFrame, templates: Sequence[Template] = TEMPLATES, k: int = GRAM_WORDS, slack: int = SLACK, id_col: str = "doc_id",
         text_col: str = "text", stretch: int = STRETCH_BYTES) -> DataFrame:
    """(id, n_words, licenses) for every row of ``docs``.

    ``licenses`` lists the verified spans: label, base (of a plain phrase), first (word, from 0), words (length of the
    span) and share (of the template, 0 to 1), ordered by first word, label and length. Null and empty texts have no words and no
    span. Rows repeated with the same id each get the spans of their own text, also those with a null id. An empty
    table gives an empty result; extra columns are ignored, whatever their names. Texts of any length are read by
    stretches; spans are found across them.
    """
    spark = docs.sparkSession
    known, sizes = template_grams(spark, templates, k)
    grams = text_grams(docs, sizes, id_col, text_col, stretch)
    met = grams.join(known, (F.col("gram") == F.col("t_gram")) & (F.col("words") == F.col("t_text")), "left").filter("t_no is not null or pos < 0")
    hits = materialize(met.select("id", "key", "n_words", "t_no", "t_words", "t_size", "t_pos", "pos"), "license-hits")
    found = hits.filter("pos >= 0")
    votes = found.groupBy("id", "key", "t_no", "t_words", "t_size", (F.col("pos") - F.col("t_pos")).alias("diagonal")).agg(
        F.collect_set("t_pos").alias("at")  # at most the template's positions
    )
    facts = spark.createDataFrame(
        [(i, t.label, t.base, float(t.share), 0 if t.share >= 1 else slack) for i, t in enumerate(templates)],
        "t_no int, label string, base boolean, needed double, slack int",
    )
    facts = F.broadcast(facts) if len(templates) <= BROADCAST_GRAMS else facts
    order = Window.partitionBy("id", "key", "t_no").orderBy("diagonal")
    apart = F.coalesce((F.col("diagonal") - F.lag("diagonal").over(order) > F.col("slack")).cast("int"), F.lit(1))
    merged = (
        votes.join(facts, "t_no").withColumn("apart", apart).withColumn("span", F.sum("apart").over(order))
        .groupBy("id", "key", "t_no", "span", "t_words", "t_size", "label", "base", "needed")
        .agg(
            F.array_distinct(F.flatten(F.collect_list("at"))).alias("at"),
            F.min(F.col("diagonal") + F.array_min("at")).alias("first"),
            F.max(F.col("diagonal") + F.array_max("at") + F.col("t_size")).alias("end"),
        )
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform("at", lambda p: F.sequence(p, p + F.col("t_size") - 1)))))
    share = covered / F.greatest(F.col("t_words"), F.col("end") - F.col("first"))
    spans = (
        merged.withColumn("share", share).filter("share >= needed")
        .groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct(
            F.col("first").cast("long").alias("first"), "label", (F.col("end") - F.col("first")).cast("long").alias("words"), "share", "base"
        ))).alias("licenses"))
    )
    texts = hits.filter("pos < 0").select(F.col("id").alias("i"), F.col("key").alias("k"), "n_words")
    none = F.array().cast(spans.schema["licenses"].dataType)
    joined = texts.join(spans, F.col("i").eqNullSafe(F.col("id")) & (F.col("k") == F.col("key")), "left")
    return joined.select(F.col("i").alias(id_col), "n_words", F.coalesce("licenses", none).alias("licenses"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``scan``: n_words, n_base, first_word, last_word, base_labels, labels and score.

    Without base places ``first_word`` and ``last_word`` are null; without labels the lists are empty strings and the
    score, the largest share of a span, is 0.
    """
    base = F.filter("licenses", lambda s: s["base"])
    first = F.transform(base, lambda s: s["first"])
    listed = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return scanned.select(
        id_col, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(first).alias("first_word"), F.array_max(first).alias("last_word"),
        listed(base).alias("base_labels"), listed(F.col("licenses")).alias("labels"),
        F.coalesce(F.array_max(F.transform("licenses", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
