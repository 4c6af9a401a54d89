"""Exact deduplication that combines in three steps, so that no group of copies meets in one task.

1. Each task keeps one row per text it has read (the map-side part of the first
   aggregate).
2. What is left meets by digest, text and salt; the salt is the reading task's
   number modulo ``salts``, so a text that a third of all rows share is spread.
3. The winners of the salts, at most ``salts`` rows a text, meet by digest and text.

The grouping key holds the whole normalised text beside the digest at every step,
so texts are equal only if their contents are. Only built-in functions are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm.common import ascii_lower, fresh_names, materialize

SALTS = 16


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _base(docs: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return docs.select(F.col(id_col).alias("_id"), norm.alias("_text")).withColumn("_digest", digest(F.col("_text")))


def winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
            digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """One row per distinct text: (_digest, _text, keep_id, group_size)."""
    salted = _base(docs, id_col, text_col, digest).withColumn("_salt", F.spark_partition_id() % salts)
    merged = salted.groupBy("_digest", "_salt", "_text").agg(F.max("_id").alias("_id"), F.count(F.lit(1)).alias("_n"))
    return merged.groupBy("_digest", "_text").agg(F.max("_id").alias("keep_id"), F.sum("_n").alias("group_size"))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS,
           digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are compared after lower-casing A-Z; null counts as empty. Of equal
    texts the row with the largest id stays. A null id is below every other: a
    group that has only null ids has a null ``keep_id`` and its rows are kept.
    Rows repeated with the same id are one document and share the decision, but
    each counts in ``group_size``. An empty table gives an empty result; extra
    columns are ignored.

    Rows find their group by digest alone where the comparison of contents has
    shown that the digest has a single text; if any digest has more (a
    collision), rows are matched by digest and text.
    """
    groups = winners(docs, id_col, text_col, salts, digest)
    narrow = materialize(groups.drop("_text"), "winners")
    shared = narrow.groupBy("_digest").count().filter("count > 1")
    rows = _base(docs, id_col, text_col, digest)
    hash_of = F.lower(F.hex("_digest")) if digest is sha256 else F.sha2("_text", 256)
    if shared.isEmpty():
        named = rows.select("_id", "_digest", hash_of.alias("text_sha256"))
        joined = named.join(narrow, "_digest")
    else:
        named = rows.withColumn("text_sha256", hash_of)
        joined = named.join(groups, ["_digest", "_text"])
    return joined.select(
        F.col("_id").alias("doc_id"), "keep_id", "group_size", F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """``docs`` without the copies: of equal texts the row with the largest id, all columns as they were.

    Rows repeated with the same id and text become one row; a null id is less than any other. An empty table
    gives an empty result. Other columns may have any names.
    """
    key = lambda c: F.coalesce(c.cast("string"), F.lit(""))  # noqa: E731  a null id is matched too
    d, k = fresh_names(docs.columns, 2)
    best = winners(docs, id_col, text_col, salts).select(F.col("_digest").alias(d), key(F.col("keep_id")).alias(k))
    norm = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.withColumns({d: sha256(norm), k: key(F.col(id_col))})
    # the join has dealt the rows by digest and id already: repeated rows go without another shuffle
    return rows.join(best, [d, k], "left_semi").dropDuplicates([d, k]).select(docs.columns)
