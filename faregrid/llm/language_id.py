"""Language identification by Bayesian fusion of evidence.

The posterior of a text's language multiplies

* the likelihood of its letters (byte trigrams, counted in labelled documents),
* the likelihood of the language that its markup declares,
* the likelihood of its address suffix (last label of the host), and
* a prior of its host, smoothed towards its domain, and that towards all texts.

The likelihoods of declarations and suffixes and the priors are grouped
aggregates over all texts of what their letters say; a text's own contribution to
its host's and domain's prior is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import ascii_lower, materialize, python_ready

GRAM_BITS = 14
MAX_LANGUAGES = 200
ENOUGH = 300  # trigrams after which more text says no more: texts are not made of independent trigrams
SMOOTHING = 4.0  # texts that the level above is worth
_KEEP = textops._LOWER.copy()
_KEEP[[*range(65), *range(91, 97), *range(123, 128)]] = 32


def _grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of letters (others are spaces, runs of them one), and the text of each."""
    raw = _KEEP[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    offsets = np.cumsum([len(t) + 1 for t in texts])
    space = raw == 32
    keep = np.concatenate([[True], ~(space[1:] & space[:-1])])
    at = np.flatnonzero(keep)
    c = raw[at].astype(np.uint32)
    text = np.searchsorted(offsets, at, "right")
    code = ((c[:-2] << 16 | c[1:-1] << 8 | c[2:]) * np.uint32(2654435761)) >> np.uint32(32 - GRAM_BITS)
    same = text[2:] == text[:-2]
    return code[same], text[2:][same]


def _count(n_languages: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_languages << GRAM_BITS, np.int64)
        for batch in batches:
            for part, texts in textops.chunks(batch):
                code, text = _grams(texts)
                language = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
                total += np.bincount((language[text] << GRAM_BITS) + code, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    return run


def fit_text(labelled: DataFrame, text_col: str = "text", label_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages, and log likelihoods (languages x trigrams), from every labelled text. Null labels are left out."""
    names = [r[0] for r in labelled.filter(F.col(label_col).isNotNull()).select(label_col).distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names.sort()
    if not names:
        return [], np.zeros((0, 1 << GRAM_BITS))
    number = F.array_position(F.array(*map(F.lit, names)), F.col(label_col)) - 1
    rows = python_ready(labelled).filter(F.col(label_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), number.alias("language"))
    table = np.full(len(names) << GRAM_BITS, 0.5)
    # at most languages x trigrams rows
    for r in rows.mapInArrow(_count(len(names)), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        table[r["at"]] += r["n"]
    table = table.reshape(len(names), -1)
    return names, np.log(table / table.sum(1, keepdims=True))


def _text_evidence(table: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                code, text = _grams(texts)
                n = np.bincount(text, minlength=len(texts))
                sums = np.stack([np.bincount(text, row[code], len(texts)) for row in table], 1).astype(float)
                sums *= (np.minimum(n, ENOUGH) / np.maximum(n, 1) / 3)[:, None]  # each letter is in three trigrams
                sums -= sums.max(1, keepdims=True)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(list(sums), pa.list_(pa.float64()))], [*part.schema.names[:-1], "evidence"])

    return run


def _normal(values: list[Column]) -> Column:
    """Array of the softmax of log values."""
    top = F.greatest(*values) if len(values) > 1 else values[0]
    raised = [F.exp(v - top) for v in values]
    total = sum(raised[1:], raised[0])
    return F.array(*[r / total for r in raised])


def _sums(df: DataFrame, by: list[str], name: str, values: str, n: int) -> DataFrame:
    return df.groupBy(*by).agg(F.array(*[F.sum(F.col(values)[i]) for i in range(n)]).alias(name))


def identify(texts: DataFrame, names: list[str], table: np.ndarray) -> DataFrame:
    """``texts`` without ``text``, plus lang, confidence and text_lang (what the letters alone say).

    ``texts`` has ``text``, and ``host`` and ``markup`` (declared language), which may
    be null: no such evidence. Null and empty texts have no letters' evidence.
    Of equally likely languages the first in order is named. Rows repeated are
    judged each and count each. Without languages ``lang`` is null. An empty table
    gives an empty result.
    """
    own = [c for c in texts.columns if c != "text"]
    if not names:
        return texts.select(*own, F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("confidence"), F.lit(None).cast("string").alias("text_lang"))
    n = len(names)
    host = F.coalesce(ascii_lower(F.col("host")), F.lit(""))
    labels = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")
    rows = python_ready(texts).select(*own, F.col("text").cast("string").alias("text"))
    schema = rows.drop("text").withColumn("evidence", F.array(F.lit(0.0))).schema
    read = rows.mapInArrow(_text_evidence(table), schema).withColumns({
        "_host": host,
        "_domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), F.lit(2))),
        "_suffix": F.element_at(labels, -1),
        "_markup": F.coalesce(F.nullif(F.regexp_extract(F.lower("markup"), r"^\s*([a-z]{2,3})\b", 1), F.lit("")), F.lit("?")),
        "_text": _normal([F.col("evidence")[i] for i in range(n)]),
    })
    read = materialize(read, "text-evidence")
    # the levels, each from the one below
    hosts = _sums(read, ["_host", "_domain"], "_by_host", "_text", n)
    domains = _sums(hosts, ["_domain"], "_by_domain", "_by_host", n)
    total = domains.agg(*[F.sum(F.col("_by_domain")[i]) for i in range(n)]).first()
    overall = np.array([x or 0.0 for x in total]) + 1.0
    overall /= overall.sum()
    size = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    markups = _sums(read.filter("_markup != '?'"), ["_markup"], "_by_markup", "_text", n)
    suffixes = _sums(read.filter("_host != ''"), ["_suffix"], "_by_suffix", "_text", n)
    known = (
        read.join(hosts.join(domains, "_domain").drop("_domain"), "_host").join(markups, "_markup", "left")
        .join(suffixes.withColumnRenamed("_suffix", "_s"), (F.col("_suffix") == F.col("_s")) & (F.col("_host") != ""), "left")
    )
    log_post = []
    for i in range(n):
        share = float(overall[i])
        above = (F.col("_by_domain")[i] - F.col("_text")[i] + SMOOTHING * share) / (size(F.col("_by_domain")) - 1 + SMOOTHING)
        prior = (F.col("_by_host")[i] - F.col("_text")[i] + SMOOTHING * above) / (size(F.col("_by_host")) - 1 + SMOOTHING)
        # P(declared | language) and P(suffix | language) up to a factor common to all languages
        declared = F.coalesce((F.col("_by_markup")[i] + share) / (size(F.col("_by_markup")) + 1) / share, F.lit(1.0))
        suffix = F.coalesce((F.col("_by_suffix")[i] + SMOOTHING * share) / (size(F.col("_by_suffix")) + SMOOTHING) / share, F.lit(1.0))
        log_post.append(F.col("evidence")[i] + F.log(F.greatest(prior, F.lit(1e-9))) + F.log(declared) + F.log(suffix))
    post, languages = _normal(log_post), F.array(*map(F.lit, names))
    best = lambda a: F.element_at(languages, F.array_position(a, F.array_max(a)).cast("int"))
    return known.withColumn("_post", post).select(
        *own, best(F.col("_post")).alias("lang"), F.array_max("_post").alias("confidence"), best(F.col("_text")).alias("text_lang")
    )


def page_texts(pages: DataFrame) -> DataFrame:
    """(page_id, text, host, markup) of web pages: text without markup, and the language that ``<html lang>`` declares."""
    return pages.select(
        "page_id",
        F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^<>]*>", " ").alias("text"),
        F.nullif(F.regexp_extract("url", r"(?s)://([^/?#]*)", 1), F.lit("")).alias("host"),
        F.nullif(F.regexp_extract("html", r"""(?is)<html\b[^<>]*?\blang\s*=\s*["']?([^"'\s<>]+)""", 1), F.lit("")).alias("markup"),
    )


def identify_tables(documents: DataFrame, pages: DataFrame, held_out: Column | None = None) -> DataFrame:
    """(doc_id, page_id, lang, confidence, text_lang) for every document and every page (the other id is null).

    Letters are learned from all documents with a ``lang``, but for those for which
    ``held_out`` is true (to measure accuracy on them). A document has no markup and no address; its
    source stands for the host.
    """
    names, table = fit_text(documents if held_out is None else documents.filter(~F.coalesce(held_out, F.lit(False))))
    none = F.lit(None).cast("string")
    docs = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(None).cast("long").alias("page_id"), F.concat(F.lit("source:"), F.col("source")).alias("host"),
        none.alias("markup"), "text",
    )
    web = page_texts(pages).select(F.lit(None).cast("long").alias("doc_id"), F.col("page_id").cast("long").alias("page_id"), "host", "markup", "text")
    found = identify(docs.union(web), names, table)
    return found.select("doc_id", "page_id", "lang", "confidence", "text_lang")
