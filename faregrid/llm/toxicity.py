"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of
the words (and word beginnings) that it has; the document's score is their
noisy-or: one offending sentence is enough. Labels exist for documents only, and
the weights are fitted to them through the noisy-or. The sentence scores then
say where the offence is.

The classifier is fitted on at most ``fit_rows`` labelled documents (those with
the smallest seeded hash of their id); every document is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm import textops
from faregrid.llm.common import fresh_names, materialize, python_ready

FIT_ROWS = 20_000
FEATURES = 4096
MIN_DOCS = 5
MIN_SCORE = 30.0  # G statistic of a feature that is used
PREFIXES = (4, 5, 6)  # bytes
THRESHOLD = 0.7
_SEED = 11

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 63]] = True  # newline ! . ?


@dataclass
class Bags:
    """Words of several texts with their features. ``sentence`` numbers sentences over the whole chunk."""

    text: np.ndarray
    sentence: np.ndarray
    start: np.ndarray
    end: np.ndarray
    features: np.ndarray  # words x kinds; 0: none
    offsets: np.ndarray


def bags(texts: list[bytes]) -> Bags:
    raw = textops._LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    offsets = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    inside = _WORD[raw]
    edge = np.diff(np.concatenate([[0], inside.view(np.int8), [0]]))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    kinds = [textops.hash_spans(raw, start, end, _SEED)]
    for k in PREFIXES:
        long = np.flatnonzero(end - start > k)
        feature = np.zeros(len(start), np.uint64)
        feature[long] = textops.hash_spans(raw, start[long], start[long] + k, _SEED + k)
        kinds.append(feature)
    text = np.searchsorted(offsets, start, "right") - 1
    return Bags(text, np.cumsum(_STOP[raw])[start], start, end, np.stack(kinds, 1), offsets)


@dataclass
class Model:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float


def _sample(docs: DataFrame, labels: DataFrame, train: Column, fit_rows: int) -> DataFrame:
    """(text, label) of the labelled training documents with the smallest hashes, at most ``fit_rows``."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("label"))
    chosen = known.filter(train).orderBy(F.xxhash64("doc_id", F.lit(_SEED)), "doc_id").limit(fit_rows)
    # at most fit_rows rows of two numbers
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with each feature, by label, summed per chunk."""
    for batch in batches:
        for part, texts in textops.chunks(batch):
            b = bags(texts)
            label = part.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            each = [textops.unique_counts(b.features[lo:hi].ravel())[0] for lo, hi in _ranges(b, len(texts))]
            if not each:
                continue
            feature = np.concatenate(each)
            toxic = np.repeat(label, [len(x) for x in each])
            feature, toxic = feature[feature != 0], toxic[feature != 0]
            unique, total = textops.unique_counts(feature)
            some, times = textops.unique_counts(feature[toxic > 0])
            pos = np.zeros(len(unique), np.int64)
            pos[np.searchsorted(unique, some)] = times
            neg = total - pos
            yield pa.RecordBatch.from_arrays([pa.array(unique.view(np.int64)), pa.array(pos), pa.array(neg)], ["feature", "pos", "neg"])


def _ranges(b: Bags, n: int) -> list[tuple[int, int]]:
    cuts = np.searchsorted(b.text, np.arange(n + 1))
    return list(zip(cuts[:-1].tolist(), cuts[1:].tolist()))


def _lookup(features: np.ndarray, model_features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, model feature) of every feature that the model knows."""
    if not len(model_features) or not len(features):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(model_features, features), len(model_features) - 1)
    word, kind = np.nonzero(model_features[at] == features)
    return word, at[word, kind]


def _known(features: np.ndarray):
    """Per document: label, number of sentences, and its known features by sentence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                b = bags(texts)
                word, feature = _lookup(b.features, features)
                sentences, hits, where = [], [], []
                order = np.argsort(word, kind="stable")
                word, feature = word[order], feature[order]
                for lo, hi in _ranges(b, len(texts)):
                    x, y = np.searchsorted(word, [lo, hi])
                    sentences.append(len(np.unique(b.sentence[lo:hi])))
                    hits.append(feature[x:y].tolist())
                    where.append((b.sentence[word[x:y]] - (b.sentence[lo] if hi > lo else 0)).tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(sentences, pa.int64()), pa.array(hits, pa.list_(pa.int64())), pa.array(where, pa.list_(pa.int64()))],
                    ["label", "sentences", "hits", "wheres"],
                )

    return run


def _log_not(z: np.ndarray) -> np.ndarray:
    """log(1 - logistic(z))"""
    return -np.logaddexp(0, z)


def fit_noisy_or(label: np.ndarray, sentences: np.ndarray, doc: np.ndarray, sentence: np.ndarray, feature: np.ndarray, n_features: int,
                 steps: int = 400, rate: float = 0.1, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the documents' likelihood under the noisy-or (Adam, full batch)."""
    w, state = np.zeros(n_features + 1), np.zeros((2, n_features + 1))
    w[-1] = -6.0
    n = max(1, len(label))
    hit, inverse = np.unique(np.stack([doc, sentence], 1), axis=0, return_inverse=True) if len(doc) else (np.zeros((0, 2), np.int64), doc)
    inverse = inverse.ravel()
    hit_doc = hit[:, 0]
    plain = sentences - np.bincount(hit_doc, minlength=len(label))
    for step in range(1, steps + 1):
        z = w[-1] + np.bincount(inverse, w[feature], len(hit))
        log_not = np.bincount(hit_doc, _log_not(z), len(label)) + plain * _log_not(w[-1:])[0]
        log_not = np.minimum(log_not, -1e-12)
        p_not = np.exp(log_not)
        # d loss / d log(1 - P): -1 for clean documents, (1-P)/P for toxic ones
        outer = np.where(label > 0, p_not / -np.expm1(log_not), -1.0) / n
        inner = -1 / (1 + np.exp(-z))  # d log(1 - s) / d z
        g = np.zeros_like(w)
        per_hit = outer[hit_doc] * inner
        g[:-1] = np.bincount(feature, per_hit[inverse], n_features) + l2 * w[:-1]
        g[-1] = per_hit.sum() + (outer * plain).sum() * (-1 / (1 + np.exp(-w[-1])))
        state = np.stack([0.9 * state[0] + 0.1 * g, 0.999 * state[1] + 0.001 * g * g])
        w -= rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, fit_rows: int = FIT_ROWS) -> Model:
    """Learns from ``labels`` (doc_id, toxic) of ``docs``; ``train`` (over doc_id) says which rows may be used.

    Null ids and labels are left out; of several labels of a document the highest
    counts. Without usable rows the model has no features and scores near 0.
    """
    train = F.lit(True) if train is None else train
    sample = materialize(_sample(python_ready(docs), labels, train, fit_rows), "toxicity-sample")
    counted = sample.mapInArrow(_count_features, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0), -12.0)
    share, n = n1 / (n1 + n0), F.col("pos") + F.col("neg")
    g = 2 * (F.col("pos") * F.log(F.col("pos") / (n * share)) + F.when(F.col("neg") > 0, F.col("neg") * F.log(F.col("neg") / (n * (1 - share)))).otherwise(0.0))
    best = counted.filter((F.col("pos") >= MIN_DOCS) & (F.col("pos") > n * share)).withColumn("g", g).filter(F.col("g") >= MIN_SCORE)
    features = np.sort(np.array([r["feature"] for r in best.orderBy(F.desc("g"), "feature").limit(FEATURES).collect()], np.int64).view(np.uint64))
    rows = sample.mapInArrow(_known(features), "label int, sentences long, hits array<long>, wheres array<long>").collect()  # at most fit_rows
    rows.sort(key=lambda r: (r["label"], r["sentences"], r["hits"], r["wheres"]))
    lengths = [len(r["hits"]) for r in rows]
    doc = np.repeat(np.arange(len(rows)), lengths)
    feature = np.array([f for r in rows for f in r["hits"]], np.int64)
    sentence = np.array([f for r in rows for f in r["wheres"]], np.int64)
    weights, bias = fit_noisy_or(np.array([r["label"] for r in rows]), np.array([r["sentences"] for r in rows]), doc, sentence, feature, len(features))
    return Model(features, weights, bias)


def _probability(b: Bags, n: int, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Noisy-or of each of ``n`` texts; of each sentence its logit, first and last word, and text."""
    word, feature = _lookup(b.features, model.features)
    cut = np.concatenate([[True], b.sentence[1:] != b.sentence[:-1]]) if len(b.sentence) else np.zeros(0, bool)
    nth = np.cumsum(cut) - 1  # sentences that have words, numbered over the chunk
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(cut)) - 1 if len(first) else first
    of_text = b.text[first]
    z = model.bias + np.bincount(nth[word], model.weights[feature], len(first))
    return -np.expm1(np.bincount(of_text, _log_not(z), n)), z, first, last, of_text


def score(docs: DataFrame, model: Model, locate: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, n_sentences, offending) for every row of ``docs``.

    ``offending`` lists the sentences with a score of ``locate`` or more: number,
    first and last byte (in UTF-8, end exclusive) from their first to their last
    word, and score. Texts without words (null, empty, blank) have score 0. Rows
    repeated are scored each, also those with a null id; an empty table gives an
    empty result; extra columns are ignored.
    """
    rows = python_ready(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spans = pa.list_(pa.struct([("sentence", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch):
                b, n = bags(texts), len(texts)
                probability, z, first, last, of_text = _probability(b, n, model)
                count = np.bincount(of_text, minlength=n)
                begin = np.cumsum(count) - count
                found: list[list[dict]] = [[] for _ in range(n)]
                prob = 1 / (1 + np.exp(-z))
                for s in np.flatnonzero(prob >= locate).tolist():
                    t = int(of_text[s])
                    found[t].append({"sentence": int(s - begin[t]), "start": int(b.start[first[s]] - b.offsets[t]),
                                     "end": int(b.end[last[s]] - b.offsets[t]), "score": float(prob[s])})
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(probability), pa.array(count), pa.array(found, spans)],
                    ["doc_id", "score", "n_sentences", "offending"],
                )

    return rows.mapInArrow(run, "doc_id long, score double, n_sentences long, offending array<struct<sentence:int,start:long,end:long,score:double>>")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, all columns as they were; nothing is shuffled.

    Each row is judged by its text alone: null and repeated ids make no difference, null and empty texts have no sentence
    and the model's score of none. An empty table gives an empty result. Other columns may have any names.
    """
    [scored] = fresh_names(docs.columns, 1)
    rows = python_ready(docs).select(*[F.col(c) for c in docs.columns], F.col(text_col).cast("string").alias(scored))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in textops.chunks(batch, scored):
                clean = _probability(bags(texts), len(texts), model)[0] < threshold
                yield pa.RecordBatch.from_arrays(part.columns[:-1], part.schema.names[:-1]).filter(pa.array(clean))

    return rows.mapInArrow(run, docs.schema)
