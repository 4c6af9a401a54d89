"""Each stage of the pipeline on its own input, against brute force."""

import hashlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from faregrid.llm.common import materialize
from tests.llm.test_queries import SF, column, components, lower, simhash


def test_stages(spark):
    label = {r["doc_id"]: r["toxic"] for r in column("labels")}
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), column("documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        after = [r.asDict() for r in docs.collect()]
        ids = Counter(r["doc_id"] for r in after)
        if name == "toxicity":
            kept = [label[d["doc_id"]] for d in before if d["doc_id"] in label and ids[d["doc_id"]]]
            known = [label[d["doc_id"]] for d in before if d["doc_id"] in label]
            assert kept.count(0) >= 0.98 * known.count(0) and kept.count(1) <= 0.5 * known.count(1)  # only 51 toxic labels at this size
        elif name == "exact_dedup":
            groups = defaultdict(list)
            for d in before:
                groups[hashlib.sha256(lower(d["text"])).digest()].append(d["doc_id"])
            assert ids == Counter(map(max, groups.values()))
        elif name == "simhash_dedup":
            own = [d["doc_id"] for d in before]
            f = np.array([simhash(d["text"]) for d in before], np.uint64)
            links = [(own[i], own[j]) for i in range(len(own)) for j in np.flatnonzero(np.bitwise_count(f[i] ^ f[i + 1 :]) <= 3) + i + 1]
            assert ids == Counter(set(components(own, links).values()))
        elif name == "mixing":
            size = {d["doc_id"]: len((d["text"] or "").encode().split()) for d in before}
            assert max(ids.values()) <= 2 and set(ids) <= set(size)
            total = sum(size.values())
            assert abs(sum(size[i] * n for i, n in ids.items()) - 1.5 * total) <= 0.01 * total
        else:
            assert Counter(r["doc_id"] for r in after if r["piece"] == 0) == Counter(d["doc_id"] for d in before)
        if name != "best_fit_packing":
            assert docs.columns == list(before[0])
        before = after
