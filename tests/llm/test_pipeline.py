"""The pipeline, stage by stage, against plain Python over its own inputs."""

from __future__ import annotations

import corpus_pipeline
from chartlens.llm import neardup, registry
from chartlens.llm.common import table, words, written
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents")
    names = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_SMALL), "test-stage")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == names
    given = {r["doc_id"]: r for r in table(spark, SF_SMALL, "documents").collect()}
    language, toxic, dedup, mix, packed = (seen[n].collect() for n, _ in corpus_pipeline.STAGES)
    for rows in (language, toxic, dedup):
        assert all(r == given[r["doc_id"]] for r in rows)
    assert len(language) >= 0.95 * len(given)

    # near copies: the least doc_id of each group stays
    sets = {}
    for r in toxic:
        w = r["text"].lower().split()
        sets[r["doc_id"]] = {tuple(w[i : i + neardup.WORDS]) for i in range(max(1, len(w) - neardup.WORDS + 1))} if w else set()
    kept = {r["doc_id"] for r in dedup}
    for d, s in sets.items():
        near = [e for e, x in sets.items() if e < d and x and s and 100 * len(s & x) >= 80 * len(s | x)]
        assert (d in kept) == (not near)

    # the mix: 150 % of the words, no document more than twice
    size = {r["doc_id"]: len(r["text"].split()) for r in dedup}
    taken = {}
    for r in mix:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
        assert given[r["doc_id"]]["text"].startswith(r["text"])
    assert all(n <= 2 * size[d] for d, n in taken.items())
    assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= len({r["source"] for r in dedup})
    assert seen["mixing"].agg(F.sum(words(F.col("text")))).first()[0] == sum(taken.values())

    # every row of the mix is packed whole
    assert sum(r["length"] for r in packed if r["start"] == 0) > 0
    starts = sum(1 for r in packed if r["start"] == 0)
    assert starts == len(mix)
    assert registry.QUERIES["pipeline"](spark, SF_SMALL).count() == len(packed)
