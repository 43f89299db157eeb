"""The order of shingles changes what the join costs, never what it finds."""

import numpy as np

from roadglass.llm import jaccard_join
from roadglass.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_components_do_not_depend_on_the_sample(spark, monkeypatch):
    real = jaccard_join.common_shingles
    rng = np.random.default_rng(2)

    def components():
        return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in QUERIES["op5_jaccard_join"](spark, SF).collect())

    def wrong(docs, work, words=jaccard_join.WORDS, **how):
        h, n = real(docs, work, words, share=0.1, seen=2)
        return h, rng.permutation(np.maximum(1, n))

    want = components()
    for order in (lambda *a, **k: (np.zeros(1, np.uint64), np.ones(1, np.int64)), wrong):
        monkeypatch.setattr(jaccard_join, "common_shingles", order)
        assert components() == want
