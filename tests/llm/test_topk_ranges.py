"""Query groups and ranges meet only where the bounds allow a score."""

import numpy as np

from dealspark.llm import common, topk


def test_fewer_pairs_than_all_and_the_same_result(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE", 64)
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERIES", 8)
    monkeypatch.setattr(topk, "SHEET", 16)
    kept = {}

    def watched(df, kind):
        out = common.stored(df, kind)
        kept.setdefault(kind, []).append(out)
        return out
    monkeypatch.setattr(topk, "stored", watched)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 12)) * 3
    x = np.repeat(centres, 100, axis=0) + rng.normal(size=(4000, 12)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(5)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(df, df.where("vec_id % 50 = 0")).collect()}
    scaled = np.floor(256 * x).astype(np.int64)
    for q in range(0, 4000, 50):
        scores = scaled @ scaled[q]
        order = [i for i in np.lexsort((np.arange(4000), -scores)) if i != q][:5]
        assert [got[q, r + 1] for r in range(5)] == [(i, scores[i]) for i in order]
    ranges, groups = kept["topk-ranges"][0].count(), kept["topk-queries"][0].count()
    met = sum(p.count() for p in kept["topk-pairs"])
    assert ranges > 50 and groups >= 10 and met < ranges * groups / 2
