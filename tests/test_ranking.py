"""Distributed ranks equal a single-machine sort, including under heavy skew."""

import numpy as np
import pandas as pd

from dealspark.operators.ranking import Asc, global_rank, keyed_rank, stepped_rank


def _frame(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    key = np.where(rng.random(n) < 0.34, 0, rng.integers(1, 50, n))  # one key holds a third
    pdf = pd.DataFrame({"id": np.arange(n), "k": key, "v": rng.integers(0, 20, n).astype(float)})
    pdf.loc[pdf.sample(frac=0.05, random_state=1).index, "v"] = np.nan
    return pdf, spark.createDataFrame(pdf)


def test_global_rank_matches_sort(spark):
    pdf, df = _frame(spark)
    got = global_rank(df, [Asc("v", nulls_last=True), "id"], out="r").toPandas()
    exp = pdf.sort_values(["v", "id"], na_position="last").reset_index(drop=True)
    exp["r"] = np.arange(len(exp))
    m = got.merge(exp[["id", "r"]], on="id", suffixes=("", "_exp"))
    assert len(m) == len(pdf) and (m.r == m.r_exp).all()


def test_keyed_rank_matches_cumcount_under_skew(spark):
    pdf, df = _frame(spark)
    got = keyed_rank(df, "k", [Asc("v", nulls_last=True), "id"], out="r").toPandas()
    exp = pdf.sort_values(["k", "v", "id"], na_position="last")
    exp["r"] = exp.groupby("k").cumcount()
    m = got.merge(exp[["id", "r"]], on="id", suffixes=("", "_exp"))
    assert len(m) == len(pdf) and (m.r == m.r_exp).all()


def test_stepped_rank_matches_cumcount_under_skew(spark):
    pdf, df = _frame(spark)
    got = stepped_rank(df, ["k"], "v", ["id"], out="r").toPandas()
    exp = pdf.sort_values(["k", "v", "id"], na_position="first")
    exp["r"] = exp.groupby("k").cumcount()
    m = got.merge(exp[["id", "r"]], on="id", suffixes=("", "_exp"))
    assert len(m) == len(pdf) and (m.r == m.r_exp).all()


def _run(df):
    """Run the frame and return its final plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_and_counts_read_one_exchange(spark):
    _, df = _frame(spark, n=500)
    for ranked in (global_rank(df, ["v", "id"]), keyed_rank(df, "k", ["v", "id"]),
                   global_rank(df, ["v", "id"]).select("rank"), global_rank(df, ["v", "id"]).select("k", "rank")):
        plan = _run(ranked).split("== Initial Plan ==")[0]
        ranges = [line for line in plan.splitlines() if "Exchange rangepartitioning" in line]
        assert sum("ReusedExchange" not in line for line in ranges) == 1 < len(ranges)
        assert "BroadcastHashJoin" in plan and "SinglePartition" in plan  # only per-partition counts


def test_building_a_rank_runs_no_job(spark):
    _, df = _frame(spark, n=500)
    spark.sparkContext.setJobGroup("rank-building", "")
    try:
        ranked = [global_rank(df, ["v", "id"]), keyed_rank(df, "k", ["v", "id"]), stepped_rank(df, ["k"], "v", ["id"])]
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("rank-building"))
        assert all("rank" in r.columns for r in ranked)
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_empty_and_single_rows(spark):
    _, df = _frame(spark, n=50)
    assert global_rank(df.where("false"), ["v", "id"]).collect() == []
    assert keyed_rank(df.where("false"), "k", ["v", "id"]).collect() == []
    assert [r["rank"] for r in global_rank(df.where("id = 3"), ["id"]).collect()] == [0]
