"""Observed batches of a stream equal the rows that were written."""

from conftest import SF_SMALL
from pyspark.sql import functions as F

from dealspark.plans.keys import overlapping_runs
from dealspark.streaming import incremental as S
from dealspark.streaming.observed import BatchMetrics, observe


def test_counts_per_batch_equal_the_written_rows(spark, tmp_path):
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for i, run in enumerate(overlapping_runs(spark, SF_SMALL)):
        run.repartition(3).write.parquet(f"{src}/r{i}")
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)
    written = {}
    try:
        stream = S.price_updates(spark, src + "/r*/*.parquet", max_files_per_trigger=2)

        def keep(batch, n):
            batch.write.mode("overwrite").parquet(f"{out}/batch_id={n}")
        q = S.run(observe(stream), ck, foreach_batch=keep)
        q.awaitTermination()
        got = metrics.take(q)
    finally:
        spark.streams.removeListener(metrics)
    for r in spark.read.parquet(out).groupBy("batch_id").agg(
            F.count("*").alias("n"), F.min("priceUpdateDate").alias("a"), F.max("priceUpdateDate").alias("b")).collect():
        written[r["batch_id"]] = (r["n"], r["a"], r["b"])
    assert len(written) == 3
    assert {n: (r["n_rows"], r["first_ts"], r["last_ts"]) for n, r in got.items()} == written
    assert metrics.held == {}
