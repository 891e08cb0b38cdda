"""Live counts equal a full run after every batch."""

import random
from datetime import datetime, timedelta

from conftest import SF_SMALL
from pyspark.sql import functions as F

from dealspark.plans import packs as K
from dealspark.plans import report as R
from dealspark.sources.catalogue import catalogue, catalogue_latest
from dealspark.streaming import incremental as S
from dealspark.streaming import live


def test_counts_after_every_batch(spark, tmp_path):
    rng = random.Random(3)
    cat = catalogue(spark, SF_SMALL)
    skus = [r["sku"] for r in cat.select("sku").collect()]
    now = catalogue_latest(spark, SF_SMALL)
    queries = K.pack(K.HTTP_PACK)
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    start, done = datetime(2024, 1, 1), []

    live.write_base(cat, queries, out, now)
    for run in range(2):
        rows = [(start + timedelta(minutes=rng.randrange(300)), rng.choice(skus), rng.choice([10.0, 500.0, 999.0, 1500.0, K.EXCLUDED_PRICE]))
                for _ in range(300)]
        rows += done[:40]  # repeats
        rows += [(None, skus[0], 1.0), (start, None, 1.0), (start, 10**12, 5.0)]
        done += rows
        spark.createDataFrame([(i, t, s, "purchase", p, None) for i, (t, s, p) in enumerate(rows)],
                              "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").write.parquet(f"{src}/r{run}")
        body = live.signed_counts(cat, queries, out, lambda: catalogue_latest(spark, SF_SMALL))
        S.run_to_end(live.price_steps(S.price_updates(spark, src + "/r*/*.parquet")), ck, foreach_batch=body)
        newest = {}
        for t, s, p in done:
            if t is not None and s is not None:
                newest[s] = max(newest.get(s, (t, p)), (t, p))
        changed = spark.createDataFrame([(s, p, t) for s, (t, p) in newest.items()], "sku long, np double, nt timestamp_ntz")
        applied = (cat.join(changed, "sku", "left").withColumn("salePrice", F.coalesce("np", "salePrice"))
                   .withColumn("priceUpdateDate", F.coalesce("nt", "priceUpdateDate")))
        want = {r["query_name"]: r["n_rows"] for r in R.shape(applied, queries, now).collect()}
        got = {r["query_name"]: r["n_rows"] for r in live.live_counts(spark.read.parquet(out)).collect()}
        assert got == want
    assert {r["query_name"]: r["n_rows"] for r in R.shape(cat, queries, now).collect()} != want
