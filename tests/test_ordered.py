"""Deep pages of a stored order."""

import glob
import os

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from dealspark.operators.compose import rank_by_order
from dealspark.sources.catalogue import catalogue
from dealspark.sources.ordered import store_ordered


@pytest.fixture(scope="module")
def rows(spark):
    one = catalogue(spark, SF_SMALL).select("sku", "salePrice", "name", "page", "pos")
    # Many equal prices and names, and missing ones.
    return one.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).select(
        "sku", "salePrice", F.when(F.col("sku") % 7 > 0, F.col("name")).alias("name"), "page", (F.col("pos") * 10 + F.col("k")).alias("pos"))


def test_every_page_opens_its_files_only(spark, rows, tmp_path):
    path = str(tmp_path / "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        stored = store_ordered(rows, path, file_rows=60)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = {r["rank"]: tuple(r)[:5] for r in rank_by_order(rows).collect()}
    n, files = len(want), glob.glob(f"{path}/rows/*.parquet")
    assert len(files) > 20
    for page, size in ((1, 25), (2, 25), (7, 100), (n // 30, 30), (n // 30 + 1, 30), (1, n + 5)):
        got = {r["rank"]: tuple(r)[:5] for r in stored.page(page, size).collect()}
        assert got == {k: v for k, v in want.items() if (page - 1) * size <= k < page * size}
    df = stored.page(n // 40, 20)
    opened = {os.path.basename(f) for f in df.inputFiles()}
    assert 1 <= len(opened) <= 3
    for f in files:  # a read of any other file would fail
        if os.path.basename(f) not in opened:
            with open(f, "wb") as out:
                out.write(b"broken")
    assert df.count() == 20
    assert stored.page(10**6, 100).collect() == [] and stored.page(10**6, 100).columns == [*rows.columns, "rank"]


def test_empty_result(rows, tmp_path):
    assert store_ordered(rows.where("false"), str(tmp_path / "none")).page(1, 10).collect() == []
