"""End-to-end runs: pack report files, export folders, per-batch idempotency."""

import datetime as dt
import os

from pyspark.sql import functions as F

from dealspark.functions import timefns as T
from dealspark.operators.compose import pack_hits
from dealspark.plans import packs as K
from dealspark.plans import runner
from dealspark.sources.catalogue import catalogue, offer_rows
from dealspark.streaming import incremental as S

from conftest import SF_SMALL


def test_pack_report_document_is_in_order(spark, tmp_path):
    cat = catalogue(spark, SF_SMALL)
    out = str(tmp_path / "run")
    shapes = {r.query_name: r for r in runner.pack_report(cat, K.pack(K.HTTP_PACK), offer_rows(spark, SF_SMALL), out).collect()}
    parts = sorted(f for f in os.listdir(f"{out}/document") if f.startswith("part-"))
    lines = []
    for f in parts:
        with open(f"{out}/document/{f}") as fh:
            lines += fh.read().splitlines()
    assert lines[0] == f"discount ({shapes['discount'].n_rows}, 15):</br>"
    assert lines[1].startswith("<tr><th></th><th>salePrice</th>") and lines[1].count("<th>") == 16
    assert lines[-1] == "</br>"
    block = lines[2:lines.index("</br>")]
    assert {line.count("<td>") for line in block} == {15}      # delivered width = stated width
    heads = [line for line in block if not line.startswith("<tr><th></th>")]
    n = shapes["discount"].n_rows
    shown = sorted(int(line[len("<tr><th>"):line.index("</th>")]) for line in heads)
    assert shown == list(range(n))   # landing positions, listed in price order
    offers = offer_rows(spark, SF_SMALL)
    hits = pack_hits(cat, [K.SAVED_QUERIES["discount"]])
    assert len(block) == offers.join(hits, "sku").count() + hits.join(offers, "sku", "left_anti").count()
    digest = spark.read.parquet(f"{out}/digest")
    assert digest.count() == sum(1 for r in shapes.values() if r.n_rows > 0)


def test_search_offers_belong_to_rows(spark):
    cat = catalogue(spark, SF_SMALL)
    res = runner.search(cat, K.SAVED_QUERIES["headphones"], offer_rows(spark, SF_SMALL))
    assert res.offers.columns == ["sku", "offer_pos", "offer.startDate", "offer.endDate"]
    assert res.offers.join(res.rows.select("sku"), "sku", "left_anti").count() == 0


def test_export_one_folder_per_query(spark, tmp_path):
    cat = catalogue(spark, SF_SMALL)
    out = str(tmp_path / "export")
    runner.export(cat, K.pack(K.SCRIPT_PACK), offer_rows(spark, SF_SMALL), out)
    folders = sorted(d for d in os.listdir(out) if d.startswith("export_name="))
    nonempty = [q for q in K.pack(K.SCRIPT_PACK) if runner.search(cat, q).rows.count() > 0]
    assert folders == sorted(f"export_name={q.subject.split(' ')[0]}" for q in nonempty)
    assert spark.read.parquet(out).select("query_name", "rank").distinct().count() == sum(runner.search(cat, q).rows.count() for q in nonempty)


def test_an_interrupted_export_is_never_read(spark, tmp_path):
    cat, offers, out = catalogue(spark, SF_SMALL), offer_rows(spark, SF_SMALL), str(tmp_path / "export")
    pack = K.pack(K.SCRIPT_PACK)
    want = runner.export_rows(cat, pack, offers)
    schema, rows = want.schema, sorted(map(str, want.collect()))
    run = runner.export_committed(cat, pack, offers, out, file_rows=50)
    files = [f for f in os.listdir(f"{out}/runs/{run}") if f.endswith(".parquet")]
    assert len(files) >= len(rows) / 50 and sorted(map(str, runner.read_export(spark, out, schema).collect())) == rows
    # A later run breaks off after its files, or within them.
    want.limit(3).write.parquet(f"{out}/runs/9-broken")
    assert sorted(map(str, runner.read_export(spark, out, schema).collect())) == rows
    # One that ends replaces it, also without rows.
    runner.export_committed(cat.where("false"), pack, offers, out)
    assert runner.read_export(spark, out, schema).collect() == [] and runner.read_export(spark, out, schema).schema == schema


def test_per_batch_report_is_idempotent(spark, tmp_path):
    cat = catalogue(spark, SF_SMALL)
    out = str(tmp_path / "report")
    upd = S.as_price_updates(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    body = S.per_batch_report(cat, K.pack(K.HTTP_PACK), out)
    body(upd, 0)
    first = spark.read.parquet(out).orderBy("query_name").collect()
    body(upd, 0)  # a replayed batch overwrites its own folder
    again = spark.read.parquet(out).orderBy("query_name").collect()
    assert first == again and sum(r.n_rows for r in first) > 0


def test_command_line_pack_report(spark, tmp_path, capsys):
    out = str(tmp_path / "cli")
    runner.main(["--tables", SF_SMALL, "--pack", "script", "--out", out])
    assert sorted(os.listdir(out)) == ["digest", "document", "shapes"]
    assert "macbook cheap" in capsys.readouterr().out


def test_export_csv(spark, tmp_path):
    cat = catalogue(spark, SF_SMALL)
    out = str(tmp_path / "csv")
    runner.export(cat, K.pack(K.SCRIPT_PACK), offer_rows(spark, SF_SMALL), out, fmt="csv")
    back = spark.read.option("header", "true").csv(out)
    assert "rank" in back.columns and "export_name" in back.columns
    assert "offer.startDate" in back.columns
    assert back.select("query_name", "rank").distinct().count() == sum(runner.search(cat, q).rows.count() for q in K.pack(K.SCRIPT_PACK))


def test_incremental_run_writes_counts_and_digests(spark, tmp_path):
    cat = catalogue(spark, SF_SMALL)
    src = str(tmp_path / "in")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").write.parquet(src)
    out, dig, ck = str(tmp_path / "report"), str(tmp_path / "digest"), str(tmp_path / "ck")
    q = runner.incremental(spark, src + "/*.parquet", cat, K.pack(K.HTTP_PACK), out, ck, live=False, digest_out=dig)
    q.awaitTermination()
    counts = {r.query_name: r.n_rows for r in spark.read.parquet(out).collect()}
    heads = spark.read.parquet(dig).collect()
    assert counts and {r.query_name for r in heads} == {k for k, n in counts.items() if n > 0}
    assert all(r.header.startswith("<p>New deals since: ") and f"({r.n_rows}, " in r.header for r in heads)


def test_a_live_run_keeps_the_last_minutes_of_its_clock(spark, tmp_path):
    cat = catalogue(spark, SF_SMALL)
    upd = S.as_price_updates(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    newest = upd.agg(F.max("priceUpdateDate").alias("m")).first()["m"]
    src, led = str(tmp_path / "in"), str(tmp_path / "ledger")
    spark.read.parquet(f"{SF_SMALL}/events.parquet").write.parquet(src)
    q = runner.incremental(spark, src + "/*.parquet", cat, K.pack(K.HTTP_PACK), str(tmp_path / "out"), str(tmp_path / "ck"),
                           live=False, ledger=led, clock=lambda: S.ntz_literal(newest))
    q.awaitTermination()
    recent = upd.where(F.col("priceUpdateDate") > T.lookback(S.ntz_literal(newest), 16))
    assert sorted(r["event_id"] for r in S.delivered(spark, led).collect()) == sorted(
        r["event_id"] for r in recent.select(*S.KEY, "event_id").groupBy(*S.KEY).agg(F.min("event_id").alias("event_id")).collect())


def test_a_product_counts_once_at_its_newest_price(spark):
    cat = catalogue(spark, SF_SMALL)
    sku = cat.first()["sku"]
    upd = spark.createDataFrame([(1, sku, dt.datetime(2024, 1, 1), 5.0), (2, sku, dt.datetime(2024, 1, 2), 7.0),
                                 (3, sku, dt.datetime(2023, 1, 2), 9.0)], "event_id long, sku long, priceUpdateDate timestamp_ntz, salePrice double")
    got = S.apply_updates(cat, upd).collect()
    assert [(r["sku"], r["salePrice"], r["priceUpdateDate"]) for r in got] == [(sku, 7.0, dt.datetime(2024, 1, 2))]
