"""Running searches the way the deal pipeline is used.

* ``search``       - one saved search: the ranked wide rows, and the offer
                     maps of those rows in exploded form;
* ``pack_report``  - a pack run in one scan: per-query shapes, digest
                     headers for the non-empty ones, and the ordered document
                     lines, all written under one output folder;
* ``export``       - the pack's rows, one folder per query named by the first
                     word of its subject;
* ``export_committed`` / ``read_export`` - the same as files of bounded size, valid
                     once a manifest is written;
* ``incremental``  - the timer: a file stream of price changes, deduplicated
                     across overlapping runs, reported per micro-batch.

Command line (batch pack over a tables folder)::

    python -m dealspark.plans.runner --tables /data/sf1 --pack http --out /shared/reports/run-1
"""

from __future__ import annotations

import argparse
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from dealspark.functions import text as X
from dealspark.functions import timefns as T
from dealspark.operators.compose import add_offers, latest_update, pack_wide, run_search
from dealspark.operators.projection import offer_entries
from dealspark.plans import packs as K
from dealspark.plans import report as R
from dealspark.plans.packs import SavedQuery
from dealspark.streaming import incremental as S

PACKS = {"http": K.HTTP_PACK, "frequent": K.FREQUENT_PACK, "daily": K.DAILY_PACK, "script": K.SCRIPT_PACK}


@dataclass(frozen=True)
class SearchResult:
    rows: DataFrame     # spec columns, attribute columns, rank
    offers: DataFrame   # (sku, offer_pos, offer.<field>...) for the rows' skus


def search(catalogue: DataFrame, query: SavedQuery, offers: DataFrame | None = None,
           now: Column | None = None) -> SearchResult:
    rows = run_search(catalogue, query, now)
    if offers is None:
        return SearchResult(rows, None)
    hits = catalogue.where(query.where(latest_update(catalogue) if now is None else now, catalogue.columns)).select("sku")
    return SearchResult(rows, offer_entries(offers, query.spec).join(hits, "sku", "left_semi"))


def pack_report(catalogue: DataFrame, queries: Sequence[SavedQuery], offers: DataFrame, out: str,
                now: Column | None = None) -> DataFrame:
    """Write ``shapes/``, ``digest/`` (non-empty queries only) and ``document/``
    (ordered text lines) under ``out``; return the shapes as read back."""
    now = latest_update(catalogue) if now is None else now
    shapes = R.shape(catalogue, queries, now)
    shapes.write.mode("overwrite").parquet(f"{out}/shapes")
    stored = catalogue.sparkSession.read.parquet(f"{out}/shapes")
    since = R.since_text(T.cutoff(now, T.DAILY_LOOKBACK_MINUTES, T.DAILY_ZONE))
    R.digest(stored.where(F.col("n_rows") > 0), since).write.mode("overwrite").parquet(f"{out}/digest")
    R.write_document(R.document_lines(catalogue, queries, offers, now), f"{out}/document")
    return stored


def export_rows(catalogue: DataFrame, queries: Sequence[SavedQuery], offers: DataFrame, now: Column | None = None) -> DataFrame:
    """The pack's rows with their offers exploded, and ``export_name``: the first word of the subject."""
    spark = catalogue.sparkSession
    names = spark.createDataFrame([(q.name, q.subject) for q in queries], "query_name string, subject string")
    return (add_offers(pack_wide(catalogue, queries, now, with_sku=True), offers).drop("__sku")
            .join(F.broadcast(names), "query_name")
            .withColumn("export_name", X.first_word(F.col("subject"))).drop("subject"))


def export(catalogue: DataFrame, queries: Sequence[SavedQuery], offers: DataFrame, out: str, now: Column | None = None,
           fmt: str = "parquet") -> None:
    """``export_rows``, one ``export_name=<...>`` folder per query;
    ``fmt="csv"`` (with a header) for spreadsheet users."""
    (export_rows(catalogue, queries, offers, now)
        .write.mode("overwrite").partitionBy("export_name").format(fmt)
        .options(**({"header": "true"} if fmt == "csv" else {})).save(out))


#: Rows of one exported file.
EXPORT_FILE_ROWS = 500_000


def export_committed(catalogue: DataFrame, queries: Sequence[SavedQuery], offers: DataFrame, out: str,
                     now: Column | None = None, file_rows: int = EXPORT_FILE_ROWS) -> str:
    """``export_rows`` in files of at most ``file_rows`` rows, valid only once its manifest is written.

    Every run writes a folder of its own under ``out/runs``; its manifest - one row per file with
    its rows, in one file, which appears at once - follows last.  A reader takes the newest
    manifest (``read_export``), so it sees a whole export, the one before or none, whatever becomes
    of a run.  Returns the run's name."""
    spark = catalogue.sparkSession
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    rows = export_rows(catalogue, queries, offers, now)
    folder = f"{out.rstrip('/')}/runs/{run}"
    rows.write.option("maxRecordsPerFile", file_rows).parquet(folder)
    files = (spark.read.schema(rows.schema).parquet(folder).groupBy(F.col("_metadata.file_name").alias("file"))
             .agg(F.count(F.lit(1)).alias("n_rows")).withColumn("run", F.lit(run)))
    # One row per file of the export, and one for an export without rows.
    none = spark.createDataFrame([(None, 0, run)], "file string, n_rows long, run string")
    files.unionByName(none).coalesce(1).write.mode("append").parquet(f"{out.rstrip('/')}/manifest")
    return run


def read_export(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The rows of the newest committed export under ``out``: the files of its manifest and no others.
    A file that is gone fails the read."""
    manifest = spark.read.schema("file string, n_rows long, run string").parquet(f"{out.rstrip('/')}/manifest")
    newest = manifest.agg(F.max("run")).first()[0]
    named = [r["file"] for r in manifest.where((F.col("run") == newest) & F.col("file").isNotNull()).select("file").collect()]
    if not named:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{out.rstrip('/')}/runs/{newest}/{f}" for f in named])


def incremental(spark: SparkSession, source: str, catalogue: DataFrame, queries: Sequence[SavedQuery],
                out: str, checkpoint: str, live: bool = True, ledger: str | None = None,
                digest_out: str | None = None, clock: Callable[[], Column] | None = None) -> StreamingQuery:
    """The timer: new price changes under ``source`` every 15 minutes, reported
    per batch under ``out`` (and the mail headers of non-empty results under
    ``digest_out``).

    A live run keeps the changes of the last 16 minutes before the clock, read
    anew for every batch; ``live=False`` catches up once on all that has landed,
    with the newest change as its "now".  ``ledger`` (default beside ``out``)
    holds the changes already reported.
    """
    clock = clock or (S.utc_now if live else None)
    body = S.first_deliveries(
        ledger or f"{out.rstrip('/')}-ledger",
        S.per_batch_report(catalogue, queries, out, clock, digest_out=digest_out), since_clock=clock)
    return S.run(S.price_updates(spark, source), checkpoint, foreach_batch=body, live=live)


def main(argv: Sequence[str] | None = None) -> None:
    from dealspark.session import build_session
    from dealspark.sources.catalogue import catalogue, offer_rows

    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--tables", required=True, help="folder holding the input parquet tables")
    ap.add_argument("--pack", default="http", choices=sorted(PACKS))
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    args = ap.parse_args(argv)
    spark = build_session()
    shapes = pack_report(catalogue(spark, args.tables, spread=True), K.pack(PACKS[args.pack]), offer_rows(spark, args.tables), args.out)
    shapes.orderBy("pack_order").show(truncate=False)


if __name__ == "__main__":
    main()
