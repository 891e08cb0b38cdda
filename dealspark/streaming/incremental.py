"""Incremental runs with Structured Streaming.

The reference re-runs its searches on a timer with a lookback cutoff (16
minutes every 15 minutes, 1441 minutes daily), so consecutive runs overlap.
Here the same job is a file stream over landed data:

* ``price_updates``  - a stream of price changes (the ``events`` table's
  purchases) read with a fixed schema, never inferred;
* ``since``          - keep changes strictly after a cutoff (STR-1);
* ``first_deliveries`` - drop repeats that overlapping runs deliver, keyed on
  ``(sku, priceUpdateDate)``, against a written ledger; nothing is lost for
  being late (STR-2);
* ``per_batch_report`` - ``foreachBatch`` that tags each micro-batch with a
  pack's searches and writes one report partition per batch id, so a replayed
  batch overwrites instead of double counting (STR-4);
* ``run`` - start a query with ``availableNow`` (tests, catch-up) or a
  processing-time cadence (live, STR-3) and a checkpoint in the shared folder.

Sinks are files (parquet) with checkpoints; no memory sink, nothing is
gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T_
from pyspark.sql.streaming import StreamingQuery

from dealspark.functions import timefns as T
from dealspark.operators.compose import latest_update, tag_pack
from dealspark.plans.packs import SavedQuery

EVENTS_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# Fixed value: live cadence of the frequent timer.
LIVE_CADENCE = "15 minutes"
#: Files of one micro-batch; a catch-up over a backlog runs in several.
MAX_FILES_PER_TRIGGER = 1000


def as_price_updates(events: DataFrame) -> DataFrame:
    """Purchases as price changes: ``(event_id, sku, priceUpdateDate, salePrice)``."""
    return (events.where(F.col("event_type") == "purchase")
                  .select("event_id", F.col("user_id").alias("sku"),
                          F.col("ts").alias("priceUpdateDate"), F.col("value").alias("salePrice")))


def price_updates(spark: SparkSession, source: str, max_files_per_trigger: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """SRC-7 for price events: a file stream over ``source`` (a folder or a glob)."""
    reader = spark.readStream.schema(EVENTS_SCHEMA).option("maxFilesPerTrigger", str(max_files_per_trigger))
    return as_price_updates(reader.parquet(source))


def since(updates: DataFrame, cutoff: Column) -> DataFrame:
    """STR-1: changes strictly after ``cutoff`` (a ``TIMESTAMP_NTZ`` literal)."""
    return updates.where(F.col("priceUpdateDate") > cutoff)


def ntz_literal(value) -> Column:
    """A ``TIMESTAMP_NTZ`` literal that does not depend on the session zone."""
    return F.to_timestamp_ntz(F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")))


def utc_now() -> Column:
    """The clock, as a ``TIMESTAMP_NTZ`` literal in UTC."""
    return ntz_literal(datetime.now(timezone.utc).replace(tzinfo=None))


KEY = ("sku", "priceUpdateDate")


def first_deliveries(ledger: str, body: Callable[[DataFrame, int], None] | None = None,
                     since_clock: Callable[[], Column] | None = None,
                     minutes: int = T.FREQUENT_LOOKBACK_MINUTES, zone: str = "UTC") -> Callable[[DataFrame, int], None]:
    """STR-2: ``foreachBatch`` body that passes on the first delivery of each
    ``(sku, priceUpdateDate)``, however late or out of order it comes.

    Deliveries are written to ``ledger`` by day, then by run and batch.  A batch
    is first aggregated to one row per key, then anti-joined with what others
    delivered on its days: the folders of these days are the only ones that are
    looked at, so neither state, listing nor read grows with the ledger's age or
    with the days between a late change and the newest.  A replayed batch replaces
    its own folders and is compared with the others.  A run is the query's id,
    which its checkpoint keeps: a query with a fresh checkpoint adds to an old
    ledger and repeats nothing that is in it.  With ``since_clock``, changes older
    than ``minutes`` before the clock are left out (STR-1).
    """
    base = ledger.rstrip("/")

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        part = f"{spark.sparkContext.getLocalProperty('sql.streaming.queryId') or 'run'}-{batch_id}"
        rows = since(batch, T.cutoff(since_clock(), minutes, zone)) if since_clock else batch
        others = [c for c in rows.columns if c not in KEY]
        first = F.min(F.struct(*others)).alias("__first")
        rows = (rows.groupBy(*KEY).agg(first).select(*KEY, "__first.*").select(*rows.columns)
                .withColumn("day", F.coalesce(F.to_date("priceUpdateDate").cast("string"), F.lit(NO_DAY))))
        days = [f"{base}/day={r['day']}" for r in rows.select("day").distinct().collect()]
        known = _read_folders(spark, base, days, rows.schema)
        if known is not None:
            known = known.where(F.col("part") != part).select(*[F.col(c).alias(f"__{c}") for c in KEY])
            same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in KEY]
            rows = rows.join(known, same, "left_anti")
        # Few files a day; a day with very many changes is split.
        (rows.withColumn("part", F.lit(part)).hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "part").parquet(base))
        if body:
            new = _read_folders(spark, base, [f"{d}/part={part}" for d in days], rows.schema)
            body(spark.createDataFrame([], batch.schema) if new is None else new.select(*batch.columns), batch_id)
    return run_batch


#: Day folder of changes without a time.
NO_DAY = "none"


def _read_folders(spark: SparkSession, base: str, folders: list[str], schema: T_.StructType) -> DataFrame | None:
    """The rows of those ledger folders that exist; none is listed besides."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    system = path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    found = [f for f in folders if system.exists(path(f))]
    if not found:
        return None
    full = T_.StructType([*schema.fields, T_.StructField("part", T_.StringType())])
    return spark.read.schema(full).option("basePath", base).parquet(*found)


def delivered(spark: SparkSession, ledger: str) -> DataFrame:
    """All first deliveries of a ledger."""
    return spark.read.parquet(ledger).drop("part", "day")


def latest_changes(updates: DataFrame) -> DataFrame:
    """The newest change of each sku (ties: the larger price), combined before the shuffle."""
    newest = F.max(F.struct("priceUpdateDate", "salePrice")).alias("__n")
    return updates.groupBy("sku").agg(newest).select(
        "sku", F.col("__n.salePrice").alias("__new_price"), F.col("__n.priceUpdateDate").alias("__new_ts"))


def apply_updates(catalogue: DataFrame, updates: DataFrame) -> DataFrame:
    """Changed catalogue rows, each once, with the price and time of its newest change.

    How the two sides meet is left to the planner, which knows the size of the
    written batch."""
    return (catalogue.join(latest_changes(updates), "sku")
                     .withColumn("salePrice", F.col("__new_price"))
                     .withColumn("priceUpdateDate", F.col("__new_ts"))
                     .drop("__new_price", "__new_ts"))


def per_batch_report(catalogue: DataFrame, queries: Sequence[SavedQuery], out: str,
                     clock: Callable[[], Column] | None = None, digest_out: str | None = None,
                     ) -> Callable[[DataFrame, int], None]:
    """STR-4: ``foreachBatch`` body writing ``(query_name, n_rows)`` per batch.

    Each batch lands in its own ``batch_id=<n>`` folder in overwrite mode, so a
    batch replayed after a failure replaces its earlier output.  A product
    counts once, at its newest price.  "Now" is read from ``clock`` for every
    batch, else it is the newest update of the changed products.  With
    ``digest_out``, the run's mail headers ("New deals since", shape) are
    written too, for the queries with results only (SNK-2).
    """
    def body(batch: DataFrame, batch_id: int) -> None:
        changed = apply_updates(catalogue, batch)
        now = clock() if clock else latest_update(catalogue.select("priceUpdateDate").union(batch.select("priceUpdateDate")))
        counts = (tag_pack(changed, queries, now)
                  .groupBy("query_name").agg(F.count(F.lit(1)).alias("n_rows")))
        target = f"{out.rstrip('/')}/batch_id={batch_id}"
        counts.write.mode("overwrite").parquet(target)
        if digest_out:
            _write_digest(batch.sparkSession.read.parquet(target), queries, now,
                          f"{digest_out.rstrip('/')}/batch_id={batch_id}")
    return body


def _write_digest(counts: DataFrame, queries: Sequence[SavedQuery], now: Column, path: str) -> None:
    """Mail headers of one run: only queries with results (the counts table
    has no row for an empty one), width = the query's columns."""
    from dealspark.plans.report import digest
    width = None
    for q in queries:
        n_cols = F.lit(len(q.spec.output_names(with_offers=True)))
        cond = F.col("query_name") == q.name
        width = F.when(cond, n_cols) if width is None else width.when(cond, n_cols)
    shapes = counts.where(F.col("n_rows") > 0).withColumn("n_cols", width)
    since = T.cutoff_text(T.cutoff(now, T.FREQUENT_LOOKBACK_MINUTES, T.FREQUENT_ZONE))
    digest(shapes, since).write.mode("overwrite").parquet(path)


def run(stream: DataFrame, checkpoint: str, sink: str | None = None,
        foreach_batch: Callable[[DataFrame, int], None] | None = None,
        live: bool = False, output_mode: str = "append") -> StreamingQuery:
    """Start ``stream`` into a parquet ``sink`` or a ``foreach_batch`` body.

    ``live=False`` processes what has landed and stops (``availableNow``);
    ``live=True`` keeps running on the 15-minute cadence.
    """
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode)
    w = w.trigger(processingTime=LIVE_CADENCE) if live else w.trigger(availableNow=True)
    if foreach_batch is not None:
        w = w.foreachBatch(foreach_batch)
    else:
        w = w.format("parquet").option("path", sink)
    return w.start()


def run_to_end(stream: DataFrame, checkpoint: str, sink: str | None = None,
               foreach_batch: Callable[[DataFrame, int], None] | None = None) -> None:
    q = run(stream, checkpoint, sink, foreach_batch, live=False)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
