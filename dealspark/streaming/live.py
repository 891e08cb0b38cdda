"""Live result counts: every price change adds to the searches it enters and
subtracts from those it leaves.

``price_steps`` keeps the newest price of each product in keyed state and turns
a stream of changes into steps from the price before to the price after; a
repeated or late change is no step.  ``signed_counts`` is a ``foreachBatch`` body
that looks the stepped products up in the catalogue, tags both versions with the
searches of a pack and writes +1 for every search a product enters and -1 for
every one it leaves, one folder per batch.  The counts of a full run plus all
batches so far are, after every batch, those of a full run over the catalogue
with the changes applied.

State is one small row per product that ever changed; on a cluster keep it in the
RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).  Searches
with a lookback cutoff are counted against the clock that is passed in: products
that leave them by age alone do so with the next full run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dealspark.operators.compose import tag_pack
from dealspark.plans import report as R
from dealspark.plans.packs import SavedQuery

_STEP = "sku bigint, old_price double, old_at bigint, new_price double, new_at bigint"


def _micros(ts: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), ts)


def _time(micros: Column) -> Column:
    return F.timestamp_add("MICROSECOND", micros, F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")))


def price_steps(updates: DataFrame) -> DataFrame:
    """``(sku, old_price, old_at, new_price, new_at)`` of every product whose newest change is
    newer than the one known before (null: the catalogue's own price); of changes at one time the
    larger price counts as the newer one, however they come in batches.  Changes without a time, a
    product or a price are no steps."""
    import pandas as pd

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before: tuple[Any, ...] = state.get if state.exists else (None, None)
        newest = max((at, price) for p in parts for at, price in zip(p["at"].tolist(), p["price"].tolist()))
        if before[0] is None or newest > before:
            state.update(newest)
            yield pd.DataFrame({"sku": [key[0]], "old_price": [before[1]], "old_at": pd.array([before[0]], "Int64"),
                                "new_price": [newest[1]], "new_at": [newest[0]]})

    rows = (updates.where("sku is not null and priceUpdateDate is not null and salePrice is not null")
            .select("sku", _micros(F.col("priceUpdateDate")).alias("at"), F.col("salePrice").alias("price")))
    return rows.groupBy("sku").applyInPandasWithState(step, _STEP, "at bigint, price double", "append", GroupStateTimeout.NoTimeout)


def signed_counts(catalogue: DataFrame, queries: Sequence[SavedQuery], out: str,
                  clock: Callable[[], Column]) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` body over ``price_steps``: ``(query_name, change)`` under ``out/batch_id=<n>``,
    replaced when a batch is replayed."""
    def body(steps: DataFrame, batch_id: int) -> None:
        sides = F.array(
            F.struct(F.lit(-1).alias("sign"), F.col("old_price").alias("price"), F.col("old_at").alias("at")),
            F.struct(F.lit(1).alias("sign"), F.col("new_price").alias("price"), F.col("new_at").alias("at")))
        both = steps.select("sku", F.explode(sides).alias("__s"))
        versions = (catalogue.join(both, "sku")
                    .withColumn("salePrice", F.when(F.col("__s.at").isNull(), F.col("salePrice")).otherwise(F.col("__s.price")))
                    .withColumn("priceUpdateDate", F.coalesce(_time(F.col("__s.at")), F.col("priceUpdateDate"))))
        (tag_pack(versions, queries, clock()).groupBy("query_name").agg(F.sum("__s.sign").cast("long").alias("change"))
         .write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id={batch_id}"))
    return body


def write_base(catalogue: DataFrame, queries: Sequence[SavedQuery], out: str, now: Column) -> None:
    """The counts of a full run, as the first entry of the changes under ``out``."""
    (R.shape(catalogue, queries, now).select("query_name", F.col("n_rows").alias("change"))
     .write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch_id=-1"))


def live_counts(changes: DataFrame) -> DataFrame:
    """``(query_name, n_rows)`` now: the full run and all changes since."""
    return changes.groupBy("query_name").agg(F.sum("change").cast("long").alias("n_rows"))
