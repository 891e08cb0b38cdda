"""Exact row numbers without a single-partition window or a per-key sort task.

``row_number().over(Window.orderBy(...))`` moves the whole input into one task,
and ``Window.partitionBy(key)`` sorts a hot key (which may hold a third of the
rows) in one task.  Here one plan serves every size, nothing runs while it is
built, and no size is probed:

* ``global_rank`` range-partitions on the full, unique order, sorts within the
  partitions and numbers the rows of each; the rows counted per partition (one
  row per partition, so bounded by the partition count) give every partition
  its first number and are broadcast back.
* ``keyed_rank`` (few keys, such as the searches of a pack) subtracts from the
  global rank the rows of the earlier keys: one row per key.
* ``stepped_rank`` (many keys) numbers rows within (key, step), where the step
  is the leading part of the order, and adds the rows of the key's earlier
  steps.  A hot key is spread over its steps.
* ``split_rank`` (many keys, few of them hot) numbers the rows of most keys with
  one exchange and leaves only the hot keys to ``stepped_rank``.
* ``running_sum`` adds up a value over the earlier rows of the whole frame.

Both branches of ``global_rank`` must read one and the same range exchange,
because the bounds of a range partitioning are sampled per exchange.  So the row
travels through it as a single array value, which no optimizer rule can prune
differently in the two branches, and Spark reuses the exchange; a row that lies
outside its partition's count fails the query rather than number rows twice.
The partition number is stated, so adaptive execution does not merge partitions.

The order must be total (end with a unique key), so that a recomputed partition
(lost executor) yields the same numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_ROW, _PID, _MID, _BASE, _N = "__ds_row", "__ds_pid", "__ds_mid", "__ds_base", "__ds_n"
_LOW_BITS = 33  # monotonically_increasing_id keeps the record number in the low 33 bits


def _named(name: str) -> Column:
    return F.col(f"`{name}`")


@dataclass(frozen=True)
class Asc:
    """One ascending sort key."""

    name: str
    nulls_last: bool = False

    def column(self, of: Callable[[str], Column] = _named) -> Column:
        c = of(self.name)
        return c.asc_nulls_last() if self.nulls_last else c.asc()


SortKey = Asc | str


def _keys(order: Sequence[SortKey]) -> list[Asc]:
    return [k if isinstance(k, Asc) else Asc(k) for k in order]


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _field(name: str) -> Column:
    return F.element_at(F.col(_ROW), 1)[name]


def _ranged(df: DataFrame, order: Sequence[SortKey]) -> tuple[DataFrame, list[Column]]:
    by = [k.column(_field) for k in _keys(order)]
    packed = df.select(F.array(F.struct(*[_named(c) for c in df.columns])).alias(_ROW))
    return packed.repartitionByRange(_partitions(df), *by).withColumn(_PID, F.spark_partition_id()), by


def _numbered(ranged: DataFrame, by: list[Column]) -> DataFrame:
    """Rows of ``_ranged`` with ``_BASE``: their number over all partitions."""
    counts = ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias(_N))
    # One row per partition: the single-partition window is bounded by design.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(_PID, _N, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_BASE))
    local = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), _LOW_BITS)
    rows = ranged.sortWithinPartitions(*by).withColumn(_MID, F.monotonically_increasing_id())
    number = F.when(local < F.col(_N), F.col(_BASE) + local).otherwise(
        F.raise_error(F.lit("the two reads of a ranked frame were partitioned differently")).cast("long"))
    # A left join: a partition without a count fails, too, rather than lose its rows.
    return rows.join(F.broadcast(offsets), _PID, "left").select(_ROW, number.cast("long").alias(_BASE))


def _unpacked(df: DataFrame, columns: Sequence[str], out: str, number: Column) -> DataFrame:
    return df.select(*[_field(c).alias(c) for c in columns], number.cast("long").alias(out))


def global_rank(df: DataFrame, order: Sequence[SortKey], out: str = "rank") -> DataFrame:
    """Add ``out`` = 0-based position of each row in ``order`` over the whole frame."""
    ranged, by = _ranged(df, order)
    return _unpacked(_numbered(ranged, by), df.columns, out, F.col(_BASE))


def keyed_rank(df: DataFrame, key: str, order: Sequence[SortKey], out: str = "rank") -> DataFrame:
    """0-based position in ``order`` among the rows of the same ``key``.

    For a key with few values (the searches of a pack): their counts are one
    row each, broadcast back."""
    ranged, by = _ranged(df, [key, *order])
    numbered = _numbered(ranged, by)
    counts = ranged.groupBy(_field(key).alias(_MID)).agg(F.count(F.lit(1)).alias(_N))
    before = Window.orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(_MID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_PID))
    joined = numbered.join(F.broadcast(starts), _field(key).eqNullSafe(F.col(_MID)), "left")
    start = F.coalesce(F.col(_PID), F.raise_error(F.lit("a key of a ranked frame has no count")).cast("long"))
    return _unpacked(joined, df.columns, out, F.col(_BASE) - start)


def stepped_rank(df: DataFrame, keys: Sequence[str], step: str, order: Sequence[SortKey], out: str = "rank") -> DataFrame:
    """0-based position in ``(step, order)`` among the rows of the same ``keys``.

    A task sorts the rows of one (key, step); the rows of earlier steps come
    from counts, of which a key has one per step."""
    cells = [*keys, step]
    own = Window.partitionBy(*map(_named, cells)).orderBy(*[k.column() for k in _keys(order)])
    earlier = (Window.partitionBy(*map(_named, keys)).orderBy(_named(step))
               .rowsBetween(Window.unboundedPreceding, -1))
    counts = df.groupBy(*map(_named, cells)).agg(F.count(F.lit(1)).alias(_N))
    starts = counts.select(*[_named(c).alias(f"__ds_{i}") for i, c in enumerate(cells)],
                           F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_BASE))
    same = F.lit(True)
    for i, c in enumerate(cells):
        same = same & _named(c).eqNullSafe(F.col(f"__ds_{i}"))
    return (df.withColumn(_MID, F.row_number().over(own) - 1).join(starts, same)
            .withColumn(out, (F.col(_BASE) + F.col(_MID)).cast("long"))
            .select(*map(_named, df.columns), out))


#: Rows of a key that one task may sort.
HOT_ROWS = 200_000


def split_rank(df: DataFrame, key: str, step: str, order: Sequence[SortKey], out: str = "rank",
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """``stepped_rank`` for one key column of which few values hold many rows.

    Keys of at most ``hot_rows`` rows are numbered by one window over the key, so
    that their rows move once; the others (at most one per ``hot_rows`` rows of the
    frame, broadcast) are spread over their steps."""
    counts = df.groupBy(_named(key).alias(_PID)).agg(F.count(F.lit(1)).alias(_N))
    hot = F.broadcast(counts.where(F.col(_N) > hot_rows).select(_PID))
    same = _named(key).eqNullSafe(F.col(_PID))
    own = Window.partitionBy(_named(key)).orderBy(*[k.column() for k in _keys([step, *order])])
    cold = df.join(hot, same, "left_anti").withColumn(out, (F.row_number().over(own) - 1).cast("long"))
    return cold.union(stepped_rank(df.join(hot, same, "left_semi"), [key], step, order, out))


#: Rows of one block of a running sum.
SUM_BLOCK = 10_000


def running_sum(df: DataFrame, order: Sequence[SortKey], value: str, out: str) -> DataFrame:
    """Add ``out`` = the sum of ``value`` over the rows before each in ``order`` over the whole frame.

    The rows are ranked and summed by blocks of ``SUM_BLOCK``; a block is one row
    of the sums before it."""
    ranked = global_rank(df, order, _MID).withColumn(_PID, F.floor(F.col(_MID) / SUM_BLOCK))
    own = Window.partitionBy(_PID).orderBy(_MID).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.groupBy(_PID).agg(F.sum(_named(value)).alias(_N))
    starts = sums.select(_PID, F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_BASE))
    return (ranked.withColumn(out, F.coalesce(F.sum(_named(value)).over(own), F.lit(0))).join(F.broadcast(starts), _PID)
            .withColumn(out, (F.col(_BASE) + F.col(out)).cast("long")).select(*map(_named, df.columns), out))
