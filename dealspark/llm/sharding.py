"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a 63-bit key: the CRC-32 of the text, then 31 bits of a hash
of the id, so equal texts lie together and a large group of copies can still be
split.  Probe keys divide the key space evenly; one aggregation counts the exact
bytes and rows between neighbouring probes.  Intervals that hold a shard's
boundary, or too much for one task, get new probes inside, until every boundary
is within ``tolerance`` of its place or its interval holds one key.  A boundary
moves by up to ``GROUP_TOLERANCE`` of a shard where that keeps equal texts in one
shard; a group of copies beyond that is split.  Only these
counts reach the driver (at most ``PROBES`` intervals a round).  Then one
exchange by key range numbers the rows: a row's slot is the number of rows in
earlier ranges of its shard, known from the counts, plus its rank in its range.

Edge cases: a null text counts as empty (size 8, CRC 0); null ids hash alike;
rows with the same key stay in one range; an empty table gives an empty result;
with fewer rows than shards some shards are empty.
"""

from __future__ import annotations

import bisect
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

KEY_BITS = 63
TOP_BITS = 12
PROBES = 1 << 14
TOLERANCE = 0.001
#: Share of a shard that may go to or come from its neighbour to keep equal texts together.
GROUP_TOLERANCE = 0.005
#: Bits of the key below the text's CRC-32.
TEXT_SHIFT = 31
#: Key ranges a shard is sorted in.
RANGES = 64


def text_size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 8).cast("long")


def text_crc32(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def sort_key(text: Column, doc: Column) -> Column:
    return F.shiftleft(text_crc32(text), TEXT_SHIFT).bitwiseOR(F.xxhash64(doc).bitwiseAND((1 << TEXT_SHIFT) - 1))


@dataclass(frozen=True)
class Cell:
    """Keys whose upper bits are ``prefix``; ``bits`` lower bits are free."""

    prefix: int
    bits: int
    size: int
    rows: int

    @property
    def low(self) -> int:
        return self.prefix << self.bits


@dataclass(frozen=True)
class Plan:
    """Ranges in key order: first key, shard, rows of the shard in earlier ranges."""

    lows: list[int]
    shards: list[int]
    offsets: list[int]


def _histogram(keys: DataFrame, cells: list[Cell] | None) -> list[Cell]:
    """Exact sizes between probes: over all keys, or inside the given cells."""
    if cells is None:
        bits = KEY_BITS - TOP_BITS
    else:
        width = cells[0].bits
        bits = max(0, width - max(2, (PROBES // len(cells)).bit_length() - 1))
        keys = keys.where(F.shiftright("key", width).isin([c.prefix for c in cells]))
    rows = (keys.groupBy(F.shiftright("key", bits).alias("prefix"))
            .agg(F.sum("size").alias("size"), F.count("*").alias("rows")).collect())
    return [Cell(r["prefix"], bits, r["size"], r["rows"]) for r in rows]


def plan(keys: DataFrame, n_shards: int, tolerance: float = TOLERANCE, ranges: int = RANGES) -> Plan:
    """Splitters of ``keys`` (key, size)."""
    cells = sorted(_histogram(keys, None), key=lambda c: c.low)
    total, n_rows = sum(c.size for c in cells), sum(c.rows for c in cells)
    targets = [total * j / n_shards for j in range(1, n_shards)]
    most_size, most_rows = total / (n_shards * ranges), n_rows / (n_shards * ranges)

    def open_cells() -> list[Cell]:
        found, at = [], 0
        for c in cells:
            here = targets[bisect.bisect_right(targets, at):bisect.bisect_left(targets, at + c.size)]
            off = max((min(t - at, at + c.size - t) for t in here), default=0)
            if c.bits and c.rows > 1 and (off > tolerance * total / n_shards or c.size > most_size or c.rows > most_rows):
                found.append(c)
            at += c.size
        return found

    while todo := open_cells():
        # Every open cell is of the last round, so all have the same width.
        fine = [c for at in range(0, len(todo), PROBES // 4) for c in _histogram(keys, todo[at:at + PROBES // 4])]
        cells = sorted({*cells} - {*todo} | {*fine}, key=lambda c: c.low)

    # Each boundary goes to the cell edge nearest to its place that splits no
    # text, if there is one within GROUP_TOLERANCE, else to the nearest edge.
    edges = [0]
    for c in cells:
        edges.append(edges[-1] + c.size)
    slack = GROUP_TOLERANCE * total / n_shards

    def cut(t: float) -> int:
        at = bisect.bisect_left(edges, t)
        near = min((i for i in (at - 1, at) if i >= 0), key=lambda i: abs(edges[i] - t))
        whole = [i for i in range(bisect.bisect_left(edges, t - slack), bisect.bisect_right(edges, t + slack))
                 if i == len(cells) or not cells[i].low & ((1 << TEXT_SHIFT) - 1)]
        return min(whole, key=lambda i: abs(edges[i] - t), default=near)

    cuts = [0, *map(cut, targets), len(cells)]
    out = Plan([], [], [])
    for shard in range(n_shards):
        before = size = rows = 0
        for i in range(cuts[shard], cuts[shard + 1]):
            c = cells[i]
            if i == cuts[shard] or size + c.size > most_size or rows + c.rows > most_rows:
                out.lows.append(c.low), out.shards.append(shard), out.offsets.append(before)
                size = rows = 0
            size, rows, before = size + c.size, rows + c.rows, before + c.rows
    return out


def _lookup(key: Column, p: Plan) -> Column:
    """Number of the range that holds ``key``: a table by the key's top bits, then the few starts inside."""
    shift = KEY_BITS - TOP_BITS
    inside: list[list[int]] = [[] for _ in range(1 << TOP_BITS)]
    for low in p.lows:
        inside[low >> shift].append(low)
    base, n = [], 0
    for x in inside:
        base.append(n)
        n += len(x)
    top = F.shiftright(key, shift).cast("int")
    starts = F.get(F.from_json(F.lit(json.dumps(inside)), "array<array<bigint>>"), top)
    below = F.aggregate(starts, F.lit(0), lambda n, x: n + (x <= key).cast("int"))
    return F.get(F.from_json(F.lit(json.dumps(base)), "array<int>"), top) + below - 1


def shard(df: DataFrame, n_shards: int = 24, key: str = "doc_id", text: str = "text",
          tolerance: float = TOLERANCE) -> DataFrame:
    """``df`` with ``size``, ``text_crc32``, ``shard`` and ``slot``.  The exchange
    carries only the columns that are used afterwards."""
    keyed = df.select(sort_key(F.col(text), F.col(key)).alias("key"), text_size(F.col(text)).alias("size"))
    p = plan(stored(keyed, "shard-keys"), n_shards, tolerance)
    numbers = lambda xs: F.from_json(F.lit(json.dumps(xs)), "array<bigint>")
    within = Window.partitionBy("_range").orderBy("_key", key)
    out = (df.withColumns({"size": text_size(F.col(text)), "text_crc32": text_crc32(F.col(text)),
                           "_key": sort_key(F.col(text), F.col(key))})
           .withColumn("_range", _lookup(F.col("_key"), p))
           .withColumn("_nth", F.row_number().over(within)))
    return out.withColumns({
        "shard": F.get(numbers(p.shards), F.col("_range")).cast("int"),
        "slot": F.get(numbers(p.offsets), F.col("_range")) + F.col("_nth") - 1}).drop("_key", "_range", "_nth")
