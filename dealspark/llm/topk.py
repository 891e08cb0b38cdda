"""Exact top-k inner products by block-at-a-time pruning.

Vectors are scaled to integers, ordered by a locality code and cut into ranges
of ``RANGE`` vectors, each of ``RANGE / BLOCK`` blocks.  A block keeps the
largest and smallest value of every component and its vectors (its forward
index).  For a query, a block's bound is the sum over the components of the
query's value times the largest (or, where that value is negative, the smallest)
value.  In a range, each query takes the blocks by falling bound and scores them
until the next bound lies below its k-th best score; ties are scored.  Queries
travel in groups of ``QUERIES``.  A group sees the bounds of all ranges, which
travel in sheets: a first round over the share of ranges with the highest bounds
gives each query a k-th score to start from, then the group meets those ranges
only in which a bound reaches it.

Edge cases: vectors that are null or hold null or non-finite components, and
rows with a null id, take no part; an empty vector scores 0; components beyond
the shorter vector count as 0; repeated rows (same id, same vector) count once;
with fewer than k candidates all are listed; no queries give an empty result.
Scores beyond 64 bits are clipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

SCALE = 256
RANGE = 2048
BLOCK = 128
QUERIES = 256
#: Ranges of the first round: one in so many.
FIRST = 16
#: Ranges whose component bounds travel in one row.
SHEET = 1024
CODE_BITS = 16
NONE = np.iinfo(np.int64).min

_PACKED = "id long, m int, dim int, ids binary, data binary, most binary, least binary"


def scaled(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(SCALE) * x.cast("double")))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def _code(rows: np.ndarray) -> np.ndarray:
    """Locality code: signs against fixed directions."""
    if not rows.shape[1]:
        return np.zeros(len(rows), np.int64)
    directions = np.random.default_rng(0).standard_normal((rows.shape[1], CODE_BITS))
    return ((rows @ directions) > 0) @ (1 << np.arange(CODE_BITS, dtype=np.int64))


def _matrix(vectors: list[list[int]]) -> np.ndarray:
    dim = max(map(len, vectors), default=0)
    if all(len(v) == dim for v in vectors):
        return np.array(vectors, np.int64).reshape(len(vectors), dim)
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("v").to_pylist()
        # One code per length, so that a vector's code never depends on its neighbours.
        code = np.zeros(len(vectors), np.int64)
        lens = np.fromiter(map(len, vectors), np.int64, len(vectors))
        for n in np.unique(lens):
            at = np.flatnonzero(lens == n)
            code[at] = _code(_matrix([vectors[i] for i in at]).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array(code), batch.column("vec_id"), batch.column("v")],
                                         names=["code", "vec_id", "v"])


def _packer(size: int):
    """Rows in code order, repeated rows dropped, packed into ranges of ``size``."""
    def pack(ids: list[int], vectors: list[list[int]], n: int) -> pa.RecordBatch:
        data = _matrix(vectors)
        return pa.RecordBatch.from_arrays([
            pa.array([TaskContext.get().partitionId() << 32 | n], pa.int64()), pa.array([len(ids)], pa.int32()),
            pa.array([data.shape[1]], pa.int32()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
            pa.array([data.astype("<i8").tobytes()], pa.binary()),
            *[pa.array([f(data, axis=0).astype("<i8").tobytes()], pa.binary()) for f in (np.max, np.min)]],
            names=["id", "m", "dim", "ids", "data", "most", "least"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, n = [], [], 0
        last = None
        for batch in batches:
            for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("v").to_pylist()):
                if (i, v) == last:
                    continue
                last = (i, v)
                ids.append(i), vectors.append(v)
                if len(ids) == size:
                    yield pack(ids, vectors, n)
                    ids, vectors, n = [], [], n + 1
        if ids:
            yield pack(ids, vectors, n)
    return run


def _unpacked(ids: bytes, data: bytes, m: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, "<i8"), np.frombuffer(data, "<i8").reshape(m, dim)


def _number_kind(q: np.ndarray, x: np.ndarray) -> type:
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(x.astype(float)).max(initial=0)) * max(1, q.shape[1])
    return np.float64 if most < 2 ** 53 else np.int64 if most < 2 ** 62 else object


def search_range(qid: np.ndarray, q: np.ndarray, floor: np.ndarray, ids: np.ndarray, x: np.ndarray,
                 k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(scores, ids) of each query's k best in the range, ``NONE`` where there are
    fewer, and the number of scored (query, block) pairs.  ``floor`` is a known
    lower bound of each query's k-th score over everything."""
    dim = min(q.shape[1], x.shape[1])
    kind = _number_kind(q, x)
    q, x = q[:, :dim].astype(kind), x[:, :dim].astype(kind)
    starts = np.arange(0, len(x), BLOCK)
    most, least = np.maximum.reduceat(x, starts), np.minimum.reduceat(x, starts)
    bound = np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T
    if kind is not object:
        bound = bound.astype(np.int64)
    order = np.argsort(-bound, axis=1, kind="stable")
    scores = np.full((len(q), k), NONE, object if kind is object else np.int64)
    found = np.full((len(q), k), np.iinfo(np.int64).max, np.int64)
    kth = floor.astype(scores.dtype)
    scored = 0
    for turn in range(len(starts)):
        block = order[:, turn]
        active = bound[np.arange(len(q)), block] >= kth
        if not active.any():
            break
        for b in np.unique(block[active]):
            rows = np.flatnonzero(active & (block == b))
            at = slice(starts[b], starts[b] + BLOCK)
            got = q[rows] @ x[at].T
            got = got if kind is object else got.astype(np.int64)
            got = np.where(ids[None, at] == qid[rows, None], NONE, got)
            scored += len(rows)
            s = np.concatenate([scores[rows], got], axis=1)
            d = np.concatenate([found[rows], np.where(got == NONE, np.iinfo(np.int64).max, np.broadcast_to(ids[at], got.shape))], axis=1)
            best = _best(s, d, k)
            scores[rows], found[rows] = np.take_along_axis(s, best, 1), np.take_along_axis(d, best, 1)
            kth[rows] = np.maximum(kth[rows], scores[rows, k - 1])
    return scores, found, scored


def _best(s: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    if s.dtype == object:
        return np.array([sorted(range(len(a)), key=lambda i: (-a[i], b[i]))[:k] for a, b in zip(s, d)])
    return np.lexsort((d, -np.maximum(s, NONE + 1)), axis=-1)[:, :k]


def _cells(k: int):
    """Rows of (query group, range) -> each query's best of the range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
                qid, q = _unpacked(row["ids"], row["data"], row["m"], row["dim"])
                ids, x = _unpacked(row["r_ids"], row["r_data"], row["r_m"], row["r_dim"])
                floor = np.frombuffer(row["floor"], "<i8")[:len(qid)] if row["floor"] else np.full(len(qid), NONE)
                scores, found, _ = search_range(qid, q, floor, ids, x, k)
                have = (scores > NONE) & (scores >= floor[:, None])
                at = np.nonzero(have)
                values = np.array([min(max(int(s), NONE + 1), -(NONE + 1)) for s in scores[at]], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at[0]), row["id"], np.int64)), pa.array(at[0].astype(np.int32)), pa.array(qid[at[0]]),
                     pa.array(found[at]), pa.array(values)], names=["grp", "place", "query_id", "vec_id", "score"])
    return run


def _floors(k: int):
    def run(key: tuple, t: pa.Table) -> pa.Table:
        place, score = t.column("place").to_numpy(), t.column("score").to_numpy()
        out = np.full(QUERIES, NONE, np.int64)
        order = np.lexsort((-score, place))
        place, score = place[order], score[order]
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        counts = np.diff(np.append(first, len(place)))
        full = counts >= k
        out[place[first[full]]] = score[first[full] + k - 1]
        return pa.table({"id": pa.array([key[0].as_py()], pa.int64()), "floor": pa.array([out.tobytes()], pa.binary())})
    return run


def _sheet(key: tuple, t: pa.Table) -> pa.Table:
    """One row of many ranges' numbers and component bounds."""
    dims = t.column("dim").to_pylist()
    packed = [b"".join(t.column(c).to_pylist()) for c in ("most", "least")]
    return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([t.column("cell").to_pylist()], pa.list_(pa.int32())),
                     pa.array([dims], pa.list_(pa.int32())), *[pa.array([x], pa.binary()) for x in packed]],
                    names=["sheet", "cells", "dims", "most", "least"])


def bounds(q: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Upper bounds of each query's scores in each range."""
    dim = min(q.shape[1], most.shape[1])
    q, most, least = q[:, :dim], most[:, :dim], least[:, :dim]
    kind = _number_kind(q, np.concatenate([most, least]))
    q, most, least = (x.astype(kind) for x in (q, most, least))
    return np.maximum(q, 0) @ most.T + np.minimum(q, 0) @ least.T


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (query group, sheet) -> ranges for the group: without floors one in ``FIRST``, those of the
    highest bounds; else all in which some query's bound is not below its floor."""
    for batch in batches:
        for r in range(batch.num_rows):
            row = {n: batch.column(n)[r].as_py() for n in batch.schema.names}
            qid, q = _unpacked(row["ids"], row["data"], row["m"], row["dim"])
            cells, dims = np.array(row["cells"], np.int32), np.array(row["dims"], np.int64)
            most, least = np.frombuffer(row["most"], "<i8"), np.frombuffer(row["least"], "<i8")
            starts, found = np.cumsum(dims) - dims, np.zeros((len(qid), len(dims)))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                where = starts[at][:, None] + np.arange(d)
                got = bounds(q, most[where], least[where])
                found = found if got.dtype == found.dtype else found.astype(object)
                found[:, at] = got
            if row["first"]:
                order = np.argsort(-found.astype(float).sum(axis=0), kind="stable")
                cells = cells[order[:-(-len(order) // FIRST)]]
            else:
                floor = np.frombuffer(row["floor"], "<i8")[:len(qid)] if row["floor"] else np.full(len(qid), NONE)
                cells = cells[(found >= floor[:, None]).any(axis=0)]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cells), row["id"], np.int64)), pa.array(cells, pa.int32())],
                                             names=["id", "cell"])


def top_k(df: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of each row of ``queries`` against all rows of ``df`` but its own id."""
    def packed(rows: DataFrame, size: int, kind: str) -> DataFrame:
        clean = (rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("e"))
                 .where(F.col("vec_id").isNotNull() & usable(F.col("e"))).select("vec_id", scaled(F.col("e")).alias("v")))
        return stored(clean.mapInArrow(_coded, "code long, vec_id long, v array<long>")
                      .repartitionByRange("code", "vec_id").sortWithinPartitions("code", "vec_id", "v")
                      .mapInArrow(_packer(size), _PACKED), kind)

    ranges = packed(df, RANGE, "topk-ranges")
    groups = packed(queries, QUERIES, "topk-queries")
    n = max(1, ranges.count())
    ranges = ranges.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
    sheets = (ranges.select(F.floor(F.col("cell") / SHEET).alias("sheet"), "cell", "dim", "most", "least")
              .groupBy("sheet").applyInArrow(_sheet, "sheet long, cells array<int>, dims array<int>, most binary, least binary"))
    ranges = ranges.select("cell", F.col("id").alias("r_id"), F.col("m").alias("r_m"), F.col("dim").alias("r_dim"),
                           F.col("ids").alias("r_ids"), F.col("data").alias("r_data"))
    columns = ["id", "m", "dim", "ids", "data", "floor", "r_m", "r_dim", "r_ids", "r_data"]
    shape = "grp long, place int, query_id long, vec_id long, score long"

    def meet(q: DataFrame, first: bool) -> DataFrame:
        # Bounds of ranges travel, many in a row; a group's and a range's vectors meet only where they are chosen.
        sheet = F.explode(F.sequence(F.lit(0).cast("long"), F.lit((n - 1) // SHEET).cast("long")))
        pairs = stored(q.drop("most", "least").withColumn("sheet", sheet).join(sheets, "sheet").withColumn("first", F.lit(first))
                       .mapInArrow(_chosen, "id long, cell int").distinct(), "topk-pairs")
        return pairs.join(q, "id").join(ranges, "cell").select(*columns).mapInArrow(_cells(k), shape)

    floors = (meet(groups.withColumn("floor", F.lit(None).cast("binary")), True)
              .groupBy(F.col("grp").alias("id")).applyInArrow(_floors(k), "id long, floor binary"))
    best = meet(groups.join(stored(floors, "topk-floors"), "id", "left"), False)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.select("query_id", "vec_id", "score").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE = """
with v as (
    select distinct vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q
    from embeddings
    where embedding is not null and vec_id is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
    select a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
    from v a join v b on b.vec_id <> a.vec_id where a.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""
