"""N-gram Jaccard self-join of texts by rare-first prefix filtering.

A text's set holds the 64-bit hashes of its distinct word n-grams (all words as
one when there are fewer than ``width``).  Texts with equal sets form a class;
everything below works on classes.

1. Every partition counts its n-grams in ``SKETCH`` hash buckets; the sums give
   the global order: n-grams in rarely hit buckets first, ties by the hash.
2. A class's prefix is its first n - ceil(t n) + 1 n-grams in that order; two
   classes that link share a prefix n-gram.  Prefix n-grams of one class only
   are dropped.
3. The classes of a prefix n-gram meet in cells by length (neighbouring length
   steps only), large cells are split into block pairs.  A pair passes the
   length, positional and suffix filters - the last bounds the overlap by the
   sizes of ``BINS`` fixed hash ranges.  In cells of more than ``HOT`` classes it
   is left out where an earlier one of the ``PRIOR`` first n-grams of such cells
   is common, too; the candidates are then made distinct, so every pair is
   verified once.
4. Verification intersects the whole sets.

The driver and the broadcasts hold a sketch and a bit table of fixed sizes (16 MB
and 0.5 MB), whatever the input; a fuller bit table only lets more sets through.

Edge cases: a text that is null, empty or blank has an empty set, links with
nothing and is its own component; repeated rows and equal texts are one class;
a null id cannot be the smallest of a component that has another id; an empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes, stored
from .components import components

SKETCH_BITS = 21
SKETCH = 1 << SKETCH_BITS
CHUNK = 4096
#: Hash ranges of the suffix filter, and of its first, coarser pass.
BIN_BITS = 8
BINS = 1 << BIN_BITS
COARSE = 32
#: Classes of one block of a cell, and of a cell in which pairs are met once.
BLOCK = 1024
HOT = 32
#: A class's first n-grams of such cells, by which a pair is known to have met before.
PRIOR = 16
#: Bits of the table of texts whose sets are read again.
PICKED_BITS = 22
STORE_WORDS = 600_000
#: Copies of a class that a task recognises among its own rows.
SEEN = 500_000


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= STORE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sorted distinct n-gram hashes of whole texts."""

    def __init__(self, width: int) -> None:
        self.width = width
        self.words = _WordHash()

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").encode("utf-8", "replace").lower().split()
        n = len(words)
        if not n:
            return np.zeros(0, np.uint64)
        h = np.fromiter(map(self.words.__getitem__, words), np.uint64, n)
        width = min(n, self.width)
        # The number of words is part of the hash, so a short text equals no n-gram of a longer one.
        x = np.full(n - width + 1, width, np.uint64)
        for k in range(width):
            x = _mixed(x * _A + h[k:n - width + 1 + k] * _B + _C)
        x = np.sort(x)
        return x[np.concatenate([[True], x[1:] != x[:-1]])]


def _class_id(hashes: np.ndarray) -> int:
    import xxhash
    return int(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).astype(np.int64))


def _scan(width: int, key: str, text: str):
    """Per row its class, set size and bin sizes; per partition, rows of the sketch."""
    names = ["key", "cls", "n", "bins", "chunk", "part", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(width)
        counts = np.zeros(SKETCH, np.int64)
        kind = pa.null()
        for batch in by_bytes(batches, text):
            sets = [shingles(t) for t in batch.column(text).to_pylist()]
            flat = np.concatenate([np.zeros(0, np.uint64), *sets])
            counts += np.bincount((flat >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=SKETCH)
            bins = [np.minimum(np.bincount((s >> np.uint64(64 - BIN_BITS)).astype(np.int64), minlength=BINS), 255)
                    .astype(np.uint8).tobytes() for s in sets]
            n, kind = batch.num_rows, batch.column(key).type
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array([_class_id(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array(bins, pa.binary()),
                 pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=names)
        at = [c for c in range(SKETCH // CHUNK) if counts[c * CHUNK:(c + 1) * CHUNK].any()]
        if at:
            n = len(at)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, kind), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()),
                 pa.array(at, pa.int32()), pa.array([TaskContext.get().partitionId() % 16] * n, pa.int32()),
                 pa.array([_pack(counts[c * CHUNK:(c + 1) * CHUNK]) for c in at], pa.binary())], names=names)
    return run


def _pack(counts: np.ndarray) -> bytes:
    """Width of a number, then the numbers."""
    width = next(w for w in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def _sketch(rows: DataFrame) -> np.ndarray:
    """Bucket counts over all rows: added up per chunk, in two steps."""
    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = np.zeros(CHUNK, np.int64)
        for x in t.column("counts").to_pylist():
            total += _unpack(x)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([_pack(total)], pa.binary())})

    kind = "chunk int, counts binary"
    got = (rows.select("chunk", "part", "counts").groupBy("chunk", "part").applyInArrow(add, kind)
           .groupBy("chunk").applyInArrow(add, kind).collect())
    out = np.zeros(SKETCH, np.int64)
    for r in got:
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = _unpack(bytes(r["counts"]))
    return out


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _prefixes(width: int, percent: int, text: str, sketch) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts, seen = Shingles(width), sketch.value, set()
        for batch in by_bytes(batches, text):
            rows: list[tuple[np.ndarray, int, int]] = []
            for t in batch.column(text).to_pylist():
                s = shingles(t)
                if not len(s):
                    continue
                cls = _class_id(s)
                if cls in seen:
                    continue
                if len(seen) < SEEN:
                    seen.add(cls)
                order = np.argsort(counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], kind="stable")
                rows.append((s[order[:prefix_length(len(s), percent)]], cls, len(s)))
            lens = [len(r[0]) for r in rows]
            total = sum(lens)
            at = np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens) if rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.uint64), *(r[0] for r in rows)]).view(np.int64)),
                 pa.array(np.repeat(np.array([r[1] for r in rows], np.int64), lens)),
                 pa.array(np.repeat(np.array([r[2] for r in rows], np.int64), lens) << 32 | at.astype(np.int64))],
                names=["gram", "cls", "place"])
    return run


def needed(nx, ny, percent: int):
    """Least intersection with 100 |x & y| >= percent |x | y|."""
    return -(-percent * (nx + ny) // (100 + percent))


def _cell_pairs(c: dict[str, np.ndarray], prior: list, percent: int) -> list[tuple[int, int]]:
    """Pairs of a cell that pass the filters and meet here first."""
    n, i, base, block = c["n"], c["i"], c["base"], c["block"]
    m = len(n)
    out = []
    two = c["two"]
    for at in range(0, m, 256):
        a = np.arange(at, min(m, at + 256))[:, None]
        b = np.arange(m)[None, :]
        ok = (b > a) & (base[a] | base[b])
        if two:
            ok &= block[a] != block[b]
        ok &= 100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b])
        need = needed(n[a], n[b], percent)
        ok &= np.minimum(i[a], i[b]) + 1 + np.minimum(n[a] - i[a], n[b] - i[b]) - 1 >= need
        x, y = np.nonzero(ok)
        need = need[x, y]
        x = x + at
        for k in range(0, len(x), 1 << 15):
            p, q, least = x[k:k + (1 << 15)], y[k:k + (1 << 15)], need[k:k + (1 << 15)]
            for bins in (c["coarse"], c["bins"]):
                held = np.minimum(bins[p], bins[q]).sum(axis=1, dtype=np.int64) >= least
                held |= c["full"][p] | c["full"][q]
                p, q, least = p[held], q[held], least[held]
            out += [(u, v) for u, v in zip(p.tolist(), q.tolist()) if prior[u].isdisjoint(prior[v])]
    return out


def _meet(percent: int):
    """Candidate pairs of cells; rows arrive sorted by cell."""
    columns = ["gram", "cell", "bi", "bj"]

    def cells(t: pa.Table) -> Iterator[tuple[int, int]]:
        key = np.stack([t.column(k).to_numpy() for k in columns])
        return np.flatnonzero(np.concatenate([[True], (key[:, 1:] != key[:, :-1]).any(axis=0)])) if t.num_rows else np.zeros(0, int)

    def pairs(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        cls = t.column("cls").to_numpy()
        whole = {"n": t.column("place").to_numpy() >> 32, "i": t.column("place").to_numpy() & 0xFFFFFFFF,
                 "base": t.column("base").to_numpy(), "block": t.column("block").to_numpy(),
                 "bins": np.frombuffer(b"".join(t.column("bins").to_pylist()), np.uint8).reshape(-1, BINS)}
        # A bin that reached its largest count bounds nothing.
        whole["full"] = (whole["bins"] == 255).any(axis=1)
        whole["coarse"] = whole["bins"].reshape(-1, COARSE, BINS // COARSE).sum(axis=2, dtype=np.uint16)
        two = t.column("bi").to_numpy() != t.column("bj").to_numpy()
        prior = list(map(frozenset, t.column("prior").to_pylist()))
        a, b = [], []
        for lo, hi in zip(starts, [*starts[1:], t.num_rows]):
            if hi - lo < 2:
                continue
            # Copies of a text in other partitions are the same class.
            at = lo + np.sort(np.unique(cls[lo:hi], return_index=True)[1])
            part = {k: v[at] for k, v in whole.items()} | {"two": bool(two[lo])}
            for u, v in _cell_pairs(part, [prior[k] for k in at], percent):
                x, y = int(cls[at[u]]), int(cls[at[v]])
                a.append(min(x, y)), b.append(max(x, y))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            starts = cells(t)
            if len(starts) < 2:
                held = t
                continue
            held = t.slice(int(starts[-1]))
            yield pairs(t.slice(0, int(starts[-1])), starts[:-1])
        if held is not None and held.num_rows:
            yield pairs(held.combine_chunks(), cells(held))
    return run


def _sets(width: int, text: str, picked):
    """Sets of the rows whose bit is set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bits = Shingles(width), picked.value
        for batch in by_bytes(batches, text):
            at = batch.column("bit").to_numpy()
            chosen = batch.filter(pa.array((bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)))
            sets = [s for s in map(shingles, chosen.column(text).to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays([pa.array([_class_id(s) for s in sets], pa.int64()),
                                              pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "grams"])
    return run


def _bit(key: str):
    return F.pmod(F.xxhash64(key), F.lit(1 << PICKED_BITS)).cast("long")


def _bit_table(keys: DataFrame, key: str) -> np.ndarray:
    """Bits of the keys' hashes, as 64-bit words; at most 2 ** (PICKED_BITS - 6) words reach the driver."""
    bit = _bit(key)
    words = (keys.select(F.shiftright(bit, 6).alias("word"), F.expr("1L").alias("one"), (bit % 64).cast("int").alias("at"))
             .groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.col("one"), F.col("at"))).alias("bits")).collect())
    out = np.zeros(1 << PICKED_BITS - 6, np.uint64)
    for r in words:
        out[r["word"]] = np.int64(r["bits"]).astype(np.uint64)
    return out


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.sort(np.concatenate([x, y]))
                shared = int((both[1:] == both[:-1]).sum())
                keep.append(100 * shared >= percent * (len(both) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


class Join:
    """Classes, their members and the links between classes of one table."""

    def __init__(self, df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3) -> None:
        spark, self.key = df.sparkSession, key
        docs = df.select(key, text)
        kind = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("cls", T.LongType()),
                             T.StructField("n", T.LongType()), T.StructField("bins", T.BinaryType()),
                             T.StructField("chunk", T.IntegerType()), T.StructField("part", T.IntegerType()),
                             T.StructField("counts", T.BinaryType())])
        scanned = stored(docs.mapInArrow(_scan(width, key, text), kind), "ngram-scan")
        rows = scanned.where("chunk is null")
        #: (key, cls, n) of every row; cls is null for an empty set.
        self.members = rows.select("key", "cls", "n")
        #: (cls, first, copies, n, bins) of every class; first is the smallest key.
        self.classes = stored(rows.where("cls is not null").groupBy("cls").agg(
            F.min("key").alias("first"), F.count("*").alias("copies"), F.first("n").alias("n"),
            F.first("bins").alias("bins")), "ngram-classes")

        sketch = spark.sparkContext.broadcast(_sketch(scanned.where("chunk is not null")))
        prefixes = stored(docs.mapInArrow(_prefixes(width, percent, text, sketch), "gram long, cls long, place long"), "ngram-prefixes")
        shared = prefixes.groupBy("gram").agg(F.count("*").alias("times")).where("times > 1").select("gram")
        n = F.shiftright("place", 32)
        step = F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("int")
        # A row meets its own length step as a base and, as the longer one, the step below.
        thin = stored(prefixes.join(shared, "gram").withColumn("step", step)
                      .withColumn("cell", F.explode(F.array("step", F.col("step") - 1)))
                      .withColumn("base", F.col("cell") == F.col("step")).drop("step"), "ngram-cells")
        sizes = (thin.groupBy("gram", "cell").agg(F.count("*").alias("size"), F.count_if("base").alias("bases"))
                 .where("size > 1 and bases > 0").select("gram", "cell", "size"))
        alive = stored(thin.join(sizes, ["gram", "cell"]), "ngram-alive")
        hot = (alive.where(F.col("size") > HOT).groupBy(F.col("cls").alias("of"))
               .agg(F.slice(F.sort_array(F.collect_set(F.struct(F.col("place").alias("at"), "gram"))), 1, PRIOR).alias("hot")))
        rows = (alive.join(self.classes.select("cls", "bins"), "cls").join(hot, F.col("cls") == F.col("of"), "left")
                .withColumn("prior", F.when(F.col("size") > HOT, F.transform(
                    F.filter("hot", lambda e: e["at"] < F.col("place")), lambda e: e["gram"])).otherwise(
                    F.array().cast("array<bigint>")))
                .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
                .withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
                .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                .withColumns({"bi": F.least("block", "other"), "bj": F.greatest("block", "other")}))
        pairs = (rows.select("gram", "cell", "bi", "bj", "cls", "place", "base", "block", "bins", "prior")
                 .repartition("gram", "cell", "bi", "bj").sortWithinPartitions("gram", "cell", "bi", "bj")
                 .mapInArrow(_meet(percent), "a long, b long"))
        candidates = stored(pairs.distinct(), "ngram-candidates")

        firsts = (candidates.select(F.col("a").alias("cls")).union(candidates.select("b")).distinct()
                  .join(self.classes, "cls").select(F.col("first").alias(key)))
        picked = spark.sparkContext.broadcast(_bit_table(firsts, key))
        sets = stored(docs.withColumn("bit", _bit(key)).mapInArrow(_sets(width, text, picked), "cls long, grams binary")
                      .dropDuplicates(["cls"]), "ngram-sets")
        #: (a, b), a < b: every pair of classes that links.
        self.links = stored(
            candidates.join(sets.select(F.col("cls").alias("a"), F.col("grams").alias("x")), "a")
            .join(sets.select(F.col("cls").alias("b"), F.col("grams").alias("y")), "b")
            .select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long"), "ngram-links")

    def components(self) -> DataFrame:
        """key, n_shingles, component_id and n_links (classes linked with the row's own) of every row."""
        labels = components(self.links)
        degree = (self.links.select(F.col("a").alias("cls")).union(self.links.select("b"))
                  .groupBy("cls").agg(F.count("*").alias("n_links")))
        grouped = self.classes.join(labels.withColumnRenamed("node", "cls"), "cls", "left").where("copies > 1 or label is not null")
        grouped = stored(grouped.select("cls", "first", F.coalesce("label", "cls").alias("label")), "ngram-grouped")
        least = grouped.groupBy("label").agg(F.min("first").alias("component_id"))
        of = stored(grouped.join(least, "label").join(degree, "cls", "left").select("cls", "component_id", "n_links"), "ngram-of")
        return self.members.join(of, "cls", "left").select(
            F.col("key").alias(self.key), F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "key").alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 90, width: int = 3) -> DataFrame:
    """The rows of ``df`` (all columns) that are the smallest id of their component,
    one of each text: of rows of one id that differ in other columns only, the least
    one, by these columns in their order; rows of one id with different texts are
    that document and all stay, and so do rows with a null id."""
    first = (Join(df, key, text, percent, width).components()
             .where(F.col(key) == F.col("component_id")).select(key).distinct())
    named = df.where(F.col(key).isNotNull()).join(first, key, "left_semi")
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns) if c not in (key, text)]
    if others:
        least = named.groupBy(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).agg(F.min(F.struct(*others)).alias("_row"))
        given = {key: F.col("_key"), text: F.col("_text")}
        one = least.select(*[given.get(c, F.col(f"_row.c{i}")).alias(c) for i, c in enumerate(df.columns)])
    else:
        one = named.distinct()
    return one.union(df.where(F.col(key).isNull()))
