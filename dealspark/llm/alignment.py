"""Tokens of two tokenisers over the same bytes, with corpus-wide pair counts by spilled runs.

Side A is a byte-level BPE read by ``tokenizers``, side B a SentencePiece BPE;
both encode a space and the text.  Byte offsets where a token of each side ends
cut the tokens into groups; a link is a pair of tokens whose bytes overlap.  The
count of an id pair is the number of documents that hold it linked.

Counting is external.  A task turns a block of documents into pair-document
records, sorts them side-major (A id, then B id, then document) and spills one
zstd-compressed run for each radix of the A id, to a table in the shared folder.
Runs of a radix are merged over a heap, ``FAN`` at a time, in as many rounds as
there are runs; a run holds each pair once with its number of documents, so a
pair of every document costs one entry a run.  The side-major order of the last
merge shows each A id's highest count.  The counts then stream back over the
runs, ``FAN`` of them to a task, and a block's documents add up what each radix
contributes.  A radix has at most (A ids / ``RADIX``) x (B ids) pairs, whatever
the corpus holds.

Edge cases: a text that is null or empty, or whose tokens' bytes on either side
are not the space and the text (such as one with U+2581), has no tokens: zeros
and ''; repeated rows are documents of their own; an empty table gives an empty
result; ids may be null; only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import ChunkStore
from .common import by_bytes, stored, vocabulary, worker_tool
from .piece_bpe import MODEL, Pieces

SIDE_A = "byte_bpe_50k.json"
RADIX = 64
#: Runs that one task merges, or streams counts back over.
FAN = 64
#: Bytes of text in a block of documents.
BLOCK_BYTES = 6 << 20
STORE_CHUNKS = 250_000
_B_BITS = 15
_ORD_BITS = 28

#: A chunk ends where a space or a line feed follows a character that is no white space.
_STARTS, _RUNS = re.compile(r"(?<=\S)(?=[ \n])"), re.compile(r"\s[ \n]")


def _pack(values: np.ndarray, dtype: str) -> bytes:
    """Values as compressed bytes: all lowest bytes first, then the next ones."""
    import zstandard
    width = np.dtype(dtype).itemsize
    planes = np.ascontiguousarray(values.astype(dtype).view(np.uint8).reshape(-1, width).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


class Sides(ChunkStore):
    """Both sides' tokens of texts by chunk: links, group texts and numbers."""

    def __init__(self, path_a: str, path_b: str, limit: int = STORE_CHUNKS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = Pieces(path_b)
        if not self.b.splits or self.b.size > 1 << _B_BITS or self.a.get_vocab_size() > 1 << (31 - _B_BITS):
            raise ValueError("texts cannot be cut at white space for this model, or it has too many ids")
        points = {c: b for b, c in _byte_letters().items()}
        entries = {i: t for t, i in self.a.get_vocab().items()}
        size = max(entries) + 1
        self.a_bytes = [bytes(points.get(c, 63) for c in entries.get(i, "")) for i in range(size)]
        self.a_length = np.fromiter(map(len, self.a_bytes), np.int64, size)
        # Texts of ids in a group: "7," within, "7|" at A's end and "7;" at B's.
        self.names = [f"{i}{e}" for e in ",|" for i in range(size)] + [f"{i}{e}" for e in ",;" for i in range(self.b.size)]
        self.name_length = np.fromiter(map(len, self.names), np.int64, len(self.names))
        super().__init__(self._align, limit, _STARTS, _RUNS)

    def _clear(self) -> None:
        super()._clear()
        self.groups: list[str] = []
        self.numbers: list[np.ndarray] = []
        self.table = np.zeros((0, 4), np.int64)

    def _align(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [e.ids for e in self.a.encode_batch_fast(chunks, add_special_tokens=False)]
        n_a = np.fromiter(map(len, ids), np.int64, len(ids))
        a = np.fromiter((t for x in ids for t in x), np.int64, int(n_a.sum()))
        b, n_b = self.b.encode(chunks)
        raw = [c.encode() for c in chunks]
        good = np.ones(len(chunks), bool)
        joined = b"".join(raw)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) != joined or \
                b"".join(map(self.b.bytes.__getitem__, b.tolist())) != joined:
            at_a, at_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
            for k, text in enumerate(raw):
                own_a, own_b = a[at_a[k]:at_a[k] + n_a[k]].tolist(), b[at_b[k]:at_b[k] + n_b[k]].tolist()
                good[k] = (b"".join(map(self.a_bytes.__getitem__, own_a)) == text
                           and b"".join(map(self.b.bytes.__getitem__, own_b)) == text)
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        size = np.fromiter(map(len, raw), np.int64, len(raw)) * good
        ends, b = np.cumsum(size), b.astype(np.int64)
        end_a, end_b = np.cumsum(self.a_length[a]), np.cumsum(self.b.lengths[b])
        # Between two neighbouring ends of either side lies one token of each: a link.
        cuts = np.union1d(end_a, end_b)
        both = np.intersect1d(end_a, end_b, assume_unique=True)
        links = (a[np.searchsorted(end_a, cuts)] << _B_BITS) + b[np.searchsorted(end_b, cuts)]
        n_links = np.diff(np.searchsorted(cuts, ends, "right"), prepend=0)
        n_groups = np.diff(np.searchsorted(both, ends, "right"), prepend=0)
        self._name_groups(a, b, end_a, end_b, both, n_a, n_b)
        self.numbers.append(np.stack([n_a, n_b, n_groups, np.where(good, 0, 1)], 1))
        return links.astype(np.int32), n_links

    def _name_groups(self, a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray,
                     both: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        last_a, last_b = np.isin(end_a, both), np.isin(end_b, both)
        upto_a, upto_b = np.searchsorted(end_a, both, "right"), np.searchsorted(end_b, both, "right")
        group_a, group_b = np.searchsorted(both, end_a), np.searchsorted(both, end_b)
        order = np.zeros(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.concatenate([[0], upto_b])[group_a]] = a + last_a * len(self.a_bytes)
        order[np.arange(len(b)) + (upto_a[group_b] if len(both) else 0)] = (
            b + last_b * self.b.size + 2 * len(self.a_bytes))
        text = "".join(map(self.names.__getitem__, order.tolist()))
        places = np.concatenate([[0], np.cumsum(self.name_length[order])])[np.concatenate([[0], np.cumsum(n_a + n_b)])].tolist()
        self.groups += [text[i:max(i, k - 1)] for i, k in zip(places, places[1:])]

    def align(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray, list[str]]:
        """Link codes, (n_a, n_b, n_groups) and group texts of (space + text)s."""
        if self.count > self.limit:
            self._clear()
        numbered = [self._numbers(" " + t if t else "") for t in texts]
        self._learn()
        if self.numbers:
            self.table = np.concatenate([self.table, *self.numbers])
            self.numbers.clear()
        links, counts, groups = [], np.zeros((len(texts), 3), np.int64), []
        for k, chunks in enumerate(numbered):
            own = self.table[chunks].sum(0)
            whole = own[3] == 0
            links.append(self._gather(chunks) if whole else np.zeros(0, np.int32))
            counts[k] = own[:3] * whole
            groups.append(";".join([self.groups[c] for c in chunks.tolist()]) if whole else "")
        return links, counts, groups


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _sides(path_a: str, path_b: str) -> Sides:
    return worker_tool(("alignment", path_a, path_b), lambda: Sides(path_a, path_b))


def _runs_of(links: list[np.ndarray], radix: int) -> Iterator[tuple]:
    """Runs of a block: (part, pairs, documents of each pair, document and times of each record)."""
    lens = np.fromiter(map(len, links), np.int64, len(links))
    code = np.concatenate([np.zeros(0, np.int32), *links]).astype(np.int64)
    a = code >> _B_BITS
    wide = (1 << (31 - _B_BITS)) // radix + 1
    # The part leads the key, so that one sort gives all runs.
    code = (((a % radix) * wide + a // radix) << _B_BITS) + (code & ((1 << _B_BITS) - 1))
    records, times = np.unique((code << _ORD_BITS) + np.repeat(np.arange(len(links)), lens), return_counts=True)
    code, document = records >> _ORD_BITS, records & ((1 << _ORD_BITS) - 1)
    bounds = np.searchsorted(code, (np.arange(radix + 1) * wide) << _B_BITS)
    for part, (i, k) in enumerate(zip(bounds, bounds[1:])):
        if i < k:
            pair, documents = np.unique(code[i:k], return_counts=True)
            local = pair - ((part * wide) << _B_BITS)
            yield (part, _pack(np.diff(local, prepend=0), "<u4"), _pack(documents, "<u8"),
                   _pack(document[i:k], "<u4"), _pack(times[i:k], "<u4"))


_RUN = ["pairs", "documents", "document", "times"]


def spill(df: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
          path_b: str | None = None, with_groups: bool = False) -> DataFrame:
    """Documents (``part`` null) and runs of their blocks, written to the shared folder."""
    path_a, path_b = path_a or vocabulary(SIDE_A), path_b or vocabulary(MODEL)
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType()),
        T.StructField("id", df.schema[key].dataType),
        *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups", T.StringType()), T.StructField("part", T.IntegerType()),
        *[T.StructField(c, T.BinaryType()) for c in _RUN]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in by_bytes(batches, text, BLOCK_BYTES):
            n = batch.num_rows
            links, counts, groups = _sides(path_a, path_b).align([t or "" for t in batch.column(text).to_pylist()])
            if not with_groups:
                groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
            yield pa.RecordBatch.from_arrays([
                pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), batch.column(key),
                *[pa.array(counts[:, k], pa.int64()) for k in range(3)], pa.array(list(map(len, links)), pa.int64()),
                pa.array(groups, pa.string()), pa.nulls(n, pa.int32()), *[pa.nulls(n, pa.binary()) for _ in _RUN]], names=schema.names)
            runs = list(_runs_of(links, RADIX))
            if runs:
                part, *blobs = zip(*runs)
                n = len(part)
                yield pa.RecordBatch.from_arrays([
                    pa.array([block] * n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, batch.schema.field(key).type),
                    *[pa.nulls(n, pa.int64()) for _ in range(4)], pa.nulls(n, pa.string()), pa.array(part, pa.int32()),
                    *[pa.array(x, pa.binary()) for x in blobs]], names=schema.names)
            block += 1

    return stored(df.select(key, text).mapInArrow(run, schema), "alignment-runs")


def _merge(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sorted runs with their summed counts, by a heap over the runs' next A ids."""
    if len(runs) == 1:
        return runs[0]
    bounds = []
    for pair, _ in runs:
        side = pair >> _B_BITS
        starts = np.concatenate([[0], np.flatnonzero(np.diff(side)) + 1, [len(side)]])
        bounds.append((side[starts[:-1]].tolist(), starts.tolist()))
    heap = [(sides[0], k, 0) for k, (sides, _) in enumerate(bounds) if sides]
    heapq.heapify(heap)
    out: list[tuple[np.ndarray, np.ndarray]] = []
    while heap:
        least = heap[0][0]
        found = []
        while heap and heap[0][0] == least:
            _, k, i = heap[0]
            sides, starts = bounds[k]
            found.append((runs[k][0][starts[i]:starts[i + 1]], runs[k][1][starts[i]:starts[i + 1]]))
            if i + 1 < len(sides):
                heapq.heapreplace(heap, (sides[i + 1], k, i + 1))
            else:
                heapq.heappop(heap)
        if len(found) == 1:
            out.append(found[0])
            continue
        pair, where = np.unique(np.concatenate([p for p, _ in found]), return_inverse=True)
        total = np.zeros(len(pair), np.int64)
        np.add.at(total, where, np.concatenate([c for _, c in found]))
        out.append((pair, total))
    return np.concatenate([p for p, _ in out]), np.concatenate([c for _, c in out])


def _read(pairs: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(_unpack(pairs, "<u4").astype(np.int64)), _unpack(counts, "<u8").astype(np.int64)


_TOTAL = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("block", T.LongType()),
                       T.StructField("pairs", T.BinaryType()), T.StructField("documents", T.BinaryType())])


def _merge_group(key: tuple, group: pa.Table) -> pa.Table:
    runs = [_read(p, c) for p, c in zip(group.column("pairs").to_pylist(), group.column("documents").to_pylist())]
    pair, total = _merge(runs)
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
                     pa.array([_pack(np.diff(pair, prepend=0), "<u4")], pa.binary()),
                     pa.array([_pack(total, "<u8")], pa.binary())], names=_TOTAL.names)


def _groups(blocks: int) -> int:
    return -(-blocks // FAN)


def totals(runs: DataFrame) -> tuple[DataFrame, int]:
    """One run a part with the corpus-wide counts, and the number of blocks."""
    blocks = runs.agg(F.count_distinct("block")).first()[0]
    merged, left = runs.select(*_TOTAL.names), blocks
    while True:
        left = _groups(left)
        group = F.pmod(F.xxhash64("block"), F.lit(max(left, 1))).alias("block")
        merged = stored(merged.select("part", group, "pairs", "documents").groupBy("part", "block")
                        .applyInArrow(_merge_group, _TOTAL), "alignment-totals")
        if left <= 1:
            return merged, blocks


def _best(pair: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether a pair's count is its A id's highest; pairs are in side-major order."""
    side = pair >> _B_BITS
    starts = np.concatenate([[0], np.flatnonzero(np.diff(side)) + 1])
    return total == np.repeat(np.maximum.reduceat(total, starts), np.diff(np.append(starts, len(side))))


_SHARE = T.StructType([T.StructField("block", T.LongType()), T.StructField("place", T.BinaryType()),
                       T.StructField("best", T.BinaryType()), T.StructField("total", T.BinaryType())])


def _stream_back(runs: pa.Table, counted: pa.Table) -> pa.Table:
    """What the runs' pairs add to each document of their blocks."""
    if not runs.num_rows:
        return _SHARE_EMPTY
    pair, total = _read(counted.column("pairs")[0].as_py(), counted.column("documents")[0].as_py())
    best = _best(pair, total)
    out = []
    for block, pairs, documents, document, times in zip(*[runs.column(c).to_pylist() for c in ("block", *_RUN)]):
        own, n = _read(pairs, documents)
        where = np.repeat(np.searchsorted(pair, own), n)
        place, at = np.unique(_unpack(document, "<u4"), return_inverse=True)
        links = _unpack(times, "<u4").astype(np.int64)
        n_best, count = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        np.add.at(n_best, at, links * best[where])
        np.add.at(count, at, links * total[where])
        out.append((block, _pack(np.diff(place.astype(np.int64), prepend=0), "<u4"), _pack(n_best, "<u8"), _pack(count, "<u8")))
    columns = list(zip(*out))
    return pa.table([pa.array(columns[0], pa.int64()), *[pa.array(c, pa.binary()) for c in columns[1:]]], names=_SHARE.names)


_SHARE_EMPTY = pa.table([pa.array([], pa.int64()), *[pa.array([], pa.binary())] * 3], names=_SHARE.names)


def align(df: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
          path_b: str | None = None, with_groups: bool = False) -> DataFrame:
    """Per document ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``
    and its ``groups``: their SHA-256, or their text (``with_groups``)."""
    spilled = spill(df, key, text, path_a, path_b, with_groups)
    runs = spilled.where("part is not null").select("block", "part", *_RUN)
    counted, blocks = totals(runs)
    n = max(_groups(blocks), 1)
    # A group of runs meets its part's totals: as many copies of them as groups.
    group = F.pmod(F.xxhash64("block"), F.lit(n))
    left = runs.withColumn("g", group).groupBy("part", "g")
    right = (counted.select("part", "pairs", "documents", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("g"))
             .groupBy("part", "g"))
    shares = left.cogroup(right).applyInArrow(_stream_back, _SHARE)
    documents = spilled.where("part is null").select("block", "place", "id", "n_a", "n_b", "n_groups", "n_links", "groups")
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *[T.StructField(c, T.LongType()) for c in (
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")], T.StructField("groups", T.StringType())])

    def add_up(rows: pa.Table, parts: pa.Table) -> pa.Table:
        places = rows.column("place").to_numpy()
        n_best, count = (np.zeros(int(places.max()) + 1 if len(places) else 0, np.int64) for _ in range(2))
        for place, best, total in zip(*[parts.column(c).to_pylist() for c in ("place", "best", "total")]):
            at = np.cumsum(_unpack(place, "<u4").astype(np.int64))
            n_best[at] += _unpack(best, "<u8").astype(np.int64)
            count[at] += _unpack(total, "<u8").astype(np.int64)
        return pa.table([rows.column("id"), *[rows.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")],
                         pa.array(n_best[places]), pa.array(count[places]), rows.column("groups")], names=schema.names)

    return documents.groupBy("block").cogroup(shares.groupBy("block")).applyInArrow(add_up, schema)


def pair_counts(df: DataFrame, key: str = "doc_id", text: str = "text", path_a: str | None = None,
                path_b: str | None = None) -> DataFrame:
    """(a, b, documents, best) of every id pair that is linked somewhere."""
    counted, _ = totals(spill(df, key, text, path_a, path_b).where("part is not null").select("block", "part", *_RUN))
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()),
                           T.StructField("documents", T.LongType()), T.StructField("best", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, pairs, documents in zip(*[batch.column(c).to_pylist() for c in ("part", "pairs", "documents")]):
                pair, total = _read(pairs, documents)
                yield pa.RecordBatch.from_arrays([
                    pa.array((pair >> _B_BITS) * RADIX + part, pa.int32()), pa.array(pair & ((1 << _B_BITS) - 1), pa.int32()),
                    pa.array(total, pa.int64()), pa.array(_best(pair, total))], names=schema.names)

    return counted.mapInArrow(run, schema)
