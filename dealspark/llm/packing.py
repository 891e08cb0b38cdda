"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents are tokenised, closed with id 0, cut into pieces of at most
``capacity`` ids (a document's first piece may be shorter) and packed.  Full
pieces are sequences of their own.  The rest is dealt to item groups of about
``GROUP_ITEMS`` pieces; each group is evolved on ``ISLANDS`` islands.  An
individual is a partition of the group's pieces into bins; crossover injects
well-filled bins of one parent into the other whole, bins that hold a piece
twice are dissolved, and displaced pieces are best-fitted, longest first.  After
an epoch each island's elite also migrates to the next island of its group.
When a group is done, its well-filled bins are settled and the pieces of the
others go on to one more, smaller deal.

Special tokens in a text get their own ids, as the library does by default; they
hold no whitespace, so chunks still have the tokens of the whole text.

Edge cases: a null or empty text has the one id 0; a text longer than the
capacity is cut; repeated rows are packed each; an empty table gives an empty
result.  Only the id and text columns are read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import ChunkStore
from .common import by_bytes, stored, vocabulary, worker_tool

CAPACITY = 2048
END_ID = 0
GROUP_ITEMS = 8192
ISLANDS = 2
POPULATION = 4
GENERATIONS = 4
#: Bytes of text that a task tokenises at a time, and chunks whose tokens it remembers.
STEP_BYTES = 2 << 20
STORE_CHUNKS = 600_000
#: Chunks that are encoded in one call.
JOINED = 128
#: Bins of a parent that count as well filled, and that are settled after a deal.
WELL_FILLED = 0.98
SETTLED = 0.995


class DocumentTokens:
    """ids of whole texts by a vocabulary file of ``tokenizers``.

    Chunks that may follow each other in a text are encoded joined, as a call
    costs more than a short chunk; the bytes of the tokens tell the chunks apart."""

    def __init__(self, path: str, store_chunks: int = STORE_CHUNKS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.store = ChunkStore(self._tokenise, store_chunks)
        # A byte-level token has one character per byte; added tokens stand as they are.
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.token_bytes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            self.token_bytes[i] = len(token)
        for i, token in self.tokenizer.get_added_tokens_decoder().items():
            self.token_bytes[i] = len(token.content.encode())

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _tokenise(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        flat = np.concatenate(self._encode(joined(chunks)))
        ends = np.cumsum(self.token_bytes[flat])
        sizes = np.fromiter((len(c) if c.isascii() else len(c.encode()) for c in chunks), np.int64, len(chunks))
        # Tokens up to the end of each chunk.
        upto = np.searchsorted(ends, np.cumsum(sizes)) + 1
        if len(ends) and upto[-1] == len(ends) and np.array_equal(ends[upto - 1], np.cumsum(sizes)):
            return flat, np.diff(upto, prepend=0)
        # A token over two chunks, or a vocabulary without some byte: each chunk by itself.
        ids = self._encode(chunks)
        return np.concatenate(ids), np.fromiter(map(len, ids), np.int64, len(ids))

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return self.store.tokens(texts)


def joined(chunks: list[str]) -> list[str]:
    """The chunks in turn, up to ``JOINED`` of them in one text; a text goes on only where
    its chunks end as they are, that is with whitespace after other characters."""
    out, first = [], 0
    for i in range(1, len(chunks) + 1):
        if i == len(chunks) or i - first == JOINED or not chunks[i][:1].isspace() or chunks[i - 1][-1:].isspace():
            out.append("".join(chunks[first:i]))
            first = i
    return out


def _document_tokens(path: str, store_chunks: int) -> DocumentTokens:
    return worker_tool(("packing", path, store_chunks), lambda: DocumentTokens(path, store_chunks))


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    head = n % capacity
    starts = [0] * bool(head) + list(range(head, n, capacity))
    return [(s, head if s < head else capacity) for s in starts]


def pieces(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None,
           capacity: int = CAPACITY, with_ids: bool = False, store_chunks: int = STORE_CHUNKS) -> DataFrame:
    """One row per piece; ``item`` is unique.  ``with_ids`` adds the ids, packed as unsigned 32-bit integers."""
    path = path or vocabulary("byte_bpe_50k.json")
    schema = T.StructType([
        T.StructField("item", T.LongType()), T.StructField(key, df.schema[key].dataType),
        T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.BinaryType())] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = TaskContext.get().partitionId() << 40
        for batch in by_bytes(batches, text, STEP_BYTES):
            out: list[tuple] = []
            rows: list[int] = []
            for i, ids in enumerate(_document_tokens(path, store_chunks)([t or "" for t in batch.column(text).to_pylist()])):
                data = np.append(ids, END_ID).astype("<u4").tobytes()
                for k, (start, length) in enumerate(cuts(len(ids) + 1, capacity)):
                    part = data[4 * start:4 * (start + length)]
                    out.append((item, k, start, length, zlib.crc32(part), part))
                    rows.append(i)
                    item += 1
            if not out:
                continue
            item_, piece, start, length, crc, part = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array(item_, pa.int64()), batch.column(key).take(pa.array(rows, pa.int64())),
                 pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crc, pa.int64()), *([pa.array(part, pa.binary())] if with_ids else [])], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


# --- the genetic algorithm on one group of lengths -------------------------

def best_fit(sizes: np.ndarray, order: np.ndarray, bins: np.ndarray, room: list[int], capacity: int) -> None:
    """Put the pieces ``order`` into ``bins`` (piece -> bin), each where the least room is left.

    ``room`` has the room of every bin and grows by the bins that are opened."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    has = 0
    for b, r in enumerate(room):
        by_room[r].append(b)
        has |= 1 << r
    for i, s in zip(order.tolist(), sizes[order].tolist()):
        fits = has >> s
        if fits:
            r = s + (fits & -fits).bit_length() - 1
            b = by_room[r].pop()
            if not by_room[r]:
                has ^= 1 << r
        else:
            r, b = capacity, len(room)
            room.append(capacity)
        room[b] = r - s
        by_room[r - s].append(b)
        has |= 1 << (r - s)
        bins[i] = b


def _loads(sizes: np.ndarray, bins: np.ndarray) -> np.ndarray:
    return np.bincount(bins, weights=sizes).astype(np.int64)


def fitness(sizes: np.ndarray, bins: np.ndarray, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the fuller ones."""
    loads = _loads(sizes, bins)
    loads = loads[loads > 0]
    return -len(loads), float(((loads / capacity) ** 2).mean()) if len(loads) else 0.0


def crossover(sizes: np.ndarray, to: np.ndarray, of: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """``to`` with well-filled bins of ``of`` injected whole."""
    loads = _loads(sizes, of)
    good = np.flatnonzero(loads >= WELL_FILLED * capacity)
    if not len(good):
        good = np.flatnonzero(loads == loads.max())
    injected = np.zeros(len(loads), bool)
    injected[rng.choice(good, max(1, len(good) // 2), replace=False)] = True
    moved = injected[of]
    hit = np.zeros(int(to.max()) + 1, bool)
    hit[to[moved]] = True
    displaced = hit[to] & ~moved
    # The poorest bins are dissolved, too, so that their pieces can fill others.
    old = _loads(sizes, to)
    poor = (old > 0) & (old < np.quantile(old[old > 0], 0.1))
    displaced |= poor[to] & ~moved
    stay = ~moved & ~displaced
    child = np.empty_like(to)
    _, child[stay] = np.unique(to[stay], return_inverse=True)
    n = int(child[stay].max()) + 1 if stay.any() else 0
    _, inj = np.unique(of[moved], return_inverse=True)
    child[moved] = n + inj
    n += int(inj.max()) + 1
    room = (capacity - np.bincount(child[stay | moved], weights=sizes[stay | moved], minlength=n)).astype(int).tolist()
    which = np.flatnonzero(displaced)
    best_fit(sizes, which[np.argsort(-sizes[which], kind="stable")], child, room, capacity)
    return child


def evolve(sizes: np.ndarray, start: list[np.ndarray], capacity: int, seed: int) -> np.ndarray:
    """The fittest individual after ``GENERATIONS``; ``start`` are immigrants and elites."""
    rng = np.random.default_rng(seed)
    people = list(start)
    while len(people) < POPULATION:
        order = np.argsort(-sizes, kind="stable") if not people else np.lexsort(
            (rng.random(len(sizes)), -(sizes // int(rng.integers(1, capacity // 16)))))
        bins = np.empty(len(sizes), np.int64)
        best_fit(sizes, order, bins, [], capacity)
        people.append(bins)
    people.sort(key=lambda b: fitness(sizes, b, capacity), reverse=True)
    lower = -(-int(sizes.sum()) // capacity)
    for _ in range(GENERATIONS):
        if -fitness(sizes, people[0], capacity)[0] <= lower:
            break
        a, b = rng.choice(len(people), 2, replace=False)
        people.append(crossover(sizes, people[a], people[b], capacity, rng))
        people.append(crossover(sizes, people[0], people[b if b else a], capacity, rng))
        people.sort(key=lambda b: fitness(sizes, b, capacity), reverse=True)
        del people[POPULATION:]
    return people[0]


# --- islands ---------------------------------------------------------------

def _bins_of(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64)


def islands(items: DataFrame, n_groups: int, capacity: int, label: int) -> DataFrame:
    """``items`` (item, length and others) with ``bin`` (unique over the groups),
    ``offset`` and ``load``: two epochs on each island, migration between them."""
    dealt = items.withColumn("_group", F.pmod(F.xxhash64(F.lit(label), "item"), F.lit(n_groups)))
    lone = T.StructType([T.StructField("item", T.LongType()), T.StructField("length", T.LongType()),
                         T.StructField("_group", T.LongType()), T.StructField("_island", T.IntegerType()),
                         T.StructField("_bin", T.LongType())])

    def first(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("item")
        group, island = (k.as_py() for k in key)
        best = evolve(_bins_of(t, "length"), [], capacity, 2 * (group * ISLANDS + island))
        return t.select(["item", "length", "_group", "_island"]).append_column("_bin", pa.array(best))

    def second(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("_island", "ascending"), ("item", "ascending")])
        group, island = (k.as_py() for k in key)
        # Rows of the same items from each island that sent its elite here.
        n = t.num_rows // len(set(t.column("_island").to_pylist()))
        sizes = _bins_of(t, "length")[:n]
        elites = [_bins_of(t, "_bin")[at:at + n] for at in range(0, t.num_rows, n)]
        best = evolve(sizes, elites, capacity, 2 * (group * ISLANDS + island) + 1)
        return pa.table({"item": t.column("item")[:n], "length": t.column("length")[:n], "_group": t.column("_group")[:n],
                         "_island": pa.array(np.full(n, island, np.int32)), "_bin": pa.array(best)})

    def settle(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by([("_island", "ascending"), ("item", "ascending")])
        n = t.num_rows // len(set(t.column("_island").to_pylist()))
        sizes = _bins_of(t, "length")[:n]
        best = max((_bins_of(t, "_bin")[at:at + n] for at in range(0, t.num_rows, n)),
                   key=lambda b: fitness(sizes, b, capacity))
        order = np.lexsort((np.arange(n), best))
        ends = np.cumsum(sizes[order])
        first_of = np.concatenate([[True], best[order][1:] != best[order][:-1]])
        offset = np.empty(n, np.int64)
        offset[order] = (ends - sizes[order]) - np.maximum.accumulate(np.where(first_of, ends - sizes[order], 0))
        return pa.table({"item": t.column("item")[:n], "bin": pa.array(best + (key[0].as_py() << 20)),
                         "offset": pa.array(offset), "load": pa.array(_loads(sizes, best)[best])})

    epoch = (dealt.select("item", "length", "_group", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])).alias("_island"))
             .groupBy("_group", "_island").applyInArrow(first, lone))
    moved = epoch.withColumn("_to", F.explode(F.array("_island", (F.col("_island") + 1) % ISLANDS)))
    epoch = moved.groupBy("_group", "_to").applyInArrow(second, lone)
    return epoch.groupBy("_group").applyInArrow(settle, "item long, bin long, offset long, load long")


def pack(items: DataFrame, capacity: int = CAPACITY, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``items`` (of ``pieces``) with ``sequence_id`` and ``offset``.

    The pieces are written first: their item numbers hold for one reading only."""
    items = stored(items, "pieces")
    open_items = items.where(F.col("length") < capacity).select("item", "length")
    n = open_items.count()
    groups = max(1, round(n / group_items))
    dealt = stored(islands(open_items, groups, capacity, 0), "packing")
    settled = F.col("load") >= SETTLED * capacity
    rest = dealt.where(~settled).join(open_items, "item").select("item", "length")
    placed = dealt.where(settled).select("item", F.shiftleft("bin", 2).alias("sequence_id"), "offset")
    left = rest.count()
    if left:
        again = islands(rest, max(1, round(left / group_items)), capacity, 1)
        placed = placed.union(again.select("item", F.shiftleft("bin", 2) + 1, "offset"))
    whole = items.where(F.col("length") == capacity).select(
        "item", (F.shiftleft("item", 2) + 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return items.join(placed.union(whole), "item")


def pack_documents(df: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
                   store_chunks: int = STORE_CHUNKS) -> DataFrame:
    return pack(pieces(df, key, text, capacity=capacity, store_chunks=store_chunks), capacity).drop("item")
