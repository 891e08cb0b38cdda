"""SentencePiece BPE in vectorised merge rounds over flat numpy arrays.

All words of a block lie in one symbol array.  A word ends where no merge can
cross: at a pair of neighbours whose joined text stands in no vocabulary piece.
In every round the minimum pair rank of each word is found (one segmented
minimum), the leftmost pairs of that rank merge in all words at once, merged
symbols are compacted away, and pairs beside them get new ranks, which may end
a word in two.  Words without a pair leave the arrays; the block is done when
none is left.  Several pairs of one word merge in the same round only up to the
first whose merge makes a pair of the same or a lower rank beside it, so the
result is that of one merge at a time.

A text is cut into chunks before spaces and line feeds, where the vocabulary
allows it (checked when it is read), and a task encodes each different chunk
once (bounded store).  Characters without a piece become byte pieces.

Edge cases: a null text counts as empty and has no tokens; U+2581 in a text
counts as a space, as in the library; an empty table gives an empty result;
repeated rows give repeated result rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .chunks import ChunkStore
from .common import by_bytes, vocabulary, worker_tool

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of text a task takes at a time, and chunks whose tokens it remembers.
STEP_BYTES = 2 << 20
STORE_CHUNKS = 400_000
#: Characters of new chunks in one block of arrays.
BLOCK_CHARS = 1 << 20

_STARTS, _RUNS = re.compile(r"(?<=[^ \n])(?=[ \n])"), re.compile(r"[ \n][ \n]")
_ALIVE, _DEAD = 1 << 20, 1 << 21  # ranks of pairs that do not merge: inside some piece, inside none


class Pairs:
    """Pair of symbols -> merged symbol, -1 (only part of a piece) or -2, by open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.bits = max(int(len(keys) * 3).bit_length(), 10)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, -2, np.int32)
        at = self._slot(keys)
        while len(keys):
            free = self.keys[at] == -1
            self.keys[at[free]] = keys[free]  # of several keys for a slot one stays
            held = self.keys[at] == keys
            self.values[at[held]] = values[held]
            keys, values, at = keys[~held], values[~held], (at[~held] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = self._slot(keys)
        found = self.keys[at]
        out = self.values[at]
        left = np.flatnonzero((found != keys) & (found != -1))
        at = at[left]
        while len(left):
            at = (at + 1) & ((1 << self.bits) - 1)
            found = self.keys[at]
            out[left] = self.values[at]
            more = (found != keys[left]) & (found != -1)
            left, at = left[more], at[more]
        return out


class Pieces:
    """Vocabulary of one model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(n)]
        if not any(map(model.is_byte, range(n))):
            raise ValueError("the model has no byte pieces")
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.ids = {p: i for i, p in enumerate(pieces) if i not in special}
        self.byte_id = np.zeros(256, np.int32)
        self.bytes: list[bytes] = []
        for i, p in enumerate(pieces):
            if model.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
                self.bytes.append(bytes([int(p[3:5], 16)]))
            elif model.is_unknown(i):
                self.bytes.append(" ⁇ ".encode())
            else:
                self.bytes.append(b"" if model.is_control(i) else p.replace(SPACE, " ").encode())
        self.spaced = frozenset(i for p, i in self.ids.items() if p[0] == SPACE)
        self.is_byte = np.array([model.is_byte(i) for i in range(n)])
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, n)
        scores = sorted({model.get_score(i) for i in self.ids.values()}, reverse=True)
        order = {s: k for k, s in enumerate(scores)}
        self.rank = np.full(n + 2, _ALIVE, np.int32)
        for i in self.ids.values():
            self.rank[i] = order[model.get_score(i)]
        self.rank[-2] = _DEAD  # index of the value -2; -1 is alive
        self.size = n
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.pairs = self._pairs()
        self.runs = self._runs()
        crossed = {m for p in self.ids for m in re.findall(f"[^{SPACE}\n]([{SPACE}\n])", p)}
        self.splits = not crossed  # whether texts may be cut before every run of spaces and line feeds

    def _pairs(self) -> Pairs:
        # Two symbols side by side within a piece; as every piece of a piece's text counts, too,
        # only pairs that start or end the piece need to be listed for each of them.
        found: dict[int, int] = {}
        ids, n = self.ids, self.size
        for p in ids:
            for i in range(len(p) - 1):
                for j in range(i + 1, len(p)):
                    a = ids.get(p[i:j])
                    if a is None:
                        continue
                    for k in range(j + 1, len(p) + 1):
                        b = ids.get(p[j:k])
                        if b is not None and a * n + b not in found:
                            found[a * n + b] = ids.get(p[i:k], -1)
        return Pairs(np.fromiter(found, np.int64, len(found)), np.fromiter(found.values(), np.int32, len(found)))

    def _runs(self) -> list[tuple[int, int]]:
        """(symbol, k): a run of k or more of the symbol merges, from its left, into
        blocks of k, one pair at a time as all its pieces have one rank; no merge
        crosses from a block to the next, so they may go on side by side."""
        out = []
        for p in {q[0] for q in self.ids if len(q) > 2 and q == q[0] * len(q) and q[0] in self.ids}:
            sizes = {len(q) for q in self.ids if q == p * len(q)}
            mixed = any(2 * p in q and q != p * len(q) for q in self.ids)
            if mixed or len({int(self.rank[self.ids[p * n]]) for n in sizes if n > 1}) > 1:
                continue
            k = max(sizes)
            run = [1] * (2 * k)
            while run[0] < k:
                at = next((i for i in range(len(run) - 1) if run[i] + run[i + 1] in sizes), None)
                if at is None:
                    break
                run[at:at + 2] = [run[at] + run[at + 1]]
            if run == [k] + [1] * k:
                out.append((self.ids[p], k))
        return out

    def join(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged symbol of each pair, or -1 or -2; negative symbols join nothing."""
        out = self.pairs.get(a.astype(np.int64) * self.size + b)
        out[(a < 0) | (b < 0)] = -2
        return out

    def encode(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all chunks in one array, and their numbers of ids."""
        parts, lens, at = [], [], 0
        while at < len(chunks):
            upto, held = at, 0
            while upto < len(chunks) and (held == 0 or held + len(chunks[upto]) <= BLOCK_CHARS):
                held += len(chunks[upto])
                upto += 1
            flat, n = self._block(chunks[at:upto])
            parts.append(flat), lens.append(n)
            at = upto
        empty = np.zeros(0, np.int64)
        return np.concatenate(parts or [empty.astype(np.int32)]), np.concatenate(lens or [empty])

    def _block(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(chunks).replace(" ", SPACE).encode("utf-32-le"), "<u4")
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        out = self._merged(self.char[points], np.cumsum(sizes)[:-1])
        # Symbols that merged into an earlier one are -2; characters without a piece, -1, become bytes.
        kept = np.flatnonzero(out != -2)
        flat, number = out[kept], np.ones(len(kept), np.int64)
        unknown = np.flatnonzero(flat == -1)
        if len(unknown):
            codes = [chr(c).encode() for c in points[kept[unknown]]]
            number[unknown] = list(map(len, codes))
            ends = np.cumsum(number)
            flat = np.repeat(flat, number)
            flat[flat == -1] = self.byte_id[np.frombuffer(b"".join(codes), np.uint8)]
        counts = np.zeros(len(points) + 1, np.int64)
        counts[kept + 1] = number
        counts = np.cumsum(counts)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return flat, np.diff(counts[bounds])

    def _merged(self, sym: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out = np.full(len(sym), -2, np.int32)
        if not len(sym):
            return out
        joined = np.full(len(sym), -2, np.int32)
        joined[:-1] = self.join(sym[:-1], sym[1:])
        joined[ends[(ends > 0) & (ends < len(sym))] - 1] = -2
        for s, k in self.runs:
            self._cut_runs(sym, joined, s, k)
        rank = self.rank[joined]
        place = np.arange(len(sym))
        while len(sym):
            starts = np.concatenate([[0], np.flatnonzero(rank[:-1] == _DEAD) + 1])
            least = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.append(starts, len(sym))))
            done = least >= _ALIVE
            if done.any():
                out[place[done]] = sym[done]
                going = ~done
                sym, joined, rank, place, least = sym[going], joined[going], rank[going], place[going], least[going]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == least)
            # Of neighbouring pairs every other one merges, from the left.
            number = np.arange(len(at))
            first = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, number, 0))
            at = at[(number - first) % 2 == 0]
            new, own = joined[at], rank[at]
            follows = np.diff(at, prepend=-9) == 2  # the symbol before has just merged, too
            follows &= rank[at - 1] != _DEAD
            before = np.where(follows, np.concatenate([[0], new[:-1]]), sym[at - 1])
            left = self.join(before, new)
            left[(at == 0) | (rank[at - 1] == _DEAD)] = -2
            ended = rank[at + 1] == _DEAD
            right = self.join(new, sym[np.minimum(at + 2, len(sym) - 1)])
            right[ended] = -2
            bad = np.minimum(self.rank[left], self.rank[right]) <= own
            if bad.any():
                starts = np.concatenate([[0], np.flatnonzero(rank[:-1] == _DEAD) + 1])
                word = np.searchsorted(starts, at, "right")
                earlier = np.cumsum(bad) - bad
                fine = earlier == earlier[np.searchsorted(word, word, "left")]
                at, new, left, right, follows = at[fine], new[fine], left[fine], right[fine], follows[fine]
            sym[at], joined[at] = new, right
            # The pair before a merged symbol belongs to the symbol that now stands there.
            holder = np.where(follows, at - 2, at - 1)
            inner = at > 0
            joined[holder[inner]] = np.where(rank[holder[inner]] == _DEAD, -2, left[inner])
            touched = np.concatenate([at, holder[inner]])
            rank[touched] = self.rank[joined[touched]]
            stay = np.ones(len(sym), bool)
            stay[at + 1] = False
            sym, joined, rank, place = sym[stay], joined[stay], rank[stay], place[stay]
        return out

    @staticmethod
    def _cut_runs(sym: np.ndarray, joined: np.ndarray, s: int, k: int) -> None:
        same = sym == s
        at = np.flatnonzero(same)
        if not len(at):
            return
        number = np.arange(len(at))
        # A run also ends where a chunk does.
        new = (np.diff(at, prepend=-2) != 1) | (joined[at - 1] == -2)
        inside = number - np.maximum.accumulate(np.where(new, number, 0))
        cut = at[(inside > 0) & (inside % k == 0)]
        joined[cut - 1] = -2

    def decode(self, ids: np.ndarray) -> str:
        """Text of an id list; the space that encoding puts in front goes."""
        listed = ids.tolist()
        raw = b"".join(map(self.bytes.__getitem__, listed))
        if next((i for i in listed if self.lengths[i]), None) in self.spaced:
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            return self._decode_loosely(ids)

    def _decode_loosely(self, ids: np.ndarray) -> str:
        """As ``decode``, where byte pieces are not UTF-8: each byte outside a character is U+FFFD."""
        out: list[str] = []
        run = b""
        for i in [*ids.tolist(), -1]:
            if i >= 0 and self.is_byte[i]:
                run += self.bytes[i]
                continue
            while run:
                size = next((n for n in range(1, 5) if _is_character(run[:n])), 0)
                out.append(run[:size].decode() if size else "�")
                run = run[size or 1:]
            if i >= 0 and self.bytes[i]:
                out.append(self.bytes[i].decode()[int(not out and i in self.spaced):])
        return "".join(out)


def _is_character(raw: bytes) -> bool:
    try:
        return len(raw.decode()) == 1
    except UnicodeDecodeError:
        return False


class Encoder:
    """ids of whole texts; each different chunk is encoded once while the store holds it."""

    def __init__(self, path: str, store_chunks: int = STORE_CHUNKS) -> None:
        self.pieces = Pieces(path)
        self.store = ChunkStore(self.pieces.encode, store_chunks, _STARTS, _RUNS) if self.pieces.splits else None

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        # The library puts one space in front of a text that is not empty.
        prepared = [" " + t.replace(SPACE, " ") if t else "" for t in texts]
        if self.store is not None:
            return self.store.tokens(prepared)
        flat, lens = self.pieces.encode(prepared)
        return np.split(flat, np.cumsum(lens)[:-1])


def encoder(path: str, store_chunks: int = STORE_CHUNKS) -> Encoder:
    return worker_tool(("piece", path, store_chunks), lambda: Encoder(path, store_chunks))


def list_column(ids: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(
        np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (``array<int>``) of every row."""
    path = path or vocabulary(MODEL)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, STEP_BYTES):
            ids = encoder(path)([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(list(map(len, ids)), pa.int64()), list_column(ids)], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of its id lists as ``out`` in the place of ``ids`` (null: empty)."""
    path = path or vocabulary(MODEL)
    kept = [f for f in df.schema.fields if f.name != ids]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, ids, STEP_BYTES):
            pieces = encoder(path).pieces
            lists = batch.column(ids)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            lens = np.nan_to_num(np.array(lists.value_lengths().to_pylist(), float)).astype(np.int64)
            texts = [pieces.decode(x) for x in np.split(values, np.cumsum(lens)[:-1])] if len(lens) else []
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(texts, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)
