"""Byte-level BPE by DuckDB recursive queries inside Spark tasks.

Encoding: the rows (word, position, token) of a block of words join the merge
table on adjacent tokens; each round contracts every unfinished word's leftmost
pair of minimum rank; words without a pair drop out of the working table, and
the rows of a word's last round are its tokens.  Words of more than
``LONG_WORD`` bytes are cut, before every round, where no merge can cross, and a
round contracts all occurrences of each segment's minimum-rank pair at once when
no merge that contains the new token has a lower rank, which gives the same
tokens as one pair at a time; a recursion of theirs is given up after a number of
rounds that its rows allow, and the next one goes on from its result.  Decoding: id rows join the vocabulary, and an ordered
aggregation puts the bytes of a document together.

Each different word of a task is encoded once (bounded store).  ids are packed
as little-endian unsigned 32-bit integers in a binary column; ``as_array`` gives
``array<int>``.

Edge cases: a null text counts as empty and has no tokens; an empty table gives
an empty result; repeated rows give repeated result rows; other columns of the
input are not read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import ChunkStore
from .common import by_bytes, vocabulary

LONG_WORD = 256
#: Memory of a task's queries; a longer word takes ``LONG_BYTES`` for each of its bytes.
MEMORY_MB = 200
LONG_BYTES = 500
#: Positions of one block of long words (a longer word stays whole), and rows that its rounds may leave.
LONG_BLOCK = 100_000
LONG_ROWS = 1_000_000
#: Words of one recursive query; bounds its memory.
BLOCK_WORDS = 10_000
#: Tokens of one decoding query.
BLOCK_TOKENS = 500_000
#: Chunks and pieces whose tokens a task remembers, and bytes of text it takes at a time.
STORE_CHUNKS = 400_000
STORE_PIECES = 150_000
STEP_BYTES = 2 << 20

_SHORT = """
with recursive s(i, w, p, t) as (
    select 0, w, p, t from start
    union all
    (with pairs as (
        select a.w, a.p, m.rank
        from s a join s b on b.w = a.w and b.p = a.p + 1
        join merges m on m.pair = a.t * 65536::bigint + b.t),
     best as (select w, min(rank::bigint * 4294967296 + p) as k from pairs group by w)
     select s.i + 1, s.w,
            case when s.p > (k & 4294967295) then s.p - 1 else s.p end,
            case when s.p = (k & 4294967295) then (k >> 32)::int else s.t end
     from s join best using (w)
     where s.p <> (k & 4294967295) + 1)
)
select w, t from s join (select w, max(i) as i from s group by w) using (w, i) order by w, p
"""

# Segments of long words: a segment ends where the joined tokens stand in no vocabulary entry,
# so that no merge can cross.  A round merges the pairs of each segment's minimum rank, and
# segments without such a pair are done; every position of a block is different.
_LONG = """
with recursive s(i, w, p, t, done) as (
    select 0, w, p, t, false from start
    union all
    (with n as materialized (
        select i, w, p, t, row_number() over (order by p) as nr, lead(p) over by_word as q, lead(t) over by_word as u
        from s where not done and i < $rounds
        window by_word as (partition by w order by p)),
     pairs as materialized (
        select n.*, m.rank, m.alone,
               coalesce(sum(case when m.pair is null then 1 else 0 end)
                        over (order by p rows between unbounded preceding and 1 preceding), 0)::int as seg
        from n left join spans m on m.pair = n.t * 65536::bigint + n.u),
     least as materialized (select *, min(rank) over (partition by seg) as best from pairs),
     hits as (select p, q, rank, alone, seg, nr - row_number() over (partition by seg order by p) as island
              from least where rank = best),
     placed as (select p, q, rank, alone, row_number() over (partition by seg order by p) as nth,
                       row_number() over (partition by seg, island order by p) as inside from hits),
     picked as materialized (
        select p, q, rank from placed where case when alone then inside % 2 = 1 else nth = 1 end)
     select l.i + 1, l.seg, l.p, coalesce(a.rank, l.t), l.best is null
     from least l left join picked a on a.p = l.p
     where l.p not in (select q from picked))
)
select w, p, t, done from s where done or i = $rounds order by p
"""


class _Sql:
    """An in-process DuckDB with bounded memory."""

    def __init__(self) -> None:
        import duckdb
        # No folder to spill to: what a query holds is bounded by its block.
        self.sql = duckdb.connect(config={"threads": "1", "memory_limit": f"{MEMORY_MB}MB", "temp_directory": ""})

    def table(self, name: str, columns: dict) -> None:
        self.sql.register("given", pa.table(columns))
        self.sql.execute(f"create or replace table {name} as select * from given")
        self.sql.unregister("given")


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class BytePairs(_Sql):
    """Merge table of one rank file."""

    def __init__(self, path: str) -> None:
        super().__init__()
        ranks = _ranks(path)
        left, right, rank = [], [], []
        for token, k in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(k)
        self.ranks, self.long_ready = ranks, False
        self.byte_rank = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.table("merges", {
            "pair": np.array(left, np.int64) * 65536 + np.array(right, np.int64), "rank": np.array(rank, np.int32)})

    def _make_spans(self) -> None:
        """Pairs of neighbours within an entry; those that merge have a rank, ``alone`` if every
        merge that contains the new token has a higher one."""
        ranks = self.ranks
        found: dict[int, int] = {}
        lowest: dict[int, int] = {}
        for token in ranks:
            for i in range(len(token) - 1):
                for j in range(i + 1, len(token)):
                    a = ranks.get(token[i:j])
                    if a is None:
                        continue
                    for k in range(j + 1, len(token) + 1):
                        b = ranks.get(token[j:k])
                        if b is not None and a * 65536 + b not in found:
                            found[a * 65536 + b] = new = ranks.get(token[i:k], -1)
                            for t in (a, b) if new >= 0 else ():
                                lowest[t] = min(lowest.get(t, new), new)
        rank = np.fromiter(found.values(), np.int32, len(found))
        self.table("spans", {
            "pair": np.fromiter(found, np.int64, len(found)), "rank": pa.array(rank, mask=rank < 0),
            "alone": [lowest.get(k, k + 1) > k for k in rank.tolist()]})
        self.long_ready = True

    def encode(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        short = [i for i, w in enumerate(words) if len(w) <= LONG_WORD]
        for at in range(0, len(short), BLOCK_WORDS):
            self._block(words, short[at:at + BLOCK_WORDS], out)
        step, held = [], 0
        for i in [i for i, w in enumerate(words) if len(w) > LONG_WORD]:
            if step and held + len(words[i]) > LONG_BLOCK:
                self._long_block(words, step, out)
                step, held = [], 0
            step.append(i)
            held += len(words[i])
        if step:
            self._long_block(words, step, out)
        return out

    def _long_block(self, words: list[bytes], which: list[int], out: list[np.ndarray]) -> None:
        if not self.long_ready:
            self._make_spans()
        data = np.frombuffer(b"".join(words[i] for i in which), np.uint8)
        lens = np.fromiter((len(words[i]) for i in which), np.int64, len(which))
        self.sql.execute(f"set memory_limit = '{max(MEMORY_MB, len(data) * LONG_BYTES >> 20)}MB'")
        w, p, t = np.repeat(np.arange(len(which), dtype=np.int32), lens), np.arange(len(data), dtype=np.int32), self.byte_rank[data]
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(p):
            self.table("start", {"w": w, "p": p, "t": t})
            # All rounds of a recursion stay in memory, so the next ones start from what is left.
            got = self.sql.execute(_LONG, {"rounds": max(1, LONG_ROWS // len(p))}).fetchnumpy()
            w, p, t, ended = (np.asarray(got[c]) for c in ("w", "p", "t", "done"))
            done.append((p[ended], t[ended]))
            w, p, t = w[~ended].astype(np.int32), p[~ended], t[~ended].astype(np.int32)
        places, ids = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(places)
        bounds = np.searchsorted(places[order], np.cumsum(lens)[:-1])
        for i, part in zip(which, np.split(ids[order].astype(np.int32), bounds)):
            out[i] = part

    def _block(self, words: list[bytes], which: list[int], out: list[np.ndarray]) -> None:
        data = np.frombuffer(b"".join(words[i] for i in which), np.uint8)
        lens = np.fromiter((len(words[i]) for i in which), np.int64, len(which))
        self.table("start", {
            "w": np.repeat(np.arange(len(which), dtype=np.int32), lens),
            "p": (np.arange(len(data)) - np.repeat(np.cumsum(lens) - lens, lens)).astype(np.int32),
            "t": self.byte_rank[data]})
        got = self.sql.execute(_SHORT).fetchnumpy()
        ids = np.asarray(got["t"], np.int32)
        ends = np.cumsum(np.bincount(np.asarray(got["w"]), minlength=len(which)))
        for i, part in zip(which, np.split(ids, ends[:-1])):
            out[i] = part


class Vocabulary(_Sql):
    """Bytes of the tokens of one rank file."""

    def __init__(self, path: str) -> None:
        super().__init__()
        ranks = _ranks(path)
        self.table("vocabulary", {"t": np.array(list(ranks.values()), np.int32), "h": [k.hex() for k in ranks]})

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each id list."""
        out: list[bytes] = [b""] * len(ids)
        step: list[int] = []
        held = 0
        for i, x in enumerate(ids):
            step.append(i)
            held += len(x)
            if held >= BLOCK_TOKENS or i == len(ids) - 1:
                self._decode_block(ids, step, out)
                step, held = [], 0
        return out

    def _decode_block(self, ids: list[np.ndarray], which: list[int], out: list[bytes]) -> None:
        lens = [len(ids[i]) for i in which]
        self.table("tokens", {
            "d": np.repeat(np.arange(len(which), dtype=np.int32), lens),
            "p": np.arange(sum(lens), dtype=np.int64), "t": np.concatenate([ids[i] for i in which])})
        rows = self.sql.execute(
            "select d, string_agg(h, '' order by p) from tokens join vocabulary using (t) group by d").fetchall()
        for d, h in rows:
            out[which[d]] = bytes.fromhex(h)


class _Words:
    """Tokenises chunks: splits them by the pattern and encodes unseen pieces."""

    def __init__(self, pairs: BytePairs) -> None:
        import public_tokenizers
        import regex
        self.pairs = pairs
        self.find = regex.compile(public_tokenizers.PATTERN).findall
        self.known: dict[str, bytes] = {}

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self.find(c) for c in chunks]
        if len(self.known) > STORE_PIECES:
            self.known.clear()
        fresh = list({p for s in split for p in s if p not in self.known})
        self.known.update((p, x.tobytes()) for p, x in zip(fresh, self.pairs.encode([p.encode() for p in fresh])))
        parts = [b"".join([self.known[p] for p in s]) for s in split]
        return np.frombuffer(b"".join(parts), np.int32), np.fromiter(map(len, parts), np.int64, len(parts)) // 4


def _encoder(path: str, held: dict = {}) -> ChunkStore:  # noqa: B006  one per Python worker
    if path not in held:
        held[path] = ChunkStore(_Words(BytePairs(path)), STORE_CHUNKS)
    return held[path]


def _decoder(path: str, held: dict = {}) -> Vocabulary:  # noqa: B006  one per Python worker
    if path not in held:
        held[path] = Vocabulary(path)
    return held[path]


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """``key``, ``n_tokens`` and packed ``ids`` of every row."""
    path = path or vocabulary("byte_bpe_multi_50k.tiktoken")
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, STEP_BYTES):
            ids = _encoder(path).tokens([t or "" for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(list(map(len, ids)), pa.int64()),
                 pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary())], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the bytes of its packed ids as ``out`` in the place of ``ids``."""
    path = path or vocabulary("byte_bpe_multi_50k.tiktoken")
    kept = [f for f in df.schema.fields if f.name != ids]
    schema = T.StructType([*kept, T.StructField(out, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, ids, STEP_BYTES):
            lists = [np.frombuffer(x or b"", "<u4").astype(np.int32) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(_decoder(path).decode(lists), pa.binary())],
                names=schema.names)

    return df.mapInArrow(run, schema)


def as_array(ids: Column) -> Column:
    """Packed ids as ``array<int>``."""
    digits = F.hex(ids)
    groups = F.regexp_extract_all(digits, F.lit("(.{8})"), F.lit(1))
    return F.transform(groups, lambda g: F.conv(F.concat(
        F.substring(g, 7, 2), F.substring(g, 5, 2), F.substring(g, 3, 2), F.substring(g, 1, 2)), 16, 10).cast("int"))
