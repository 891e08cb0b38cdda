"""Conversation prefix trie by burst tries over Spark shards.

A turn is known by the SHA-256 of its role and text, a conversation by its list
of turns; equal conversations become one path with their number first.  Paths
start in one container under the root.  A container that holds more than
``CONTAINER_PATHS`` paths bursts: its head becomes a node, and its paths go to
containers by their next turn.  The containers that are left are dealt to shards
whole, sorted there by Spark, and swept into nodes with a stack.  Heads get the
sums of their children from the deepest level up.

The ids of the conversations that end in a node are hashed in numeric order: a
range exchange sorts (path, id), each task hashes the paths that lie wholly in
its range and passes on the id texts of the others, which are hashed as they
stream by; no task holds a path's ids.

Edge cases: rows without a conversation id take no part; a null role or text is
empty; turns of equal number are ordered by role, then by the hash of the turn;
repeated rows are turns of their own; conversations without turns end in the
root; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

#: Different paths that a container may hold without bursting.  A sweep streams, so
#: this bounds a shard's share of the work, not its memory.
CONTAINER_PATHS = 1 << 12
#: Heads whose table may be broadcast (each is a hash and two numbers).
BROADCAST_HEADS = 50_000
#: Characters of an id text that is passed on.
TEXT_CHARS = 1 << 16

_WORD = r"[^\x20\x09-\x0D]+"
_TURN = "array<struct<id:string,words:long>>"


def conversations(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role",
                  text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of every conversation, in order."""
    said, by = (F.coalesce(F.col(c), F.lit("")) for c in (text, role))
    # The role's length keeps (role, text) apart from other pairs of the same concatenation.
    ident = F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)
    words = F.size(F.regexp_extract_all(said, F.lit(_WORD), F.lit(0))).cast("long")
    turns = (df.where(F.col(key).isNotNull())
             .select(F.col(key).cast("long").alias("conv_id"), F.struct(
                 F.col(turn).alias("turn"), by.alias("role"), F.substring(ident, 1, 32).alias("id"), words.alias("words")).alias("t")))
    # sort_array puts null turns first; a cell holds hashes, no texts.
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["words"].alias("words"))).cast(_TURN).alias("turns"))


def rebuilt(convs: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """(conv_id, path): the first h turns of conversation c - c % ``every``, then c's own turns
    after its first h; h = crc32 of c's digits, modulo ``most``."""
    own = convs.select("conv_id", "turns", (F.col("conv_id") - F.col("conv_id") % every).alias("of"),
                       (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int").alias("h"))
    firsts = convs.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("of"), F.slice("turns", 1, most).alias("first"))
    nothing = F.array().cast(_TURN)
    head = F.slice(F.coalesce("first", nothing), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(firsts, "of", "left").select("conv_id", F.concat(head, rest).alias("path"))


def path_key(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda t: t["id"]), ""), 256)


# -- ids that end in a node ----------------------------------------------------

_ENDS = T.StructType([T.StructField("end", T.StringType()), T.StructField("first", T.LongType()),
                      T.StructField("text", T.StringType()), T.StructField("sha", T.StringType())])


def _hash_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (end, id) of one range in order: hashes of the paths inside it, id texts of the first and last one,
    and of every path whose text grows beyond ``TEXT_CHARS``."""
    rows: list[tuple] = []
    end, first, parts, chars = None, 0, [], 0
    passed = True  # whether the path's ids are passed on: the first one may have begun in an earlier range

    def text() -> tuple:
        return end, first, ",".join(parts), None

    for batch in batches:
        for e, i in zip(batch.column("end").to_pylist(), batch.column("conv_id").to_pylist()):
            if e != end:
                if end is not None:
                    rows.append(text() if passed else (end, first, None, hashlib.sha256(",".join(parts).encode()).hexdigest()))
                    passed = False
                end, first, parts, chars = e, i, [], 0
            elif chars > TEXT_CHARS:
                rows.append(text())
                first, parts, chars, passed = i, [], 0, True
            parts.append(str(i))
            chars += len(parts[-1]) + 1
            if len(rows) >= 4096:
                yield _batch(rows, _ENDS)
                rows = []
    if end is not None:
        rows.append(text())
    yield _batch(rows, _ENDS)


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (end, first, text) in order: one hash a path, streamed."""
    end, state = None, None
    rows: list[tuple] = []
    for batch in batches:
        for e, text in zip(batch.column("end").to_pylist(), batch.column("text").to_pylist()):
            if e != end:
                if end is not None:
                    rows.append((end, None, None, state.hexdigest()))
                end, state = e, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
    if end is not None:
        rows.append((end, None, None, state.hexdigest()))
    yield _batch(rows, _ENDS)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def ends(paths: DataFrame) -> DataFrame:
    """(end, sha): SHA-256 of the comma-joined ids, ascending, of the rows (conv_id, end) of each path."""
    ranged = paths.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    found = stored(ranged.mapInArrow(_hash_ranges, _ENDS), "trie-ends")
    split = found.where("sha is null").repartition("end").sortWithinPartitions("end", "first")
    return found.where("sha is not null").select("end", "sha").unionAll(
        split.mapInArrow(_hash_texts, _ENDS).select("end", "sha"))


# -- containers ----------------------------------------------------------------

_NODE = T.StructType([
    T.StructField("top", T.StringType()), T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()),
    T.StructField("parent_conv_id", T.LongType()), T.StructField("n_convs", T.LongType()),
    T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()),
    T.StructField("saved_tokens", T.LongType()), T.StructField("end", T.StringType())])


class _Node:
    __slots__ = ("turn", "depth", "words", "least", "convs", "children", "leaves", "saved", "end")

    def __init__(self, turn: str | None, depth: int, words: int) -> None:
        self.turn, self.depth, self.words = turn, depth, words
        self.least: int | None = None
        self.convs, self.leaves, self.saved = 0, 0, 0
        self.children: list[tuple] = []
        self.end: str | None = None


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of containers whose paths come sorted; a node's row waits for its parent's smallest id."""
    rows: list[tuple] = []
    stack: list[_Node] = []
    head, above = None, None

    def close() -> None:
        node = stack.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.convs - 1) * node.words
        rows.extend((None, *c[:2], node.least, *c[2:]) for c in node.children)
        row = (node.least, node.depth, node.convs, len(node.children), node.leaves, node.saved, node.end)
        if not stack:
            rows.append((head, *row[:2], above, *row[2:]))
            return
        up = stack[-1]
        up.children.append(row)
        up.convs += node.convs
        up.leaves += node.leaves
        up.saved += node.saved
        up.least = node.least if up.least is None else min(up.least, node.least)

    for batch in batches:
        for r in batch.to_pylist():
            path, depth = r["path"], r["depth"]
            if r["head"] != head or not stack:
                while stack:
                    close()
                head, above = r["head"], r["above"]
                stack.append(_Node(None, depth, path[depth - 1]["words"] if depth else 0))
            top = stack[0].depth
            shared = top
            while shared - top + 1 < len(stack) and shared < len(path) and stack[shared - top + 1].turn == path[shared]["id"]:
                shared += 1
            while len(stack) > shared - top + 1:
                close()
            for k in range(shared, len(path)):
                stack.append(_Node(path[k]["id"], k + 1, path[k]["words"]))
            node = stack[-1]
            node.convs += r["n"]
            node.least = r["least"] if node.least is None else min(node.least, r["least"])
            node.end = r["end"]
        if len(rows) >= 4096:
            yield _batch(rows, _NODE)
            rows = []
    while stack:
        close()
    yield _batch(rows, _NODE)


def nodes(rows: DataFrame, container_paths: int = CONTAINER_PATHS) -> DataFrame:
    """The trie of the rows (conv_id, path): one row a node, ``end`` being the path of those that end there."""
    spark = rows.sparkSession
    left = stored(rows.withColumn("end", path_key(F.col("path"))).groupBy("end").agg(
        F.first("path").alias("path"), F.min("conv_id").alias("least"), F.count("*").alias("n"))
        .select("end", "path", "least", "n", F.lit("").alias("head"), F.lit(None).cast("string").alias("up"),
                F.lit(None).cast("long").alias("above"), F.lit(0).alias("depth")), "trie-paths")
    levels: list[DataFrame] = []  # heads by depth
    swept: DataFrame | None = None
    while True:
        sizes = left.groupBy("head").agg(
            F.count("*").alias("paths"), F.min("least").alias("h_least"),
            F.sum("n").alias("n_convs"), F.max(F.when(F.size("path") == F.col("depth"), F.col("end"))).alias("h_end"),
            F.max("up").alias("h_up"), F.max("above").alias("h_above"),
            F.max(F.when(F.col("depth") > 0, F.get("path", F.col("depth") - 1)["words"])).alias("words"))
        big = stored(sizes.where(F.col("paths") > container_paths), "trie-heads")
        n = big.count()
        bigs = big.select(F.col("head").alias("b_head"), "h_least")
        bigs = F.broadcast(bigs) if n <= BROADCAST_HEADS else bigs
        joined = left.join(bigs, F.col("head") == F.col("b_head"), "left") if n else left
        whole = joined.where("b_head is null").select(*left.columns) if n else left
        swept = whole if swept is None else swept.unionAll(whole)
        if not n:
            break
        levels.append(big)
        going = joined.where("b_head is not null and size(path) > depth")
        left = stored(going.select(
            "end", "path", "least", "n", F.sha2(F.concat("head", F.get("path", F.col("depth"))["id"]), 256).alias("head"),
            F.col("head").alias("up"), F.col("h_least").alias("above"), (F.col("depth") + 1).alias("depth")), "trie-paths")
    kept = stored(swept.repartition("head").sortWithinPartitions("head", "path").select(
        "head", "above", "depth", "path", "least", "n", "end").mapInArrow(_sweep, _NODE), "trie-nodes")
    out = kept
    # Heads from the deepest level up: each sums the heads and container tops right below it.
    below = swept.groupBy("head").agg(F.max("up").alias("up")).join(
        kept.where("top is not null").select(F.col("top").alias("head"), "depth", "n_leaves", "saved_tokens"), "head")
    below = stored(below.select("up", "depth", "n_leaves", "saved_tokens"), "trie-tops")
    upper: DataFrame | None = None
    for depth in range(len(levels) - 1, -1, -1):
        under = below.where(F.col("depth") == depth + 1)
        under = under if upper is None else under.unionAll(upper)
        sums = under.groupBy("up").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                                       F.sum("saved_tokens").alias("saved"))
        heads = stored(levels[depth].join(sums.withColumnRenamed("up", "head"), "head").select(
            "h_up", F.col("head").alias("top"), F.col("h_least").alias("conv_id"), F.lit(depth).cast("long").alias("depth"),
            F.col("h_above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
            (F.col("saved") + (F.col("n_convs") - 1) * F.coalesce("words", F.lit(0))).alias("saved_tokens"),
            F.col("h_end").alias("end")), "trie-heads")
        upper = heads.select(F.col("h_up").alias("up"), "depth", "n_leaves", "saved_tokens")
        out = out.unionAll(heads.select(*_NODE.names))
    return out.drop("top")


def trie(df: DataFrame, container_paths: int = CONTAINER_PATHS) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations of ``df``, with the hash of the ids that end in each."""
    rows = stored(rebuilt(conversations(df)), "trie-rebuilt")
    found = nodes(rows, container_paths)
    hashes = ends(rows.select("conv_id", path_key(F.col("path")).alias("end")))
    columns = [F.col(c) for c in _NODE.names if c not in ("top", "end")]
    # Nodes in which nothing ends have no key; they stay out of the join.
    none = found.where("end is null").select(*columns, F.sha2(F.lit("").cast("binary"), 256).alias("ends_sha256"))
    return found.where("end is not null").join(hashes, "end").select(*columns, F.col("sha").alias("ends_sha256")).unionAll(none)


#: The trie in DuckDB SQL: all prefixes of all rebuilt conversations, grouped.
ORACLE = r"""
with digits as (
    select distinct conv_id, conv_id::varchar as t from conversations where conv_id is not null),
crc as (
    select conv_id, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(t, ''), lambda c: ord(c)::bigint)),
        lambda x, c: list_reduce(list_prepend(xor(x, c), range(8)), lambda y, k:
            xor(y >> 1, (y & 1) * 3988292384::bigint))), 4294967295::bigint) as n
    from digits),
turns as (
    select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
        order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
    from conversations where conv_id is not null group by conv_id),
rebuilt as (
    select c.conv_id, list_concat(coalesce(b.turns, [])[1:(n % 4)], c.turns[(n % 4) + 1:]) as path
    from turns c join crc using (conv_id) left join turns b on b.conv_id = c.conv_id - c.conv_id % 20),
prefixes as (
    select conv_id, d, len(path) as size, sha256(to_json(path[1:d])::varchar) as node,
           case when d > 0 then sha256(to_json(path[1:d - 1])::varchar) end as up,
           case when d > 0 then len(regexp_extract_all(path[d].text, '[^\x20\x09-\x0D]+')) else 0 end as words
    from (select *, unnest(range(len(path) + 1)) as d from rebuilt)),
nodes as (
    select node, any_value(up) as up, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
           (count(*) - 1) * any_value(words) as saved,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where size = d), '')) as ends_sha256
    from prefixes group by node),
children as (select up, count(*) as n from nodes where up is not null group by up),
ancestors as (
    select distinct p.node as node, a.node as above
    from prefixes p join prefixes a on a.conv_id = p.conv_id and a.d <= p.d),
subtrees as (
    select above, sum(saved) as saved_tokens, count(*) filter (where c.n is null) as n_leaves
    from ancestors join nodes using (node) left join children c on c.up = node group by above)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
       s.n_leaves, s.saved_tokens::bigint as saved_tokens, n.ends_sha256
from nodes n join subtrees s on s.above = n.node left join nodes p on p.node = n.up left join children c on c.up = n.node
"""
