"""Line dedup by content-defined chunks of lines, in DataFrame operations only.

Lines that are not blank are hashed, lines of under ``SHORT_WORDS`` words above
all others and lines of more than ``LONG_WORDS`` words to zero, and a window of two
lines rolls over the hashes: a line that is the lower one in a window starts a
chunk.  So a boundary depends on its two neighbours only, and every two lines in
a row that texts share hold a boundary line which they share, too, whatever
surrounds them.  Boundary lines are hashed and counted; those whose hashes repeat
are extended over the line after and the line before them, and the bytes of these
two-line pieces are compared.  The first place of a piece is the smallest id that
holds it, and its first place there.

Repeated pieces that follow each other form a passage: a chunk of several lines.
A passage goes if it has ``MIN_WORDS`` words, and so does a repeated line of more
than ``LONG_WORDS`` words; the blank lines in it go, too.  A line goes only where an
earlier place holds the same line, so the earliest place of every line stays.

Edge cases: a null text stays null; an empty text has one blank line and stays;
a text whose lines all repeat an earlier document's becomes empty; rows with
the same id count as one document, also with different texts; rows with a null id
keep their text and take nothing from others; unequal pieces whose two hashes both
agree stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

SHORT_WORDS = 6
MIN_WORDS = 20
LONG_WORDS = 50
_SHORT = 1 << 62  # added to the hashes of short lines


def _has_words(text: Column, n: int) -> Column:
    return F.rlike(text, F.lit(rf"^\s*+(?:\S++\s++){{{n - 1}}}+\S"))


def _is_long(line: Column) -> Column:
    return (F.length(line) > 2 * LONG_WORDS) & _has_words(line, LONG_WORDS + 1)


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used;
    named columns would be inlined into the lambdas and computed per element."""
    return F.get(F.transform(F.array(value), then), 0)


def _numbers(n: Column) -> Column:
    """0 to n - 1."""
    return F.filter(F.sequence(F.lit(0), n), lambda i: i < n)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _full(lines: Column) -> Column:
    """Numbers of the lines that are not blank."""
    return F.filter(_numbers(F.size(lines)), lambda i: F.rlike(F.get(lines, i), F.lit(r"\S")))


def _of(lines: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of the lines that are not blank."""
    return _let(F.filter(lines, lambda x: F.rlike(x, F.lit(r"\S"))), then)


def _key(line: Column) -> Column:
    ranked = F.shiftrightunsigned(F.xxhash64(line), 2)
    return F.when(_is_long(line), F.lit(0)).when(_has_words(line, SHORT_WORDS), ranked).otherwise(ranked + F.lit(_SHORT))


def boundaries(keys: Column) -> Column:
    """Numbers of the lines that start a chunk."""
    def starts(m: Column) -> Column:
        own = F.get(keys, m)
        return (F.coalesce(own <= F.get(keys, m - 1), F.lit(False)) | F.coalesce(own <= F.get(keys, m + 1), F.lit(False))
                | (own == 0))
    return F.filter(_numbers(F.size(keys)), starts)


def _hashes(line: Column) -> Column:
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def repeated_lines(rows: DataFrame) -> DataFrame:
    """(_id, _hash, at): places of the boundary lines whose hashes are found twice or more."""
    def hashed(full: Column) -> Column:
        return F.transform(_let(F.transform(full, _key), boundaries), lambda m: F.struct(
            m.alias("at"), _hashes(F.get(full, m)).alias("h")))

    seen = (rows.where("_id is not null and _text is not null")
            .select("_id", "_hash", F.explode(_of(_lines(F.col("_text")), hashed)).alias("c"))
            .select("_id", "_hash", "c.at", "c.h.a", "c.h.b"))
    again = seen.groupBy("a", "b").agg(F.count("*").alias("times")).where("times > 1").select("a", "b")
    return seen.join(again, ["a", "b"], "left_semi").select("_id", "_hash", "at")


def _pieces(rows: DataFrame, places: DataFrame) -> DataFrame:
    """(_id, _hash, s, e, body, a, b): the lines s to e from or up to each place, and long lines alone."""
    wanted = places.groupBy("_id", "_hash").agg(F.collect_set("at").alias("_wanted"))
    texts = rows.select("_id", "_hash", "_text").join(wanted, ["_id", "_hash"])

    def held(full: Column) -> Column:
        def of(keys: Column) -> Column:
            def around(m: Column) -> Column:
                # Of a short and another line, the other one is a boundary and has the piece.
                high = F.when(F.get(keys, m) >= F.lit(_SHORT), F.lit(_SHORT)).otherwise(F.lit(0))
                pair = lambda s, other: F.when(F.get(keys, other) >= high, F.struct(s.alias("s"), (s + 1).alias("e")))
                return F.array(F.when(F.get(keys, m) == 0, F.struct(m.alias("s"), m.alias("e"))), pair(m, m + 1), pair(m - 1, m - 1))

            spans = F.array_distinct(F.filter(F.flatten(F.transform("_wanted", around)), lambda x: x.isNotNull()))
            return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), _body(full, x["s"], x["e"]).alias("body")))

        return _let(F.transform(full, _key), of)

    return (texts.select("_id", "_hash", F.explode(_of(_lines(F.col("_text")), held)).alias("c")).select("_id", "_hash", "c.*")
            .withColumn("h", _hashes(F.col("body"))).select("_id", "_hash", "s", "e", "body", "h.a", "h.b"))


def _body(full: Column, s: Column, e: Column) -> Column:
    return F.array_join(F.slice(full, s + 1, e - s + 1), "\n")


def removals(rows: DataFrame) -> DataFrame:
    """(_id, _hash, _gone): of each text the pieces (s, e) that an earlier place holds, too."""
    places = stored(repeated_lines(rows), "line-places")
    held = stored(_pieces(rows, places), "line-pieces")
    # Grouping by the body compares the bytes of pieces with equal hashes.
    same = held.groupBy("a", "b", "body").agg(F.min(F.struct("_id", "s")).alias("first"), F.count("*").alias("times"))
    firsts = (same.groupBy("a", "b").agg(F.count("*").alias("bodies"), F.min("first").alias("first"), F.sum("times").alias("times"))
              .where("bodies = 1 and times > 1").select("a", "b", F.col("first._id").alias("first"), F.col("first.s").alias("first_s")))
    gone = held.select("a", "b", "_id", "_hash", "s", "e").join(firsts, ["a", "b"]).where("_id <> first or s <> first_s")
    return gone.groupBy("_id", "_hash").agg(F.collect_set(F.struct("s", "e")).alias("_gone"))


def _passages(full: Column, gone: Column) -> Column:
    """(s, e) of the passages that go, numbers among the lines that are not blank."""
    def runs(starts: Column) -> Column:
        heads = F.filter(_numbers(F.size(starts)), lambda i: F.coalesce(F.get(starts, i - 1) + 1 != F.get(starts, i), F.lit(True)))
        return _let(heads, lambda hs: F.transform(hs, lambda h, j: F.struct(
            F.get(starts, h).alias("s"),
            (F.get(starts, h) + F.coalesce(F.get(hs, j + 1), F.size(starts)) - h).alias("e"))))

    pairs = F.sort_array(F.transform(F.filter(gone, lambda g: g["e"] > g["s"]), lambda g: g["s"]))
    passages = F.filter(_let(pairs, runs), lambda r: _has_words(_body(full, r["s"], r["e"]), MIN_WORDS))
    return F.concat(passages, F.filter(gone, lambda g: g["e"] == g["s"]))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", counts: bool = True,
          drop_emptied: bool = False) -> DataFrame:
    """``df`` with the text without repeated passages.

    ``counts`` adds (or replaces) ``n_lines``, ``removed_lines`` and
    ``removed_chunks`` (runs of removed lines); ``drop_emptied`` leaves out the rows that keep no
    character other than whitespace after a removal."""
    others = [c for c in df.columns if c not in (key, text)]
    rows = df.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_hash"), F.col(text).alias("_text"),
                     *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row")] if others else []))
    joined = (rows.where("_id is not null").join(removals(rows), ["_id", "_hash"], "left")
              .unionByName(rows.where("_id is null"), allowMissingColumns=True))

    def cleaned(lines: Column) -> Column:
        def without(out: Column) -> Column:
            return _let(F.array_except(_numbers(F.size(lines)), out), lambda kept: F.struct(
                F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n").alias("text"), F.size(kept).alias("lines"),
                F.size(F.array_except(out, F.transform(out, lambda k: k + 1))).alias("chunks")))

        def out(places: Column) -> Column:
            return F.array_distinct(F.flatten(F.transform(
                _of(lines, lambda full: _passages(full, F.col("_gone"))),
                lambda p: F.sequence(F.get(places, p["s"]), F.get(places, p["e"])))))

        return _let(_let(_full(lines), out), without)

    n_lines = F.coalesce(F.size(_lines(F.col("_text"))), F.lit(0))
    new = joined.withColumn("_new", F.when(F.col("_text").isNotNull() & F.col("_gone").isNotNull(), _let(_lines(F.col("_text")), cleaned)))
    if drop_emptied:
        new = new.where(F.col("_gone").isNull() | F.rlike("_new.text", F.lit(r"\S")))
    added = {"n_lines": n_lines, "removed_lines": F.coalesce(n_lines - F.col("_new.lines"), F.lit(0)),
             "removed_chunks": F.coalesce("_new.chunks", F.lit(0))} if counts else {}
    given = {key: F.col("_id"), text: F.coalesce("_new.text", "_text")} | {c: F.col("_row").getField(c) for c in others}
    return new.select(*[given[c].alias(c) for c in df.columns if c not in added], *[v.alias(k) for k, v in added.items()])
