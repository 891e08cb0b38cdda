"""Language identification by rank-order n-gram profiles.

A text's profile is its most frequent character 1- to 3-grams over lower-cased
letter runs (runs are separated by one blank), most frequent first, ties by the
gram.  A language's profile comes from the counts of all its training texts.
The distance between a text and a language is the sum, over the text's profile,
of how far each gram is out of place; a gram that the language's profile lacks
counts as the greatest distance.  The nearest language wins, ties go to the
smaller code.  The score is 1 - distance / greatest possible distance.

Edge cases: a null text or one without a letter is ``und`` with score 0, as is
every text when nothing was learned; rows with a null language are not learned
from; a null id is not held out; an empty table gives an empty result; repeated
rows count each time.  Text, ids and language are read by name, other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import by_bytes

#: Grams of a language's profile, and of a text's.
LANGUAGE_GRAMS = 400
TEXT_GRAMS = 300
#: Different grams that a training task holds before it passes partial counts on.
HELD_GRAMS = 500_000
#: A text whose best score lies below is like none of the learned languages.
MIN_SCORE = 0.3
#: Code points of a long text that are counted at a time.
STEP = 1 << 20

UNKNOWN = "und"


def _letters(held: list = []) -> np.ndarray:  # noqa: B006  one per Python worker
    if not held:
        held.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return held[0]


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different grams (as integers, 21 bits a character) and their counts, over the whole text."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # One blank before, between and after the runs of letters.
    letter = np.concatenate([[False], letter, [False]])
    codes = np.concatenate([[0], codes, [0]]).astype(np.int64)
    codes[~letter] = 32
    keep = letter | np.concatenate([letter[1:], [False]]) | (np.arange(len(letter)) == len(letter) - 1)
    codes = codes[keep]
    parts = []
    for at in range(0, len(codes), STEP):
        c = codes[at:at + STEP + 2]
        one, two, three = c[:STEP], (c[:-1] << 21 | c[1:])[:STEP], (c[:-2] << 42 | c[1:-1] << 21 | c[2:])[:STEP]
        parts.append(_counted(np.concatenate([one[one != 32], two, three])))
    return parts[0] if len(parts) == 1 else _merged(parts)


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def top(keys: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` most frequent grams, most frequent first, ties by the smaller gram."""
    if len(keys) > n:
        least = np.partition(counts, len(counts) - n)[len(counts) - n]
        at = counts >= least
        keys, counts = keys[at], counts[at]
    return keys[np.lexsort((keys, -counts))][:n]


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows with a text and a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}

        def out() -> pa.RecordBatch:
            merged = {k: _merged(v) for k, v in held.items()}
            held.clear()
            return pa.RecordBatch.from_arrays([
                pa.array([k for k, v in merged.items() for _ in range(len(v[0]))], pa.string()),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(v[0] for v in merged.values())])),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(v[1] for v in merged.values())]))],
                names=["lang", "gram", "n"])

        size = 0
        for batch in by_bytes(batches, text):
            for code, value in zip(batch.column(lang).to_pylist(), batch.column(text).to_pylist()):
                parts = held.setdefault(code, [])
                parts.append(grams(value))
                size += len(parts[-1][0])
                if size > HELD_GRAMS:
                    held = {k: [_merged(v)] for k, v in held.items()}
                    size = sum(len(v[0][0]) for v in held.values())
                    if size > HELD_GRAMS // 2:
                        yield out()
                        size = 0
        if held:
            yield out()

    return (df.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
            .where("lang is not null and text is not null")
            .mapInArrow(_renamed(run, lang, text), "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def _renamed(run, lang: str, text: str):
    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(b.rename_columns([lang, text]) for b in batches)
    return inner


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, list[int]]:
    """Language -> profile.  At most ``LANGUAGE_GRAMS`` integers a language reach the driver."""
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    rows = (gram_counts(df, text, lang).withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= LANGUAGE_GRAMS).collect())
    found: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        found.setdefault(r["lang"], []).append(r["gram"])
    return found


class Profiles:
    def __init__(self, profiles: dict[str, list[int]]) -> None:
        self.langs = sorted(profiles)
        self.grams = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(p, np.int64) for p in profiles.values())]))
        self.rank = np.full((len(self.langs), len(self.grams)), -1, np.int64)
        for i, code in enumerate(self.langs):
            p = np.array(profiles[code], np.int64)
            self.rank[i, np.searchsorted(self.grams, p)] = np.arange(len(p))

    def predict(self, text: str | None) -> tuple[str, float]:
        keys, counts = grams(text or "")
        if not len(keys) or not self.langs or not len(self.grams):
            return UNKNOWN, 0.0
        best = top(keys, counts, TEXT_GRAMS)
        at = np.minimum(np.searchsorted(self.grams, best), len(self.grams) - 1)
        rank = np.where(self.grams[at] == best, self.rank[:, at], -1)
        off = np.where(rank < 0, LANGUAGE_GRAMS, np.abs(rank - np.arange(len(best))))
        distance = off.sum(axis=1)
        i = int(distance.argmin())
        return self.langs[i], 1.0 - float(distance[i]) / (LANGUAGE_GRAMS * len(best))


def predict(df: DataFrame, profiles: dict[str, list[int]], key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``lang_pred`` and ``score`` of every row."""
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles)
        for batch in by_bytes(batches, text):
            got = [known.predict(t) for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array([g[0] for g in got], pa.string()),
                                              pa.array([g[1] for g in got], pa.float64())], names=schema.names)

    return df.select(key, text).mapInArrow(run, schema)


def keep_known(df: DataFrame, profiles: dict[str, list[int]], text: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``df`` (all columns) whose text is like a learned language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Profiles(profiles)
        for batch in by_bytes(batches, text):
            got = [known.predict(t) for t in batch.column(text).to_pylist()]
            yield batch.filter(pa.array([g[0] != UNKNOWN and g[1] >= min_score for g in got], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def held_out(df: DataFrame, key: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(df[key].cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out; predict every row."""
    profiles = learn(df.where(~held_out(df, key)), text, lang)
    out = predict(df, profiles, key, text)
    return out.select(key, held_out(out, key).alias("held_out"), "lang_pred", "score")
