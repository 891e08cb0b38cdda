"""Quality rules: base counts of a text and the fertility of public vocabularies.

A word is a run of bytes other than space and 0x09-0x0D.  Every distinct word is
tokenised once per task by each vocabulary; a document's tokens are those of its
words.  Measures: characters per token, the share of byte-fallback tokens and
the entropy of the document's token distribution, each held against a band of
the text's language (or of its script where the language has too few rows).

Bands are learned from the corpus: counts of every measure per language, script
and quality label reach the driver in steps of 1 / ``STEPS``.  An edge lies
``SPREADS`` spreads from the median of the rows labelled good, or further in where
that rejects a larger share of the low labels than of the good ones; no edge
rejects more than ``MAX_GOOD_LOSS`` of the good rows.  Without labels the spreads
of all rows count.  A text without a language gets the one its character n-grams
are like.  A language of fewer than ``MIN_ROWS`` rows takes the band of the script,
and a script of fewer the band of the whole corpus; a corpus without a row that
passes the base rule accepts all measures.

Edge cases: a null, empty or blank text has no words, all counts 0 and fails the
base rule; repeated rows give repeated result rows; null ids pass through; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import language_id
from .common import by_bytes, stored, vocabulary, worker_tool

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Distinct words whose tokens a task keeps; beyond it the store starts anew.
STORE_WORDS = 400_000


@dataclass(frozen=True)
class Band:
    """Accepted range of each measure.

    ``entropy_*`` is per token, relative to log2 of the number of tokens (1.0:
    every token differs)."""

    min_chars_per_token: float
    min_chars_per_token_multi: float
    max_chars_per_token: float
    max_byte_share: float
    min_entropy: float
    max_entropy: float = 1.0
    max_chars_per_token_multi: float = 9.0


#: Rows of which a band is learned, low labels that can move an edge, share of good rows an edge may reject.
MIN_ROWS, MIN_LOW, MAX_GOOD_LOSS = 50, 10, 0.01
STEPS, SPREADS = 200, 4
#: Measures, the fields of their edges, and the least spread of each.
LEARNED = (("chars_per_token", 0.02), ("chars_per_token_multi", 0.02), ("byte_share", 0.01), ("entropy", 0.02))

#: Name of the band of all rows, for languages and scripts of too few; and what a corpus without a row to learn from accepts.
ALL = "all"
OPEN = Band(0.0, 0.0, float("inf"), 1.0, 0.0, 1.0, float("inf"))

MEASURES = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_dup_lines", T.LongType()),
    T.StructField("n_repeat_words", T.LongType()), T.StructField("base_failed", T.BooleanType()),
    T.StructField("kept", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("chars_per_token", T.DoubleType()), T.StructField("chars_per_token_multi", T.DoubleType()),
    T.StructField("byte_share", T.DoubleType()), T.StructField("entropy", T.DoubleType()),
    T.StructField("band", T.StringType()),
])


def repeat_words(ids: np.ndarray) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    top = int(ids.max()) + 1
    if top < 1 << 21:
        key = (ids[:-2] * top + ids[1:-1]) * top + ids[2:] if top else ids[2:]
    else:
        pairs = np.unique(ids[:-1] * top + ids[1:], return_inverse=True)[1]
        key = np.unique(pairs[:-1] * top + ids[2:], return_inverse=True)[1]
    order = np.sort(key)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.searchsorted(twice, key)
    hit = twice[np.minimum(at, len(twice) - 1)] == key
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def dup_lines(data: bytes) -> int:
    seen: set[bytes] = set()
    found = 0
    for line in data.split(b"\n"):
        if line in seen:
            found += 1
        elif line.strip():
            seen.add(line)
    return found


class _Words(dict):
    """Word -> number; numbers are given on first sight."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        self.fresh.append(word)
        return n


class Fertility:
    """Tokens of words, kept by word number in flat arrays."""

    def __init__(self, piece_path: str, multi_path: str, store_words: int = STORE_WORDS) -> None:
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        n = self.pieces.get_piece_size()
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(n)])
        with open(multi_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.multi = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self.store_words = store_words
        self._clear()

    def _clear(self) -> None:
        self.words = _Words()
        self.start = np.zeros(1024, np.int64)
        self.length = np.zeros(1024, np.int64)
        self.multi_length = np.zeros(1024, np.int64)
        self.pool = np.zeros(4096, np.int32)
        self.used = 0

    def numbers(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        if len(self.words) > self.store_words:
            self._clear()
        return [np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)) for words in texts]

    def learn(self) -> None:
        """Tokenise the words seen since the last call."""
        fresh = self.words.fresh
        if not fresh:
            return
        texts = [w.decode("utf-8", "replace") for w in fresh]
        ids = self.pieces.encode(texts, num_threads=1)
        multi = [self.multi.encode_ordinary(" " + t) for t in texts]
        lens = np.fromiter(map(len, ids), np.int64, len(ids))
        top = len(self.words)
        flat = np.fromiter((t for x in ids for t in x), np.int32, int(lens.sum()))
        self.start, self.length, self.multi_length = (_grown(a, top) for a in (self.start, self.length, self.multi_length))
        self.pool = _grown(self.pool, self.used + len(flat))
        at = top - len(fresh)
        self.length[at:top] = lens
        self.multi_length[at:top] = np.fromiter(map(len, multi), np.int64, len(multi))
        self.start[at:top] = self.used + np.cumsum(lens) - lens
        self.pool[self.used:self.used + len(flat)] = flat
        self.used += len(flat)
        fresh.clear()

    def measure(self, numbers: np.ndarray) -> tuple[int, int, float, float]:
        """Tokens, tokens of the second vocabulary, byte share, relative entropy."""
        lens = self.length[numbers]
        n = int(lens.sum())
        if not n:
            return 0, 0, 0.0, 0.0
        ends = np.cumsum(lens)
        tokens = self.pool[np.arange(n) + np.repeat(self.start[numbers] - (ends - lens), lens)]
        counts = np.bincount(tokens, minlength=len(self.is_byte))
        share = counts[self.is_byte].sum() / n
        counts = counts[counts > 0]
        bits = math.log2(n) - float((counts * np.log2(counts)).sum()) / n
        return n, int(self.multi_length[numbers].sum()), float(share), bits / math.log2(n) if n > 1 else 0.0


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    return np.concatenate([a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)])


def script(text: str) -> str:
    """``latin`` when at least half of the letters are of a Latin block."""
    if text.isascii():
        return "latin"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = int((codes >= 0x250).sum())
    return "latin" if 2 * wide <= len(codes) else "other"


class Rules:
    """Learned bands and, for texts without a language, profiles of the languages."""

    def __init__(self, learned: dict[str, Band], profiles: dict[str, list[int]] | None) -> None:
        self.learned = learned
        self.known = language_id.Profiles(profiles) if profiles else None

    def language(self, text: str, lang: str | None) -> str | None:
        if (lang and lang.strip()) or not self.known:
            return lang
        found, score = self.known.predict(text)
        return found if score >= language_id.MIN_SCORE else None

    def band(self, text: str, lang: str | None) -> tuple[str, Band]:
        name = next((n for n in self.names(text, lang) if n in self.learned), ALL)
        return name, self.learned.get(name, OPEN)

    def names(self, text: str, lang: str | None) -> list[str]:
        """The bands of a text, the nearest first."""
        return [n for n in (self.language(text, lang), script(text), ALL) if n]


def assess(fertility: Fertility, rules: Rules, texts: list[str | None], langs: list[str | None]) -> dict[str, list]:
    out: dict[str, list] = {f.name: [] for f in MEASURES.fields}
    step, split, held = [], [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        split.append((data, data.split()))
        step.append(i)
        held += len(data)
        if held > 2 << 20 or i == len(texts) - 1:
            _assess(fertility, rules, [texts[j] or "" for j in step], [langs[j] for j in step], split, out)
            step, split, held = [], [], 0
    return out


def _assess(fertility: Fertility, rules: Rules, texts: list[str], langs: list[str | None],
            split: list[tuple[bytes, list[bytes]]], out: dict[str, list]) -> None:
    numbered = fertility.numbers([words for _, words in split])
    fertility.learn()
    for text, lang, numbers, (data, words) in zip(texts, langs, numbered, split):
        n = len(words)
        chars = len(text) - sum(map(text.count, " \t\n\x0b\x0c\r"))
        repeated = repeat_words(numbers)
        failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
        tokens, multi, share, entropy = fertility.measure(numbers)
        band, rule = rules.band(text, lang)
        per, per_multi = (chars / tokens if tokens else 0.0), (chars / multi if multi else 0.0)
        kept = not failed and rule.min_chars_per_token <= per <= rule.max_chars_per_token \
            and rule.min_chars_per_token_multi <= per_multi <= rule.max_chars_per_token_multi and share <= rule.max_byte_share and rule.min_entropy <= entropy <= rule.max_entropy
        for k, v in (("n_words", n), ("word_chars", chars),
                     ("n_symbols", len(data) - len(data.translate(None, SYMBOLS))), ("n_dup_lines", dup_lines(data)),
                     ("n_repeat_words", repeated), ("base_failed", failed), ("kept", kept), ("n_tokens", tokens),
                     ("chars_per_token", per), ("chars_per_token_multi", per_multi), ("byte_share", share),
                     ("entropy", entropy), ("band", band)):
            out[k].append(v)


def _fertility(paths: tuple[str, str]) -> Fertility:
    return worker_tool(("fertility", *paths), lambda: Fertility(*paths))


def _paths(piece_path: str | None, multi_path: str | None) -> tuple[str, str]:
    return (piece_path or vocabulary("piece_bpe_32k.model"), multi_path or vocabulary("byte_bpe_multi_50k.tiktoken"))


def _langs(batch: pa.RecordBatch, lang: str | None) -> list[str | None]:
    return batch.column(lang).to_pylist() if lang and lang in batch.schema.names else [None] * batch.num_rows


def _profiles(df: DataFrame, text: str, lang: str | None) -> dict[str, list[int]] | None:
    """Profiles of the languages, if a row has none."""
    if not lang or not df.where(F.col(lang).isNull() | (F.trim(F.col(lang).cast("string")) == "")).select(lang).take(1):
        return None
    # Texts without a letter have no n-grams to learn from.
    return language_id.learn(df.where((F.trim(F.col(lang)) != "") & F.rlike(F.col(text), F.lit(r"\p{L}"))), text, lang)


def _counts(df: DataFrame, paths: tuple[str, str], profiles: dict | None, labels: DataFrame | None,
            key: str, text: str, lang: str | None) -> DataFrame:
    """(band, label, measure, step, n) of the rows that pass the base rule; label -1 is all of them."""
    labelled = labels is not None and key in df.columns
    schema = T.StructType([*([T.StructField("_id", df.schema[key].dataType)] if labelled else []),
                           T.StructField("bands", T.ArrayType(T.StringType())), T.StructField("steps", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules({}, profiles)
        for batch in by_bytes(batches, text):
            texts, langs = batch.column(text).to_pylist(), _langs(batch, lang)
            out = assess(_fertility(paths), rules, texts, langs)
            rows = [i for i, failed in enumerate(out["base_failed"]) if not failed]
            bands = [rules.names(texts[i], langs[i]) for i in rows]
            steps = [[int(out[m][i] * STEPS) for m, _ in LEARNED] for i in rows]
            yield pa.RecordBatch.from_arrays(
                [*([batch.column(key).take(pa.array(rows, pa.int64()))] if labelled else []),
                 pa.array(bands, pa.list_(pa.string())), pa.array(steps, pa.list_(pa.int32()))], names=schema.names)

    found = stored(df.select(*dict.fromkeys([*([key] if labelled else []), text, *([lang] if lang else [])])).mapInArrow(run, schema),
                   "quality-steps")
    rows = found.select(F.lit(-1).alias("label"), "bands", "steps")
    if labelled:
        given = labels.where("quality in (0, 1)").groupBy(F.col(key).alias("_id")).agg(F.min("quality").cast("int").alias("label"))
        rows = rows.union(found.join(given, "_id").select("label", "bands", "steps"))
    counts = (rows.select(F.explode("bands").alias("band"), "label", "steps")
              .select("band", "label", F.posexplode("steps").alias("measure", "step"))
              .groupBy("band", "label", "measure", "step").agg(F.count("*").alias("n")))
    enough = found.select(F.explode("bands").alias("band")).groupBy("band").count().where(
        (F.col("count") >= MIN_ROWS) | (F.col("band") == ALL)).select("band")
    return counts.join(enough, "band", "left_semi")


def _edge(ref: np.ndarray, low: np.ndarray, least: float, capped: bool) -> int:
    """The smallest accepted step by counts per step; mirrored counts give the largest."""
    below = np.concatenate([[0], np.cumsum(ref)])
    quartile, median = (int(np.searchsorted(below[1:], q * below[-1])) for q in (0.25, 0.5))
    edge = math.floor(median - SPREADS * max(least * STEPS, (median - quartile) / 0.6745))
    if not capped:
        return edge
    furthest = int(np.searchsorted(below, math.floor(MAX_GOOD_LOSS * below[-1]), side="right")) - 1
    edge = min(edge, furthest)
    if low.sum() >= MIN_LOW:
        gain = np.concatenate([[0], np.cumsum(low)]) / low.sum() - below / below[-1]
        start = max(edge, 0)
        best = start + int(gain[start:furthest + 1].argmax()) if furthest >= start else start
        edge = best if gain[best] > gain[start] else edge
    return edge


def learn(df: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text", lang: str | None = "lang",
          paths: tuple[str, str] | None = None) -> tuple[dict[str, Band], dict[str, list[int]] | None]:
    """Band per language and script with enough rows, and profiles for texts without a language.

    Counts per step reach the driver, of bands of ``MIN_ROWS`` rows or more."""
    lang = lang if lang in df.columns else None
    profiles = _profiles(df, text, lang)
    held: dict[str, dict[tuple[int, int], np.ndarray]] = {}
    rows = _counts(df, paths or _paths(None, None), profiles, labels, key, text, lang).collect()
    size = max((r["step"] for r in rows), default=0) + 1
    for r in rows:
        held.setdefault(r["band"], {}).setdefault((r["label"], r["measure"]), np.zeros(size, np.int64))[r["step"]] = r["n"]
    none = np.zeros(size, np.int64)
    bands = {}
    for name, of in held.items():
        edges = {}
        for k, (measure, least) in enumerate(LEARNED):
            good, low = of.get((1, k), none), of.get((0, k), none)
            capped = good.sum() >= MIN_ROWS
            ref = good if capped else of[-1, k]
            edges["min_" + measure] = _edge(ref, low, least, capped) / STEPS
            edges["max_" + measure] = (size - _edge(ref[::-1], low[::-1], least, capped)) / STEPS
        del edges["min_byte_share"]
        bands[name] = Band(**edges)
    return bands, profiles


def measure(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str | None = "lang",
            piece_path: str | None = None, multi_path: str | None = None, labels: DataFrame | None = None) -> DataFrame:
    """One row per row of ``df``: its key, the base counts, the measures and the verdict.

    ``labels`` has ``key`` and ``quality`` (0 or 1) of some rows."""
    paths = _paths(piece_path, multi_path)
    lang = lang if lang in df.columns else None
    learned = learn(df, labels, key, text, lang, paths)
    schema = T.StructType([T.StructField(key, df.schema[key].dataType), *MEASURES.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules(*learned)
        for batch in by_bytes(batches, text):
            out = assess(_fertility(paths), rules, batch.column(text).to_pylist(), _langs(batch, lang))
            yield pa.RecordBatch.from_arrays([batch.column(key), *map(pa.array, out.values())],
                                             names=[key, *out])

    return df.select(*dict.fromkeys([key, text, *([lang] if lang else [])])).mapInArrow(run, schema)


def keep_good(df: DataFrame, text: str = "text", lang: str | None = "lang", piece_path: str | None = None,
              multi_path: str | None = None, labels: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """The rows of ``df`` (all columns) that the rules keep."""
    paths = _paths(piece_path, multi_path)
    lang = lang if lang in df.columns else None
    learned = learn(df, labels, key, text, lang, paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Rules(*learned)
        for batch in by_bytes(batches, text):
            out = assess(_fertility(paths), rules, batch.column(text).to_pylist(), _langs(batch, lang))
            yield batch.filter(pa.array(out["kept"], pa.bool_()))

    return df.mapInArrow(run, df.schema)
