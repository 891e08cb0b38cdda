"""The n-gram join on many near copies of long texts, and the rows that stay of a group."""

import random
from collections import Counter

from dealspark.llm import common, ngram_join


def near_copies(rng, words, n, changes):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(changes):
            t[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(t))
    return out


def test_many_near_copies_of_a_long_text_carry_short_lists(spark, monkeypatch):
    rng = random.Random(4)
    kept = {}

    def watched(df, kind):
        out = common.stored(df, kind)
        kept[kind] = out
        return out
    monkeypatch.setattr(ngram_join, "stored", watched)
    texts = near_copies(rng, 4000, 50, 4)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = ngram_join.Join(df).components().collect()
    assert {r["component_id"] for r in got} == {0} and {r["n_links"] for r in got} == {49}
    # Each pair was found, and few of them more than once before they were made distinct.
    assert kept["ngram-candidates"].count() == 50 * 49 // 2


def test_links_are_found_with_any_length_of_the_lists(spark, monkeypatch):
    rng = random.Random(5)
    texts = [t for _ in range(3) for t in near_copies(rng, 300, 40, 7)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    want = None
    for n in (16, 1):
        monkeypatch.setattr(ngram_join, "PRIOR", n)
        got = Counter(map(tuple, ngram_join.Join(df).components().collect()))
        want = want or got
        assert got == want


def test_rows_of_one_id(spark):
    one, two = "a b c d e f g h i j", "q r s t u v w x y z"
    rows = [(1, one, "b", 2), (1, one, "a", 9), (1, two, "a", 1), (2, one, "a", 0), (3, two, None, None), (4, None, "n", 1),
            (4, None, "m", 1), (None, one, "z", 1), (None, one, "z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, first int")
    got = Counter(map(tuple, ngram_join.keep_one(df.repartition(3)).collect()))
    # Both texts of id 1 stay, each with its least other columns; 2 and 3 are copies of them.
    assert got == Counter([(1, one, "a", 9), (1, two, "a", 1), (4, None, "m", 1), (None, one, "z", 1), (None, one, "z", 1)])
    bare = df.select("doc_id", "text")
    assert Counter(map(tuple, ngram_join.keep_one(bare).collect())) == Counter(
        [(1, one), (1, two), (4, None), (None, one), (None, one)])
