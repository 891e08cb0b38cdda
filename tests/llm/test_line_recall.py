"""Recall of the line stage on planted passages, and its result against a plain version."""

import random
from collections import Counter

from plain_lines import plain_dedup

from dealspark.llm import line_dedup
from dealspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def liner(rng):
    return lambda n: " ".join("".join(rng.choices("abcdefghijk", k=6)) for _ in range(n))


def test_planted_passages_of_short_lines(spark):
    rng = random.Random(3)
    line = liner(rng)
    passages = [[line(-(-52 // k) + 1) for _ in range(k)] for k in (2, 3, 4, 5, 6, 7, 8) for _ in range(12)]
    passages += [[line(60), line(5), line(60)] for _ in range(12)] + [[line(30), "", line(30)] for _ in range(12)]
    passages += [[line(3), line(40), line(2), line(9)] for _ in range(12)] + [[line(55)] for _ in range(12)]
    rows = []
    for n, p in enumerate(passages):
        for k in range(3):
            rows.append((3 * n + k, "\n".join([line(6) for _ in range(rng.randrange(1, 4))] + p + [line(7) for _ in range(rng.randrange(1, 4))])))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in line_dedup.dedup(df).collect()}
    before = dict(rows)
    for n, p in enumerate(passages):
        assert got[3 * n]["text"] == before[3 * n] and got[3 * n]["removed_chunks"] == 0
        for k in (1, 2):
            r = got[3 * n + k]
            assert r["text"] == before[3 * n + k].replace("\n".join(p) + "\n", ""), len(p)
            assert (r["removed_lines"], r["removed_chunks"]) == (len(p), 1)


def test_a_formula_stays_wherever_it_stands(spark):
    rng = random.Random(7)
    line = liner(rng)
    formulas = ["Dear reader of these pages today,\nit is good to see you", "Best wishes\nAnna", "one two three four five six seven\nx"]
    rows = []
    for i in range(200):
        body = [line(rng.randrange(1, 40)) for _ in range(rng.randrange(1, 9))]
        body.insert(rng.randrange(len(body) + 1), formulas[i % 3])
        rows.append((i, "\n".join(body)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(rows)


def test_random_mixtures(spark):
    rng = random.Random(9)
    line = liner(rng)
    pool = [line(rng.choice([1, 3, 8, 20, 60])) for _ in range(12)] + ["", " ", "x"]
    blocks = [[rng.choice(pool) for _ in range(rng.randrange(1, 7))] for _ in range(6)]
    rows = []
    for i in range(300):
        text = []
        for _ in range(rng.randrange(1, 5)):
            text += rng.choice([blocks[rng.randrange(6)], [rng.choice(pool)], [line(5)], [line(9)]])
        rows.append((i, "\n".join(text)))
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(plain_dedup(rows))
    assert sum(got[i] != t for i, t in rows) > 30


def test_line_result(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {r["doc_id"]: r["text"] for r in QUERIES["op7_line_dedup"](spark, SF).collect()} == dict(plain_dedup(docs))
    long = "a b c d e f g h i j k l m n o p q r s t u v w x y z"
    odd = [(1, "x\n" * 40), (2, "x\n\nx\nx"), (3, f"{long}\nc"), (4, f"{long}\nc\nd"), (5, f"c\nd\n{long}"), (6, ""), (7, "\n\n"), (8, "\n\n"),
           (9, "only"), (10, "only"), (11, f"é ü\n東京 {long}\n🙂"), (12, f"z\né ü\n東京 {long}\n🙂")]
    extra = [(None, f"{long}\nc"), (13, None), (3, f"{long}\nc"), (3, f"q\n{long}\nc")]
    df = spark.createDataFrame(odd + extra, "doc_id long, text string")
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.dedup(df).collect())
    # The second text of id 3 holds the passage at another place than the first one.
    assert got == Counter([*plain_dedup(odd), (None, f"{long}\nc"), (13, None), (3, f"{long}\nc"), (3, "q")])
    left = {x for _, t in got for x in (t or "").split("\n")}
    assert left >= {x for _, t in odd for x in t.split("\n")}
    assert line_dedup.dedup(df.where("false")).collect() == []
