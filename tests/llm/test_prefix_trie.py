"""Conversation trie against a plain version over all prefixes."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb

from dealspark.llm import prefix_trie
from dealspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t, key=lambda x: (x[:3], hashlib.sha256(
        f"{len(x[2].encode())}:{x[2]}{x[3]}".encode()).hexdigest()))] for c, t in turns.items()}
    members, ended = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(own.get(c - (c - 20 * int(c / 20)), [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ended[path].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * words
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, sorted(ended[p]))).encode()).hexdigest()) for p, m in members.items())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows],
                                 "conv_id long, turn long, role string, text string, path string, depth int")


def check(spark, rows, **kw):
    out = prefix_trie.trie(frame(spark, rows), **kw)
    assert out.columns == NAMES
    assert Counter(map(tuple, out.collect())) == plain(rows)


def test_query_and_sql(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = QUERIES["op11_prefix_trie"](spark, SF)
    want = plain(rows)
    assert got.columns == NAMES and Counter(map(tuple, got.collect())) == want
    sql = duckdb.connect()
    sql.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    found = sql.execute(ORACLES["op11_prefix_trie"])
    assert [d[0] for d in found.description] == NAMES
    assert Counter(found.fetchall()) == want


def test_bursting_copies_and_ids_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "TEXT_CHARS", 40)
    rng = random.Random(4)
    rows = []
    for c in range(-40, 900):
        if c % 3 == 0:  # a third of all are the same
            said = ["hello there", "hi you all", "what", "that is it"]
        else:
            said = [rng.choice(["a b", "c", ""]) for _ in range(rng.randrange(1, 9))]
        rows += [(c, t, rng.choice(["user", "user", None]) if c % 3 else "user", x) for t, x in enumerate(said)]
    rng.shuffle(rows)
    check(spark, rows, container_paths=5)
    check(spark, rows)


def test_a_long_conversation_and_a_hot_one(spark):
    rows = [(1, t, "user", f"t{t % 7}") for t in range(160)] + [(2, t, "user", f"t{t % 7}") for t in range(130)]
    rows += [(c, t, "user", "same") for c in range(20, 60) for t in range(2)]
    check(spark, rows, container_paths=3)


def test_nulls_ties_repeats_and_empty_tables(spark):
    rows = [(None, 1, "user", "x"), (5, None, "user", "first"), (5, 0, None, None), (5, 0, "a", "one"), (5, 0, "a", "two"),
            (5, 0, "a", "one"), (7, 0, "us", "erx"), (8, 0, "user", "x"), (9, 0, "", ""), (13, 3, "user", None),
            (-3, 0, "u", "neg"), (0, 0, "u", "zero"), (0, 1, "u", "zero two"), (20, 0, "u", "a" * 100_000)]
    check(spark, rows)
    check(spark, rows, container_paths=1)
    assert prefix_trie.trie(frame(spark, [])).collect() == []
