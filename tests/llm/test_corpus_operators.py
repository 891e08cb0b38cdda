"""Operators over whole tables, against plain-Python versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from plain_lines import plain_dedup

import corpus_pipeline
from dealspark.llm import common, line_dedup, ngram_join, packing, topk, warc
from dealspark.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def rows_of(spark, table):
    return spark.read.parquet(f"{SF}/{table}.parquet").collect()


# --- n-gram join ------------------------------------------------------------

def plain_set(text, width=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(zip(*(words[k:] for k in range(width)))) if len(words) >= width else frozenset([tuple(words)])


def plain_components(rows, percent=90, width=3):
    """id -> (set size, component, links) over (id, text) rows."""
    by_set = defaultdict(set)
    for i, t in rows:
        by_set[plain_set(t, width)].add(i)
    sets = [s for s in by_set if s]
    holders, parent = defaultdict(list), list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    degree = Counter()
    for j, s in enumerate(sets):
        shared = Counter(k for g in s for k in holders[g])
        for k, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[k]) - n):
                degree[j] += 1
                degree[k] += 1
                parent[find(j)] = find(k)
        for g in s:
            holders[g].append(j)
    least = {}
    for j, s in enumerate(sets):
        own = [i for i in by_set[s] if i is not None]
        if own:
            least[find(j)] = min(least.get(find(j), min(own)), min(own))
    out = {}
    for j, s in enumerate(sets):
        for i in by_set[s]:
            out[i, s] = (len(s), least.get(find(j)), degree[j])
    return out


def check_join(rows, got, percent=90, width=3):
    want = plain_components(rows, percent, width)
    left = Counter((i, *(want[i, plain_set(t, width)] if plain_set(t, width) else (0, i, 0))) for i, t in rows)
    assert left == Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in got)


def near_texts(seed=0, groups=40, hot=150):
    rng = random.Random(seed)
    word = lambda: "w%d" % rng.randrange(3000)
    out = []
    for g in range(groups):
        base = [word() for _ in range(rng.choice([1, 2, 3, 5, 30, 60, 120, 200]))]
        for _ in range(hot if g == 3 else rng.randrange(1, 6)):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                t[rng.randrange(len(t))] = word()
            out.append(" ".join(t))
    return out


def test_join_brute_force(spark, monkeypatch):
    texts = near_texts() + [None, "", " \n", "One two", "one  TWO", "Ünï Öä x", "ünï öä x", "k " * 500, "K " * 700]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, texts[5]), (None, texts[0]), (None, "only here and nowhere else")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, cls string, label string")
    check_join(rows, ngram_join.Join(df).components().collect())
    check_join(rows, ngram_join.Join(df, percent=80, width=5).components().collect(), 80, 5)
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    check_join(rows, ngram_join.Join(df).components().collect())
    assert ngram_join.Join(df.where("false")).components().collect() == []
    kept = ngram_join.keep_one(df)
    assert kept.columns == df.columns
    want = {v[1] if v else i for i, v in ((i, plain_components(rows).get((i, plain_set(t)))) for i, t in rows)} - {None}
    got = [r["doc_id"] for r in kept.collect()]
    assert Counter(got) == Counter([*want, None, None])


def test_join_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in rows_of(spark, "documents")]
    check_join(rows, QUERIES["op2_ngram_join"](spark, SF).collect())


def test_prefixes_and_needed_overlap():
    for n in range(1, 60):
        assert ngram_join.prefix_length(n, 90) == n - math.ceil(0.9 * n) + 1
        for m in range(1, 60):
            least = next(i for i in range(n + m) if 100 * i >= 90 * (n + m - i))
            assert ngram_join.needed(n, m, 90) == least


# --- top-k ------------------------------------------------------------------

def plain_top(vectors, queries, k=5):
    ok = {(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in vectors
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for q, a in ok:
        if queries(q):
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def top_rows(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_top_k_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(0)
    hot = rng.standard_normal(8).tolist()
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(300)] + [(i, hot) for i in range(300, 450)]
    rows += [(450, None), (451, [None] * 8), (452, [float("nan")] * 8), (453, [float("inf")] + [0.0] * 7), (454, []),
             (455, [1.0, 2.0]), (450, hot), (7, rows[7][1]), (None, hot), (456, [0.5] * 9), (500, [1e4] * 8)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, score int")
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    want = plain_top(single, lambda i: i % 50 == 0)
    assert top_rows(topk.top_k(df, df.where("vec_id % 50 = 0"))) == want
    for size, n in (("RANGE", 64), ("QUERIES", 4), ("FIRST", 2)):
        monkeypatch.setattr(topk, size, n)
    assert top_rows(topk.top_k(df, df.where("vec_id % 50 = 0"))) == want
    assert topk.top_k(df.where("false"), df.where("false")).collect() == []
    few = df.where("vec_id in (0, 1, 2)")
    assert top_rows(topk.top_k(few, few.where("vec_id = 0"))) == plain_top([x for x in single if x[0] in (0, 1, 2)], lambda i: i == 0)


def test_blocks_are_pruned():
    rng = np.random.default_rng(0)
    x = np.repeat(rng.integers(-200, 200, (16, 8)) * 10, topk.BLOCK, axis=0) + rng.integers(-3, 3, (16 * topk.BLOCK, 8))
    q = rng.integers(-200, 200, (10, 8))
    scores, found, scored = topk.search_range(np.arange(-10, 0), q, np.full(10, topk.NONE), np.arange(len(x)), x, 5)
    assert scored < 10 * 16 / 2
    for a, s in zip(q, scores):
        assert sorted((x @ a).tolist(), reverse=True)[:5] == s.tolist()


# --- packing ----------------------------------------------------------------

def check_packing(rows, texts, capacity=packing.CAPACITY):
    """rows of the query against the tokenizer; returns its sequences and those of best-fit decreasing over everything."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    want = []
    for i, text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        head = len(ids) % capacity
        starts = ([0] if head else []) + list(range(head, len(ids), capacity))
        for k, s in enumerate(starts):
            part = ids[s:starts[k + 1] if k + 1 < len(starts) else len(ids)]
            want.append((i is None, i or 0, k, s, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert got == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    sizes = np.array([r["length"] for r in rows])
    room: list[int] = []
    packing.best_fit(sizes, np.argsort(-sizes, kind="stable"), np.empty(len(sizes), np.int64), room, capacity)
    return len(bins), len(room)


def test_packing(spark):
    rng = random.Random(0)
    texts = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma\n", "x1", " ", "déjà"]) for _ in range(rng.choice([3, 50, 400, 900, 2500]))))
             for i in range(300)] + [(300, None), (301, ""), (302, "word " * 5000), (5, "again"), (5, "again"), (None, "no id")]
    df = spark.createDataFrame([(i, t, 1) for i, t in texts], "doc_id long, text string, item int")
    n, least = check_packing(packing.pack_documents(df).collect(), texts)
    assert n <= least + 1
    assert packing.pack_documents(df.where("false")).collect() == []
    n, least = check_packing(packing.pack(packing.pieces(df), group_items=40).collect(), texts)
    docs = [(r["doc_id"], r["text"]) for r in rows_of(spark, "documents")]
    n, least = check_packing(QUERIES["op6_genetic_packing"](spark, SF).collect(), docs)
    assert n <= least + 1
    with_ids = packing.pieces(df.where("doc_id = 302"), with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in with_ids) and len(with_ids) == 3


def test_crossover_keeps_all_pieces():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 1500, 500)
    parents = []
    for _ in range(2):
        bins = np.empty(500, np.int64)
        packing.best_fit(sizes, rng.permutation(500), bins, [], 2048)
        parents.append(bins)
    child = packing.crossover(sizes, parents[0], parents[1], 2048, rng)
    loads = np.bincount(child, weights=sizes)
    assert len(child) == 500 and loads.max() <= 2048 and loads.sum() == sizes.sum()
    best = packing.evolve(sizes, parents, 2048, 1)
    assert packing.fitness(sizes, best, 2048) >= max(packing.fitness(sizes, p, 2048) for p in parents)


# --- lines ------------------------------------------------------------------

def same(a, b):
    assert Counter(a) == Counter(b)


def test_line_dedup(spark):
    rng = random.Random(0)
    line = lambda n: " ".join(rng.choice("abcdefghijk") * rng.randrange(1, 5) for _ in range(n))
    passage, block = line(60), "\n".join(line(6) for _ in range(12))
    rows = [(i, "\n".join([line(5), line(7)] + ([passage] if i % 3 == 0 else []) + [block] * (i % 2) + [line(4), "", line(70)])) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1]), (102, None), (103, ""), (104, "\n\n\n"), (105, "\n\n\n"), (None, rows[1][1]),
             (1, rows[1][1]), (106, "one line"), (107, "one line"), (108, "x\n" * 3000)]
    df = spark.createDataFrame([(i, t, "a", "b", 5) for i, t in rows], "doc_id long, text string, first string, _gone string, n_lines int")
    got = line_dedup.dedup(df)
    same([(r["doc_id"], r["text"]) for r in got.collect()], plain_dedup(rows))
    assert got.columns == ["doc_id", "text", "first", "_gone", "n_lines", "removed_lines", "removed_chunks"]
    texts = {i: t for i, t in plain_dedup(rows)}
    assert sum(passage in (t or "") for i, t in texts.items() if i is not None) == 1
    assert sum(block.split("\n")[6] in (t or "") for i, t in texts.items() if i is not None) < 20
    assert line_dedup.dedup(df.where("false")).collect() == []
    dropped = line_dedup.dedup(df, counts=False, drop_emptied=True)
    assert dropped.columns == df.columns
    before = Counter(rows)
    same([(r["doc_id"], r["text"]) for r in dropped.collect()],
         [(i, t) for (i, t), (j, old) in zip(plain_dedup(rows), rows) if t == old or re.search(r"\S", t or "")])
    assert before[103, ""] and any(r["doc_id"] == 103 for r in dropped.collect())


def test_line_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in rows_of(spark, "documents")]
    same([(r["doc_id"], r["text"]) for r in QUERIES["op7_line_dedup"](spark, SF).collect()], plain_dedup(rows))


# --- WARC -------------------------------------------------------------------

def plain_warc(rows):
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        other = len(data) >= 100 and first.get(h or "") is not None and first[h or ""] != i
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if other else "response", first[h] if other else None))
    return out


def test_warc(spark):
    big, bigger = "<p>é</p>" * 40, "x" * 100
    rows = [(i, f"http://h{i % 7}.Example.com:80/p/{i % 11}?q={i}", big if i % 3 == 0 else f"page {i}") for i in range(1, 400)]
    rows += [(500, None, None), (501, "", ""), (502, "no scheme", bigger), (503, "http://x/\r\n a", bigger), (503, "http://x/", bigger),
             (None, "http://x/", bigger), (None, "http://y/", "lone" * 50), (504, "http://x/", "x" * 99), (505, "http://x/", "x" * 99),
             (502, "no scheme", bigger)]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, digest string")
    got = [tuple(r) for r in warc.round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    same(got, plain_warc(rows))
    assert warc.round_trip(df.where("false")).collect() == []


def test_warc_lookup_of_some(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    root, parts = warc.archive(pages)
    asked = pages.where("page_id % 7 = 1").select(warc.url_key(F.col("url")).alias("key"), "page_id")
    got = {r["page_id"]: bytes(r["payload"]) for r in warc.lookup(asked, root, parts, with_payload=True).collect()}
    assert got == {r["page_id"]: (r["html"] or "").encode() for r in pages.where("page_id % 7 = 1").collect()}
    none = spark.createDataFrame([("zz", 1), ("", None)], "key string, page_id long")
    assert warc.lookup(none, root, parts).collect() == []


def test_url_keys(spark):
    df = spark.createDataFrame([("HTTP://u@WWW.Example.com:80/A?b#c",), ("",), (None,), ("a.b/c",)], "u string")
    assert [r[0] for r in df.select(warc.url_key(F.col("u"))).collect()] == ["com,example,www)/A?b#c", "", "", "b,a)/c"]


# --- SQL oracles and the pipeline --------------------------------------------

@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracles(spark, key):
    import duckdb
    sql = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        sql.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = QUERIES[key](spark, SF)
    want = sql.execute(ORACLES[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    same([tuple(r) for r in got.select(*names).collect()], want.fetchall())


def test_pipeline(spark):
    docs = common.table(spark, SF, "documents")
    columns = docs.columns
    kept = docs.collect()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = common.stored(stage(spark, docs, SF), "test-pipeline")
        rows = out.collect()
        before = {r["doc_id"]: r["text"] for r in kept}
        if name != "best-fit packing":
            assert out.columns == columns and len(rows) <= len(kept)
        if name in ("quality rules", "language ID"):
            assert all(r["text"] == before[r["doc_id"]] for r in rows)
        if name == "line dedup":
            want = {i: t for i, t in plain_dedup(list(before.items()))}
            assert {r["doc_id"]: r["text"] for r in rows} == {i: t for i, t in want.items() if t == before[i] or re.search(r"\S", t or "")}
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "n-gram Jaccard join":
            want = plain_components(list(before.items()), 80, 5)
            assert sorted(r["doc_id"] for r in rows) == sorted(
                i for i, t in before.items() if (want[i, plain_set(t, 5)][1] if plain_set(t) else i) == i)
        if name == "best-fit packing":
            n, least = check_packing(rows, list(before.items()))
            assert n <= least + 1
        docs, kept = out, rows
    labels = {r["doc_id"]: r["quality"] for r in rows_of(spark, "labels")}
    good = quality_kept(spark)
    assert all(i in good or labels.get(i) != 1 or n < 50 for i, n in ((r["doc_id"], len((r["text"] or "").split())) for r in rows_of(spark, "documents")))


def quality_kept(spark):
    return {r["doc_id"] for r in corpus_pipeline.quality(spark, common.table(spark, SF, "documents"), SF).collect()}


def test_pipeline_empty_and_clashing(spark):
    empty = common.table(spark, SF, "documents").where("false").withColumn("label", F.lit("x")).withColumn("cls", F.lit(1))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.collect() == []
    odd = spark.createDataFrame([(1, None, None, "s", None, "c"), (None, "t", "en", None, 1, "c"), (1, None, None, "s", None, "c")],
                                "doc_id long, text string, lang string, source string, n_chars long, first string")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, odd, SF).collect()


def test_components(spark):
    from dealspark.llm.components import components
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(100, 160)] + [(500, 900 + i) for i in range(50)] + [(7, 7), (3, 2), (2, 3)] + \
            [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for x in parent if x != 7 and any(x in p and p[0] != p[1] for p in links)}
    df = spark.createDataFrame(links, "a long, b long")
    assert {r["node"]: r["label"] for r in components(df).collect()} == want
    assert components(df.where("false")).collect() == []
