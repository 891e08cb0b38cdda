"""Large packs by the predicate index, against the searches one by one."""

import random
from collections import Counter

import pytest
from conftest import SF_SMALL, plan_text
from pyspark.sql import functions as F

from dealspark.operators import predicates as P
from dealspark.operators.compose import tag_pack
from dealspark.operators.pack_index import PackIndex, tag_pack_indexed
from dealspark.plans import packs as K
from dealspark.plans.packs import SavedQuery, conditions_to_predicate
from dealspark.sources.catalogue import catalogue, catalogue_latest, store_catalogue


def generated(n, seed=5):
    """Searches of two to six random conditions over every kind of field."""
    rng = random.Random(seed)
    brands = [f"Brand#{k}" for k in range(10, 60)] + ["apple", "sony interactive"]
    words = ["airpods", "macbook", "pro", "hot", "red", "metallic", "blue"]
    kinds = [
        lambda: ("eq", "manufacturer", rng.choice(brands)), lambda: ("ne", "manufacturer", rng.choice(brands)),
        lambda: ("eq", rng.choice(["onSale", "active", "preowned"]), rng.random() < 0.7),
        lambda: ("eq", "subclassId", rng.choice([410, 7835, rng.randrange(50)])),
        lambda: ("ne", "protectionPlanTerm", "gsr"), lambda: ("ne", "salePrice", K.EXCLUDED_PRICE),
        lambda: ("eq", "salePrice", rng.randrange(500) * 4 + 0.99),
        lambda: ("lt", "salePrice", rng.randrange(2000)), lambda: ("gt", "percentSavings", rng.randrange(100)),
        lambda: ("gt", "screenSizeClassIn", rng.randrange(90)), lambda: K.DAILY_CUTOFF, lambda: K.FREQUENT_CUTOFF,
        lambda: ("prefix", "name", rng.choice(["macbook pro", "apple", "r", "b", "%"])),
        lambda: ("in", "productTemplate", rng.sample([*K.TV_TEMPLATES, "Laptops", "Desktops"], 2)),
        lambda: ("any_eq", "details.value", rng.choice(["nvidia", "AMD", "Full HD", "4k"])),
        lambda: ("any_prefix", "categoryPath.name", rng.choice(["laptop", "macb", "desk", "s"])),
        lambda: ("none_eq", "details.value", rng.choice(["intel", "amd"])),
        lambda: ("none_prefix", "details.value", rng.choice(["1650", "16", "noise"])),
        lambda: ("search", rng.choice(words)),
        lambda: ("any_of", [("prefix", "color", rng.choice(K.PURPLE_SHADES)), ("eq", "color", "red"), ("search", "hot")]),
    ]
    return [SavedQuery(f"s{i}", f"s{i}", conditions_to_predicate([rng.choice(kinds)() for _ in range(rng.randrange(2, 7))]))
            for i in range(n)]


def pairs(df):
    return Counter(map(tuple, df.select("query_name", "sku").collect()))


@pytest.fixture(scope="module")
def cat(spark):
    return catalogue(spark, SF_SMALL)


def test_saved_searches(spark, cat, tmp_path):
    queries = [q for q in K.SAVED_QUERIES.values()]
    now = catalogue_latest(spark, SF_SMALL)
    want = pairs(tag_pack(cat, queries, now))
    index = PackIndex(queries)
    assert pairs(tag_pack_indexed(cat, index, now)) == want
    assert pairs(tag_pack_indexed(cat, index.measured(cat), now)) == want
    stored = store_catalogue(cat, str(tmp_path / "cat"))
    assert pairs(tag_pack_indexed(stored, index, now)) == want


def test_random_searches_equal_one_by_one(spark, cat):
    queries = generated(200)
    now = catalogue_latest(spark, SF_SMALL)
    want = Counter()
    for k in range(0, len(queries), 50):
        want += pairs(tag_pack(cat, queries[k:k + 50], now))
    assert pairs(tag_pack_indexed(cat, PackIndex(queries), now)) == want and len(want) > 500
    assert pairs(tag_pack_indexed(cat, PackIndex(queries).measured(cat), now)) == want


def test_plan_does_not_grow_with_the_pack(spark, cat):
    now = catalogue_latest(spark, SF_SMALL)
    big = generated(2000)
    small, large = (tag_pack_indexed(cat, PackIndex(q), now) for q in (big[:200], big))
    nodes = lambda df: plan_text(df).count("\n(")
    assert nodes(small) == nodes(large)
    text = plan_text(large)
    assert text.count("Location: ") == 2  # the catalogue, and the newest update
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Exchange hashpartitioning" not in text
    found = large.groupBy("query_name").count().collect()
    rng = random.Random(1)
    counts = {r["query_name"]: r["count"] for r in found}
    chosen = rng.sample(big, 40)
    one = pairs(tag_pack(cat, chosen, now))
    by_query = Counter()
    for (q, _), n in one.items():
        by_query[q] += n
    assert {q.name: counts.get(q.name, 0) for q in chosen} == {q.name: by_query[q.name] for q in chosen}


def test_missing_values_and_lists(spark):
    rows = [(1, None, None, None, None), (2, "A", [("x",), (None,)], 5.0, None), (3, "ab", [], 6.0, True), (4, "AB", None, None, False)]
    df = spark.createDataFrame(rows, "sku long, name string, tags array<struct<v:string>>, price double, ok boolean")
    tests = {"eq": [("eq", "name", "ab")], "ne": [("ne", "name", "ab")], "none": [("none_eq", "tags.v", "x")],
             "nonep": [("none_prefix", "tags.v", "x")], "any": [("any_eq", "tags.v", "X")], "lt": [("lt", "price", 6)],
             "nen": [("ne", "price", 5.0)], "pre": [("prefix", "name", "a")], "ok": [("eq", "ok", False)], "nok": [("ne", "ok", True)],
             "gap": [("gt", "price", 5), ("lt", "price", 7)], "both": [("eq", "ok", True), ("ne", "name", "a")]}
    queries = [SavedQuery(n, n, conditions_to_predicate(c)) for n, c in tests.items()]
    now = F.lit(None).cast("timestamp_ntz")
    want = Counter()
    for q in queries:
        want += Counter((q.name, r["sku"]) for r in df.where(q.where(now)).collect())
    got = pairs(tag_pack_indexed(df, PackIndex(queries), now))
    assert got == want and ("none", 1) in got
    with pytest.raises(ValueError):
        PackIndex([SavedQuery("p", "p", lambda now: P.lt("price", 5))])
    with pytest.raises(ValueError):
        PackIndex([SavedQuery("p", "p", conditions_to_predicate([("any_of", [("lt", "price", 5)])]))])
