"""Predicate builders against a plain-Python model on random records."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from dealspark.operators import predicates as P

WORDS = ["Apple", "apple", "APPLE pie", "Sony", "sony-x", "Intel Core", "intel", None]
SCHEMA = "sku int, name string, price double, details array<struct<name:string,value:string>>"

word = st.sampled_from(WORDS)
detail = st.tuples(st.sampled_from(["Color", "GPU", None]), word)
row = st.tuples(word, st.one_of(st.none(), st.floats(0, 2000, allow_nan=False)),
                st.one_of(st.none(), st.lists(detail, max_size=3)))


def _low(x):
    return None if x is None else x.lower()


MODEL = {
    "eq": (lambda: P.eq("name", "apple"), lambda n, p, d: _low(n) == "apple"),
    "ne": (lambda: P.ne("name", "apple"), lambda n, p, d: _low(n) != "apple"),
    "prefix": (lambda: P.prefix("name", "Apple"), lambda n, p, d: n is not None and n.lower().startswith("apple")),
    "isin": (lambda: P.isin("name", ["SONY", "intel"]), lambda n, p, d: _low(n) in ("sony", "intel")),
    "lt": (lambda: P.lt("price", 1000), lambda n, p, d: p is not None and p < 1000),
    "ne_num": (lambda: P.ne("price", 1000.0), lambda n, p, d: p != 1000.0),
    "any_eq": (lambda: P.any_eq("details.value", "intel"),
               lambda n, p, d: any(_low(v) == "intel" for _, v in (d or []))),
    "any_prefix": (lambda: P.any_prefix("details.value", "intel"),
                   lambda n, p, d: any(v is not None and v.lower().startswith("intel") for _, v in (d or []))),
    "none_eq": (lambda: P.none_eq("details.value", "intel"),
                lambda n, p, d: not any(_low(v) == "intel" for _, v in (d or []))),
    "none_prefix": (lambda: P.none_prefix("details.value", "intel"),
                    lambda n, p, d: not any(v is not None and v.lower().startswith("intel") for _, v in (d or []))),
    "search": (lambda: P.search("apple"),
               lambda n, p, d: n is not None and "apple" in [w for w in re.split(r"[^a-z0-9_]+", n.lower())]),
    "or_group": (lambda: P.any_of(P.prefix("name", "sony"), P.eq("name", "intel")),
                 lambda n, p, d: n is not None and (n.lower().startswith("sony") or n.lower() == "intel")),
}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=12))
def test_builders_match_model(spark, rows):
    data = [(i, n, p, d) for i, (n, p, d) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA).cache()
    for label, (build, model) in MODEL.items():
        got = sorted(r.sku for r in df.where(build()).collect())
        exp = sorted(i for i, n, p, d in data if model(n, p, d))
        assert got == exp, label
    df.unpersist()
