"""Predicate semantics: case, nulls, list fields, exact complements."""

from pyspark.sql import functions as F

from dealspark.operators import predicates as P
from dealspark.sources.catalogue import products

from conftest import SF_SMALL

SCHEMA = "sku int, name string, price double, details array<struct<name:string,value:string>>"
ROWS = [
    (1, "Apple AirPods Pro", 10.0, [("GPU", "NVIDIA RTX"), ("Processor", "Intel Core")]),
    (2, "airpods-case", None, [("GPU", None)]),
    (3, "Sony headset", 99.5, []),
    (4, None, 60696.99, None),
]


def _skus(spark, pred):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return sorted(r.sku for r in df.where(pred).collect())


def test_case_insensitive_equality_and_prefix(spark):
    assert _skus(spark, P.eq("name", "apple airpods pro")) == [1]
    assert _skus(spark, P.prefix("name", "SONY")) == [3]
    assert _skus(spark, P.isin("name", ["SONY HEADSET", "x"])) == [3]


def test_negation_keeps_missing_values(spark):
    assert _skus(spark, P.ne("name", "sony headset")) == [1, 2, 4]
    assert _skus(spark, P.ne("price", 60696.99)) == [1, 2, 3]


def test_list_any_and_none(spark):
    assert _skus(spark, P.any_eq("details.value", "nvidia rtx")) == [1]
    assert _skus(spark, P.any_prefix("details.value", "intel")) == [1]
    # a null element, an empty list and a null list all mean "no element matches"
    assert _skus(spark, P.none_prefix("details.value", "intel")) == [2, 3, 4]
    assert _skus(spark, P.none_eq("details.value", "intel")) == [1, 2, 3, 4]


def test_search_is_whole_word(spark):
    assert _skus(spark, P.search("airpods")) == [1, 2]
    assert _skus(spark, P.search("airpod")) == []


def test_anti_prefix_local_is_case_sensitive(spark):
    df = spark.createDataFrame([(1, "Intel i7"), (2, "intel"), (3, None)], "sku int, m string")
    assert sorted(r.sku for r in df.where(P.anti_prefix_local("m", "Intel")).collect()) == [2, 3]


def test_positive_and_negative_partition_the_catalogue(spark):
    cat = products(spark, SF_SMALL)
    total = cat.count()
    cases = [
        P.eq("protectionPlanTerm", "gsr"), P.eq("manufacturer", "apple"), P.lt("salePrice", 1000),
        P.any_eq("details.value", "nvidia"), P.any_prefix("categoryPath.name", "laptop"),
        P.prefix("color", "purple"), P.search("airpods"),
    ]
    for pred in cases:
        pos = cat.where(pred).count()
        neg = cat.where(P.negate(pred)).count()
        assert pos + neg == total
        both = cat.where(F.coalesce(pred, F.lit(False)) & P.negate(pred)).count()
        assert both == 0
