"""Inverted attribute and word tables, against the predicates over the catalogue."""

import os
import random

import pytest
from conftest import SF_SMALL, plan_text
from pyspark.sql import functions as F

from dealspark.operators import predicates as P
from dealspark.sources.attributes import WORDS, AttributeIndex, attribute_rows, store_attributes
from dealspark.sources.catalogue import catalogue

BUILD = {"any_eq": P.any_eq, "any_prefix": P.any_prefix, "none_eq": P.none_eq, "none_prefix": P.none_prefix, "search": P.search}


@pytest.fixture(scope="module")
def cat(spark):
    return catalogue(spark, SF_SMALL)


@pytest.fixture(scope="module")
def index(spark, cat, tmp_path_factory):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        return store_attributes(cat, str(tmp_path_factory.mktemp("attributes")))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def skus(df):
    return sorted(r["sku"] for r in df.select("sku").collect())


@pytest.mark.parametrize("conds", [
    [("any_eq", "details.value", "nvidia")], [("any_prefix", "categoryPath.name", "laptop")],
    [("none_eq", "details.value", "intel")], [("none_prefix", "details.value", "1650")], [("search", "airpods")],
    [("any_eq", "details.value", "no such value")], [("none_eq", "details.value", "zzz")], [("search", "")],
    [("any_prefix", "details.value", "")], [("any_eq", "categoryPath.id", "abcat0204000"), ("search", "apple")],
    [("any_prefix", "categoryPath.name", "laptop"), ("any_eq", "details.value", "NVIDIA"), ("none_prefix", "details.value", "1650"),
     ("none_prefix", "details.value", "1660")]])
def test_conditions(cat, index, conds):
    want = cat
    for op, *args in conds:
        want = want.where(BUILD[op](*args))
    if conds == [("search", "")]:  # the empty text is no word
        want = cat.where("false")
    assert skus(index.matching(cat, conds)) == skus(want)


def test_only_files_of_the_value_are_opened(index):
    everything = {r["file"] for r in index.directory().collect()}
    assert len(everything) >= 6
    for field, value in (("categoryPath.id", "abcat0204000"), (WORDS, "airpods"), ("details.value", "4070")):
        files = index.files(field, value)
        assert 0 < len(files) < len(everything) / 2, (field, value)
        df = index.equal(field, value)
        assert {os.path.basename(f) for f in df.inputFiles()} == {os.path.basename(f) for f in files}
        assert f"EqualTo(value,{value})" in plan_text(df)
    assert index.files("details.value", "~~") == []


def test_a_hot_value_is_split_by_product(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, f"n{i}", [("hot",)] if i % 3 else [("hot",), (f"v{rng.randrange(500)}",)]) for i in range(6000)]
    df = spark.createDataFrame(rows, "sku long, name string, tags array<struct<v:string>>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        index = store_attributes(df, str(tmp_path), ["tags.v"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = [r["n"] for r in index.directory().where("field = 'tags.v' and low = 'hot'").collect()]
    assert len(parts) >= 3 and max(parts) < 4000
    assert skus(index.equal("tags.v", "HOT")) == list(range(6000))


def test_nulls_and_empty(spark, tmp_path):
    rows = [(1, None, None), (2, "", []), (3, "Wi-Fi  wi", [(None,), ("A",), ("a",)]), (4, "x", [("\U0010FFFFz",)])]
    df = spark.createDataFrame(rows, "sku long, name string, tags array<struct<v:string>>")
    got = {tuple(r) for r in attribute_rows(df, ["tags.v"]).collect()}
    assert got == {("tags.v", "a", 3), (WORDS, "wi", 3), (WORDS, "fi", 3), (WORDS, "x", 4), ("tags.v", "\U0010FFFFz", 4)}
    index = store_attributes(df, str(tmp_path / "a"), ["tags.v"])
    assert skus(index.matching(df, [("none_eq", "tags.v", "a")])) == [1, 2, 4]
    assert skus(index.starting("tags.v", "\U0010FFFF")) == [4] and skus(index.starting("tags.v", "")) == [3, 4]
    with pytest.raises(ValueError):
        index.skus(("eq", "name", "x"))
    empty = store_attributes(df.where("false"), str(tmp_path / "b"), ["tags.v"])
    assert skus(empty.matching(df, [("any_eq", "tags.v", "a")])) == []
    assert skus(AttributeIndex(spark, str(tmp_path / "a")).equal(WORDS, "fi")) == [3]
