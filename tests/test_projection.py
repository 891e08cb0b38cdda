"""Attribute lookup, offer maps and the defaulting rule."""

from conftest import plan_text
from dealspark.operators.projection import (DEFAULT_COLUMNS, DEFAULT_DETAILS, ProjectionSpec,
                                            attribute_alias, detail_value, offer_map)

DETAILS = "details array<struct<name:string,value:string>>"


def test_first_match_wins_any_case(spark):
    df = spark.createDataFrame([([("Color", "Purple"), ("COLOR", "x")],)], DETAILS)
    assert df.select(detail_value("color").alias("c")).first().c == "Purple"


def test_no_match_empty_and_null_value(spark):
    df = spark.createDataFrame([([],), ([("Size", "4")],), ([("Color", None), ("color", "late")],)], DETAILS)
    got = [r.c for r in df.select(detail_value("Color").alias("c")).collect()]
    assert got == [None, None, None]


def test_offer_map_keeps_nulls_and_empty(spark):
    df = spark.createDataFrame([([("2024-01-01", None)],), ([],)],
                               "offers array<struct<startDate:string,endDate:string>>")
    rows = df.select(offer_map("endDate").alias("m"), offer_map("startDate").alias("s")).collect()
    assert rows[0].m == {0: None} and rows[0].s == {0: "2024-01-01"}
    assert rows[1].m == {} and rows[1].s == {}


def test_falsy_spec_means_defaults():
    s = ProjectionSpec([], None, []).resolved()
    assert list(s.columns) == list(DEFAULT_COLUMNS) and list(s.details) == list(DEFAULT_DETAILS)
    assert list(s.offers) == ["startDate", "endDate"]


def test_name_clash_gets_detail_prefix():
    assert attribute_alias("Color", ["color", "name"]) == "detail.Color"
    assert attribute_alias("Color", ["name"]) == "Color"
    names = ProjectionSpec(["salePrice", "color"], [], None).output_names(with_offers=True)
    assert "detail.Color" in names and names[-2:] == ["offer.startDate", "offer.endDate"]


def test_projection_adds_no_exchange(spark):
    from dealspark.operators.projection import flatten
    df = spark.createDataFrame([(1, "a", 1.0, "u", "c", [("Color", "x")], [("s", "e")])],
                               "sku long, name string, salePrice double, url string, addToCartUrl string, "
                               f"{DETAILS}, offers array<struct<startDate:string,endDate:string>>")
    out = flatten(df, ProjectionSpec())
    assert "Exchange" not in plan_text(out)
    assert out.first()["offer.startDate"] == {0: "s"}
