"""Cutoffs: subtract in UTC first, then convert; text format; DST."""

import datetime as dt

from pyspark.sql import functions as F

from dealspark.functions import text as X
from dealspark.functions import timefns as T


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_dst_lookback_pacific(spark):
    now = F.to_timestamp_ntz(F.lit("2024-03-10 12:00:00"))
    got = _one(spark, T.cutoff(now, 1441, "US/Pacific"))
    assert got == dt.datetime(2024, 3, 9, 3, 59)
    assert _one(spark, T.cutoff_text(T.cutoff(now, 1441, "US/Pacific"))) == "2024-03-09T03:59:00"


def test_subtract_before_converting_matters_across_dst(spark):
    now = F.to_timestamp_ntz(F.lit("2024-03-10 12:00:00"))
    right = _one(spark, T.cutoff(now, 1441, "US/Pacific"))
    wrong = _one(spark, T.lookback(T.to_zone(now, "US/Pacific"), 1441))
    assert wrong == dt.datetime(2024, 3, 9, 4, 59) and wrong - right == dt.timedelta(hours=1)


def test_result_does_not_depend_on_session_zone(spark):
    now = F.to_timestamp_ntz(F.lit("2024-07-01 00:10:00"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        tokyo = _one(spark, T.cutoff(now, 16, "US/Central"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tokyo == _one(spark, T.cutoff(now, 16, "US/Central")) == dt.datetime(2024, 6, 30, 18, 54)


def test_text_helpers(spark):
    assert _one(spark, X.first_word(F.lit("MacBook Deals (today)"))) == "MacBook"
    assert _one(spark, X.after_token(F.lit("https://api.example.com/v1/products(x)"))) == "/products(x)"
    assert _one(spark, X.after_token(F.lit("no token here"))) == ""
    assert _one(spark, X.ceil_div(F.lit(401), F.lit(100))) == 5
    assert _one(spark, X.ceil_div(F.lit(400), F.lit(100))) == 4
    assert _one(spark, X.ceil_div(F.lit(9007199254740993), F.lit(2))) == 4503599627370497
    html = _one(spark, X.link_rewrite(F.lit("https://s/1/pdp")))
    assert html == '<a href="https://s/1/pdp" target="_blank">urlLink</a>'
