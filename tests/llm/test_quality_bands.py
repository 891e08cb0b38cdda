"""Bands learned from labelled rows: the low labels they reject and the good ones they keep."""

from pyspark.sql import functions as F

from dealspark.llm import quality_rules
from dealspark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def shares(rows, labels, texts):
    """Shares of rejected low and kept good labels, and of rejected lists, among rows that pass the base rule."""
    rows = [r for r in rows if not r["base_failed"]]
    of = lambda q: [r["kept"] for r in rows if labels.get(r["doc_id"]) == q]
    lists = [r["kept"] for r in rows if 4 * texts[r["doc_id"]].count(" | ") > len(texts[r["doc_id"]].split())]
    print(len(of(0)), len(of(1)), len(lists), 1 - sum(of(0)) / len(of(0)), sum(of(1)) / len(of(1)), 1 - sum(lists) / len(lists))
    return 1 - sum(of(0)) / len(of(0)), sum(of(1)) / len(of(1)), 1 - sum(lists) / len(lists)


def test_learned_bands(spark):
    docs, given = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    labels = {r["doc_id"]: r["quality"] for r in given.collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    low, good, lists = shares(QUERIES["op10_quality_rules"](spark, SF).collect(), labels, texts)
    assert low > 0.85 and good > 0.97 and lists > 0.8
    # Labels of one half of the rows, verdicts on the other; a third of the rows without a language.
    half = docs.withColumn("lang", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    rows = quality_rules.measure(half, labels=given.where("doc_id % 2 = 0")).collect()
    assert {r["band"] for r in rows if r["doc_id"] % 3 == 0 and not r["base_failed"]} >= {"en", "de", "es", "fr"}
    low, good, lists = shares([r for r in rows if r["doc_id"] % 2], labels, texts)
    assert low > 0.8 and good > 0.96 and lists > 0.75


def test_without_a_row_to_learn_from_all_measures_pass(spark):
    df = spark.createDataFrame([(1, "word " * 3, None), (2, None, "en")], "doc_id long, text string, lang string")
    assert quality_rules.learn(df)[0] == {} and len(quality_rules.measure(df).collect()) == 2


def test_few_rows_take_the_band_of_their_script_or_of_all(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    text = docs.where("lang = 'en' and length(text) > 800").select("text").first()["text"]
    rare = spark.createDataFrame([(-1, text, "xx"), (-2, "слово дело время рука день жизнь глаз " * 12 + text[:60], "yy")],
                                 "doc_id long, text string, lang string")
    df = docs.select("doc_id", "text", "lang").union(rare)
    bands = quality_rules.learn(df)[0]
    assert {"all", "latin", "en"} <= set(bands) and not {"xx", "yy"} & set(bands)
    got = {r["doc_id"]: r for r in quality_rules.measure(df).where("doc_id < 0").collect()}
    assert got[-1]["band"] == "latin" and got[-1]["kept"]
    assert got[-2]["band"] == "all"
    # A corpus smaller than a band's least size learns the one band of all its rows.
    few = docs.limit(30).select("doc_id", "text", "lang")
    assert set(quality_rules.learn(few)[0]) == {"all"}
