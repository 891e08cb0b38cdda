"""The pack document at scale: only matches are put in order, products are dealt to tasks, hot offers are split."""

from pyspark.sql import functions as F

from dealspark.operators.projection import ProjectionSpec
from dealspark.operators.ranking import running_sum, split_rank, stepped_rank
from dealspark.plans import packs as K
from dealspark.plans import report as R
from dealspark.plans.packs import SavedQuery
from dealspark.sources.catalogue import catalogue, catalogue_latest, offer_rows, products

from conftest import SF_SMALL, plan_text


def test_the_lines_of_a_document_are_not_sorted(spark):
    lines = R.document_lines(catalogue(spark, SF_SMALL, spread=True), K.pack(K.HTTP_PACK), offer_rows(spark, SF_SMALL),
                             catalogue_latest(spark, SF_SMALL))
    assert "rangepartitioning" not in plan_text(lines)
    n = lines.count()
    assert sorted(r.doc_line for r in lines.select("doc_line").collect()) == list(range(n))


def test_products_are_dealt_to_tasks(spark):
    assert "hashpartitioning(p_partkey" in plan_text(catalogue(spark, SF_SMALL, spread=True))
    assert catalogue(spark, SF_SMALL, spread=True).exceptAll(catalogue(spark, SF_SMALL)).count() == 0


def test_repeated_and_null_products_take_turns(spark):
    cat = products(spark, SF_SMALL).where("sku in (1, 2, 4)")
    twice = cat.union(cat.where("sku = 2")).union(cat.where("sku = 1").withColumn("sku", F.lit(None).cast("long")))
    offers = spark.createDataFrame([(2, i, f"s{i}", f"e{i}") for i in range(3)] + [(1, 0, "s", None), (9, 0, "x", "x")],
                                   "sku long, offer_pos int, startDate string, endDate string")
    q = SavedQuery("all", "All", lambda now: F.lit(True), ProjectionSpec(["sku"], ["Type"]))
    none = SavedQuery("none", "None", lambda now: F.lit(False), ProjectionSpec(["sku"], ["Type"]))
    got = [r.text for r in R.document_lines(twice, [none, q], offers).orderBy("doc_line").collect()]
    assert got[0] == "none (0, 0):</br>" and got[2] == "</br>"
    assert got[3] == "all (5, 4):</br>" and got[-1] == "</br>"
    shown = [line.split("</th>")[1].split("<td>")[1:] for line in got[5:-1]]
    shown = [(c[0][:-5], c[2][:-5]) for c in shown]
    turns = [("2", "0: s0"), ("2", "0: s0"), ("", "1: s1"), ("", "1: s1"), ("", "2: s2"), ("", "2: s2")]
    first = {None: [("None", "{}")], 1: [("1", "0: s")], 4: [("4", "{}")], 2: turns}
    rows = sorted(twice.select("sku", "salePrice", "name", "page", "pos").distinct().collect(),
                  key=lambda r: (r["salePrice"] is None, r["salePrice"], r["name"], r["page"], r["pos"], r["sku"] or -1))
    assert shown == [line for r in rows for line in first[r["sku"]]]


def test_split_rank_is_stepped_rank(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 != 1, F.col("id") % 40).alias("k"),
                                  F.when(F.col("id") % 11 != 0, F.col("id") * 37 % 30).alias("day"), "id")
    want = stepped_rank(df, ["k"], "day", ["id"], out="r")
    for hot in (0, 70, 10_000):
        got = split_rank(df, "k", "day", ["id"], "r", hot)
        assert got.exceptAll(want).count() == 0 and got.count() == 3000


def test_running_sum(spark):
    df = spark.range(25_000).select((F.col("id") * 7919 % 25_000).alias("v"))
    rows = sorted(tuple(r) for r in running_sum(df, ["v"], "v", "s").collect())
    assert rows == [(v, v * (v - 1) // 2) for v in range(25_000)]
