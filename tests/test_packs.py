"""Pack composition properties: one-scan tagging equals separate runs; slices
concatenate to the sorted whole; top-k is the head of the sorted whole."""

import re

from pyspark.sql import functions as F

from dealspark.operators.compose import (latest_update, page_slice, rank_by_order, run_search, tag_pack,
                                         top_k, pack_wide)
from dealspark.plans import packs as K
from dealspark.sources.catalogue import products

from conftest import SF_SMALL, plan_text


def test_tagged_counts_equal_separate_counts(spark):
    cat = products(spark, SF_SMALL)
    now = latest_update(cat)
    qs = K.pack(K.HTTP_PACK)
    tagged = {r.query_name: r.n for r in
              tag_pack(cat, qs, now).groupBy("query_name").agg(F.count(F.lit(1)).alias("n")).collect()}
    for q in qs:
        assert tagged.get(q.name, 0) == cat.where(q.where(now)).count(), q.name


def test_pack_is_one_scan(spark):
    cat = products(spark, SF_SMALL)
    plan = plan_text(tag_pack(cat, K.pack(K.HTTP_PACK)))
    # one scan for the rows, one for the "now" scalar subquery
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, re.M)) == 2


def test_pack_wide_ranks_match_single_runs(spark):
    cat = products(spark, SF_SMALL)
    qs = K.pack(K.HTTP_PACK)
    wide = pack_wide(cat, qs)
    for q in qs:
        single = {(r.name, r.rank) for r in run_search(cat, q).select("name", "rank").collect()}
        mine = {(r.name, r.rank) for r in wide.where(F.col("query_name") == q.name).select("name", "rank").collect()}
        assert single == mine, q.name


def test_page_slices_concatenate_to_sorted_whole(spark):
    cat = products(spark, SF_SMALL).select("sku", "salePrice", "name", "page", "pos")
    whole = [r.sku for r in rank_by_order(cat).orderBy("rank").collect()]
    size = 17
    pages = []
    for p in range(1, len(whole) // size + 2):
        pages += [r.sku for r in page_slice(cat, p, size).orderBy("rank").collect()]
    assert pages == whole


def test_top_k_is_head(spark):
    cat = products(spark, SF_SMALL).select("sku", "salePrice", "name", "page", "pos")
    whole = [r.sku for r in rank_by_order(cat).orderBy("rank").collect()]
    assert [r.sku for r in top_k(cat, 10).orderBy("rank").collect()] == whole[:10]
    assert "TakeOrderedAndProject" in plan_text(cat.orderBy("salePrice", "sku").limit(10))


def test_flat_conjuncts_reach_the_scan(spark, tmp_path):
    # stored as a typed table, the flat parts of a search are pushed to parquet
    cat = products(spark, SF_SMALL)
    path = str(tmp_path / "catalogue")
    cat.write.parquet(path)
    stored = spark.read.parquet(path)
    q = K.SAVED_QUERIES["television"]
    plan = plan_text(stored.where(q.where(latest_update(stored))).select("sku"))
    assert "PushedFilters" in plan and "LessThan(salePrice,1000.0)" in plan
    assert "GreaterThan(screenSizeClassIn,84.0)" in plan


def test_shared_conditions_reach_the_scan(spark, tmp_path):
    from dealspark.plans import report as R
    from dealspark.sources.catalogue import store_catalogue
    stored = store_catalogue(products(spark, SF_SMALL), str(tmp_path / "stored"))
    qs = K.pack(K.HTTP_PACK)
    for df in (pack_wide(stored, qs), R.shape(stored, qs), tag_pack(stored, qs)):
        plan = plan_text(df)
        assert "EqualTo(onSale,true)" in plan and "EqualTo(active,true)" in plan
    plan = plan_text(run_search(stored, K.SAVED_QUERIES["airpods"]))
    assert "EqualTo(folded_manufacturer,apple)" in plan and "EqualTo(folded_orderable,available)" in plan
    assert "StringStartsWith(folded_manufacturer,sony)" in plan_text(run_search(stored, K.SAVED_QUERIES["ps5 controller"]))
    cat = products(spark, SF_SMALL)
    for q in K.SAVED_QUERIES.values():
        assert run_search(stored, q).columns == run_search(cat, q).columns
    for name in ("airpods", "ps5 controller", "purple", "macbook"):
        same = [sorted(map(tuple, run_search(c, K.SAVED_QUERIES[name]).collect()), key=str) for c in (stored, cat)]
        assert same[0] == same[1]


def test_building_a_search_runs_no_job(spark):
    cat = products(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("search-building", "")
    try:
        for q in K.SAVED_QUERIES.values():
            run_search(cat, q)
        pack_wide(cat, K.pack(K.HTTP_PACK))
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("search-building"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_offers_complete_the_stated_width(spark):
    from dealspark.operators.compose import add_offers
    from dealspark.plans import report as R
    from dealspark.sources.catalogue import offer_rows
    cat, offers = products(spark, SF_SMALL), offer_rows(spark, SF_SMALL)
    widths = {r.query_name: r.n_cols for r in R.shape(cat, K.pack(K.HTTP_PACK)).collect() if r.n_rows}
    for q in K.pack(K.HTTP_PACK)[:3]:
        rows = add_offers(pack_wide(cat, [q], with_sku=True), offers, fields=q.spec.offers)
        lines = R.render_rows(rows, q).collect()
        assert {r.row_html.count("<td>") for r in lines if r["rank"] >= 0} == {widths[q.name]}
        assert [r.row_html.count("<th>") for r in lines if r["rank"] < 0] == [widths[q.name] + 1]


def test_a_product_without_offers_stays(spark):
    from dealspark.operators.compose import add_offers
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "__sku long, name string")
    offers = spark.createDataFrame([(1, 0, "s", None), (1, 1, "t", "e")], "sku long, offer_pos int, startDate string, endDate string")
    got = sorted((r["name"], r["offer_pos"], r["offer.startDate"], r["offer.endDate"]) for r in add_offers(rows, offers).collect()[:2])
    assert got == [("a", 0, "s", None), ("a", 1, "t", "e")]
    assert add_offers(rows, offers).where("offer_pos is null").collect()[0]["name"] == "b"


def test_attribute_named_like_a_sort_key(spark):
    # a user spec may ask for an attribute called "Name" without the name column
    from dealspark.operators.projection import ProjectionSpec
    from dealspark.plans.packs import SavedQuery
    cat = products(spark, SF_SMALL)
    q = SavedQuery("custom", "Custom deals", lambda now: F.col("onSale"), ProjectionSpec(["sku"], ["Name", "Type"]))
    res = run_search(cat, q)
    assert res.columns == ["sku", "Name", "Type", "rank"]
    assert res.count() == cat.where("onSale").count()
