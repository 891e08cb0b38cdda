"""Landed page envelopes: missing vs null keys, page-level reject, plan, audit."""

import json

from pyspark.sql import functions as F

from dealspark.operators.projection import ProjectionSpec
from dealspark.sources import pages as G


def product(sku, **over):
    p = {"sku": sku, "name": f"item {sku}", "salePrice": 10.0 + sku, "url": f"https://s/{sku}/pdp",
         "addToCartUrl": f"https://s/{sku}/cart",
         "details": [{"name": "Color", "value": "Purple"}, {"name": "COLOR", "value": "x"}],
         "offers": [{"startDate": "2024-01-01", "endDate": None}]}
    p.update(over)
    return {k: v for k, v in p.items() if v is not ...}


def env(page, prods, total_pages=3, total=None):
    e = {"totalPages": total_pages, "total": total if total is not None else 3 * len(prods), "currentPage": page}
    if prods is not None:
        e["products"] = prods
    return json.dumps(e)


def test_missing_key_drops_whole_page_null_key_keeps_row(spark, tmp_json):
    path = tmp_json(env(1, [product(1), product(2, name=None)]),
                    env(2, [product(3), product(4, addToCartUrl=...)]),
                    env(3, [product(5)]))
    flat = G.flatten_pages(G.read_envelopes(spark, path), ProjectionSpec())
    rows = {r.sku: r for r in flat.collect()}
    assert sorted(rows) == [1, 2, 5]
    assert rows[2].name is None
    assert rows[1].Color == "Purple"
    assert rows[1]["offer.endDate"] == {0: None} and rows[1]["offer.startDate"] == {0: "2024-01-01"}


def test_reject_depends_on_requested_columns(spark, tmp_json):
    path = tmp_json(env(1, [product(1, addToCartUrl=...)]))
    e = G.read_envelopes(spark, path)
    assert G.flatten_pages(e, ProjectionSpec()).count() == 0
    assert G.flatten_pages(e, ProjectionSpec(["sku", "name"])).count() == 1


def test_detail_without_name_or_value(spark, tmp_json):
    no_name = product(1, details=[{"value": "v"}])
    no_value_hit = product(2, details=[{"name": "Color"}])
    no_value_miss = product(3, details=[{"name": "Size"}, {"name": "Other", "value": "y"}])
    path = tmp_json(env(1, [no_name]), env(2, [no_value_hit]), env(3, [no_value_miss]))
    flat = G.flatten_pages(G.read_envelopes(spark, path), ProjectionSpec(None, ["Color"]))
    # a nameless detail fails the lookup; a value-less detail fails only when it matches
    assert sorted(r.sku for r in flat.collect()) == [3]


def test_envelope_without_products_is_ignored(spark, tmp_json):
    path = tmp_json(env(1, [product(1)]), json.dumps({"totalPages": 2}), json.dumps({"products": None}))
    e = G.read_envelopes(spark, path)
    assert G.usable(e).count() == 2          # the JSON-null products key passes the guard ...
    assert G.flatten_pages(e, ProjectionSpec()).count() == 1   # ... and is rejected later


def test_page_plan_and_zero_pages(spark):
    df = spark.createDataFrame([("a", 6), ("z", 0)], "q string, totalPages int")
    plan = G.page_plan(df).collect()
    assert [(r.q, r.page, r.batch) for r in plan] == [("a", 1, 0), ("a", 2, 0), ("a", 3, 0), ("a", 4, 0),
                                                      ("a", 5, 1), ("a", 6, 1)]


def test_audit_reports_lost_and_rejected(spark, tmp_json):
    path = tmp_json(env(1, [product(1)], total_pages=4), env(3, [product(3, url=...)], total_pages=4),
                    env(4, [product(4)], total_pages=4))
    audit = sorted((r.page, r.status) for r in G.page_audit(G.read_envelopes(spark, path), ProjectionSpec()).collect())
    assert audit == [(2, "lost"), (3, "rejected")]


def test_totals_default_to_zero(spark, tmp_json):
    path = tmp_json(json.dumps({"currentPage": 1, "products": []}))
    t = G.totals(G.read_envelopes(spark, path)).select("totalPages", "total").first()
    assert (t.totalPages, t.total) == (0, 0)


def test_landing_roundtrip_matches_fixture(spark):
    from conftest import SF_SMALL
    from dealspark.sources.catalogue import products
    path = G.land_envelopes(spark, SF_SMALL)
    e = G.read_envelopes(spark, path)
    cat = products(spark, SF_SMALL)
    assert e.count() == cat.select("page").distinct().count()
    rej = sorted(r.page for r in G.rejected_pages(e, ProjectionSpec()).collect())
    exp = sorted({r.page for r in cat.where(F.col("sku") % 997 == 0).collect()})
    assert rej == exp


def test_zero_pages_give_no_rows_and_shape_zero(spark, tmp_json):
    path = tmp_json(json.dumps({"totalPages": 0, "total": 0, "currentPage": 1, "products": []}))
    e = G.read_envelopes(spark, path)
    assert G.flatten_pages(e, ProjectionSpec()).count() == 0
    assert G.page_plan(G.totals(e)).count() == 0
    assert G.page_audit(e, ProjectionSpec()).count() == 0


def test_empty_search_reports_shape_zero(spark):
    from conftest import SF_SMALL
    from dealspark.plans import packs as K
    from dealspark.plans import report as R
    from dealspark.sources.catalogue import catalogue
    shapes = {r.query_name: (r.n_rows, r.n_cols) for r in
              R.shape(catalogue(spark, SF_SMALL), K.pack(K.SCRIPT_PACK)).collect()}
    assert shapes["nvidia cheap"] == (0, 0)          # empty at sf0.001
    assert shapes["macbook cheap"][1] == 5 + 4 + 2   # columns + attributes + offer maps


def test_non_object_product_rejects_its_page(spark, tmp_json):
    path = tmp_json(env(1, [product(1), 5]), env(2, [product(2), ["x"]]), env(3, [product(3)]))
    flat = G.flatten_pages(G.read_envelopes(spark, path), ProjectionSpec())
    assert sorted(r.sku for r in flat.collect()) == [3]


def test_columns_and_offer_fields_outside_the_fixed_ones(spark, tmp_json):
    path = tmp_json(env(1, [product(1, modelNumber="MX-1", shelf={"row": 3}, weight=2.5,
                                    offers=[{"id": 7, "startDate": "a", "endDate": None}, {"id": "x", "startDate": "b"}])]))
    flat = G.flatten_pages(G.read_envelopes(spark, path), ProjectionSpec(["sku", "modelNumber", "shelf", "name", "weight"], ["Color"], ["id"]))
    assert flat.columns == ["page", "pos", "sku", "modelNumber", "shelf", "name", "weight", "Color", "offer.id"]
    row = flat.collect()[0]
    assert (row.modelNumber, row.shelf, row.name, row.weight) == ("MX-1", '{"row":3}', "item 1", "2.5")
    assert row["offer.id"] == {0: "7", 1: "x"}


def test_a_long_page_plan_in_blocks(spark):
    df = spark.createDataFrame([(25_001,), (0,), (10_000,), (None,)], "totalPages long")
    got = G.page_plan(df)
    assert got.count() == 35_001 and got.where("page = 25001").collect()[0]["batch"] == 6250
    assert got.groupBy("totalPages", "page").count().where("count > 1").count() == 0


def test_page_intervals_over_blocks(spark, monkeypatch):
    import random
    rng = random.Random(6)
    monkeypatch.setattr(G, "PLAN_BLOCK", 7)
    good = '{"sku":1,"name":"a","salePrice":1.0,"url":"u","addToCartUrl":"c","details":[],"offers":[]}'
    bad = '{"sku":1,"name":"a","salePrice":1.0,"url":"u","details":[],"offers":[]}'
    total, lines, state = 60, [], {}
    for page in range(1, total + 1):
        kinds = rng.choice([[], [good], [good], [bad], [bad, good], ["none"], [], [bad, bad]])
        if 20 <= page < 30:
            kinds = []  # a block without any page
        for k in kinds:
            products = '' if k == "none" else f',"products":[{k}]'
            lines.append((f'{{"totalPages":{total},"currentPage":{page}{products}}}',))
        landed = [k for k in kinds if k != "none"]
        state[page] = "lost" if not landed else "rejected" if good not in landed else "good"
    env = spark.createDataFrame(lines, "value string").select(F.parse_json("value").alias(G.ENVELOPE))
    want = []
    for page in range(1, total + 1):
        if state[page] == "good":
            continue
        if want and want[-1][0] == state[page] and want[-1][2] == page - 1 and (page - 1) % 7:
            want[-1][2] = page
        else:
            want.append([state[page], page, page])
    got = sorted(tuple(r) for r in G.page_intervals(env, ProjectionSpec()).collect())
    assert got == sorted((s, a, b, b - a + 1) for s, a, b in want)
    none = spark.createDataFrame([], "value string").select(F.parse_json("value").alias(G.ENVELOPE))
    assert G.page_intervals(none, ProjectionSpec()).collect() == []
