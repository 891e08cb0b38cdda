"""Every registered query: ``key -> (spark, sf_dir) -> DataFrame``.

Each callable reads the given tables (or tables Spark derives from them) in
full; nothing is sampled, capped or filtered by id to make it cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dealspark.functions import text as X
from dealspark.functions import timefns as T
from dealspark.operators import predicates as P
from dealspark.operators.compose import (add_offers, pack_offers, pack_wide, page_slice, rank_by_order,
                                         run_search, select_spec, tag_pack, top_k)
from dealspark.operators.pack_index import PackIndex, tag_pack_indexed
from dealspark.operators.projection import ProjectionSpec, detail_columns, offer_entries
from dealspark.operators.ranking import global_rank
from dealspark.plans import packs as K
from dealspark.plans import report as R
from dealspark.plans import runner
from dealspark.plans.packs import SAVED_QUERIES
from dealspark.session import fresh_scratch
from dealspark.sources import pages as G
from dealspark.sources.attributes import store_attributes
from dealspark.sources.catalogue import catalogue, catalogue_latest, offer_rows, products, table
from dealspark.sources.ordered import store_ordered
from dealspark.streaming import incremental as S
from dealspark.streaming import live
from dealspark.streaming.observed import BatchMetrics, observe

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def register(key: str):
    def deco(fn: QueryFn) -> QueryFn:
        if fn.__name__ == "fn":  # built by a factory: name it after its key
            fn.__name__ = fn.__qualname__ = key
        QUERIES[key] = fn
        return fn
    return deco


# -- saved searches (QRY-1..14) ----------------------------------------------

SEARCH_KEYS = {
    "q_discount": "discount",
    "q_headphones": "headphones",
    "q_airpods": "airpods",
    "q_controller": "ps5 controller",
    "q_television": "television",
    "q_macbook_pro": "macbook",
    "q_gpu_laptop": "nvidia",
    "q_gpu_desktop": "desktop",
    "q_purple": "purple",
    "q_airpods_recent": "airpods recent",
    "q_macbook_cheap": "macbook cheap",
    "q_gpu_laptop_cheap": "nvidia cheap",
    "q_tv_top10": "television top10",
    "q_gpu_top10": "nvidia top10",
}


def _search(name: str) -> QueryFn:
    def fn(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run_search(catalogue(spark, sf_dir), SAVED_QUERIES[name], catalogue_latest(spark, sf_dir))
    fn.__name__ = f"search_{name.replace(' ', '_')}"
    return fn


for _key, _name in SEARCH_KEYS.items():
    register(_key)(_search(_name))


# -- predicates (PRD-1..18): matching skus plus the tested field ---------------

def _match(pred_fn, *fields):
    """``pred_fn(now)`` over the whole catalogue."""
    def fn(spark, sf_dir):
        cat = catalogue(spark, sf_dir)
        return cat.where(pred_fn(catalogue_latest(spark, sf_dir))).select("sku", *[F.col(f"`{f}`") for f in fields])
    return fn


register("prd_eq_str")(_match(lambda now: P.eq("manufacturer", "apple"), "manufacturer"))
register("prd_eq_bool")(_match(lambda now: P.eq("preowned", False), "preowned"))
register("prd_eq_int")(_match(lambda now: P.eq("subclassId", 410), "subclassId"))
register("prd_ne_str")(_match(lambda now: P.ne("protectionPlanTerm", "gsr"), "protectionPlanTerm"))
register("prd_ne_num")(_match(lambda now: P.ne("salePrice", K.EXCLUDED_PRICE), "salePrice"))
register("prd_lt")(_match(lambda now: P.lt("salePrice", 1000), "salePrice"))
register("prd_gt")(_match(lambda now: P.gt("screenSizeClassIn", 84), "screenSizeClassIn"))
register("prd_gt_ts")(_match(
    lambda now: P.gt_ts("priceUpdateDate", T.cutoff(now, T.DAILY_LOOKBACK_MINUTES, T.DAILY_ZONE)), "priceUpdateDate"))
register("prd_prefix")(_match(lambda now: P.prefix("manufacturer", "Sony"), "manufacturer"))
register("prd_in")(_match(lambda now: P.isin("productTemplate", K.TV_TEMPLATES), "productTemplate"))
register("prd_and")(_match(lambda now: P.all_of(*K.base()), "orderable"))
register("prd_or_group")(_match(lambda now: P.any_of(*[P.prefix("color", s) for s in K.PURPLE_SHADES]), "color"))
register("prd_any_eq")(_match(lambda now: P.any_eq("details.value", "nvidia"), "name"))
register("prd_any_prefix")(_match(lambda now: P.any_prefix("categoryPath.name", "laptop"), "name"))
register("prd_none_eq")(_match(lambda now: P.none_eq("details.value", "intel"), "name"))
register("prd_none_prefix")(_match(lambda now: P.none_prefix("details.value", "1650"), "name"))
register("prd_search")(_match(lambda now: P.search("airpods"), "name"))


# -- list conditions over a stored inverted table (PRD-13..17) ------------------

def _indexed(cond, field="name"):
    def fn(spark, sf_dir):
        cat = catalogue(spark, sf_dir)
        return store_attributes(cat, fresh_scratch(spark, "attributes")).matching(cat, [cond]).select("sku", field)
    return fn


register("idx_any_eq")(_indexed(("any_eq", "details.value", "nvidia")))
register("idx_any_prefix")(_indexed(("any_prefix", "categoryPath.name", "laptop")))
register("idx_none_eq")(_indexed(("none_eq", "details.value", "intel")))
register("idx_none_prefix")(_indexed(("none_prefix", "details.value", "1650")))
register("idx_search")(_indexed(("search", "airpods")))


@register("prd_anti_prefix_local")
def prd_anti_prefix_local(spark, sf_dir):
    """Archived local post-filter on the flattened table: drop ``Processor Model``
    values starting with ``Intel`` (case-sensitive), then rank by price, name."""
    flat = select_spec(catalogue(spark, sf_dir), ProjectionSpec(None, K.LAPTOP_ATTRS), keep=["page", "pos"])
    kept = flat.where(P.anti_prefix_local("Processor Model", "Intel"))
    return rank_by_order(kept).select("sku", "name", "salePrice", "`Processor Model`", "rank")


# -- projection (PRJ-1..9) ---------------------------------------------------

@register("prj_columns")
def prj_columns(spark, sf_dir):
    return products(spark, sf_dir).select(*[F.col(c) for c in K.MACBOOK_COLUMNS])


@register("prj_defaults")
def prj_defaults(spark, sf_dir):
    """Falsy spec -> 5 default columns and 8 default attributes."""
    return select_spec(products(spark, sf_dir), ProjectionSpec([], [], None))


# Attributes probed by the lookup key (case, duplicates, nulls, gaps).
PROBE_ATTRS = ("brand", "SIZE", "Type", "Color")


@register("prj_detail_first")
def prj_detail_first(spark, sf_dir):
    return products(spark, sf_dir).select("sku", *detail_columns(PROBE_ATTRS))


@register("prj_detail_pivot")
def prj_detail_pivot(spark, sf_dir):
    names = list(dict.fromkeys([*K.GPU_ATTRS, *K.TV_ATTRS, *K.HEADPHONE_ATTRS]))
    return products(spark, sf_dir).select("sku", *detail_columns(names))


@register("prj_offer_map")
def prj_offer_map(spark, sf_dir):
    """``offer.startDate`` / ``offer.endDate`` of every catalogue product, exploded
    to ``(sku, offer_pos, offer.startDate, offer.endDate)``."""
    cat = catalogue(spark, sf_dir).select("sku")
    return offer_entries(offer_rows(spark, sf_dir), ProjectionSpec()).join(cat, "sku", "left_semi")


def _discount_hits(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    return cat.where(K.SAVED_QUERIES["discount"].where(catalogue_latest(spark, sf_dir)))


@register("prj_row_index")
def prj_row_index(spark, sf_dir):
    """Index by landing position (page, pos), kept through the price sort."""
    hits = _discount_hits(spark, sf_dir).select("sku", "page", "pos")
    return global_rank(hits, ["page", "pos"], out="row_index").select("sku", "row_index")


@register("prj_rank_index")
def prj_rank_index(spark, sf_dir):
    hits = _discount_hits(spark, sf_dir).select("sku", "salePrice", "name", "page", "pos")
    return rank_by_order(hits).select("sku", "rank")


@register("prj_query_tag")
def prj_query_tag(spark, sf_dir):
    """Each result row tagged with its query's name and the result's shape."""
    q = K.SAVED_QUERIES["discount"]
    cat = catalogue(spark, sf_dir)
    now = catalogue_latest(spark, sf_dir)
    res = run_search(cat, q, now)
    # the shape counts the matches (a partial count over the filtered scan),
    # not the ranked result again
    n_rows = cat.where(q.where(now)).select(F.count(F.lit(1))).scalar()
    width = len(q.spec.output_names(with_offers=True))
    tagged = res.select(F.lit(q.name).alias("query_name"), "name", "salePrice", "rank", n_rows.alias("n_rows"))
    return tagged.withColumn("n_cols", F.when(F.col("n_rows") > 0, F.lit(width)).otherwise(F.lit(0)))


# -- order / limits (SRT-1, LIM-1, LIM-2) ------------------------------------

@register("sort_price_name")
def sort_price_name(spark, sf_dir):
    cat = catalogue(spark, sf_dir).select("sku", "salePrice", "name", "page", "pos")
    return rank_by_order(cat).select("sku", "salePrice", "name", "rank")


# The page requested and the page size of the script entry.
SLICE_PAGE, SLICE_SIZE = 2, 10


@register("page_slice")
def page_slice_key(spark, sf_dir):
    cat = catalogue(spark, sf_dir).select("sku", "salePrice", "name", "page", "pos")
    return page_slice(cat, SLICE_PAGE, SLICE_SIZE).select("sku", "salePrice", "name", "rank")


# A page deep in the result.
DEEP_PAGE, DEEP_SIZE = 15, 100


@register("page_deep")
def page_deep(spark, sf_dir):
    """LIM-1 over a stored order: only the files of the page are opened."""
    cat = catalogue(spark, sf_dir).select("sku", "salePrice", "name", "page", "pos")
    return store_ordered(cat, fresh_scratch(spark, "ordered")).page(DEEP_PAGE, DEEP_SIZE).select("sku", "salePrice", "name", "rank")


@register("topk_cheapest")
def topk_cheapest(spark, sf_dir):
    cat = catalogue(spark, sf_dir).select("sku", "salePrice", "name", "page", "pos")
    return top_k(cat, 10).select("sku", "salePrice", "name", "rank")


# -- set operations (SET-1, SET-2) -------------------------------------------

@register("set_pack_offers")
def set_pack_offers(spark, sf_dir):
    """Every offer of every result row of all saved searches, by search and rank."""
    return pack_offers(catalogue(spark, sf_dir), list(SAVED_QUERIES.values()), offer_rows(spark, sf_dir),
                       catalogue_latest(spark, sf_dir))


@register("set_pack_tagged")
def set_pack_tagged(spark, sf_dir):
    tagged = tag_pack(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), catalogue_latest(spark, sf_dir))
    return tagged.select("query_name", "sku")


@register("set_pack_index")
def set_pack_index(spark, sf_dir):
    """SET-2 for a pack of thousands: one scan, the searches as rows of an index."""
    tagged = tag_pack_indexed(catalogue(spark, sf_dir), PackIndex(K.grid_pack()))
    return tagged.select("query_name", "sku")


@register("set_pack_wide")
def set_pack_wide(spark, sf_dir):
    return pack_wide(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), catalogue_latest(spark, sf_dir))


# -- aggregates (AGG-1, AGG-3, AGG-4) ----------------------------------------

@register("agg_shape")
def agg_shape(spark, sf_dir):
    shapes = R.shape(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), catalogue_latest(spark, sf_dir))
    return shapes.select("query_name", "n_rows", "n_cols")


# The two searches of the smoke notebook (before their top-10 limit).
NOTEBOOK_PACK = ("television top10", "nvidia top10")


@register("agg_sum_totals")
def agg_sum_totals(spark, sf_dir):
    """Sum of the reported totals (matches before paging) of the notebook's searches."""
    shapes = R.shape(catalogue(spark, sf_dir), K.pack(NOTEBOOK_PACK), catalogue_latest(spark, sf_dir))
    return shapes.agg(F.sum("n_rows").cast("long").alias("total_products"))


@register("agg_document")
def agg_document(spark, sf_dir):
    return R.document_lines(catalogue(spark, sf_dir, spread=True), K.pack(K.HTTP_PACK), offer_rows(spark, sf_dir),
                            catalogue_latest(spark, sf_dir))


# -- scalar functions (SCL-1..9) ---------------------------------------------

@register("scl_link_rewrite")
def scl_link_rewrite(spark, sf_dir):
    cat = products(spark, sf_dir)
    return cat.select("sku", X.link_rewrite(F.col("url")).alias("url_html"),
                      X.link_rewrite(F.col("addToCartUrl")).alias("cart_html"))


def _event_times(spark, sf_dir):
    """The time of every event."""
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").alias("priceUpdateDate"))


@register("scl_lookback")
def scl_lookback(spark, sf_dir):
    ev = _event_times(spark, sf_dir)
    ts = F.col("priceUpdateDate")
    return ev.select("event_id", T.lookback(ts, T.DAILY_LOOKBACK_MINUTES).alias("daily_since"),
                     T.lookback(ts, T.FREQUENT_LOOKBACK_MINUTES).alias("frequent_since"))


@register("scl_tz_cutoff")
def scl_tz_cutoff(spark, sf_dir):
    ev = _event_times(spark, sf_dir)
    ts = F.col("priceUpdateDate")
    return ev.select("event_id", T.cutoff(ts, T.DAILY_LOOKBACK_MINUTES, T.DAILY_ZONE).alias("daily_cutoff"),
                     T.cutoff(ts, T.FREQUENT_LOOKBACK_MINUTES, T.FREQUENT_ZONE).alias("frequent_cutoff"))


@register("scl_cutoff_text")
def scl_cutoff_text(spark, sf_dir):
    ev = _event_times(spark, sf_dir)
    ts = F.col("priceUpdateDate")
    return ev.select("event_id",
                     T.cutoff_text(T.cutoff(ts, T.DAILY_LOOKBACK_MINUTES, T.DAILY_ZONE)).alias("daily_text"),
                     T.cutoff_text(T.cutoff(ts, T.FREQUENT_LOOKBACK_MINUTES, T.FREQUENT_ZONE)).alias("frequent_text"))


@register("scl_first_word")
def scl_first_word(spark, sf_dir):
    return products(spark, sf_dir).select("sku", X.first_word(F.col("name")).alias("first_word"))


@register("scl_after_token")
def scl_after_token(spark, sf_dir):
    """Path after a URL's leading token.  Search URLs carry the API version
    (``v1``, the helper's default); catalogue product URLs carry ``site`` in
    that place, so every product URL is split on it."""
    return products(spark, sf_dir).select("sku", X.after_token(F.col("url"), "site").alias("path"))


@register("scl_ceil_div")
def scl_ceil_div(spark, sf_dir):
    """Pages needed per query of the pack, at page sizes 100 and 10."""
    shapes = R.shape(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), catalogue_latest(spark, sf_dir))
    n = F.col("n_rows")
    return shapes.select("query_name", n.alias("total"),
                         X.ceil_div(n, F.lit(100)).alias("pages_100"), X.ceil_div(n, F.lit(10)).alias("pages_10"))


# -- report rendering (RPT-1, RPT-2) -----------------------------------------

@register("rpt_table")
def rpt_table(spark, sf_dir):
    q = K.SAVED_QUERIES["discount"]
    rows = pack_wide(catalogue(spark, sf_dir), [q], catalogue_latest(spark, sf_dir), with_sku=True)
    return R.render_rows(add_offers(rows, offer_rows(spark, sf_dir), fields=q.spec.offers), q)


@register("rpt_digest")
def rpt_digest(spark, sf_dir):
    cat = catalogue(spark, sf_dir)
    now = catalogue_latest(spark, sf_dir)
    since = R.since_text(T.cutoff(now, T.DAILY_LOOKBACK_MINUTES, T.DAILY_ZONE))
    return R.digest(R.shape(cat, K.pack(K.HTTP_PACK), now), since).select("query_name", "header")


# -- landed pages (SRC-1..6, PRJ-3, AGG-2, SNK-1/2, OBS-1) --------------------



def _envelopes(spark, sf_dir):
    return G.envelopes(spark, sf_dir)


def _n_products():
    return F.size(F.try_variant_get(F.col(G.ENVELOPE), "$.products", "array<variant>")).cast("int")


@register("src_pages")
def src_pages(spark, sf_dir):
    """Envelopes landed as JSON files and read back."""
    env = G.read_envelopes(spark, G.land_envelopes(spark, sf_dir))
    return G.totals(env).select("currentPage", "totalPages", "total", _n_products().alias("n_products"))


@register("src_valid_pages")
def src_valid_pages(spark, sf_dir):
    env = G.usable(_envelopes(spark, sf_dir))
    return env.select(F.variant_get(F.col(G.ENVELOPE), "$.currentPage", "int").alias("currentPage"),
                      _n_products().alias("n_products"))


@register("src_flatten")
def src_flatten(spark, sf_dir):
    rows = G.typed(G.explode_products(G.usable(_envelopes(spark, sf_dir))),
                   ["sku", "name", "salePrice", "addToCartUrl", "offers"])
    return rows.select("page", "pos", "sku", "name", "salePrice", "addToCartUrl",
                       F.size("offers").cast("int").alias("n_offers"))


# Columns and an offer field that no default names.
OPEN_COLUMNS = ("modelNumber", "sku", "shelf", "name")
OPEN_OFFER = "id"


@register("prj_open_schema")
def prj_open_schema(spark, sf_dir):
    """Flatten with base columns and an offer field outside the fixed ones, in
    the listed order; the offer map as JSON text."""
    spec = ProjectionSpec(OPEN_COLUMNS, ["Brand"], [OPEN_OFFER])
    flat = G.flatten_pages(_envelopes(spark, sf_dir), spec)
    return flat.withColumn(f"offer.{OPEN_OFFER}", F.to_json(F.col(f"`offer.{OPEN_OFFER}`")))


@register("set_union_pages")
def set_union_pages(spark, sf_dir):
    """UNION ALL of the flattened result pages, page by page, duplicates kept:
    odd pages, then even pages, as two sets of landed files."""
    env = G.read_envelopes(spark, G.land_envelopes(spark, sf_dir))
    page = F.variant_get(F.col(G.ENVELOPE), "$.currentPage", "int")
    spec = ProjectionSpec(["sku", "name", "salePrice", "url"])
    odd, even = (G.flatten_pages(env.where(page % 2 == k), spec) for k in (1, 0))
    return odd.unionByName(even).select("page", "pos", "sku", "name", "salePrice", "url")


@register("prj_page_reject")
def prj_page_reject(spark, sf_dir):
    """Per-page flatten with the default spec; pages holding a product without
    ``addToCartUrl`` are dropped whole.  Offer maps are rendered as JSON text."""
    flat = G.flatten_pages(_envelopes(spark, sf_dir), ProjectionSpec())
    maps = [c for c in flat.columns if c.startswith("offer.")]
    return flat.select(*[F.to_json(F.col(f"`{c}`")).alias(c) if c in maps else F.col(f"`{c}`")
                         for c in flat.columns])


@register("agg_reported_total")
def agg_reported_total(spark, sf_dir):
    head = G.totals(_envelopes(spark, sf_dir)).where(F.col("currentPage") == 1)
    return head.select("total", "totalPages")


@register("page_plan")
def page_plan_key(spark, sf_dir):
    shapes = R.shape(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), catalogue_latest(spark, sf_dir))
    totals = shapes.select("query_name", X.ceil_div(F.col("n_rows"), F.lit(G.PRODUCTS_PER_PAGE)).alias("totalPages"))
    return G.page_plan(totals).select("query_name", "page", "batch")


# Pages that do not arrive in the audit's landing.
LOST_MODULUS, LOST_PAGE = 7, 4


@register("page_audit")
def page_audit_key(spark, sf_dir):
    """Pages lost on the way (every 7th page here, from the 4th) and pages rejected."""
    page = F.variant_get(F.col(G.ENVELOPE), "$.currentPage", "int")
    return G.page_audit(_envelopes(spark, sf_dir).where(page % LOST_MODULUS != LOST_PAGE), ProjectionSpec())


@register("page_intervals")
def page_intervals_key(spark, sf_dir):
    """The same landing as runs of pages to fetch again."""
    page = F.variant_get(F.col(G.ENVELOPE), "$.currentPage", "int")
    return G.page_intervals(_envelopes(spark, sf_dir).where(page % LOST_MODULUS != LOST_PAGE), ProjectionSpec())


@register("empty_result")
def empty_result(spark, sf_dir):
    """A search whose cutoff is the latest update itself finds nothing newer:
    the result is empty but keeps the projected columns."""
    q = K.SAVED_QUERIES["discount"]
    none_newer = K.SavedQuery("discount", q.subject,
                              lambda now: P.all_of(q.where(now), P.gt_ts("priceUpdateDate", T.cutoff(now, 0, "UTC"))),
                              q.spec)
    return run_search(catalogue(spark, sf_dir), none_newer, catalogue_latest(spark, sf_dir))


@register("export_roundtrip")
def export_roundtrip(spark, sf_dir):
    """The pack's results and offers exported one folder per query, named by the
    subject's first word (``partitionBy``), and read back."""
    path = fresh_scratch(spark, "export")
    runner.export(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), offer_rows(spark, sf_dir), path, catalogue_latest(spark, sf_dir))
    back = spark.read.parquet(path)
    return back.select("export_name", "query_name", "name", "salePrice", "rank", "offer_pos",
                       "`offer.startDate`", "`offer.endDate`")


@register("export_committed")
def export_committed(spark, sf_dir):
    """SNK-1 with a manifest: the newest committed export, read beside one that was broken off."""
    path = fresh_scratch(spark, "export")
    cat, offers, now = catalogue(spark, sf_dir), offer_rows(spark, sf_dir), catalogue_latest(spark, sf_dir)
    pack = K.pack(K.HTTP_PACK)
    run = runner.export_committed(cat, pack, offers, path, now)
    schema = spark.read.parquet(f"{path}/runs/{run}").schema
    # Broken off: its files are there, its manifest is not.
    runner.read_export(spark, path, schema).limit(5).write.parquet(f"{path}/runs/99991231T000000")
    return runner.read_export(spark, path, schema).select("export_name", "query_name", "name", "salePrice", "rank", "offer_pos",
                                                          "`offer.startDate`", "`offer.endDate`")


@register("report_nonempty")
def report_nonempty(spark, sf_dir):
    """Only non-empty results are reported: shapes of every saved search, the
    empty ones filtered out, written as the run's report table and read back."""
    shapes = R.shape(catalogue(spark, sf_dir), list(K.SAVED_QUERIES.values()),
                     catalogue_latest(spark, sf_dir))
    path = fresh_scratch(spark, "report")
    shapes.where(F.col("n_rows") > 0).select("query_name", "n_rows").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register("obs_counts")
def obs_counts(spark, sf_dir):
    """OBS-1: the product count of a run, observed while the result is written."""
    res = run_search(catalogue(spark, sf_dir), K.SAVED_QUERIES["discount"],
                     catalogue_latest(spark, sf_dir))
    obs = Observation("discount_run")
    path = fresh_scratch(spark, "run")
    res.observe(obs, F.count(F.lit(1)).alias("n_products")).write.mode("overwrite").parquet(path)
    n = obs.get["n_products"]
    return spark.createDataFrame([(int(n),)], "n_products bigint")


# -- streaming (SRC-7, STR-1..4) ---------------------------------------------



def _events_glob(sf_dir: str) -> str:
    return f"{sf_dir.rstrip('/')}/events*.parquet"


@register("stream_pages")
def stream_pages(spark, sf_dir):
    """Landed envelopes picked up by a file stream (availableNow), guarded, and
    written to a parquet sink; returns the sink's contents."""
    src = G.land_envelopes(spark, sf_dir)
    base = fresh_scratch(spark, "stream_pages")
    st = G.usable(G.stream_envelopes(spark, src)).select(
        F.variant_get(F.col(G.ENVELOPE), "$.currentPage", "int").alias("currentPage"),
        _n_products().alias("n_products"))
    S.run_to_end(st, f"{base}/_checkpoint", f"{base}/out")
    return spark.read.parquet(f"{base}/out")


def _latest_event(spark, sf_dir):
    """The newest price change: one value, the deterministic "now" of a stream run."""
    return (S.as_price_updates(table(spark, sf_dir, "events"))
            .agg(F.max("priceUpdateDate").alias("m")).first()["m"])


@register("stream_recent")
def stream_recent(spark, sf_dir):
    """STR-1: price changes after the frequent cutoff (16 min before the newest
    change, as Central wall clock), streamed from the events files."""
    now = S.ntz_literal(_latest_event(spark, sf_dir))
    cut = T.cutoff(now, T.FREQUENT_LOOKBACK_MINUTES, T.FREQUENT_ZONE)
    base = fresh_scratch(spark, "stream_recent")
    S.run_to_end(S.since(S.price_updates(spark, _events_glob(sf_dir)), cut), f"{base}/_checkpoint", f"{base}/out")
    return spark.read.parquet(f"{base}/out")


def overlapping_runs(spark, sf_dir, overlap_minutes: int = T.DAILY_LOOKBACK_MINUTES):
    """Two runs of price changes in the events file layout.  The second run is a
    restarted daily run: it re-delivers its whole lookback window (the last
    ``overlap_minutes`` of the first run) before the new changes."""
    upd = S.as_price_updates(table(spark, sf_dir, "events"))
    bounds = upd.agg(F.min("priceUpdateDate").alias("lo"), F.max("priceUpdateDate").alias("hi"))
    mid = bounds.select((F.col("lo") + (F.col("hi") - F.col("lo")) / 2).alias("mid")).scalar()
    overlap = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(overlap_minutes), F.lit(0))

    def raw(d):
        return d.select("event_id", F.col("priceUpdateDate").alias("ts"), F.col("sku").alias("user_id"),
                        F.lit("purchase").alias("event_type"), F.col("salePrice").alias("value"),
                        F.lit(None).cast("string").alias("props"))
    return (raw(upd.where(F.col("priceUpdateDate") <= mid)),
            raw(upd.where(F.col("priceUpdateDate") >= mid - overlap)))


def _run_in_turns(runs, base, start):
    """Land each run, then trigger the (same, checkpointed) query once per run."""
    for i, run_df in enumerate(runs, start=1):
        run_df.write.mode("overwrite").parquet(f"{base}/landed/run-{i}")
        start(f"{base}/landed/run-*/*.parquet")


def _ledger_of(spark, runs, kind):
    base = fresh_scratch(spark, kind)
    body = S.first_deliveries(f"{base}/ledger")
    _run_in_turns(runs, base, lambda src: S.run_to_end(
        S.price_updates(spark, src), f"{base}/_checkpoint", foreach_batch=body))
    return S.delivered(spark, f"{base}/ledger")


@register("stream_dedupe")
def stream_dedupe(spark, sf_dir):
    """STR-2: two overlapping runs processed as two successive triggers of one
    checkpointed query; the overlap's repeats are dropped."""
    return _ledger_of(spark, overlapping_runs(spark, sf_dir), "stream_dedupe")


@register("stream_out_of_order")
def stream_out_of_order(spark, sf_dir):
    """STR-2 with the newer run delivered first: late changes are kept."""
    return _ledger_of(spark, overlapping_runs(spark, sf_dir)[::-1], "stream_out_of_order")


@register("stream_report")
def stream_report(spark, sf_dir):
    """STR-4: per-batch pack report via foreachBatch (idempotent per batch id)
    over the first deliveries of two runs, added up over the runs; a product
    counts once a run, at its newest price."""
    base = fresh_scratch(spark, "stream_report")
    report = S.per_batch_report(catalogue(spark, sf_dir), K.pack(K.HTTP_PACK), f"{base}/report",
                                lambda: catalogue_latest(spark, sf_dir))
    body = S.first_deliveries(f"{base}/ledger", report)
    _run_in_turns(overlapping_runs(spark, sf_dir), base, lambda src: S.run_to_end(
        S.price_updates(spark, src), f"{base}/_checkpoint", foreach_batch=body))
    rep = spark.read.parquet(f"{base}/report")
    return rep.groupBy("query_name").agg(F.sum("n_rows").alias("n_rows"))


@register("stream_live")
def stream_live(spark, sf_dir):
    """STR-4 with AGG-1: counts of a full run plus signed changes of two overlapping
    runs, the newer one first; equal to a full run over the changed catalogue."""
    base = fresh_scratch(spark, "stream_live")
    cat, pack = catalogue(spark, sf_dir), K.pack(K.HTTP_PACK)
    live.write_base(cat, pack, f"{base}/changes", catalogue_latest(spark, sf_dir))
    body = live.signed_counts(cat, pack, f"{base}/changes", lambda: catalogue_latest(spark, sf_dir))
    _run_in_turns(overlapping_runs(spark, sf_dir)[::-1], base, lambda src: S.run_to_end(
        live.price_steps(S.price_updates(spark, src)), f"{base}/_checkpoint", foreach_batch=body))
    return live.live_counts(spark.read.parquet(f"{base}/changes"))


@register("obs_batches")
def obs_batches(spark, sf_dir):
    """OBS-1 per micro-batch: rows of each of two overlapping runs, observed as they are written."""
    base, counts = fresh_scratch(spark, "obs_batches"), {}
    metrics = BatchMetrics()
    spark.streams.addListener(metrics)

    def start(src: str) -> None:
        q = S.run(observe(S.price_updates(spark, src)), f"{base}/_checkpoint", f"{base}/out")
        q.awaitTermination()
        counts.update(metrics.take(q))
    try:
        _run_in_turns(overlapping_runs(spark, sf_dir), base, start)
    finally:
        spark.streams.removeListener(metrics)
    rows = [(n, r["n_rows"], r["first_ts"], r["last_ts"]) for n, r in counts.items()]
    return spark.createDataFrame(rows, "batch_id long, n_rows long, first_ts timestamp_ntz, last_ts timestamp_ntz")
