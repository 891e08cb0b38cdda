"""Landed result pages: write, read, guard, reject, flatten, plan and audit.

A page envelope is one JSON object per line::

    {"totalPages": N, "total": T, "currentPage": p, "products": [ {...}, ... ]}

It is read as a single ``VARIANT`` column, so that a *missing* key and a JSON
``null`` stay distinct - the difference decides whether a page is usable.
Everything downstream is narrow per envelope (``posexplode`` + typed
``variant_get``); a page holds at most ``page_size`` products by construction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealspark.functions.text import ceil_div
from dealspark.operators.projection import ProjectionSpec, attribute_alias, detail_value, offer_column_name
from dealspark.session import fresh_scratch, stored
from dealspark.sources.catalogue import OFFER_ORDER, PRODUCTS_PER_PAGE, offer_dates, offer_lines, products

ENVELOPE = "v"

# Typed shape of one product record (everything the searches and specs read).
PRODUCT_FIELDS: dict[str, str] = {
    "sku": "bigint", "name": "string", "salePrice": "double", "url": "string", "addToCartUrl": "string",
    "color": "string", "onSale": "boolean", "active": "boolean", "onlineAvailability": "boolean",
    "orderable": "string", "condition": "string", "preowned": "boolean", "percentSavings": "double",
    "screenSizeClassIn": "double", "productTemplate": "string", "class": "string", "subclassId": "int",
    "manufacturer": "string", "albumTitle": "string", "protectionPlanTerm": "string",
    "priceUpdateDate": "timestamp_ntz",
    "categoryPath": "array<struct<id:string,name:string>>",
    "details": "array<struct<name:string,value:string>>",
    "offers": "array<struct<startDate:string,endDate:string>>",
}

# sku%997=0 products land without `addToCartUrl` (a missing key).
MISSING_KEY_MODULUS = 997


# -- landing (the writer side: what the source would deliver) -----------------

def envelope_texts(spark: SparkSession, sf_dir: str, page_size: int = PRODUCTS_PER_PAGE) -> DataFrame:
    """The catalogue as page envelopes, one JSON text per page (``value``).

    Offers are nested per product and products per page (at most ``page_size``
    per page): a product record is one JSON value in this format, however many
    offers it has.  JSON nulls are kept (``ignoreNullFields=false``);
    ``addToCartUrl`` is left out for every sku%997=0 product so that those pages
    carry a genuinely missing key.
    """
    cat = products(spark, sf_dir)
    # Offers in list order: sorting the collected structs by their leading
    # fields (the offer order key) gives the order without numbering them first.
    # Dealt by product before they are rendered: collecting lists on the reading side
    # would not shrink them.
    lines = offer_lines(spark, sf_dir).repartition("l_partkey").select(
        "*", *offer_dates(), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"))
    nested = (lines.groupBy(F.col("l_partkey").alias("sku"))
              .agg(F.sort_array(F.collect_list(F.struct(*OFFER_ORDER, "id", "startDate", "endDate"))).alias("o")))
    offers = F.coalesce(F.transform(F.col("o"), lambda x: F.struct(x["id"].alias("id"), x["startDate"].alias("startDate"),
                                                                      x["endDate"].alias("endDate"))),
                        F.expr("CAST(array() AS ARRAY<STRUCT<id:STRING,startDate:STRING,endDate:STRING>>)"))
    full = (cat.join(nested, "sku", "left").withColumn("offers", offers)
            .withColumn("modelNumber", F.concat(F.lit("MX-"), F.col("sku").cast("string")))
            .withColumn("shelf", F.struct((F.col("sku") % 9).alias("row"))))
    fields = [*PRODUCT_FIELDS, "modelNumber", "shelf"]
    opts = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss"}
    with_all = F.to_json(F.struct(*[F.col(f"`{f}`") for f in fields]), opts)
    without = F.to_json(F.struct(*[F.col(f"`{f}`") for f in fields if f != "addToCartUrl"]), opts)
    product_json = F.when(F.col("sku") % MISSING_KEY_MODULUS == 0, without).otherwise(with_all)
    total = cat.select(F.count(F.lit(1))).scalar()
    per_page = (full.select("page", "pos", product_json.alias("j"))
                    .groupBy("page")
                    .agg(F.sort_array(F.collect_list(F.struct("pos", "j"))).alias("items")))
    envelope = F.concat(
        F.lit('{"totalPages":'), ceil_div(total, F.lit(page_size)).cast("string"),
        F.lit(',"total":'), total.cast("string"),
        F.lit(',"currentPage":'), F.col("page").cast("string"),
        F.lit(',"products":['), F.array_join(F.transform("items", lambda x: x["j"]), ","), F.lit("]}"))
    return per_page.select(envelope.alias("value"))


def land_envelopes(spark: SparkSession, sf_dir: str, dest: str | None = None) -> str:
    """Write the envelopes as JSON lines and return the folder."""
    dest = dest or fresh_scratch(spark, "landed")
    envelope_texts(spark, sf_dir).write.mode("overwrite").text(dest)
    return dest


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes as they would be read, without landing them."""
    return envelope_texts(spark, sf_dir).select(_once(F.parse_json("value")).alias(ENVELOPE))


def _once(value: Column) -> Column:
    """A row's value as a generated column: it is computed once, where a plain
    column would be computed anew in every filter and projection above it."""
    return F.explode(F.array(value))


# -- reading -----------------------------------------------------------------

def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: every landed envelope as one ``VARIANT`` column ``v``."""
    return spark.read.option("singleVariantColumn", ENVELOPE).json(path)


def stream_envelopes(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: the same, as a file stream picking up newly landed pages."""
    return (spark.readStream.option("singleVariantColumn", ENVELOPE)
                 .schema(f"{ENVELOPE} variant").json(path))


def _variant_get_untyped(v: Column, path: str) -> Column:
    # variant_get without a type returns the sub-variant (NULL when the key is missing)
    return F.variant_get(v, path, "variant")


def totals(env: DataFrame) -> DataFrame:
    """Envelope header fields; absent counts read as 0 (``.get(key, 0)``)."""
    v = F.col(ENVELOPE)
    return env.select(
        F.variant_get(v, "$.currentPage", "int").alias("currentPage"),
        F.coalesce(F.variant_get(v, "$.totalPages", "int"), F.lit(0)).alias("totalPages"),
        F.coalesce(F.variant_get(v, "$.total", "bigint"), F.lit(0)).alias("total"),
        v)


def usable(env: DataFrame) -> DataFrame:
    """SRC-2: keep envelopes that have a ``products`` key (a JSON null key still
    passes this guard and is rejected later, as iterating it fails)."""
    return env.where(_variant_get_untyped(F.col(ENVELOPE), "$.products").isNotNull())


def _missing(p: Column, key: str) -> Column:
    return _variant_get_untyped(p, f"$['{key}']").isNull()


def _text_or_null(x: Column, key: str) -> Column:
    """The member as text when it is a JSON string; NULL when it is missing,
    null or of another JSON type (which cannot be case-folded)."""
    member = _variant_get_untyped(x, f"$['{key}']")
    return F.when(F.schema_of_variant(member) == F.lit("STRING"), F.variant_get(member, "$", "string"))


def _decode(p: Column) -> Column:
    """Per product, the parts the fault test reads, decoded from VARIANT once:
    the product, its ``details`` as ``(n: lower-cased name when a JSON string,
    v: has a value key)`` and its ``offers`` list."""
    details = F.try_variant_get(p, "$.details", "array<variant>")
    return F.struct(
        p.alias("p"),
        F.transform(details, lambda d: F.struct(F.lower(_text_or_null(d, "name")).alias("n"),
                                                (~_missing(d, "value")).alias("v"))).alias("details"),
        F.try_variant_get(p, "$.offers", "array<variant>").alias("offers"))


def product_faults(x: Column, spec: ProjectionSpec) -> Column:
    """True when flattening this product record with ``spec`` fails
    (``x`` is the product as decoded by ``_decode``):

    * a requested base column is missing (a JSON null is fine);
    * ``details`` is missing or not a list; while looking an attribute up, a
      detail examined before (or at) the first match has no usable ``name``,
      or the matching detail has no ``value`` key;
    * ``offers`` is missing or not a list, or an offer misses a requested field.
    """
    s = spec.resolved()
    p, details, offers = x["p"], x["details"], x["offers"]
    # A record that is not an object has no keys, so it already fails here: a
    # resolved spec always requests at least one column.
    faults: list[Column] = [_missing(p, c) for c in s.columns]
    faults.append(details.isNull())
    for name in s.details:
        key = F.lit(name.lower())
        k = F.array_position(F.transform(details, lambda d: d["n"].isNull() | (d["n"] == key)), True)
        hit = F.get(details, (k - 1).cast("int"))
        faults.append(F.coalesce((k > 0) & (hit["n"].isNull() | ~hit["v"]), F.lit(False)))
    faults.append(offers.isNull())
    if s.offers:  # one pass over the offers for all requested fields
        faults.append(F.coalesce(F.exists(offers, lambda o: _any([_missing(o, f) for f in s.offers])), F.lit(False)))
    return F.coalesce(_any(faults), F.lit(True))


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for more in conds[1:]:
        out = out | more
    return out


def _page_bad(spec: ProjectionSpec, if_no_products: bool) -> Column:
    prods = F.try_variant_get(F.col(ENVELOPE), "$.products", "array<variant>")
    decoded = F.transform(prods, _decode)
    return F.coalesce(F.exists(decoded, lambda x: product_faults(x, spec)), F.lit(if_no_products))


def _accepted_products(env: DataFrame, spec: ProjectionSpec) -> DataFrame:
    """PRJ-3: ``(page, products)`` of the pages whose products can all be flattened
    with ``spec``, each product as decoded by ``_decode``.

    A page is decoded once, tested with ``exists`` over its products and handed
    on: no shuffle, and the rest of the run goes on with the other pages.
    """
    prods = F.try_variant_get(F.col(ENVELOPE), "$.products", "array<variant>")
    decoded = env.select(F.variant_get(F.col(ENVELOPE), "$.currentPage", "int").alias("page"),
                         _once(F.transform(prods, _decode)).alias("products"))
    bad = F.exists("products", lambda x: product_faults(x, spec))
    return decoded.where(F.col("products").isNotNull() & ~F.coalesce(bad, F.lit(False)))


def accepted(env: DataFrame, spec: ProjectionSpec) -> DataFrame:
    """The envelopes of the pages whose products can all be flattened with ``spec``."""
    prods = F.try_variant_get(F.col(ENVELOPE), "$.products", "array<variant>")
    return env.where(prods.isNotNull() & ~_page_bad(spec, if_no_products=False))


def rejected_pages(env: DataFrame, spec: ProjectionSpec) -> DataFrame:
    return env.where(_page_bad(spec, if_no_products=True)).select(
        F.variant_get(F.col(ENVELOPE), "$.currentPage", "int").alias("page"))


def explode_products(env: DataFrame) -> DataFrame:
    """SRC-3: one row per product, ``(page, pos, p)`` with ``p`` still a VARIANT."""
    prods = F.try_variant_get(F.col(ENVELOPE), "$.products", "array<variant>")
    return env.select(F.variant_get(F.col(ENVELOPE), "$.currentPage", "int").alias("page"),
                      F.posexplode(prods).alias("pos", "p"))


def typed(rows: DataFrame, fields: Sequence[str] | None = None) -> DataFrame:
    """Typed columns out of ``p`` (missing and null both become SQL NULL)."""
    return rows.select("page", "pos", *[_typed(f).alias(f) for f in fields or PRODUCT_FIELDS])


def flatten_pages(env: DataFrame, spec: ProjectionSpec) -> DataFrame:
    """The per-page flatten of the reference, as one narrow plan: reject, explode,
    then base columns in the listed order, attribute columns and
    ``offer.<field>`` maps.  A base column or offer field without a known type is
    text, as it stands in the record (a nested value as JSON)."""
    s = spec.resolved()
    rows = _accepted_products(env, spec).select("page", F.posexplode("products").alias("pos", "x"))
    rows = rows.select("page", "pos", F.col("x.p").alias("p"), F.col("x.offers").alias("offers"))
    rows = rows.withColumn("details", _typed("details"))
    base = [_typed(c).alias(c) for c in s.columns]
    attrs = [detail_value(d).alias(attribute_alias(d, s.columns)) for d in s.details]
    offs = [_offer_texts(f).alias(offer_column_name(f)) for f in s.offers]
    return rows.select("page", "pos", *base, *attrs, *offs)


def _typed(field: str) -> Column:
    """A field of the product ``p``: typed where it is known, else as text."""
    kind = PRODUCT_FIELDS.get(field, "string")
    if kind == "timestamp_ntz":
        return F.to_timestamp_ntz(F.try_variant_get("p", f"$['{field}']", "string"))
    return F.try_variant_get("p", f"$['{field}']", kind)


def _offer_texts(field: str) -> Column:
    """``MAP<INT,STRING>`` offer position -> any field of the offer as text."""
    return F.map_from_entries(F.transform(F.col("offers"), lambda o, i: F.struct(
        i.alias("key"), F.try_variant_get(o, f"$['{field}']", "string").alias("value"))))


# -- page plan and audit -----------------------------------------------------

def page_plan(totals_df: DataFrame, batch_size: int = 4, pages_col: str = "totalPages") -> DataFrame:
    """SRC-4: pages 1..N and their batch number, per row of ``totals_df``.

    Two steps of bounded lists: blocks of ``PLAN_BLOCK`` pages, then the pages of
    each block; ``sequence(1, 0)`` counts down to ``[1, 0]``, so N = 0 is guarded.
    """
    n = F.col(pages_col).cast("long")
    block = F.lit(PLAN_BLOCK)
    blocks = F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / block))).otherwise(F.array().cast("array<bigint>"))
    out = totals_df.withColumn("__block", F.explode(blocks))
    first = F.col("__block") * block
    out = out.withColumn("page", F.explode(F.sequence(first + 1, F.least(first + block, n)))).drop("__block")
    return out.withColumns({"page": F.col("page").cast("int"), "batch": F.floor((F.col("page") - 1) / F.lit(batch_size)).cast("int")})


#: Pages of one block of a plan.
PLAN_BLOCK = 10_000


def page_audit(env: DataFrame, spec: ProjectionSpec) -> DataFrame:
    """SRC-5: pages whose products did not arrive, and why.

    Expected pages come from the largest reported ``totalPages``; ``lost`` = no
    usable envelope landed for it (``left_anti``), ``rejected`` = it landed but
    could not be flattened.  Both tables have one row per page.
    """
    head = totals(env).agg(F.max("totalPages").alias("totalPages"))
    expected = page_plan(head).select("page")
    landed_pages = usable(env).select(F.variant_get(F.col(ENVELOPE), "$.currentPage", "int").alias("page"))
    lost = expected.join(landed_pages, "page", "left_anti").withColumn("status", F.lit("lost"))
    rej = rejected_pages(usable(env), spec).join(expected, "page", "left_semi").withColumn("status", F.lit("rejected"))
    return lost.unionByName(rej)


def page_intervals(env: DataFrame, spec: ProjectionSpec) -> DataFrame:
    """SRC-5 for repair: ``(status, first_page, last_page, n_pages)`` of the pages to fetch
    again, as runs of neighbouring pages, from one scan of the envelopes.

    The scan is written as one narrow row per envelope.  A page is good if one of its
    envelopes is, ``rejected`` if some landed but none can be flattened, else ``lost``.
    Gaps and islands are found per block of ``PLAN_BLOCK`` pages, so no task sees all
    pages; a run ends at its block's end.
    """
    usable_page = _variant_get_untyped(F.col(ENVELOPE), "$.products").isNotNull()
    facts = F.struct(F.variant_get(F.col(ENVELOPE), "$.currentPage", "long").alias("page"),
                     F.coalesce(F.variant_get(F.col(ENVELOPE), "$.totalPages", "long"), F.lit(0)).alias("total"),
                     usable_page.alias("usable"), (usable_page & _page_bad(spec, if_no_products=True)).alias("bad"))
    seen = stored(env.select(_once(facts).alias("f")).select("f.*"), "page-facts")
    total = seen.agg(F.coalesce(F.max("total"), F.lit(0))).scalar()
    landed = (seen.where("usable and page is not null").groupBy("page").agg(F.min("bad").alias("bad"))
              .where((F.col("page") >= 1) & (F.col("page") <= total)).withColumn("block", F.floor((F.col("page") - 1) / PLAN_BLOCK)))
    spark = env.sparkSession
    # The block numbers, in two steps so that no cell holds them all.
    many = F.lit(PLAN_BLOCK)
    ends = (spark.range(1).select(F.explode(F.sequence(F.lit(0).cast("long"), F.floor(total / (many * many)))).alias("b"))
            .select(F.explode(F.sequence(F.col("b") * many, F.col("b") * many + many - 1)).alias("block"))
            .where(F.col("block") * many < total))
    last = F.least((F.col("block") + 1) * many, total)
    # A mark after each block's last page closes its last gap.
    marks = landed.select("block", "page").unionByName(ends.select("block", (last + 1).alias("page")))
    before = F.coalesce(F.lag("page").over(Window.partitionBy("block").orderBy("page")), F.col("block") * many)
    lost = (marks.select((before + 1).alias("first_page"), (F.col("page") - 1).alias("last_page"))
            .where("first_page <= last_page").select(F.lit("lost").alias("status"), "first_page", "last_page"))
    bad = landed.where("bad")
    island = F.col("page") - F.row_number().over(Window.partitionBy("block").orderBy("page"))
    rejected = (bad.withColumn("island", island).groupBy("block", "island")
                .agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
                .select(F.lit("rejected").alias("status"), "first_page", "last_page"))
    return lost.unionByName(rejected).withColumn("n_pages", F.col("last_page") - F.col("first_page") + 1)
