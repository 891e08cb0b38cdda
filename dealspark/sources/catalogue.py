"""Typed views over the landed tables: the product catalogue, offers, price events.

The deal searches run over a product catalogue.  Here it is derived, row by
row and without any shuffle, from the ``part`` table (``products``); offers
come from ``lineitem`` (``offer_rows``) and price changes from ``events``
(``price_events``).  The derivation rules are fixed fixture values shared with
the SQL oracle, so they are stated once, as expressions, below.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.operators.predicates import FOLDED
from dealspark.operators.ranking import HOT_ROWS, split_rank


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_NO_DETAILS = "CAST(array() AS ARRAY<STRUCT<name:STRING,value:STRING>>)"

# The catalogue derivation shared with the oracle SQL.  Every
# column is a row-local expression of one `part` row, so the view is narrow
# (no exchange) and Catalyst prunes `part` to the five columns it reads.
PRODUCT_COLUMNS: list[tuple[str, str]] = [
    ("sku", "p_partkey"),
    ("name", "CASE WHEN p_type='STANDARD' AND p_partkey%2=1 THEN concat('MacBook Pro ', p_name) "
             "WHEN p_type='MEDIUM' AND p_partkey%3=1 THEN concat('Apple AirPods ', p_name) ELSE p_name END"),
    ("salePrice", "CASE WHEN p_partkey%97=0 THEN NULL WHEN p_partkey%89=0 THEN CAST(60696.99 AS DOUBLE) "
                  "ELSE CAST((p_partkey*37%500)*4 AS DOUBLE) + CAST(0.99 AS DOUBLE) END"),
    ("url", "concat('https://shop.example.com/site/', p_partkey, '/pdp')"),
    ("addToCartUrl", "concat('https://shop.example.com/site/', p_partkey, '/cart')"),
    ("color", "CASE split_part(p_name,' ',1) WHEN 'red' THEN 'Purple Haze' WHEN 'blue' THEN 'Lilac' "
              "WHEN 'hot' THEN 'violet' ELSE split_part(p_name,' ',1) END"),
    ("onSale", "p_partkey%3<>0"),
    ("active", "p_partkey%10<>0"),
    ("onlineAvailability", "p_partkey%7<>0"),
    ("orderable", "CASE WHEN p_partkey%4<>0 THEN 'Available' ELSE 'SoldOut' END"),
    ("condition", "CASE WHEN p_partkey%5=0 THEN 'refurbished' ELSE 'new' END"),
    ("preowned", "p_partkey%5=0"),
    ("percentSavings", "CAST(p_partkey*7%100 AS DOUBLE)"),
    ("screenSizeClassIn", "CAST(p_size*2 AS DOUBLE)"),
    ("productTemplate", "CASE p_type WHEN 'PROMO' THEN 'Televisions' WHEN 'LARGE' THEN "
                        "'Digital_Signage_Displays_and_Players' WHEN 'MEDIUM' THEN 'Headphones_and_Headsets' "
                        "WHEN 'SMALL' THEN 'Gaming_Controllers' WHEN 'STANDARD' THEN 'Laptops' ELSE 'Desktops' END"),
    ("class", "CASE WHEN p_type='MEDIUM' THEN 'HEADPHONES' ELSE p_type END"),
    ("subclassId", "CASE WHEN p_type='MEDIUM' THEN 410 WHEN p_type='STANDARD' AND p_partkey%2=1 THEN 7835 "
                   "ELSE p_size END"),
    ("manufacturer", "CASE WHEN p_type='MEDIUM' AND p_partkey%3=1 THEN 'Apple' "
                     "WHEN p_type='SMALL' THEN 'Sony Interactive' ELSE p_brand END"),
    ("albumTitle", "CASE WHEN p_type='SMALL' AND p_size%2=0 THEN concat('DualSense Wireless Controller ', p_name) END"),
    ("protectionPlanTerm", "CASE p_size%3 WHEN 0 THEN NULL WHEN 1 THEN 'GSR' ELSE '2yr' END"),
    ("priceUpdateDate", "TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0,0,CAST(p_partkey%43200 AS INT),0)"),
    ("page", "CAST(p_partkey DIV 100 AS INT) + 1"),
    ("pos", "CAST(p_partkey%100 AS INT)"),
    ("categoryPath", "array(named_struct('id','cat00000','name','Shop'),"
                     "named_struct('id',CASE WHEN p_type='MEDIUM' THEN 'abcat0204000' ELSE concat('cat', p_type) END,"
                     "'name',CASE p_type WHEN 'MEDIUM' THEN 'Headphones' WHEN 'STANDARD' THEN "
                     "CASE WHEN p_partkey%2=1 THEN 'MacBooks' ELSE 'Laptops' END "
                     "WHEN 'ECONOMY' THEN 'Desktop Computers' ELSE p_type END))"),
    ("details", "concat(array(named_struct('name',CASE WHEN p_partkey%3=0 THEN 'BRAND' ELSE 'Brand' END,'value',p_brand)), "
                f"CASE WHEN p_partkey%4=0 THEN {_NO_DETAILS} "
                "ELSE array(named_struct('name','Size','value',CAST(p_size AS STRING))) END, "
                "CASE WHEN p_partkey%6=0 THEN array(named_struct('name','brand','value','shadowed')) "
                f"ELSE {_NO_DETAILS} END, "
                "array(named_struct('name','Type','value',CASE WHEN p_partkey%11=0 THEN NULL ELSE p_type END),"
                "named_struct('name','Advanced Graphics Rendering Technique(s)','value',"
                "CASE p_size%4 WHEN 1 THEN 'AMD' WHEN 2 THEN 'Iris' ELSE 'NVIDIA' END),"
                "named_struct('name','GPU Model','value',CASE p_size%5 WHEN 0 THEN '1650 Ti' "
                "WHEN 1 THEN '1660 Super' ELSE '4070' END),"
                "named_struct('name','Noise Cancelling (Active)','value',"
                "CASE WHEN p_size%2=0 THEN 'Noise Canceling' ELSE 'Passive' END),"
                "named_struct('name','Resolution','value',CASE WHEN p_size%3=0 THEN 'Full HD' ELSE '4K' END),"
                "named_struct('name','Processor Model','value',CASE p_size%7 WHEN 0 THEN 'Intel' "
                "WHEN 1 THEN 'Intel Core i7' ELSE 'M3' END)))"),
]

# Every lineitem row is an offer of its part.
OFFER_DAYS = 7
PRODUCTS_PER_PAGE = 100


def products(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The typed product catalogue, one row per sku (narrow over ``part``).

    ``spread`` deals the rows of ``part`` to tasks first: a compact table has few
    splits, and a report does much work per product."""
    part = table(spark, sf_dir, "part")
    if spread:
        part = part.repartition("p_partkey")
    return part.select(*[F.expr(e).alias(n) for n, e in PRODUCT_COLUMNS])


# The order of a product's offers.
OFFER_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def offer_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are offers, with their order key."""
    return table(spark, sf_dir, "lineitem").select("l_partkey", *OFFER_ORDER)


def offer_dates() -> list[Column]:
    """The dates of an offer line; rendered after lines are moved, as texts are wider."""
    day = F.col("l_shipdate").cast("date")
    return [day.cast("string").alias("startDate"), F.date_add(day, OFFER_DAYS).cast("string").alias("endDate")]


def offer_rows(spark: SparkSession, sf_dir: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per offer: ``(sku, offer_pos, startDate, endDate)``.

    ``offer_pos`` is the offer's index in the product's offer list, ordered by
    ship date and then the line's identity.  A task sorts a sku's lines; of a sku
    with over ``hot_rows`` lines it sorts those of one date (``split_rank``), so a
    sku holding a third of all lines is spread over its dates.
    """
    ranked = split_rank(offer_lines(spark, sf_dir), "l_partkey", OFFER_ORDER[0], list(OFFER_ORDER[1:]), "offer_pos", hot_rows)
    return ranked.select(F.col("l_partkey").alias("sku"), F.col("offer_pos").cast("int").alias("offer_pos"), *offer_dates())


def price_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price changes: ``(event_id, sku, priceUpdateDate, salePrice)`` from purchase events."""
    ev = table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == "purchase")
              .select("event_id", F.col("user_id").alias("sku"),
                      F.col("ts").alias("priceUpdateDate"), F.col("value").alias("salePrice")))


# -- the catalogue the searches scan -------------------------------------------

CATALOGUE_PARTITION = "productTemplate"
#: Text fields that conditions compare, stored in lower case as well.
FOLDED_TEXTS = ("name", "color", "orderable", "condition", "class", "manufacturer", "albumTitle", "protectionPlanTerm")


def store_catalogue(catalogue: DataFrame, path: str) -> DataFrame:
    """Write the typed catalogue to a shared folder of the caller's and read it back.

    An explicit step for users who search one catalogue many times:

    * ``partitionBy(productTemplate)``: template predicates (``=``, ``in``,
      prefix, even through ``lower``) become partition filters;
    * range-partitioned on ``(productTemplate, salePrice, sku)`` before the
      write: a template holding a third of the catalogue is spread over many
      tasks instead of one, and each file covers a narrow price range, so
      parquet min/max statistics skip row groups for price predicates;
    * flat columns are stored typed, and compared texts a second time in lower
      case, so boolean, number, timestamp and text conjuncts are pushed to the
      scan.
    """
    catalogue = catalogue.withColumns({FOLDED + c: F.lower(F.col(f"`{c}`")) for c in FOLDED_TEXTS if c in catalogue.columns})
    (catalogue.repartitionByRange(CATALOGUE_PARTITION, "salePrice", "sku")
              .sortWithinPartitions(CATALOGUE_PARTITION, "salePrice", "sku")
              .write.mode("overwrite").partitionBy(CATALOGUE_PARTITION).parquet(path))
    return catalogue.sparkSession.read.schema(catalogue.schema).parquet(path)


def catalogue(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """The catalogue of ``sf_dir``: a narrow view over its tables, derived anew by
    every query; nothing is written or kept."""
    return products(spark, sf_dir, spread)


def catalogue_latest(spark: SparkSession, sf_dir: str) -> Column:
    """The newest ``priceUpdateDate`` as a scalar subquery (runs with the query, over one column)."""
    return products(spark, sf_dir).select(F.max("priceUpdateDate")).scalar()
