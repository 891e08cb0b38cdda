"""Running searches: filter, project, order, rank, slice, and whole packs in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealspark.operators.projection import (ProjectionSpec, attribute_alias, detail_columns, detail_value,
                                            offer_column_name, offer_entries)
from dealspark.operators.ranking import Asc, global_rank, keyed_rank
from dealspark.plans.packs import SavedQuery, shared
from dealspark.session import stored

# Result order: price, then name, ascending with missing values last; page and
# position make it a total order (ties keep landing order).
TIE_BREAK = ("page", "pos")


SORT_KEYS = ("salePrice", "name", *TIE_BREAK)
_SORT, _SKU = "__sort_", "__sku"


def result_order(prefix: str = "") -> list[Asc]:
    """The result order over ``salePrice, name, page, pos`` (optionally carried
    under ``prefix``-ed names)."""
    return [Asc(f"{prefix}{k}", nulls_last=k not in TIE_BREAK) for k in SORT_KEYS]


def _by(prefix: str = "") -> list[Column]:
    return [k.column() for k in result_order(prefix)]


def latest_update(catalogue: DataFrame) -> Column:
    """``max(priceUpdateDate)`` as a scalar subquery: the deterministic "now"."""
    return catalogue.select(F.max("priceUpdateDate")).scalar()


def rank_by_order(df: DataFrame, out: str = "rank") -> DataFrame:
    """0-based rank in result order, computed without a single-partition window."""
    return global_rank(df, result_order(), out=out)


def top_k(df: DataFrame, k: int, out: str = "rank", prefix: str = "") -> DataFrame:
    """The first ``k`` rows in result order (TakeOrderedAndProject: per-partition
    top-k, then a merge of at most ``k`` rows per partition), numbered 0..k-1."""
    head = df.orderBy(*_by(prefix)).limit(k)
    # At most k rows remain, so numbering them in one partition is bounded.
    return head.withColumn(out, (F.row_number().over(Window.orderBy(*_by(prefix))) - 1).cast("long"))


def page_slice(df: DataFrame, page: int, page_size: int, out: str = "rank") -> DataFrame:
    """Page ``page`` (1-based) of ``page_size`` rows in result order: the head up
    to that page is taken, not the whole frame ranked."""
    return top_k(df, page * page_size, out).where(F.col(out) >= (page - 1) * page_size)


def select_spec(df: DataFrame, spec: ProjectionSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Base columns and attribute columns of ``spec`` (offer maps kept apart)."""
    s = spec.resolved()
    cols = [F.col(f"`{c}`") for c in s.columns] + detail_columns(s.details, base_columns=s.columns)
    return df.select(*cols, *[F.col(k) for k in keep if k not in s.columns])


def run_search(catalogue: DataFrame, q: SavedQuery, now: Column | None = None,
               rank_col: str = "rank") -> DataFrame:
    """One saved search: filter, project, and number rows in result order.

    The sort keys ride along, under internal names, only until the rank is
    computed.
    """
    now = latest_update(catalogue) if now is None else now
    hits = catalogue.where(q.where(now, catalogue.columns))
    s = q.spec.resolved()
    carried = [F.col(k).alias(f"{_SORT}{k}") for k in SORT_KEYS]  # never clash with output names
    projected = hits.select(*[F.col(f"`{c}`") for c in s.columns],
                            *detail_columns(s.details, base_columns=s.columns), *carried)
    if q.top_k:
        ranked = top_k(projected, q.top_k, rank_col, prefix=_SORT)
    else:
        ranked = global_rank(projected, result_order(_SORT), out=rank_col)
    out = q.spec.output_names() + [rank_col]
    return ranked.select(*[F.col(f"`{c}`") for c in out])


# -- packs -------------------------------------------------------------------

def tag_pack(catalogue: DataFrame, queries: Sequence[SavedQuery], now: Column | None = None,
             tag: str = "query_name") -> DataFrame:
    """Every (product, matching query) pair from **one** scan of the catalogue.

    The conditions that all queries share filter first, so that they reach the
    scan and fewer products are tagged.  Each query
    contributes ``when(pred, name)``; a product matching several is repeated,
    once per query.  (A higher-order ``filter`` cannot hold the scalar "now"
    subquery.)
    """
    now = latest_update(catalogue) if now is None else now
    tags = F.array(*[F.when(q.where(now, catalogue.columns), F.lit(q.name)) for q in queries])
    return (catalogue.where(shared(queries, now, catalogue.columns)).withColumn(tag, F.explode(tags))
            .where(F.col(tag).isNotNull()))


def pack_order(queries: Sequence[SavedQuery], tag: str = "query_name") -> Column:
    """Position of the query in its pack (0-based), as a column."""
    expr = None
    for i, q in enumerate(queries):
        expr = F.when(F.col(tag) == q.name, F.lit(i)) if expr is None else expr.when(F.col(tag) == q.name, F.lit(i))
    return expr


def pack_wide(catalogue: DataFrame, queries: Sequence[SavedQuery], now: Column | None = None,
              tag: str = "query_name", rank_col: str = "rank", with_sku: bool = False) -> DataFrame:
    """The stacked results of a pack in one wide table (union-by-name semantics).

    Rather than scanning once per query and ``unionByName``-ing frames whose
    columns differ, the catalogue is scanned once, tagged, and each output
    column is kept only for the queries that project it (null elsewhere).
    Rows are ranked per query; the pack's query count bounds the per-key table.
    """
    tagged = tag_pack(catalogue, queries, now, tag)
    columns: dict[str, list[str]] = {}
    details: dict[str, list[str]] = {}
    for q in queries:
        s = q.spec.resolved()
        for c in s.columns:
            columns.setdefault(c, []).append(q.name)
        for d in s.details:
            details.setdefault(d, []).append(q.name)
    sel = [F.col(tag)]
    for c, owners in columns.items():
        sel.append(F.when(F.col(tag).isin(owners), F.col(f"`{c}`")).alias(c))
    for d, owners in details.items():
        sel.append(F.when(F.col(tag).isin(owners), detail_value(d)).alias(attribute_alias(d, list(columns))))
    keep = [F.col(k).alias(f"{_SORT}{k}") for k in SORT_KEYS] + [F.col("sku").alias(_SKU)]
    ranked = keyed_rank(tagged.select(*sel, *keep), tag, result_order(_SORT), out=rank_col)
    dropped = [f"{_SORT}{k}" for k in SORT_KEYS] + ([] if with_sku else [_SKU])
    return ranked.drop(*dropped)


# -- offers --------------------------------------------------------------------

OFFER_POS = "offer_pos"


def pack_hits(catalogue: DataFrame, queries: Sequence[SavedQuery], now: Column | None = None,
              tag: str = "query_name", rank_col: str = "rank") -> DataFrame:
    """``(query_name, sku, rank)`` of every result row of a pack, from one scan."""
    keep = [F.col(k).alias(f"{_SORT}{k}") for k in SORT_KEYS]
    tagged = tag_pack(catalogue, queries, now, tag).select(tag, "sku", *keep)
    ranked = keyed_rank(tagged, tag, result_order(_SORT), out=rank_col).select(tag, "sku", rank_col)
    limits = [(q.name, q.top_k) for q in queries if q.top_k]
    for name, k in limits:
        ranked = ranked.where((F.col(tag) != name) | (F.col(rank_col) < k))
    return ranked


def add_offers(rows: DataFrame, offers: DataFrame, sku: str = _SKU, fields: Sequence[str] | None = None) -> DataFrame:
    """Result rows with their offers, one row per (result row, offer).

    The scalable form of the ``offer.<field>`` maps: nothing is collected per
    product.  A row without offers stays, with null offer columns.  The offers
    drive the join, so a product with very many of them can be split.  The rows and
    the joined lines are written to the shared scratch folder, so that a ranked
    result and the numbered offers are computed once.
    """
    spec = ProjectionSpec(offers=fields)
    entries = offer_entries(offers, spec).withColumnRenamed("sku", "__offer_sku")
    names = [OFFER_POS, *[offer_column_name(f) for f in spec.resolved().offers]]
    columns = [F.col(f"`{c}`") for c in [*rows.columns, *names]]
    rows = stored(rows, "offer-rows")
    some = stored(entries.join(rows, F.col("__offer_sku") == F.col(f"`{sku}`")).select(*columns), "offer-lines")
    with_any = some.where(F.col(OFFER_POS) == 0).select(F.col(f"`{sku}`").alias("__offer_sku")).distinct()
    none = rows.join(with_any, F.col("__offer_sku") == F.col(f"`{sku}`"), "left_anti")
    types = dict(entries.dtypes)
    return some.unionByName(none.select("*", *[F.lit(None).cast(types[n]).alias(n) for n in names]))


def pack_offers(catalogue: DataFrame, queries: Sequence[SavedQuery], offers: DataFrame,
                now: Column | None = None, tag: str = "query_name") -> DataFrame:
    """``(query_name, rank, offer_pos, offer.<field>...)`` of every result row's offers."""
    hits = pack_hits(catalogue, queries, now, tag)
    entries = offer_entries(offers, ProjectionSpec())
    names = [F.col(f"`{c}`") for c in entries.columns if c != "sku"]
    return entries.join(hits, "sku").select(tag, "rank", *names)
