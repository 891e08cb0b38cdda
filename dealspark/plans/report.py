"""Reports: result shape per query, rendered HTML rows, digest headers, documents.

Rendering is per row (``concat`` of escaped cells), so it runs in parallel like
any projection.  A "document" is kept as ordered lines - ``(doc_line, text)``
with distributed ranks - and written with ``write_document`` as ordered text
part files; it is never assembled into one string in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealspark.functions.text import link_rewrite
from dealspark.operators.compose import OFFER_POS, latest_update, pack_order, tag_pack
from dealspark.operators.projection import (ProjectionSpec, attribute_alias, detail_names, detail_value, offer_column_name,
                                            offer_entries)
from dealspark.operators.ranking import Asc, running_sum, stepped_rank
from dealspark.plans.packs import SavedQuery, shared
from dealspark.session import stored

URL_COLUMNS = ("url", "addToCartUrl")


def escape_html(c: Column) -> Column:
    """Escape ``&``, ``<``, ``>`` (``&`` first), as the HTML table writer does."""
    out = F.replace(c, F.lit("&"), F.lit("&amp;"))
    out = F.replace(out, F.lit("<"), F.lit("&lt;"))
    return F.replace(out, F.lit(">"), F.lit("&gt;"))


def cell_text(c: Column, dtype: str) -> Column:
    """Text of one cell: booleans ``True``/``False``, timestamps ``yyyy-MM-dd HH:mm:ss``,
    numbers in plain decimal notation; missing numbers ``NaN``, other missing values ``None``."""
    missing = "None"
    if dtype == "boolean":
        txt = F.when(c, F.lit("True")).when(~c, F.lit("False"))
    elif dtype.startswith("timestamp"):
        txt = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    elif dtype in ("double", "float"):
        missing = "NaN"
        txt = F.regexp_replace(c.cast("decimal(38,6)").cast("string"), r"(\.\d+?)0+$", "$1")
    else:
        txt = c.cast("string")
    return F.coalesce(txt, F.lit(missing))


def _td(name: str, col: Column, dtype: str) -> Column:
    """A ``<td>`` cell; URL cells become anchors (SCL-2)."""
    txt = escape_html(cell_text(col, dtype))
    return F.concat(F.lit("<td>"), link_rewrite(txt) if name in URL_COLUMNS else txt, F.lit("</td>"))


def _tds(cells: Sequence[tuple[str, Column, str]]) -> Column:
    return F.concat(*[_td(*c) for c in cells])


def heading_html(names: Sequence[str]) -> Column:
    """The row of column headings."""
    return F.concat(F.lit("<tr><th></th>"), *[F.concat(F.lit("<th>"), escape_html(F.lit(n)), F.lit("</th>")) for n in names],
                    F.lit("</tr>"))


def line_html(index: Column, cells: Column, n_cells: int, offer_fields: Sequence[str]) -> Column:
    """One line of a result row with its offers exploded: the first line holds
    the row's cells and its first offer, a further line only another offer, so
    every line has the full width.  An offer cell reads ``position: value``;
    ``{}`` stands for no offers."""
    pos = F.col(OFFER_POS)
    first = F.coalesce(pos, F.lit(0)) == 0
    head = F.when(first, F.concat(F.lit("<tr><th>"), index.cast("string"), F.lit("</th>"), cells)).otherwise(
        F.lit("<tr><th></th>" + "<td></td>" * n_cells))
    offers = [F.concat(F.lit("<td>"), F.when(pos.isNull(), F.lit("{}")).otherwise(F.concat(
        pos.cast("string"), F.lit(": "), escape_html(cell_text(F.col(f"`{offer_column_name(f)}`"), "string")))), F.lit("</td>"))
        for f in offer_fields]
    return F.concat(head, *offers, F.lit("</tr>"))


def render_rows(result: DataFrame, query: SavedQuery, rank_col: str = "rank") -> DataFrame:
    """RPT-1 over a ranked search result with exploded offers (``add_offers``):
    ``(rank, offer_pos, row_html)``; the headings come first, at -1."""
    types = dict(result.dtypes)
    names = query.spec.output_names()
    cells = _tds([(c, F.col(f"`{c}`"), types[c]) for c in names])
    fields = query.spec.resolved().offers
    body = result.select(F.col(rank_col), F.coalesce(OFFER_POS, F.lit(0)).alias(OFFER_POS),
                         line_html(F.col(rank_col), cells, len(names), fields).alias("row_html"))
    head = result.sparkSession.range(1).select(
        F.lit(-1).cast("long").alias(rank_col), F.lit(-1).alias(OFFER_POS),
        heading_html(query.spec.output_names(with_offers=True)).alias("row_html"))
    return head.unionByName(body)


def shape(catalogue: DataFrame, queries: Sequence[SavedQuery], now: Column | None = None,
          tag: str = "query_name") -> DataFrame:
    """AGG-1: ``(query_name, pack_order, n_rows, n_cols)`` for every query of a pack.

    One pass over the products that meet what all queries share, one conditional count per
    query (``count_if``): each partition
    sends one partial row to the final aggregate, and no product is repeated
    per query.  The single result row is then unpacked to one row per query;
    an empty result has shape (0, 0).
    """
    now = latest_update(catalogue) if now is None else now
    counts = catalogue.where(shared(queries, now, catalogue.columns)).agg(*[F.count_if(F.coalesce(q.where(now, catalogue.columns), F.lit(False))).alias(f"__c{i}")
                             for i, q in enumerate(queries)])
    per_query = F.array(*[F.struct(F.lit(q.name).alias(tag), F.lit(i).alias("pack_order"),
                                   F.col(f"__c{i}").cast("long").alias("n_rows"),
                                   F.lit(len(q.spec.output_names(with_offers=True))).alias("width"))
                          for i, q in enumerate(queries)])
    rows = counts.select(F.explode(per_query).alias("s")).select("s.*")
    return rows.select(tag, "pack_order", "n_rows",
                       F.when(F.col("n_rows") > 0, F.col("width")).otherwise(F.lit(0)).cast("int").alias("n_cols"))


def shape_text(n_rows: Column, n_cols: Column) -> Column:
    return F.concat(F.lit("("), n_rows.cast("string"), F.lit(", "), n_cols.cast("string"), F.lit(")"))


def digest(shapes: DataFrame, since: Column, tag: str = "query_name") -> DataFrame:
    """RPT-2: the mail header per query: "New deals since" and "total shape"."""
    # The header's text.
    header = F.concat(F.lit("<p>New deals since: "), since, F.lit("</p><br/>\n<p>total shape: "),
                      shape_text(F.col("n_rows"), F.col("n_cols")), F.lit("</p></br>"))
    return shapes.select(tag, "n_rows", "n_cols", header.alias("header"))


def _pack_cells(catalogue: DataFrame, queries: Sequence[SavedQuery]) -> tuple[Column, list[tuple[Column, int]]]:
    """The cells that some query shows, each rendered once, as a struct to be named
    ``__td``, and per query its cells out of it and their number.  The catalogue has
    ``detail_names`` as ``__names``."""
    types = dict(catalogue.dtypes)
    at: dict[tuple[str, bool], int] = {}
    rendered: list[Column] = []
    out = []
    for q in queries:
        s = q.spec.resolved()
        own = []
        for name, detail in [(c, False) for c in s.columns] + [(d, True) for d in s.details]:
            if (name, detail) not in at:
                at[name, detail] = len(rendered)
                cell = (attribute_alias(name, s.columns), detail_value(name, names=F.col("__names")), "string") if detail else (
                    name, F.col(f"`{name}`"), types[name])
                rendered.append(_td(*cell).alias(f"c{len(rendered)}"))
            own.append(F.col(f"__td.c{at[name, detail]}"))
        out.append((F.concat(*own), len(own)))
    return F.struct(*rendered), out


def document_lines(catalogue: DataFrame, queries: Sequence[SavedQuery], offers: DataFrame, now: Column | None = None,
                   tag: str = "query_name") -> DataFrame:
    """AGG-4: the pack document as ordered lines ``(doc_line, text)``.

    Per query, in pack order: a block header ``"<name> (<rows>, <cols>):</br>"``,
    the column headings, the rendered rows in result order with their offers
    (``line_html``), and a closing ``"</br>"``.  As in the HTTP report, a row's
    index is its landing position within the query's results (page, then
    position), kept through the price sort.

    The catalogue is read once: each match is written with its order keys and its
    rendered cells, then with its landing index, which counts the matches of earlier
    blocks of pages.  Only the matches, without their cells, are put in order: a
    match's first line comes after all lines of the matches before it, and
    ``offer_pos`` (gapless from 0 per sku) tells where an offer's line stands from
    there, so the offers are joined on the way out and neither written nor sorted by
    line.  Repeated products take turns.  The counts before each query are a table
    with one row per query of the pack.
    """
    now = latest_update(catalogue) if now is None else now
    order = ["pack_order", Asc("salePrice", True), Asc("name", True), "page", "pos", "sku"]
    matches = tag_pack(catalogue, queries, now, tag).withColumn("pack_order", pack_order(queries, tag))
    each, cells = _pack_cells(catalogue, queries)
    # Generated, so that the attribute names are stated once and not for every cell, and a cell not for every query.
    matches = matches.withColumn("__names", F.explode(F.array(detail_names()))).withColumn("__td", F.explode(F.array(each)))
    rendered = _chosen([c for c, _ in cells], F.col(tag), [q.name for q in queries])
    matches = stored(matches.select(F.monotonically_increasing_id().alias("__id"), "pack_order", "sku", "salePrice", "name", "page",
                                    "pos", rendered.alias("cells"), F.floor(F.col("page") / PAGE_BLOCK).alias("__block")), "document")
    placed = stored(stepped_rank(matches.drop("cells"), ["pack_order"], "__block", ["page", "pos"], "__index").drop("__block"), "document")
    names = sorted({f for q in queries for f in q.spec.resolved().offers})
    entries = offer_entries(offers, ProjectionSpec(offers=names)).withColumnRenamed("sku", "__offer_sku")
    # A product that comes more than once: its rows take turns, offer by offer.
    twins = Window.partitionBy(*[k.name if isinstance(k, Asc) else k for k in order])
    placed = placed.select("*", F.count(F.lit(1)).over(twins).alias("__twins"),
                           (F.row_number().over(twins.orderBy("__index")) - 1).alias("__twin"))
    counts = entries.groupBy("__offer_sku").agg(F.count(F.lit(1)).alias("__offers"))
    placed = (placed.join(counts, F.col("__offer_sku") == F.col("sku"), "left").drop("__offer_sku").na.fill(0, ["__offers"])
              .withColumn("__lines", F.greatest("__offers", F.lit(1))))
    placed = running_sum(placed, [*order, "__twin"], "__lines", "__before").select(
        "__id", "__index", "__offers", "__lines", "__twins",
        (F.col("__before") - F.col("__twin") * F.col("__lines") + F.col("__twin")).alias("__first"))
    matches = stored(matches.select("__id", "pack_order", "sku", "cells").join(placed, "__id").drop("__id"), "document")
    # The offers drive the join, so that a product with very many of them can be split; only a
    # match's first line shows its cells.
    some = entries.join(matches, F.col("__offer_sku") == F.col("sku")).drop("__offer_sku")
    lines = some.unionByName(matches.where(F.col("__offers") == 0), allowMissingColumns=True)
    at = F.coalesce(OFFER_POS, F.lit(0))
    at = F.when(at < F.col("__lines"), F.col("__first") + at * F.col("__twins")).otherwise(
        F.raise_error(F.lit("the offers of a product are not numbered without gaps")).cast("long"))

    # One row per query of the pack: the single-partition window is bounded.
    before = Window.orderBy("pack_order").rowsBetween(Window.unboundedPreceding, -1)
    listed = catalogue.sparkSession.createDataFrame(
        [(q.name, i, len(q.spec.output_names(with_offers=True))) for i, q in enumerate(queries)], f"{tag} string, pack_order int, width int")
    bodies = matches.groupBy("pack_order").agg(F.sum("__lines").alias("__lines"), F.count(F.lit(1)).alias("n_rows"))
    starts = (listed.join(bodies, "pack_order", "left").na.fill(0, ["__lines", "n_rows"])
              .withColumn("n_cols", F.when(F.col("n_rows") > 0, F.col("width")).otherwise(F.lit(0)))
              .withColumn("__at", F.coalesce(F.sum("__lines").over(before), F.lit(0)).cast("long") + 3 * F.col("pack_order")))
    fixed = F.explode(F.array(
        F.struct(F.col("__at").alias("doc_line"), F.concat(
            F.col(tag), F.lit(" "), shape_text(F.col("n_rows"), F.col("n_cols")), F.lit(":</br>")).alias("text")),
        F.struct((F.col("__at") + 1).alias("doc_line"), _chosen(
            [heading_html(q.spec.output_names(with_offers=True)) for q in queries]).alias("text")),
        F.struct((F.col("__at") + F.col("__lines") + 2).alias("doc_line"), F.lit("</br>").alias("text"))))
    frame = starts.select(fixed.alias("l")).select("l.*")

    html = [line_html(F.col("__index"), F.col("cells"), n, q.spec.resolved().offers) for q, (_, n) in zip(queries, cells)]
    body = lines.select((at + 3 * F.col("pack_order") + 2).alias("doc_line"), _chosen(html).alias("text"))
    return frame.unionByName(body)


#: Pages of one step of a landing index: a task sorts the matches of a block, and counts of blocks are few.
PAGE_BLOCK = 1000


def _chosen(per_query: Sequence[Column], of: Column | None = None, keys: Sequence | None = None) -> Column:
    """The entry of the row's query, told by its place in the pack or another key."""
    of = F.col("pack_order") if of is None else of
    keys = range(len(per_query)) if keys is None else keys
    out = None
    for k, c in zip(keys, per_query):
        out = F.when(of == k, c) if out is None else out.when(of == k, c)
    return out


def write_document(lines: DataFrame, path: str) -> None:
    """Write ordered lines as text; part files in name order concatenate to the document."""
    lines.orderBy("doc_line").select("text").write.mode("overwrite").text(path)


def since_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
