"""Flattening a product record into the wide result table.

A ``ProjectionSpec`` names base columns, attribute names looked up in the
``details`` list, and offer fields indexed into a map.  All three are narrow
expressions (``select``), never a ``groupBy().pivot()``, so projecting adds no
exchange however many attributes are asked for.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default projection.
DEFAULT_COLUMNS = ("sku", "name", "salePrice", "url", "addToCartUrl")
DEFAULT_DETAILS = ("Color", "Product Name", "Product Height", "Product Width", "Product Depth",
                   "Product Weight", "Warranty - Labor", "Warranty - Parts")
DEFAULT_OFFERS = ("startDate", "endDate")


@dataclass(frozen=True)
class ProjectionSpec:
    """What to keep.  An empty list and ``None`` both mean "the defaults"."""

    columns: Sequence[str] | None = None
    details: Sequence[str] | None = None
    offers: Sequence[str] | None = None

    def resolved(self) -> "ProjectionSpec":
        return ProjectionSpec(tuple(self.columns or DEFAULT_COLUMNS),
                              tuple(self.details or DEFAULT_DETAILS),
                              tuple(self.offers or DEFAULT_OFFERS))

    def output_names(self, with_offers: bool = False) -> list[str]:
        s = self.resolved()
        names = list(s.columns) + [attribute_alias(d, s.columns) for d in s.details]
        if with_offers:
            names += [offer_column_name(f) for f in s.offers]
        return names


def detail_names(details: str = "details") -> Column:
    """The lower-cased attribute names of a row."""
    return F.transform(F.col(details), lambda d: F.lower(d["name"]))


def detail_value(name: str, details: str = "details", names: Column | None = None) -> Column:
    """Value of the first attribute whose name equals ``name`` ignoring case.

    No match, an empty list, or a matching entry with a null value all give
    null.  The lower-cased name list is the same expression for every
    attribute of a projection (computed once per row), and ``array_position``
    finds the first match without building a filtered array; ``get`` with
    index -1 (no match) is null, also under ANSI mode.  ``names``: a column that
    already has ``detail_names``.
    """
    names = detail_names(details) if names is None else names
    return F.get(F.col(details), F.array_position(names, F.lit(name.lower())) - 1)["value"]


def attribute_alias(name: str, base_columns: Sequence[str] = ()) -> str:
    """Output name of an attribute column.

    Spark resolves names case-insensitively, so an attribute that equals a base
    column up to case (``Color`` next to ``color``) is named ``detail.<name>``.
    """
    taken = {c.lower() for c in base_columns}
    return f"detail.{name}" if name.lower() in taken else name


def detail_columns(names: Sequence[str], details: str = "details",
                   base_columns: Sequence[str] = ()) -> list[Column]:
    """One column per attribute name, in order (the narrow "pivot")."""
    return [detail_value(n, details).alias(attribute_alias(n, base_columns)) for n in names]


def offer_column_name(field: str) -> str:
    return f"offer.{field}"


def offer_map(field: str, offers: str = "offers") -> Column:
    """``MAP<INT,STRING>`` offer position -> ``field`` ({} for no offers; null values kept)."""
    return F.map_from_entries(
        F.transform(F.col(offers), lambda o, i: F.struct(i.alias("key"), o[field].alias("value"))))


def flatten(df: DataFrame, spec: ProjectionSpec, with_offers: bool = True,
            keep: Sequence[str] = ()) -> DataFrame:
    """The wide table: base columns, attribute columns, then ``offer.<field>`` maps.

    ``keep`` carries extra columns (sort keys, tags) through the projection.
    """
    s = spec.resolved()
    cols: list[Column] = [F.col(f"`{c}`") for c in s.columns]
    cols += detail_columns(s.details, base_columns=s.columns)
    if with_offers:
        cols += [offer_map(f).alias(offer_column_name(f)) for f in s.offers]
    extra = [F.col(k) for k in keep if k not in s.columns]
    return df.select(*cols, *extra)


def offer_entries(offers: DataFrame, spec: ProjectionSpec) -> DataFrame:
    """The offer maps in normalized (exploded) form: ``(sku, offer_pos, <field>...)``.

    This is the scalable shape of ``offer.<field>``: no per-product collection,
    one row per offer.
    """
    s = spec.resolved()
    return offers.select("sku", "offer_pos", *[F.col(f).alias(offer_column_name(f)) for f in s.offers])
