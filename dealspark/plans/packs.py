"""Saved searches and packs of them.

A saved search is a predicate over the catalogue plus a projection spec.  The
predicate receives ``now`` (a ``TIMESTAMP_NTZ`` column, UTC) so that searches
with a lookback cutoff are deterministic: queries pass the latest
``priceUpdateDate`` of the data, a live run passes the clock.

The searches themselves are data: a list of conditions per search, each
``(operator, field, value)``, turned into ``Column`` predicates by
``conditions_to_predicate``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealspark.functions import timefns as T
from dealspark.operators import predicates as P
from dealspark.operators.projection import ProjectionSpec


@dataclass(frozen=True)
class SavedQuery:
    name: str
    subject: str
    predicate: Callable[[Column], Column]
    spec: ProjectionSpec = field(default_factory=ProjectionSpec)
    top_k: int | None = None

    def where(self, now: Column, columns: Sequence[str] = ()) -> Column:
        """The predicate over a catalogue with ``columns``; conditions use its case-folded copies."""
        if isinstance(self.predicate, Conjunction):
            return self.predicate(now, P.folded_fields(columns))
        return self.predicate(now)


# -- conditions -> predicates --------------------------------------------------

Condition = tuple

# Operators whose test scans a list field (or splits text): evaluated after the
# flat ones, which can reach the parquet scan and are cheap per row.
_LIST_OPERATORS = {"any_eq", "any_prefix", "none_eq", "none_prefix", "search", "any_of"}


def _one(cond: Condition, now: Column, folded: frozenset[str] = frozenset()) -> Column:
    op, *args = cond
    if op == "eq":
        return P.eq(*args, folded=folded)
    if op == "ne":
        return P.ne(*args, folded=folded)
    if op == "lt":
        return P.lt(*args)
    if op == "gt":
        return P.gt(*args)
    if op == "prefix":
        return P.prefix(*args, folded=folded)
    if op == "in":
        return P.isin(*args, folded=folded)
    if op == "after":  # field changed after "now - minutes" as wall clock in zone
        fld, minutes, zone = args
        return P.gt_ts(fld, T.cutoff(now, minutes, zone))
    if op == "any_eq":
        return P.any_eq(*args)
    if op == "any_prefix":
        return P.any_prefix(*args)
    if op == "none_eq":
        return P.none_eq(*args)
    if op == "none_prefix":
        return P.none_prefix(*args)
    if op == "search":
        return P.search(*args)
    if op == "any_of":
        return P.any_of(*[_one(c, now, folded) for c in args[0]])
    raise ValueError(f"unknown condition {cond!r}")


@dataclass(frozen=True)
class Conjunction:
    """AND of conditions; flat conditions are placed before list ones."""

    conditions: tuple[Condition, ...]

    def __call__(self, now: Column, folded: frozenset[str] = frozenset()) -> Column:
        flat = [c for c in self.conditions if c[0] not in _LIST_OPERATORS]
        lists = [c for c in self.conditions if c[0] in _LIST_OPERATORS]
        return P.all_of(*[_one(c, now, folded) for c in [*flat, *lists]])


def conditions_to_predicate(conditions: Sequence[Condition]) -> Conjunction:
    return Conjunction(tuple(conditions))


def shared(queries: Sequence[SavedQuery], now: Column, columns: Sequence[str] = ()) -> Column:
    """What every search of a pack asks for: a filter that the scan can take
    before the searches are told apart.  True when a search is no list of
    conditions or they have none in common."""
    lists = [q.predicate.conditions if isinstance(q.predicate, Conjunction) else () for q in queries]
    common = tuple(c for c in lists[0] if all(c in other for other in lists[1:]))
    return Conjunction(common)(now, P.folded_fields(columns)) if common else F.lit(True)


# The saved searches.  Conditions are listed in the order the
# searches state them; attribute and column lists as the searches request them.
AVAILABLE = "Available"
EXCLUDED_PRICE = 60696.99
TV_TEMPLATES = ("Televisions", "Digital_Signage_Displays_and_Players", "Portable_TVs_and_Video")
PURPLE_SHADES = ("purple", "lilac", "lavender", "violet", "amethyst", "plum")
HEADPHONE_ATTRS = ("Headphone Fit", "Microphone Features", "Sound Isolating", "Built-In Microphone",
                   "Noise Cancelling (Active)", "Battery Life")
TV_ATTRS = ("Built-In Speakers", "Resolution", "Display Type", "Screen Size Class", "Screen Size",
            "Curved Screen")
LAPTOP_ATTRS = ("Graphics", "Processor Model", "System Memory (RAM)", "Solid State Drive Capacity")
GPU_ATTRS = ("Advanced Graphics Rendering Technique(s)", "GPU Video Memory (RAM)", *LAPTOP_ATTRS)
PRICE_FEED_COLUMNS = ("salePrice", "name", "url", "addToCartUrl", "priceUpdateDate")
CONTROLLER_COLUMNS = ("salePrice", "name", "color", "url", "addToCartUrl")
MACBOOK_COLUMNS = ("sku", "name", "salePrice", "onSale", "url", "addToCartUrl")

DAILY_CUTOFF = ("after", "priceUpdateDate", T.DAILY_LOOKBACK_MINUTES, T.DAILY_ZONE)
FREQUENT_CUTOFF = ("after", "priceUpdateDate", T.FREQUENT_LOOKBACK_MINUTES, T.FREQUENT_ZONE)

AIRPODS = [("search", "airpods"), ("eq", "manufacturer", "apple"), ("any_eq", "categoryPath.id", "abcat0204000"),
           ("eq", "orderable", AVAILABLE), ("eq", "onlineAvailability", True), ("eq", "active", True),
           ("eq", "onSale", True), ("ne", "protectionPlanTerm", "gsr")]


def gpu(category: str) -> list[Condition]:
    return [("any_prefix", "categoryPath.name", category), ("eq", "onSale", True), ("eq", "orderable", AVAILABLE),
            ("eq", "onlineAvailability", True), ("eq", "active", True), ("any_eq", "details.value", "nvidia"),
            ("none_prefix", "details.value", "1650"), ("none_prefix", "details.value", "1660")]


# name, subject, conditions, columns, attributes, offers, top_k
SEARCHES = [
    ("discount", "Discount>50% deals",
     [DAILY_CUTOFF, ("eq", "onSale", True), ("eq", "active", True), ("gt", "percentSavings", 50),
      ("ne", "salePrice", EXCLUDED_PRICE)],
     PRICE_FEED_COLUMNS, [], None, None),
    ("headphones", "Headphones noise cancelling deals",
     [("eq", "productTemplate", "Headphones_and_Headsets"), ("eq", "class", "HEADPHONES"), ("eq", "subclassId", 410),
      ("any_prefix", "details.value", "noise cancel"), ("eq", "orderable", AVAILABLE),
      ("eq", "onlineAvailability", True), ("eq", "active", True), ("eq", "onSale", True)],
     None, HEADPHONE_ATTRS, [], None),
    ("airpods", "Airpods deals", AIRPODS, None, HEADPHONE_ATTRS, [], None),
    ("ps5 controller", "Controller (Playstation 5) deals",
     [("eq", "productTemplate", "Gaming_Controllers"), ("prefix", "manufacturer", "Sony"),
      ("prefix", "albumTitle", "DualSense Wireless Controller"), ("eq", "orderable", AVAILABLE),
      ("eq", "onlineAvailability", True), ("eq", "active", True), ("eq", "onSale", True)],
     CONTROLLER_COLUMNS, [], [], None),
    ("television", "Television deals",
     [("in", "productTemplate", TV_TEMPLATES), ("gt", "screenSizeClassIn", 84), ("lt", "salePrice", 1000),
      ("none_eq", "details.value", "Full HD"), ("eq", "onSale", True), ("eq", "orderable", AVAILABLE),
      ("eq", "onlineAvailability", True), ("eq", "active", True)],
     None, TV_ATTRS, [], None),
    ("macbook", "Macbook deals",
     [("prefix", "name", "macbook pro"), ("any_prefix", "categoryPath.name", "macbook"),
      ("none_eq", "details.value", "intel"), ("eq", "orderable", AVAILABLE), ("eq", "onlineAvailability", True),
      ("eq", "onSale", True), ("eq", "active", True), ("eq", "preowned", False), ("eq", "subclassId", 7835)],
     MACBOOK_COLUMNS, LAPTOP_ATTRS, [], None),
    ("nvidia", "Laptops with Nvidia graphics", gpu("laptop"), None, GPU_ATTRS, [], None),
    ("desktop", "Desktops with Nvidia graphics", gpu("desktop"), None, GPU_ATTRS, [], None),
    ("purple", "Purple deals",
     [("eq", "onSale", True), ("eq", "condition", "new"), ("eq", "active", True),
      ("any_of", [("prefix", "color", shade) for shade in PURPLE_SHADES])],
     PRICE_FEED_COLUMNS, [], None, None),
    ("airpods recent", "AirpodsRecent deals", [*AIRPODS, FREQUENT_CUTOFF], None, HEADPHONE_ATTRS, [], None),
    ("macbook cheap", "MacbookCheap deals",
     [("any_prefix", "categoryPath.name", "macbook"), ("lt", "salePrice", 1000),
      ("none_prefix", "details.value", "intel"), ("eq", "orderable", AVAILABLE), ("eq", "onlineAvailability", True),
      ("eq", "onSale", True), ("eq", "active", True)],
     None, LAPTOP_ATTRS, None, None),
    ("nvidia cheap", "LaptopsCheap with Nvidia graphics",
     [("any_prefix", "categoryPath.name", "laptop"), ("lt", "salePrice", 1000), *gpu("laptop")[1:]],
     None, GPU_ATTRS, None, None),
    ("television top10", "TelevisionTop ten",
     [("in", "productTemplate", ["Televisions"]), ("gt", "screenSizeClassIn", 39), ("lt", "salePrice", 999)],
     None, None, None, 10),
    ("nvidia top10", "LaptopsTop ten",
     [("any_prefix", "categoryPath.name", "laptop"), ("eq", "onSale", True), ("any_eq", "details.value", "nvidia")],
     None, None, None, 10),
]

SAVED_QUERIES: dict[str, SavedQuery] = {
    name: SavedQuery(name, subject, conditions_to_predicate(conds), ProjectionSpec(cols, attrs, offers), top_k)
    for name, subject, conds, cols, attrs, offers, top_k in SEARCHES
}

# The packs the searches were run in (HTTP pack, frequent timer, daily timer, script).
HTTP_PACK = ("discount", "headphones", "airpods", "ps5 controller", "television", "macbook", "nvidia",
             "desktop", "purple")
FREQUENT_PACK = ("airpods recent",)
DAILY_PACK = ("purple", "macbook", "nvidia", "television", "ps5 controller", "headphones", "airpods")
SCRIPT_PACK = ("macbook cheap", "nvidia cheap")


def base() -> list[Column]:
    """Orderable online now and on sale (the common part of most searches)."""
    return [P.eq("orderable", AVAILABLE), P.eq("onlineAvailability", True),
            P.eq("active", True), P.eq("onSale", True)]


def pack(names) -> list[SavedQuery]:
    return [SAVED_QUERIES[n] for n in names]


# A large pack, one search per brand, template and price limit.
GRID_BRANDS = tuple(f"Brand#{n}" for n in range(10, 60))
GRID_TEMPLATES = ("Televisions", "Digital_Signage_Displays_and_Players", "Headphones_and_Headsets", "Gaming_Controllers",
                  "Laptops", "Desktops")
GRID_LIMITS = (200, 400, 700, 1000, 1300, 1600, 1900)


def grid_pack() -> list[SavedQuery]:
    """2,100 searches: a brand's products of a template, under a price, active, without Intel."""
    return [SavedQuery(f"{b} {t} under {limit}", f"{b} {t}", conditions_to_predicate(
        [("eq", "manufacturer", b), ("eq", "productTemplate", t), ("lt", "salePrice", limit), ("eq", "active", True),
         ("none_prefix", "details.value", "intel")])) for b in GRID_BRANDS for t in GRID_TEMPLATES for limit in GRID_LIMITS]
