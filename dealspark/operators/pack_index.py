"""Large packs of searches by a predicate index: the searches are data, not expressions.

``tag_pack`` holds one predicate per search, which suits a pack of tens.  For
thousands, the conditions of all searches become rows of a small table.  A
product states its *facts* once - one text per tested value, such as
``=manufacturer:apple``, ``^name:macbook`` or ``?name:airpods`` - and one array of
its tested numbers.  Each search is filed under one condition it requires (the
rarest one); a product's facts fetch the searches filed under them from a
broadcast table, and only those are verified against all of the product's facts
and numbers: required facts present, forbidden ones absent, numbers within
bounds.  That is one scan, one broadcast join and no shuffle, with a plan whose
size follows the tested fields, not the searches.

Conditions have the meaning of ``predicates``: text compares case-insensitively,
positive conditions never match a missing value, negative ones keep it.  A
disjunction may hold equalities, prefixes and words; other conditions in one, or
predicates that are no list of conditions, raise ``ValueError`` (use
``tag_pack``).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.operators.predicates import FOLDED
from dealspark.plans.packs import Condition, Conjunction, SavedQuery

#: Rows of the index up to which it is broadcast; beyond, the planner decides.
BROADCAST_ROWS = 1_000_000
#: Filed under this fact, which every product has: searches that require no other.
ALWAYS = "*"

_SCHEMA = ("query_name string, key string, access array<string>, required array<array<string>>, forbidden array<string>, "
           "bounds array<struct<f:int,lo:double,hi:double>>, points array<struct<f:int,v:double,is:boolean>>, "
           "after array<struct<f:int,minutes:int,zone:string>>")
_POSITIVE = {"ne": "eq", "none_eq": "any_eq", "none_prefix": "any_prefix"}


def _is_number(value) -> bool:
    return isinstance(value, float)


def _facts_of(cond: Condition) -> list[str]:
    """The facts of which a product needs one to meet a positive condition."""
    op, *args = cond
    if op == "any_of":
        return [k for c in args[0] for k in _facts_of(c)]
    name, values = (args[1], [args[0]]) if op == "search" and len(args) > 1 else ("name", args) if op == "search" else (
        args[0], args[1] if op == "in" else [args[1]])
    mark = {"eq": "=", "in": "=", "any_eq": "=", "prefix": "^", "any_prefix": "^", "search": "?"}.get(op)
    if mark is None or any(map(_is_number, values)):
        raise ValueError(f"no fact for condition {cond!r}")
    return [f"{mark}{name}:{str(v).lower()}" for v in values]


@dataclass(frozen=True)
class _Search:
    name: str
    required: tuple[tuple[str, ...], ...]
    forbidden: tuple[str, ...]
    bounds: tuple[tuple[str, float, float], ...]
    points: tuple[tuple[str, float, bool], ...]
    after: tuple[tuple[str, int, str], ...]


def _read(q: SavedQuery) -> _Search:
    if not isinstance(q.predicate, Conjunction):
        raise ValueError(f"search {q.name!r} is no list of conditions")
    required, forbidden, points, after = [], [], [], []
    low: dict[str, float] = {}
    high: dict[str, float] = {}
    for cond in q.predicate.conditions:
        op, *args = cond
        if op in ("lt", "gt"):
            name, value = args[0], float(args[1])
            side, better = (high, min) if op == "lt" else (low, max)
            side[name] = better(side.get(name, value), value)
        elif op == "after":
            after.append(tuple(args))
        elif op in ("eq", "ne") and _is_number(args[1]):
            points.append((args[0], args[1], op == "eq"))
        elif op in _POSITIVE:
            forbidden += _facts_of((_POSITIVE[op], *args))
        else:
            required.append(tuple(dict.fromkeys(_facts_of(cond))))
    bounds = tuple((f, low.get(f, float("-inf")), high.get(f, float("inf"))) for f in dict.fromkeys([*low, *high]))
    return _Search(q.name, tuple(dict.fromkeys(required)), tuple(dict.fromkeys(forbidden)), bounds, tuple(points), tuple(after))


@dataclass(frozen=True)
class PackIndex:
    """The searches of a pack as rows.  ``counts`` (fact -> products, see ``measured``)
    tells which condition is rarest; without it, the one that fewest searches share."""

    queries: Sequence[SavedQuery]
    counts: Mapping[str, int] | None = None
    searches: list[_Search] = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "searches", [_read(q) for q in self.queries])

    def _access(self, s: _Search, shared: Counter) -> tuple[str, ...]:
        cost = (lambda g: sum(self.counts.get(k, 0) for k in g)) if self.counts is not None else (lambda g: sum(shared[k] for k in g))
        return min(s.required, key=cost, default=(ALWAYS,))

    def _numbers(self) -> list[str]:
        return list(dict.fromkeys(x[0] for s in self.searches for x in (*s.bounds, *s.points, *s.after)))

    def rows(self, spark: SparkSession, now: Column | None = None) -> DataFrame:
        """One row per search and fact it is filed under; lookback cutoffs as numbers."""
        at = {f: i for i, f in enumerate(self._numbers())}
        shared = Counter(k for s in self.searches for g in s.required for k in g)
        data = []
        for s in self.searches:
            access = self._access(s, shared)
            own = (list(access), [list(g) for g in s.required if g != access], list(s.forbidden),
                   [(at[f], lo, hi) for f, lo, hi in s.bounds], [(at[f], v, want) for f, v, want in s.points],
                   [(at[f], minutes, zone) for f, minutes, zone in s.after])
            data += [(s.name, k, *own) for k in access]
        df = spark.createDataFrame(data, _SCHEMA)
        if any(s.after for s in self.searches):
            cut = lambda a: _number(F.convert_timezone(F.lit("UTC"), a["zone"], F.col("now") - F.make_dt_interval(
                F.lit(0), F.lit(0), a["minutes"], F.lit(0))), "timestamp_ntz")
            floor = lambda a: F.struct(a["f"].alias("f"), cut(a).alias("lo"), F.lit(float("inf")).alias("hi"))
            df = df.withColumn("now", now).withColumn("bounds", F.concat("bounds", F.transform("after", floor))).drop("now")
        df = df.drop("after")
        return F.broadcast(df) if len(data) <= BROADCAST_ROWS else df

    def facts(self, catalogue: DataFrame) -> tuple[Column, Column]:
        """A product's facts, those alone that some search tests, and its tested numbers."""
        types = dict(catalogue.dtypes)
        used: dict[tuple[str, str], set[int]] = {}
        for s in self.searches:
            for k in (*(k for g in s.required for k in g), *s.forbidden):
                name, _, value = k[1:].partition(":")
                used.setdefault((k[0], name), set()).add(len(value))
        parts = [F.array(F.lit(ALWAYS))]
        for (mark, name), lengths in used.items():
            values = _texts(name, types) if mark != "?" else F.split(F.lower(F.col(name)), r"\W+")
            if mark == "^":
                sizes = F.array(*[F.lit(n) for n in sorted(lengths)])
                values = F.flatten(F.transform(values, lambda v: F.transform(sizes, lambda n: F.substr(v, F.lit(1), n))))  # noqa: B023
            parts.append(F.coalesce(F.transform(F.array_compact(values), lambda v: F.concat(F.lit(f"{mark}{name}:"), v)),  # noqa: B023
                                    F.array().cast("array<string>")))
        numbers = [_number(F.col(f), types[f]) for f in self._numbers()]
        return F.array_distinct(F.concat(*parts)), F.array(*numbers) if numbers else F.array().cast("array<double>")

    def measured(self, catalogue: DataFrame) -> PackIndex:
        """The index with its facts counted over the whole catalogue.  What comes back
        is one number per fact of the pack, which the driver holds already."""
        facts, _ = self.facts(catalogue)
        keys = sorted({k for s in self.searches for g in s.required for k in g})
        asked = catalogue.sparkSession.createDataFrame([(k,) for k in keys], "key string")
        asked = F.broadcast(asked) if len(keys) <= BROADCAST_ROWS else asked
        found = catalogue.select(F.explode(facts).alias("key")).join(asked, "key").groupBy("key").count()
        return PackIndex(self.queries, {r["key"]: r["count"] for r in found.collect()})


def _texts(name: str, types: Mapping[str, str]) -> Column:
    """The values of a field, or of a member of a list field, in lower case."""
    outer, _, member = name.partition(".")
    if member:
        return F.transform(F.coalesce(F.col(outer), F.array().cast(types[outer])), lambda e: F.lower(e[member]))
    if FOLDED + name in types:
        return F.array(F.col(FOLDED + name))
    return F.array(F.lower(F.col(f"`{name}`").cast("string")))


def _number(c: Column, dtype: str) -> Column:
    """A number or a time (microseconds) as a double."""
    if dtype.startswith("timestamp"):
        return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), c).cast("double")
    return c.cast("double")


def tag_pack_indexed(catalogue: DataFrame, index: PackIndex, now: Column | None = None, tag: str = "query_name") -> DataFrame:
    """Every (product, matching search) pair, as ``tag_pack`` gives, from one scan."""
    facts, numbers = index.facts(catalogue)
    rows = index.rows(catalogue.sparkSession, now).withColumnsRenamed({
        "query_name": tag, **{c: f"__{c}" for c in ("key", "access", "required", "forbidden", "bounds", "points")}})
    # Generated, so that the facts are stated once per product and not in every test below.
    stated = catalogue.withColumn("__p", F.explode(F.array(F.struct(facts.alias("facts"), numbers.alias("numbers")))))
    hits = stated.withColumn("__fact", F.explode("__p.facts")).join(rows, F.col("__fact") == F.col("__key"))
    own, n = F.col("__p.facts"), lambda x: F.get("__p.numbers", x["f"])
    overlap = lambda keys: F.coalesce(F.arrays_overlap(own, keys), F.lit(False))
    # A product that has several of the facts a search is filed under meets it at the first one.
    first = F.col("__fact") == F.get(F.filter("__access", lambda k: F.array_contains(own, k)), 0)
    kept = hits.where(first & F.forall("__required", overlap) & ~overlap(F.col("__forbidden"))
                      & F.forall("__bounds", lambda b: F.coalesce((n(b) > b["lo"]) & (n(b) < b["hi"]), F.lit(False)))
                      & F.forall("__points", lambda x: F.coalesce(n(x) == x["v"], F.lit(False)) == x["is"]))
    return kept.select(*[F.col(f"`{c}`") for c in catalogue.columns], tag)
