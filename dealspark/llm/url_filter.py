"""URL rules indexed by their rarest literal token.

A rule is a regular expression over host + path with the literal tokens that
every match holds.  The tokens of all rules are counted over all URLs, and each
rule is filed under its rarest one.  A URL's tokens fetch the rules filed under
them, and only those run their expression; the longest matching rule with a name
decides, else a matching pattern's verdict, else ``DEFAULT``.  A rule list is a
parameter of the driver; it travels inside the plan, hashed into buckets.

Edge cases: a null URL or one without ``://`` has empty host and path, fits no
rule and takes ``DEFAULT``; repeated rows are judged each; an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT = "allow"
#: Buckets of the smallest index; it has one for each rule or more.
BUCKETS = 256


@dataclass(frozen=True)
class UrlRule:
    pattern: str            # searched in host + path
    tokens: tuple[str, ...]  # lower-case [a-z0-9]+ tokens of every match
    verdict: str            # allow or block
    name: str | None = None  # reported as ``rule``; a rule without one is a pattern of the method


def site_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A host with its subdomains, and a path prefix.  The last token of a path
    that does not end in a separator may go on in the URL, so it is no literal."""
    parts = re.findall(r"[a-z0-9]+", host.lower())
    inner = re.findall(r"[a-z0-9]+(?=[^a-z0-9])", path.lower()) if path.isascii() else []
    return UrlRule(rf"^(?:[^/]*\.)?{_quoted(host)}{_quoted(path)}", tuple(dict.fromkeys([*parts, *inner])), verdict, host + path)


def host_word_rule(verdict: str, word: str) -> UrlRule:
    """A word that stands alone between the separators of a host name."""
    return UrlRule(rf"^(?:[^/]*[.-])?{_quoted(word)}(?:[.-][^/]*)?(?:/|$)", (word,), verdict)


def _quoted(s: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", s)


#: The site list, and the method's own patterns for hosts the list leaves open.
SITE_RULES = (
    site_rule("allow", "org", "/"), site_rule("block", "example.org", "/es/"),
    site_rule("block", "example.org", "/en/1"), site_rule("allow", "com", "/fr/"),
    site_rule("block", "com", "/de/"),
)
BLOCKED_WORDS = ("casino", "bets", "porn", "viagra", "xxx", "poker")
RULES = SITE_RULES + tuple(host_word_rule("block", w) for w in BLOCKED_WORDS)


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), upper, upper.lower())
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _tokens(target: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit("[a-z0-9]+"), F.lit(0)))


def token_counts(df: DataFrame, tokens: list[str], url: str = "url") -> dict[str, int]:
    """URLs that hold each of the given tokens; one row per token reaches the driver."""
    host, path = host_path(F.col(url))
    wanted = F.array(*[F.lit(t) for t in tokens])
    rows = (df.select(F.explode(F.array_intersect(_tokens(F.concat(host, path)), wanted)).alias("token"))
            .groupBy("token").count().collect())
    return {r["token"]: r["count"] for r in rows}


def index(rules: tuple[UrlRule, ...], counts: dict[str, int]) -> list[list[dict]]:
    """Buckets of (token, pattern, ...) entries; each rule under its rarest token."""
    out: list[list[dict]] = [[] for _ in range(max(BUCKETS, len(rules)))]
    for r in rules:
        if not r.tokens:
            raise ValueError(f"a rule needs a literal token: {r.pattern}")
        token = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
        out[zlib.crc32(token.encode()) % len(out)].append(
            {"token": token, "pattern": r.pattern, "named": r.name is not None,
             "length": len(r.name or r.pattern), "rule": r.name, "verdict": r.verdict})
    return out


def judge(df: DataFrame, rules: tuple[UrlRule, ...] = RULES, url: str = "url", tried: str | None = None) -> DataFrame:
    """``df`` with host, path, rule and verdict, and, if ``tried`` names a column, the number of
    expressions that were run on the URL."""
    counts = token_counts(df, sorted({t for r in rules for t in r.tokens}), url) if rules else {}
    buckets = index(rules, counts)
    shape = "token string, pattern string, named boolean, length int, rule string, verdict string"
    filed = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<{shape.replace(' ', ':').replace(',:', ',')}>>>")
    host, path = host_path(F.col(url))
    target = F.concat(host, path)
    fetched = F.flatten(F.transform(_tokens(target), lambda t: F.filter(
        F.get(filed, (F.crc32(t.cast("binary")) % len(buckets)).cast("int")), lambda r: r["token"] == t)))
    best = F.array_max(F.transform(F.filter(fetched, lambda r: F.rlike(target, r["pattern"])),
                                   lambda r: F.struct(r["named"], r["length"], r["rule"], r["verdict"])))
    counted = {tried: F.coalesce(F.size(fetched), F.lit(0))} if tried else {}
    return (df.withColumns({"host": host, "path": path, **counted}).withColumn("_best", best)
            .withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce(F.col("_best.verdict"), F.lit(DEFAULT))})
            .drop("_best"))


ORACLE = """
with parts as (
    select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest
    from pages),
split as (
    select page_id,
           translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
    from parts),
ruled as (
    select *, case
        when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/en/1') then 'example.org/en/1'
        when (host = 'example.org' or ends_with(host, '.example.org')) and starts_with(path, '/es/') then 'example.org/es/'
        when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/fr/') then 'com/fr/'
        when (host = 'com' or ends_with(host, '.com')) and starts_with(path, '/de/') then 'com/de/'
        when (host = 'org' or ends_with(host, '.org')) and starts_with(path, '/') then 'org/' end as rule
    from split)
select page_id, host, path, rule, case
    when rule in ('org/', 'com/fr/') then 'allow'
    when rule is not null then 'block'
    when len(list_intersect(string_split(replace(host, '-', '.'), '.'), ['casino', 'bets', 'porn', 'viagra', 'xxx', 'poker'])) > 0 then 'block'
    else 'allow' end as verdict
from ruled
"""
