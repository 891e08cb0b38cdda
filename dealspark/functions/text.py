"""Small text helpers of the report path (all built-in expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ordered literal replacements that turn URLs into anchors.
LINK_REWRITES = (
    ("http", '<a href="http'),
    ("/pdp", '/pdp" target="_blank">urlLink</a>'),
    ("/cart", '/cart" target="_blank">addToCartUrl</a>'),
)


def link_rewrite(text: Column) -> Column:
    """Apply the three replacements in order, every occurrence (SCL-2)."""
    out = text
    for old, new in LINK_REWRITES:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def first_word(text: Column) -> Column:
    """Text before the first space (SCL-6)."""
    return F.split_part(text, F.lit(" "), F.lit(1))


def after_token(text: Column, token: str = "v1") -> Column:
    """The part between the first and second ``token`` (SCL-7); '' when absent."""
    return F.split_part(text, F.lit(token), F.lit(2))


def ceil_div(n: Column, d: Column) -> Column:
    """Integer ceiling division (SCL-9), exact for BIGINT operands: the decimal
    quotient is never rounded through a double."""
    return F.ceil(n.cast("decimal(20,0)") / d.cast("decimal(20,0)")).cast("long")
