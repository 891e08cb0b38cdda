"""Inverted tables of a catalogue's list fields and words, for searches that are asked often.

``store_attributes`` writes one row ``(field, value, sku)`` per list element
(``details.value``, ``categoryPath.name``, ...) and per word of the name
(``name?``), values in lower case, ordered by field, value and sku.  The range
exchange splits a value that a third of all products hold over many files by sku,
and an ordinary file holds few neighbouring values; within a file blocks are
small, sorted and carry a Bloom filter, so that a scan reads the blocks of a value
only.  ``directory`` is a small table of the files' fields and value bounds,
written beside them: a condition opens the files whose bounds meet it and no others.

Conditions on the index then are joins by sku: semi joins for positive ones and
anti joins for negative ones, with the meaning of ``predicates``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.plans.packs import Condition

#: Field of the words of the name.
WORDS = "name?"
LIST_FIELDS = ("details.value", "categoryPath.name", "categoryPath.id")
#: Bytes of a block that a scan reads or skips as a whole.
BLOCK_BYTES = 1 << 20

_SCHEMA = "field string, value string, sku bigint"


def attribute_rows(catalogue: DataFrame, fields: Sequence[str] = LIST_FIELDS) -> DataFrame:
    """``(field, value, sku)`` of every list element and word, each once a product."""
    types = dict(catalogue.dtypes)
    parts = []
    for f in fields:
        outer, member = f.split(".")
        values = F.transform(F.coalesce(F.col(outer), F.array().cast(types[outer])), lambda e: F.lower(e[member]))  # noqa: B023
        parts.append(F.transform(F.array_distinct(F.array_compact(values)),
                                 lambda v: F.struct(F.lit(f).alias("field"), v.alias("value"))))  # noqa: B023
    words = F.array_distinct(F.split(F.lower(F.coalesce(F.col("name"), F.lit(""))), r"\W+"))
    parts.append(F.transform(F.filter(words, lambda w: (w != "") & F.col("name").isNotNull()),
                             lambda w: F.struct(F.lit(WORDS).alias("field"), w.alias("value"))))
    return catalogue.select("sku", F.explode(F.concat(*parts)).alias("x")).select("x.field", "x.value", "sku")


def store_attributes(catalogue: DataFrame, path: str, fields: Sequence[str] = LIST_FIELDS) -> AttributeIndex:
    """Write the inverted table and its directory under ``path`` (shared storage)."""
    (attribute_rows(catalogue, fields).repartitionByRange("field", "value", "sku").sortWithinPartitions("field", "value", "sku")
     .write.mode("overwrite").option("parquet.bloom.filter.enabled#value", "true")
     .option("parquet.block.size", str(BLOCK_BYTES)).parquet(f"{path}/rows"))
    spark = catalogue.sparkSession
    rows = spark.read.schema(_SCHEMA).parquet(f"{path}/rows")
    (rows.groupBy(F.col("_metadata.file_name").alias("file"), "field")
     .agg(F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n"))
     .write.mode("overwrite").parquet(f"{path}/directory"))
    return AttributeIndex(spark, path)


@dataclass(frozen=True)
class AttributeIndex:
    """A stored inverted table."""

    spark: SparkSession
    path: str

    def directory(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/directory")

    def files(self, field: str, value: str, prefix: bool = False) -> list[str]:
        """The files that may hold a value of a field, or values with a prefix: as many as these
        values fill, and one at each end."""
        low, high = F.col("low"), F.col("high")
        # Of sorted texts from a prefix on, those with the prefix come first.
        below = (low <= value) | F.startswith(low, F.lit(value)) if prefix else low <= value
        met = self.directory().where((F.col("field") == field) & (high >= value) & below)
        return sorted(f"{self.path}/rows/{r['file']}" for r in met.select("file").distinct().collect())

    def _read(self, field: str, value: str, prefix: bool) -> DataFrame:
        files = self.files(field, value, prefix)
        if not files:
            return self.spark.createDataFrame([], _SCHEMA).select("sku")
        test = F.startswith("value", F.lit(value)) if prefix else F.col("value") == value
        return self.spark.read.schema(_SCHEMA).parquet(*files).where((F.col("field") == field) & test).select("sku")

    def equal(self, field: str, value: str) -> DataFrame:
        """skus of the products that hold a value."""
        return self._read(field, value.lower(), False)

    def starting(self, field: str, text: str) -> DataFrame:
        """skus of the products that hold a value with a prefix; a product may come several times."""
        return self._read(field, text.lower(), True)

    def skus(self, cond: Condition) -> tuple[DataFrame, bool]:
        """skus of a list or word condition, and whether they are the matches or the others."""
        op, *args = cond
        if op == "search":
            return self.equal(WORDS, args[0]), True
        if op in ("any_eq", "none_eq"):
            return self.equal(*args), op == "any_eq"
        if op in ("any_prefix", "none_prefix"):
            return self.starting(*args), op == "any_prefix"
        raise ValueError(f"no inverted table for condition {cond!r}")

    def matching(self, catalogue: DataFrame, conditions: Sequence[Condition]) -> DataFrame:
        """The rows of ``catalogue`` that meet all list and word conditions."""
        found = [self.skus(c) for c in conditions]
        out = catalogue
        for skus, _ in (x for x in found if x[1]):
            out = out.join(skus, "sku", "left_semi")
        for skus, _ in (x for x in found if not x[1]):
            out = out.join(skus, "sku", "left_anti")
        return out
