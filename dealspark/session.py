"""Session construction and the shared scratch folder.

Cluster jobs get their settings from the cluster; ``build_session`` is what the
tests, the bench and local runs use.  ``scratch_dir`` always prefers the folder
the cluster names in ``spark.checkpoint.dir`` and only makes a local one when
that setting is absent (local tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove a ranked frame's checkpoint files once nothing references it.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Stop a query rather than silently pull a runaway result to the driver.
    "spark.driver.maxResultSize": "2g",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "dealspark", extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset on a
    ``local`` master (tests) a temporary folder is created and registered, so
    that ``DataFrame.checkpoint()`` and our written tables land in the same
    place.  On any other master an unset folder is an error: executors would
    each write to a disk of their own.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="dealspark-ckpt-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    base = base.rstrip("/")
    return "/".join([base, *parts]) if parts else base


def fresh_scratch(spark: SparkSession, kind: str) -> str:
    """A new, unique folder under the scratch root (never reused between runs)."""
    return scratch_dir(spark, "dealspark", kind, uuid.uuid4().hex)


def stored(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written once under the scratch root and read back: cuts the lineage
    where a recomputation would repeat much work."""
    path = fresh_scratch(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
