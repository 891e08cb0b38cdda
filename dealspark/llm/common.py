"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from dealspark.session import fresh_scratch

#: Folder of the public vocabulary files; every operator that reads one takes a path.
TOKENIZER_DIR = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def vocabulary(name: str) -> str:
    return os.path.join(TOKENIZER_DIR, name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage, so that later jobs do not repeat the work and a lost
    executor re-reads files instead of recomputing.
    """
    spark = df.sparkSession
    path = fresh_scratch(spark, kind)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def worker_tool(key: tuple, make: Callable[[], object], held: dict = {}) -> object:  # noqa: B006
    """A tokeniser with its stores, kept by the Python worker for its next tasks.

    A worker holds one: stages that follow each other do not add up their stores."""
    if key not in held:
        held.clear()
        held[key] = make()
    return held[key]


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of record batches that hold at most ``limit`` bytes in ``column``
    (a single longer row stays whole), so that a task's memory does not follow
    the number of rows in an Arrow batch."""
    for batch in batches:
        start, held = 0, 0
        sizes = _lengths(batch.column(column))
        for i, n in enumerate(sizes):
            if held and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def _lengths(values: pa.Array) -> list[int]:
    import pyarrow.compute as pc
    if pa.types.is_list(values.type):
        return pc.multiply(pc.fill_null(pc.list_value_length(values), 0), 4).to_pylist()
    return pc.fill_null(pc.binary_length(values), 0).to_pylist()
