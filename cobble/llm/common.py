"""Helpers that several operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cobble.session import shared_scratch, table

__all__ = ["gathered", "materialize", "partitions", "prepare", "slices", "table", "texts"]

#: Rows in an Arrow batch sent to Python; bounds a batch when single texts are long.
BATCH_ROWS = 1000
#: Text bytes that Python code works on at a time.
SLICE_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Make Python workers find this package and get small Arrow batches.

    On a cluster the package comes with ``--py-files`` or the image; the path added here serves
    local runs started from another folder.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    have = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def partitions(spark: SparkSession) -> int:
    """Reduce-side partitions that the session asks for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text)`` only: extra columns, clashing names included, never reach an operator. A null text is empty."""
    return df.select(
        df[id_col].cast("bigint").alias("doc_id"), F.coalesce(df[text_col].cast("string"), F.lit("")).alias("text")
    )


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the named column holds about ``most`` bytes; a longer text comes alone."""
    for batch in batches:
        col = batch.column(column)
        sizes = pa.compute.binary_length(col).to_pylist()
        at = held = 0
        for i, n in enumerate(sizes):
            if held and held + (n or 0) > most:
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += n or 0
        if at < len(sizes):
            yield batch.slice(at)


def gathered(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Join small batches to ones of up to about ``most`` bytes, in order."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield pa.concat_batches(held)
