"""The flagship over files that keep arriving: counts are added up, addresses are resolved once.

A ``ViolationStore`` is a shared folder with, for every batch of files,

* ``resolved/batch=N``: the addresses that no batch before had, each with its segment or none;
* ``counts/batch=N``: yearly counts per segment of the batch's violations.

Yearly counts of an address are sums over its violations, and its segment depends on the address
alone, so adding a batch gives what a run over all files gives, and reads none of the earlier files. A
batch that is tried again replaces its own folders and looks only at batches before it.

The roster and the summed counts are kept as bucketed tables, dealt and sorted by id when they are
written: the outer join of the report and the counting of the roster's copies need no exchange.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cobble.functions.streets import VIOLATION_YEARS
from cobble.operators.aggregates import with_trend
from cobble.operators.joins import StreetIndex, first_match_segment, roster_outer_join
from cobble.operators.violations import ADDRESS_KEYS, address_counts
from cobble.session import shared_scratch

RESOLVED = "street string, borough int, house string, pid bigint"


def write_bucketed(df: DataFrame, key: str, buckets: int, path: str | None = None, name: str | None = None) -> DataFrame:
    """``df`` as a table of ``buckets`` buckets by ``key``, each one sorted file (IO15). Tables of equally
    many buckets join and group by the key without an exchange."""
    spark = df.sparkSession
    name = name or f"cobble_{uuid.uuid4().hex[:12]}"
    path = path or shared_scratch(spark, name)
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path).saveAsTable(name)
    return spark.table(name)


@dataclass(frozen=True)
class ViolationStore:
    path: str
    years: Sequence[int] = VIOLATION_YEARS

    @property
    def _ycols(self) -> list[str]:
        return [f"y{y}" for y in self.years]

    def _read(self, spark: SparkSession, part: str, schema: str, before: int | None = None) -> DataFrame:
        """Rows of the batches before ``before`` (all where it is None)."""
        folder = os.path.join(self.path, part)
        # Batch 0 has nothing before it, and its folder may not be there yet.
        if before == 0:
            return spark.createDataFrame([], f"{schema}, batch bigint")
        rows = spark.read.schema(f"{schema}, batch bigint").parquet(folder)
        return rows if before is None else rows.filter(F.col("batch") < before)

    def add(self, violations: DataFrame, index: StreetIndex, batch: int) -> None:
        """Count the violations (year, borough, house, street) of batch number ``batch`` (from 0 on)."""
        spark = violations.sparkSession
        counts = address_counts(violations, self.years)
        known = self._read(spark, "resolved", RESOLVED, batch).select(*ADDRESS_KEYS, "pid", F.lit(True).alias("_known"))
        met = counts.join(known, ADDRESS_KEYS, "left")
        fresh = met.filter("_known IS NULL").select(*ADDRESS_KEYS, "parts")
        resolved = os.path.join(self.path, "resolved", f"batch={batch}")
        first_match_segment(fresh, index, ADDRESS_KEYS, keep_all=True).select(*ADDRESS_KEYS, "pid").write.mode("overwrite").parquet(resolved)
        now = self._read(spark, "resolved", RESOLVED).filter(F.col("batch") <= batch).select(*ADDRESS_KEYS, "pid")
        placed = counts.join(now, ADDRESS_KEYS).filter("pid IS NOT NULL")
        sums = placed.groupBy("pid").agg(*[F.sum(c).cast("bigint").alias(c) for c in self._ycols])
        sums.write.mode("overwrite").parquet(os.path.join(self.path, "counts", f"batch={batch}"))

    def per_segment(self, spark: SparkSession) -> DataFrame:
        """pid -> yearly counts over all batches."""
        columns = ", ".join(f"{c} bigint" for c in ["pid", *self._ycols])
        rows = self._read(spark, "counts", columns)
        return rows.groupBy("pid").agg(*[F.sum(c).cast("bigint").alias(c) for c in self._ycols])

    def report(self, roster: DataFrame, buckets: int, ordered: bool = True) -> DataFrame:
        """The rows of ``violations_report`` from the counts so far. ``roster``: a table by
        ``write_bucketed`` with as many buckets, so that nothing is exchanged below the outer join."""
        counts = write_bucketed(self.per_segment(roster.sparkSession), "pid", buckets)
        full = roster_outer_join(roster, with_trend(counts, self.years), "pid", [*self._ycols, "slope"], ordered)
        return full.select("pid", *self._ycols, F.col("slope").cast("double"), "copy")
