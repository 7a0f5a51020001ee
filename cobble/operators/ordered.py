"""Order-dependent operators: runs, first row per day, running level maxima, top-k.

A running computation over a global order ("the level after every event") cannot use a
Window without a partition key at scale: that moves every row into one task. Here the
order is cut into contiguous ranges with ``repartitionByRange`` (sampled boundaries, so a
hot timestamp or key is split as well), each range is solved with a partitioned window,
and the few per-range summaries are stitched together in order. The result equals the
global sequential answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cobble.operators.joins import broadcast_if_bounded
from cobble.session import shared_scratch

BUCKET = "_bucket"


def _num_buckets(df: DataFrame, num_buckets: int | None) -> int:
    if num_buckets:
        return int(num_buckets)
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def range_buckets(df: DataFrame, order_cols: Sequence[str], num_buckets: int | None = None) -> DataFrame:
    """Cut the rows into contiguous ranges of ``order_cols``; ``_bucket`` numbers them in order.

    ``order_cols`` must end in a unique tie-breaker so ranges never share a key value.
    """
    n = _num_buckets(df, num_buckets)
    return df.repartitionByRange(n, *[F.col(c) for c in order_cols]).withColumn(BUCKET, F.spark_partition_id())


def change_runs(
    df: DataFrame,
    key: str,
    member: str,
    order_cols: Sequence[str],
    out: str = "runs",
    num_buckets: int | None = None,
) -> DataFrame:
    """key -> number of runs of equal consecutive ``member`` values in ``order_cols`` order.

    Counts one for the first row of each key and one for every row whose member differs
    from the previous row of the same key (a NULL member equals a NULL one): the counter of
    a one-pass scan that remembers only the last member per key.
    """
    cols = [key, member, *order_cols]
    b = range_buckets(df.select(*cols), [key, *order_cols], num_buckets)
    w = Window.partitionBy(key, BUCKET).orderBy(*order_cols)
    prev, first = F.lag(member).over(w), F.row_number().over(w) == 1
    starts = b.select(
        key,
        BUCKET,
        member,
        F.struct(*order_cols).alias("_o"),
        F.when(first | ~prev.eqNullSafe(F.col(member)), 1).otherwise(0).alias("_start"),
    )
    # One row per (key, range); the window above already clusters by (key, _bucket).
    per_range = starts.groupBy(key, BUCKET).agg(
        F.sum("_start").alias("_starts"),
        F.min_by(member, "_o").alias("_first"),
        F.max_by(member, "_o").alias("_last"),
    )
    w2 = Window.partitionBy(key).orderBy(BUCKET)
    joined = (F.row_number().over(w2) > 1) & F.lag("_last").over(w2).eqNullSafe(F.col("_first"))
    return per_range.select(key, (F.col("_starts") - F.when(joined, 1).otherwise(0)).alias("_r")).groupBy(key).agg(
        F.sum("_r").cast("bigint").alias(out)
    )


def first_per_group(df: DataFrame, group: Column | str, order_cols: Sequence[str], group_name: str = "day") -> DataFrame:
    """The whole earliest record of each group (ties broken by the later order columns).

    ``min_by(struct(record), struct(order))`` is a plain aggregate with partial aggregation,
    so a group with very many rows is reduced map-side rather than sorted in one task.
    """
    g = F.col(group) if isinstance(group, str) else group
    rec = F.struct(*[F.col(c) for c in df.columns])
    return (
        df.groupBy(g.alias(group_name))
        .agg(F.min_by(rec, F.struct(*[F.col(c) for c in order_cols])).alias("_r"))
        .select(group_name, "_r.*")
    )


def level_summaries(
    df: DataFrame,
    order_cols: Sequence[str],
    delta: Column,
    peak_at: Column,
    num_buckets: int | None = None,
) -> DataFrame:
    """One row per ordered range: ``_bucket``, ``_net`` (sum of deltas) and ``_peak`` (highest
    in-range running total at a peak row; NULL when the range has none). Zero deltas are
    dropped first."""
    d = df.select(*order_cols, delta.cast("bigint").alias("_d"), peak_at.alias("_p")).filter(F.col("_d") != 0)
    b = range_buckets(d, order_cols, num_buckets)
    w = Window.partitionBy(BUCKET).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = b.select(BUCKET, "_d", F.when(F.col("_p"), F.sum("_d").over(w)).alias("_lvl"))
    return levels.groupBy(BUCKET).agg(F.sum("_d").alias("_net"), F.max("_lvl").alias("_peak"))


def stitch_levels(summaries: DataFrame, order_col: str, net: str = "_net", peak: str = "_peak") -> DataFrame:
    """Fold ordered (net, peak) summaries: a range's offset is the sum of the nets before it;
    returns one row (``_net``, ``_peak``) for the whole sequence. The window runs over one
    row per range, never over raw rows."""
    before = Window.orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(net).over(before), F.lit(0))
    return summaries.select(F.col(net).alias("_n"), (offset + F.col(peak)).alias("_abs")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("_net"), F.max("_abs").cast("bigint").alias("_peak")
    )


def max_running_level(
    df: DataFrame,
    order_cols: Sequence[str],
    delta: Column,
    peak_at: Column,
    out: str = "max_level",
    num_buckets: int | None = None,
) -> DataFrame:
    """max(0, highest running total of ``delta`` measured at rows where ``peak_at`` holds).

    The level starts at 0 and may go negative. Rows with a zero delta are ignored. Per
    ordered range: net change and highest in-range prefix at peak rows; then the offset of
    each range is the sum of the nets before it (a window over one row per range).
    """
    total = stitch_levels(level_summaries(df, order_cols, delta, peak_at, num_buckets), BUCKET)
    return total.select(F.greatest(F.lit(0), F.coalesce(F.col("_peak"), F.lit(0))).cast("bigint").alias(out))


def max_concurrency(
    df: DataFrame,
    start: str,
    stop: str,
    out: str = "max_concurrent",
    num_buckets: int | None = None,
) -> DataFrame:
    """Most intervals [start, stop) open at once: +1 at start, -1 at stop, and at equal
    times the stop is applied before the start.

    All stops of a time come before all its starts, so the level after the last of them is
    the time's peak: starts and stops are first added up by time, map-side, and only one row
    per distinct time and kind is put in order."""
    ev = df.select(
        F.explode(
            F.array(
                F.struct(F.col(start).alias("t"), F.lit(1).alias("k"), F.lit(1).alias("d")),
                F.struct(F.col(stop).alias("t"), F.lit(0).alias("k"), F.lit(-1).alias("d")),
            )
        ).alias("e")
    ).select("e.*")
    # A missing time counts like any other value in the order, as one time.
    steps = ev.groupBy("t", "k").agg(F.sum("d").alias("d"))
    return max_running_level(steps, ["t", "k"], F.col("d"), F.col("k") == 1, out=out, num_buckets=num_buckets)


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """Top-k by an explicit total order (TakeOrderedAndProject: per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def with_ordinal(df: DataFrame, order_cols: Sequence[str], name: str = "ordinal", num_buckets: int | None = None) -> DataFrame:
    """Number the rows from 0 in ``order_cols`` order (F18): numbers within ordered ranges, and
    for each range how many rows lie before it (a window over one row per range). The
    numbered ranges are written once, since ranges cut a second time may differ."""
    spark = df.sparkSession
    b = range_buckets(df, order_cols, num_buckets)
    within = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*order_cols))
    path = shared_scratch(spark, "ordinal")
    b.withColumn("_within", within.cast("bigint") - 1).write.parquet(path)
    numbered = spark.read.parquet(path)
    sizes = numbered.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(BUCKET, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return numbered.join(F.broadcast(starts), BUCKET).select(
        *df.columns, (F.col("_start") + F.col("_within")).cast("bigint").alias(name)
    )


def _text(spark: SparkSession, paths: str | Sequence[str], line_sep: str | None) -> DataFrame:
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text([paths] if isinstance(paths, str) else list(paths))


def number_lines(
    spark: SparkSession, paths: str | Sequence[str], name: str = "ordinal", line_sep: str | None = None
) -> DataFrame:
    """Lines of text files as (``value``, file, ``name``), numbered from 0 in order of (path, place in file)
    (F18).

    Lines are counted for every split; the sums before each split (a window over one row a split)
    and a line's place in its split make its number. The lines themselves are neither sorted nor
    shuffled. A line's row id counts on within a task, so its place is the distance from the
    smallest id that the split had when it was counted; both scans cut the files alike.
    """
    text = _text(spark, paths, line_sep)
    meta = F.col("_metadata")
    lines = text.select("value", meta["file_path"].alias("file"), meta["file_block_start"].alias("_block"), F.monotonically_increasing_id().alias("_id"))
    splits = lines.groupBy("file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    starts, _ = broadcast_if_bounded(starts)
    place = F.col("_id") - F.col("_first")
    moved = F.raise_error(F.lit("the files changed while their lines were numbered")).cast("bigint")
    checked = F.when((place >= 0) & (place < F.col("_n")), F.col("_start") + place).otherwise(moved)
    return lines.join(starts, ["file", "_block"]).select("value", "file", checked.alias(name))


def first_text_lines(
    spark: SparkSession, paths: str | Sequence[str], n: int, name: str = "ordinal", line_sep: str | None = None
) -> DataFrame:
    """The first ``n`` lines of text files in order of (path, place in file) (K5), numbered.

    Files are taken by path, twice as many each time, until they hold enough lines: further
    files are never opened.
    """
    files = sorted(_text(spark, paths, line_sep).inputFiles())
    some = 1
    while some < len(files) and _text(spark, files[:some], line_sep).count() < n:
        some *= 2
    return first_lines(number_lines(spark, files[:some] or paths, name, line_sep), name, n)


def first_lines(df: DataFrame, ordinal: str, n: int) -> DataFrame:
    """The first ``n`` rows by a stored input ordinal (K5): a filter, not ``limit``, so the
    choice of rows does not depend on how the input was split."""
    return df.filter(F.col(ordinal) < F.lit(n))
