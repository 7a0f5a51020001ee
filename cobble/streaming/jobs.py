"""Structured Streaming forms of the event operators.

Each job reads a file stream, keeps only small keyed state, and writes its result with
``foreachBatch`` into a table in the shared folder; ``run_available`` drives a stream over
the files present (``Trigger.AvailableNow``) and returns the written table. A job with an
unbounded input stays the same: start it with a processing-time trigger instead.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cobble.operators.ordered import BUCKET, range_buckets
from cobble.session import shared_scratch


def _sink(spark: SparkSession, stream_df: DataFrame, name: str, mode: str, write) -> str:
    """Run ``stream_df`` over all files now present; ``write(batch, path)`` writes a batch to a
    folder of its own. A batch that is tried again overwrites its own folder, so it counts
    once, and no reader meets a half-replaced result. Returns the folder of the batches."""
    out, ckpt = shared_scratch(spark, f"{name}-out"), shared_scratch(spark, f"{name}-ckpt")
    q = (
        stream_df.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, batch_id: write(batch, f"{out}/batch={batch_id}"))
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return out


def _batches(spark: SparkSession, out: str, schema) -> DataFrame:
    """All rows of the written batches, with their ``batch`` number."""
    kept = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return spark.read.schema(f"{kept}, batch BIGINT").parquet(out)


#: Partitions of a state that has a row an hour or a day. A stateful batch runs a task for each, and each
#: task reports on every one, so they follow the keys and not the session's shuffles of whole tables.
STATE_PARTITIONS = 8


@contextmanager
def _at_most(spark: SparkSession, partitions: int | None):
    """Streams started within get at most so many state partitions, and keep them."""
    key = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(key)
    if partitions:
        spark.conf.set(key, str(min(int(usual), partitions)))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def run_available(
    spark: SparkSession, stream_df: DataFrame, name: str, mode: str = "complete", partitions: int | None = STATE_PARTITIONS
) -> DataFrame:
    """What ``stream_df`` gives over all files now present. ``partitions``: at most as many for its
    state (None: the session's number, for keys that grow with the rows).

    complete mode: each micro-batch carries the whole (small) result; the last one's counts.
    append mode: each batch adds its rows.
    """
    with _at_most(stream_df.sparkSession, partitions):
        out = _sink(spark, stream_df, name, mode, lambda batch, path: batch.write.mode("overwrite").parquet(path))
    rows = _batches(spark, out, stream_df.schema)
    if mode == "complete":
        rows = rows.filter(F.col("batch") == rows.agg(F.max("batch")).scalar())
    return rows.drop("batch")


def hour_histogram(events: DataFrame) -> DataFrame:
    """Events per hour of day (complete mode; one state row per hour)."""
    return events.groupBy(F.hour("ts").cast("int").alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def first_event_of_day(events: DataFrame, cols: list[str]) -> DataFrame:
    """The whole earliest event of each day, as a running min_by per day (complete
    mode; one state row per day). The day is taken from the stored wall-clock time, so it
    does not depend on the session time zone."""
    rec = F.struct(*[F.col(c) for c in cols])
    return (
        events.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"))
        .agg(F.min_by(rec, F.struct("ts", "event_id")).alias("_r"))
        .select("day", "_r.*")
    )


def event_time(ts: str = "ts") -> Column:
    """Watermarks need TIMESTAMP, not TIMESTAMP_NTZ. Casting reads the stored wall-clock in
    the session zone; shifting back by that zone's offset makes the instant equal the
    wall-clock read as UTC, so event-time windows fall on wall-clock days in any session."""
    return F.from_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())


def first_event_of_day_windowed(events: DataFrame, cols: list[str], late: str = "1 hour") -> DataFrame:
    """X2 for append mode: a one-day event-time window per day with a watermark, so each
    day is emitted once, when no event later than ``late`` behind it can still arrive, and
    its state is then dropped. Events older than the watermark are ignored."""
    rec = F.struct(*[F.col(c) for c in cols])
    return (
        events.withColumn("_et", event_time())
        .withWatermark("_et", late)
        .groupBy(F.window("_et", "1 day").alias("_w"))
        .agg(F.min_by(rec, F.struct("ts", "event_id")).alias("_r"))
        .select(F.date_format(F.col("_r.ts"), "yyyy-MM-dd").alias("day"), "_r.*")
    )


#: Batches after which the state of distinct members is put together into one table.
COMPACT_EVERY = 8
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _member_state(rows: DataFrame, key: str, member: str, whole: bool) -> DataFrame:
    """Distinct members of each key: for integers a bitmap for every 32,768 numbers, else the members."""
    if not whole:
        return rows.select(key, F.col(member).cast("string").alias("m")).distinct()
    m = F.col(member).cast("bigint")
    bits = F.when(m.isNotNull(), F.bitmap_bit_position(m))
    return rows.groupBy(key, F.bitmap_bucket_number(m).alias("m")).agg(F.bitmap_construct_agg(bits).alias("bits"))


def _merged_state(state: DataFrame, key: str, whole: bool) -> DataFrame:
    if not whole:
        return state.select(key, "m").distinct()
    return state.groupBy(key, "m").agg(F.bitmap_or_agg("bits").alias("bits"))


def stream_distinct_and_total(
    spark: SparkSession,
    events: DataFrame,
    key: str,
    member: str,
    amount: str,
    name: str = "stream_revenue",
    compact_every: int = COMPACT_EVERY,
) -> DataFrame:
    """Exact distinct members and the total per key (``customers``, ``revenue``), in one pass.

    Sets of members merge, so a batch writes its own sets and totals only. Integer members are held
    as bitmaps, which the next merge ORs together; other members are rows. After every
    ``compact_every`` batches the newest compact table and the batches since become the next compact
    table: what is read at the end, or by a compaction, is bounded by the distinct members and
    ``compact_every`` batches, however many batches there were. A batch that is tried again
    replaces its own folders, and its compaction reads earlier compactions only. A null member
    counts as one.
    """
    money = F.col(amount).cast("decimal(18,2)")
    types = dict(events.dtypes)
    whole = types[member] in _INTEGERS
    fresh, compact = shared_scratch(spark, f"{name}-fresh"), shared_scratch(spark, f"{name}-compact")
    columns = f"`{key}` {types[key]}, m {'bigint, bits binary' if whole else 'string'}, amount decimal(28,2), kind string"
    kept = [key, "m", *(["bits"] if whole else []), "amount", "kind"]

    def rows_of(state: DataFrame, totals: DataFrame) -> DataFrame:
        """Members and totals as rows of one table, told apart by ``kind``."""
        members = state.withColumn("amount", F.lit(None).cast("decimal(28,2)")).withColumn("kind", F.lit("member"))
        sums = totals.withColumn("m", F.lit(None).cast("bigint" if whole else "string")).withColumn("kind", F.lit("total"))
        if whole:
            sums = sums.withColumn("bits", F.lit(None).cast("binary"))
        return members.select(*kept).unionByName(sums.select(*kept))

    def read(path: str) -> DataFrame:
        return spark.read.schema(f"{columns}, batch bigint").parquet(path)

    def merged(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        state = _merged_state(rows.filter("kind = 'member'"), key, whole)
        totals = rows.filter("kind = 'total'").groupBy(key).agg(F.sum("amount").cast("decimal(28,2)").alias("amount"))
        return state, totals

    def write(batch: DataFrame, path: str) -> None:
        number = int(path.rsplit("=", 1)[1])
        totals = batch.groupBy(key).agg(F.sum(money).cast("decimal(28,2)").alias("amount"))
        out = rows_of(_member_state(batch, key, member, whole), totals)
        out.write.mode("overwrite").parquet(f"{fresh}/batch={number}")
        if (number + 1) % compact_every == 0:
            since = read(fresh).filter(F.col("batch").between(number + 1 - compact_every, number))
            if number >= compact_every:
                since = since.unionByName(read(compact).filter(F.col("batch") == number - compact_every))
            rows_of(*merged(since)).write.mode("overwrite").parquet(f"{compact}/batch={number}")

    _sink(spark, events, name, "append", write)
    try:
        rows = read(fresh)
        last = rows.agg(F.max("batch")).first()[0]
    except AnalysisException:  # nothing has arrived: no folder
        rows, last = spark.createDataFrame([], f"{columns}, batch bigint"), -1
    done = (last + 1) // compact_every * compact_every - 1
    rows = rows.filter(F.col("batch") > done)
    if done >= 0:
        rows = rows.unionByName(read(compact).filter(F.col("batch") == done))
    state, totals = merged(rows)
    if whole:
        # The numbers of a null member's bitmap: none; it still counts as one member.
        n = F.when(F.col("m").isNull(), 1).otherwise(F.bitmap_count("bits"))
        counts = state.groupBy(key).agg(F.sum(n).cast("bigint").alias("customers"))
    else:
        counts = state.groupBy(key).agg(F.count(F.lit(1)).alias("customers"))
    both = counts.join(totals, counts[key].eqNullSafe(totals[key]))
    return both.select(counts[key], "customers", F.col("amount").alias("revenue"))


def stream_first_with_late(
    spark: SparkSession,
    events: DataFrame,
    cols: list[str],
    ts: str = "ts",
    tie: str = "event_id",
    late: str = "1 hour",
    name: str = "stream_days",
) -> dict[str, DataFrame]:
    """X2 with nothing lost: the earliest event of each day, emitted when the day closes, with what arrives
    after that listed and corrected, and the days still open at the end flushed.

    A day closes with the batch after which the latest time seen is ``late`` or more past the day's end (its
    timer). Every batch writes, in folders of its own: the first event and the number of rows of each of its
    days; the latest time seen so far; the days that it closes; its rows of days that an earlier batch closed.

    closed: (day, batch, record) as emitted; late: (batch, record) rows of closed days; corrected: (day,
    record) of days whose emitted first event a late one precedes; final: (day, n, record, closed) over
    all rows, the flush of open days included.
    """
    where = {k: shared_scratch(spark, f"{name}-{k}") for k in ("days", "seen", "closed", "late")}
    kinds = dict(events.dtypes)
    record = "struct<" + ", ".join(f"`{c}`: {kinds[c]}" for c in cols) + ">"
    order = f"struct<`{ts}`: {kinds[ts]}, `{tie}`: {kinds[tie]}>"
    schemas = {
        "days": f"day date, n bigint, o {order}, r {record}",
        "seen": f"t {kinds[ts]}",
        "closed": f"day date, o {order}, r {record}",
        "late": f"day date, o {order}, r {record}",
    }
    day = F.to_date(ts)
    first = [F.min("o").alias("o"), F.min_by("r", "o").alias("r")]

    def read(part: str) -> DataFrame:
        return spark.read.schema(f"{schemas[part]}, batch bigint").parquet(where[part])

    def ended(days: DataFrame, horizon) -> DataFrame:
        """The days whose time is up at ``horizon``."""
        end = F.expr(f"timestampadd(DAY, 1, CAST(day AS {kinds[ts]})) + INTERVAL {late}")
        return days.filter(end <= F.lit(horizon).cast(kinds[ts])) if horizon is not None else days.limit(0)

    def write(batch: DataFrame, path: str) -> None:
        number = int(path.rsplit("=", 1)[1])

        def put(df: DataFrame, part: str) -> None:
            df.write.mode("overwrite").parquet(f"{where[part]}/batch={number}")

        rows = batch.select(day.alias("day"), F.struct(ts, tie).alias("o"), F.struct(*cols).alias("r"))
        before = read("seen").filter(F.col("batch") < number).agg(F.max("t")).first()[0] if number else None
        put(rows.groupBy("day").agg(F.count(F.lit(1)).alias("n"), *first).select("day", "n", "o", "r"), "days")
        put(ended(rows, before), "late")
        put(batch.agg(F.max(ts).alias("t")), "seen")
        now = read("seen").filter(F.col("batch") <= number).agg(F.max("t")).first()[0]
        all_days = read("days").filter(F.col("batch") <= number).groupBy("day").agg(*first)
        newly = ended(all_days, now)
        if number:
            newly = newly.join(read("closed").filter(F.col("batch") < number).select("day"), "day", "left_anti")
        put(newly.select("day", "o", "r"), "closed")

    _sink(spark, events, name, "append", write)
    closed, late_rows = read("closed"), read("late")
    whole = read("days").groupBy("day").agg(F.sum("n").alias("n"), *first)
    final = whole.join(closed.select("day", F.lit(True).alias("c")), "day", "left")
    fixed = late_rows.groupBy("day").agg(*first).join(closed.select("day", F.col("o").alias("was")), "day").filter("o < was")
    return {
        "closed": closed.select("day", "batch", "r.*"),
        "late": late_rows.select("batch", "r.*"),
        "corrected": fixed.select("day", "r.*"),
        "final": final.select("day", "n", "r.*", F.coalesce("c", F.lit(False)).alias("closed")),
    }


#: Stretch of time whose steps are summed up together.
LEVEL_BUCKET = "hour"
#: Steps worth a range of their own; the session's shuffle partitions are the most ranges.
STEPS_PER_RANGE = 100_000


def _put(df: DataFrame, path: str, group: str, batch: int) -> None:
    """Write rows to ``path/<group>=.../batch=<batch>``; a batch that is tried again replaces its own."""
    out = df.withColumn("batch", F.lit(batch).cast("bigint"))
    out.write.partitionBy(group, "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def _get(spark: SparkSession, path: str, group: str, groups: list[str], schema: str, batch: int) -> DataFrame:
    """What batches up to ``batch`` wrote for some groups; no other group's folder is opened or listed."""
    reader = spark.read.schema(f"{schema}, {group} string, batch bigint").option("basePath", path)
    return reader.parquet(*[f"{path}/{group}={g}" for g in groups]).filter(F.col("batch") <= batch)


def _newest(sums: DataFrame, *keys: str) -> DataFrame:
    """The last written (net, peak) of each key."""
    return sums.groupBy(*keys).agg(F.max_by(F.struct("net", "peak"), "batch").alias("s")).select(*keys, "s.net", "s.peak")


def stream_max_level(
    spark: SparkSession,
    events: DataFrame,
    ts: str,
    tie: str,
    delta: Column,
    peak_at: Column,
    bucket: str = LEVEL_BUCKET,
    out: str = "max_level",
    name: str = "stream_levels",
) -> DataFrame:
    """max(0, highest running total of ``delta`` at rows where ``peak_at`` holds), exact for
    any order of arrival.

    (net change, peak) of neighbouring stretches of time compose associatively, so they are kept as a
    tree: stretch (an hour) -> day -> month. A batch adds its non-zero steps to the folders of their
    days. A day is due when the steps that came since it was last summed up are as many as those
    before: its hours are then summed up from all its steps, and just the days and months above them
    renewed. What is still waiting at the end is summed up then, so a step is read a few times in
    all, in whatever order and in however many batches the steps come. The steps of an hour are cut
    into ranges of equal size first, so a hot hour is summed up by many tasks.
    """
    where = {k: shared_scratch(spark, f"{name}-{k}") for k in ("steps", "counts", "hours", "days", "months")}
    kind = dict(events.dtypes)
    sums = "net bigint, peak bigint"
    counts = "day string, summed bigint, waiting bigint, due boolean"

    def write(batch: DataFrame, path: str) -> None:
        number = int(path.rsplit("=", 1)[1])
        new = batch.select(
            F.date_format(ts, "yyyyMMdd").alias("day"),
            F.date_trunc(bucket, F.col(ts)).cast(kind[ts]).alias("b"),
            F.col(ts).alias("t"),
            F.col(tie).alias("id"),
            delta.cast("bigint").alias("d"),
            peak_at.alias("p"),
        ).filter("d <> 0")
        # A file a day, but where a day is large.
        _put(new.hint("rebalance", F.col("day")), where["steps"], "day", number)
        # One row a day: steps already summed up, steps waiting, and whether this batch sums it up.
        since = new.groupBy("day").agg(F.lit(0).cast("bigint").alias("summed"), F.count(F.lit(1)).alias("waiting"))
        if number:
            was = spark.read.schema(counts).parquet(f"{where['counts']}/batch={number - 1}")
            done, rest = F.when(F.col("due"), F.col("waiting")).otherwise(0), F.when(F.col("due"), 0).otherwise(F.col("waiting"))
            since = since.unionByName(was.select("day", (F.col("summed") + done).alias("summed"), rest.alias("waiting")))
        known = since.groupBy("day").agg(F.sum("summed").alias("summed"), F.sum("waiting").alias("waiting"))
        due = known.withColumn("due", (F.col("waiting") > 0) & (F.col("waiting") >= F.col("summed")))
        now = f"{where['counts']}/batch={number}"
        due.coalesce(1).write.mode("overwrite").parquet(now)
        renew(spark.read.schema(counts).parquet(now).filter("due"), number)

    def renew(which: DataFrame, number: int) -> None:
        """Sum up these days from all their steps, and the months above them."""
        known = which.select("day", (F.col("summed") + F.col("waiting")).alias("n")).collect()
        if not known:
            return
        days, n = [r["day"] for r in known], sum(r["n"] for r in known)
        ranges = min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // STEPS_PER_RANGE))
        steps = f"b {kind[ts]}, t {kind[ts]}, id {kind[tie]}, d bigint, p boolean"
        rows = range_buckets(_get(spark, where["steps"], "day", days, steps, number), ["b", "t", "id"], ranges)
        w = Window.partitionBy("day", "b", BUCKET).orderBy("t", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        level = rows.select("day", "b", BUCKET, "d", F.when(F.col("p"), F.sum("d").over(w)).alias("level"))
        sums_of = level.groupBy("day", "b", BUCKET).agg(F.sum("d").alias("net"), F.max("level").alias("peak"))
        _put(_fold(sums_of, BUCKET, ["day", "b"]), where["hours"], "day", number)

        hours = _newest(_get(spark, where["hours"], "day", days, f"b {kind[ts]}, {sums}", number), "day", "b")
        per_day = _fold(hours, "b", ["day"]).withColumn("month", F.substring("day", 1, 6))
        _put(per_day, where["days"], "month", number)

        months = sorted({d[:6] for d in days})
        by_day = _newest(_get(spark, where["days"], "month", months, f"day string, {sums}", number), "month", "day")
        _put(_fold(by_day, "day", ["month"]), where["months"], "month", number)

    _sink(spark, events, name, "append", write)
    try:
        known = spark.read.schema(f"{counts}, batch bigint").parquet(where["counts"])
        last = known.agg(F.max("batch")).first()[0]
    except AnalysisException:  # nothing has arrived: no folder
        last = None
    if last is not None:
        waiting = known.filter((F.col("batch") == last) & ~F.col("due") & (F.col("waiting") > 0))
        renew(waiting, last + 1)
    # The root: one row a month.
    try:
        root = spark.read.schema(f"{sums}, month string, batch bigint").parquet(where["months"])
    except AnalysisException:  # nothing has arrived: no folder
        root = spark.createDataFrame([], f"{sums}, month string, batch bigint")
    total = _fold(_newest(root, "month"), "month")
    return total.select(F.greatest(F.lit(0), F.coalesce("peak", F.lit(0))).cast("bigint").alias(out))


def _fold(sums: DataFrame, order: str, within: list[str] | None = None) -> DataFrame:
    """(net, peak) of stretches put together in ``order``, for each value of ``within``."""
    keys = within or []
    before = F.coalesce(F.sum("net").over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = sums.select(*keys, "net", (before + F.col("peak")).alias("peak"))
    return placed.groupBy(*keys).agg(F.sum("net").alias("net"), F.max("peak").alias("peak"))
