"""Streaming jobs equal their batch twins."""

import random
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from cobble.plans.queries import QUERIES
from cobble.session import shared_scratch, table
from cobble.sources.io import read_stream
from cobble.streaming import jobs

SF = "/root/testdata/sf0.001"


def _arriving_in_time_order(spark, parts=6):
    """Events written as one file per time range, one write after another, so files arrive
    (by modification time) in event-time order, as a live feed would."""
    ev = table(spark, SF, "events").select("event_id", "ts", "user_id", "event_type", "value")
    bounds = ev.approxQuantile("event_id", [i / parts for i in range(1, parts)], 0.0)
    path = shared_scratch(spark, "ordered_events")
    lo = None
    for hi in [*bounds, None]:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col("event_id") > lo)
        if hi is not None:
            cond = cond & (F.col("event_id") <= hi)
        ev.filter(cond).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
        lo = hi
    return path


def test_first_event_of_day_append_mode_emits_closed_days(spark):
    cols = ["event_id", "ts", "user_id", "event_type", "value"]
    src = _arriving_in_time_order(spark)
    schema = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"
    s = jobs.first_event_of_day_windowed(read_stream(spark, src, schema, files_per_batch=1), cols)
    got = [(r["day"], r["event_id"]) for r in jobs.run_available(spark, s, "x2_append", mode="append").collect()]
    first = {r["day"]: r["event_id"] for r in QUERIES["first_event_of_day"](spark, SF).collect()}
    latest = table(spark, SF, "events").agg(F.max("ts")).first()[0]
    # exactly the days that ended an hour or more before the latest event, each once
    closed = {d: e for d, e in first.items() if datetime.fromisoformat(d) + timedelta(days=1) <= latest - timedelta(hours=1)}
    assert closed and sorted(got) == sorted(closed.items())


def test_stream_revenue_equals_batch(spark):
    s = {tuple(r) for r in QUERIES["stream_revenue"](spark, SF).select("event_type", "users").collect()}
    b = {tuple(r) for r in QUERIES["customer_runs"](spark, SF).select("event_type", "users").collect()}
    assert s == b


def test_stream_levels_equal_batch(spark):
    s = QUERIES["stream_max_concurrent_events"](spark, SF).first()[0]
    b = QUERIES["max_concurrent_events"](spark, SF).first()[0]
    assert s == b


def _shuffled_files(spark, rows, schema, files):
    """Rows dealt at random over files, which a stream then reads in any order."""
    random.Random(4).shuffle(rows)
    path = shared_scratch(spark, "shuffled_events")
    for k in range(files):
        spark.createDataFrame(rows[k::files], schema).coalesce(1).write.mode("append").parquet(path)
    return path


def test_level_is_exact_for_any_order_of_arrival(spark):
    rnd = random.Random(6)
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=rnd.randrange(200_000)), rnd.choice("+++--.")) for i in range(600)]
    level = best = 0
    for _, _, e in sorted(rows, key=lambda r: (r[1], r[0])):
        level += {"+": 1, "-": -1}.get(e, 0)
        best = max(best, level) if e == "+" else best
    schema = "id BIGINT, ts TIMESTAMP_NTZ, e STRING"
    src = _shuffled_files(spark, rows, schema, 5)
    s = read_stream(spark, src, schema, files_per_batch=2)
    delta = F.when(F.col("e") == "+", 1).when(F.col("e") == "-", -1).otherwise(0)
    assert jobs.stream_max_level(spark, s, "ts", "id", delta, F.col("e") == "+").first()[0] == best


def test_replayed_batch_counts_once(spark, monkeypatch):
    """Every batch is written twice, as after a failure between the write and its commit."""
    write_once = jobs._sink

    def twice(spark_, df, name, mode, write):
        def again(batch, path):
            write(batch, path)
            write(batch, path)

        return write_once(spark_, df, name, mode, again)

    want = {name: sorted(map(str, QUERIES[name](spark, SF).collect())) for name in ("stream_revenue", "stream_max_concurrent_events", "stream_hour_histogram")}
    monkeypatch.setattr(jobs, "_sink", twice)
    for name, rows in want.items():
        assert sorted(map(str, QUERIES[name](spark, SF).collect())) == rows


def _level(rows):
    level = best = 0
    for _, _, e in sorted(rows, key=lambda r: (r[1], r[0])):
        level += {"+": 1, "-": -1}.get(e, 0)
        best = max(best, level) if e == "+" else best
    return best


def _delta():
    return F.when(F.col("e") == "+", 1).when(F.col("e") == "-", -1).otherwise(0)


LEVEL_SCHEMA = "id BIGINT, ts TIMESTAMP_NTZ, e STRING"


def _files_in_order(spark, groups):
    """One file for each group of rows, read in this order."""
    path = shared_scratch(spark, "level_events")
    for g in groups:
        spark.createDataFrame(g, LEVEL_SCHEMA).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return path


def test_level_tree_reads_touched_days_and_months_only(spark, monkeypatch):
    """A month a file, then late rows of the second month: the last batch opens that month alone."""
    rnd = random.Random(8)
    groups = []
    for month in range(1, 5):
        start = datetime(2024, month, 1)
        groups.append([(month * 1000 + i, start + timedelta(hours=rnd.randrange(24 * 27)), rnd.choice("++-.")) for i in range(150)])
    groups.append([(9000 + i, datetime(2024, 2, 3, 4, i % 60), "+") for i in range(20)])
    opened, real = [], jobs._get

    def get(spark_, path, group, names, *rest):
        opened.append((rest[-1], group, sorted(names)))
        return real(spark_, path, group, names, *rest)

    monkeypatch.setattr(jobs, "_get", get)
    s = read_stream(spark, _files_in_order(spark, groups), LEVEL_SCHEMA, files_per_batch=1)
    got = jobs.stream_max_level(spark, s, "ts", "id", _delta(), F.col("e") == "+").first()[0]
    assert got == _level([r for g in groups for r in g])
    assert [x for x in opened if x[0] == 4] == [(4, "day", ["20240203"]), (4, "day", ["20240203"]), (4, "month", ["202402"])]


def test_level_of_one_hot_hour(spark):
    """All rows in one hour, most of them in one second: cut into ranges before they are summed up."""
    rnd = random.Random(12)
    hour = datetime(2024, 5, 5, 5)
    rows = [(i, hour + timedelta(seconds=rnd.choice([7, 7, 7, rnd.randrange(3600)])), rnd.choice("+-")) for i in range(900)]
    src = _shuffled_files(spark, rows, LEVEL_SCHEMA, 3)
    s = read_stream(spark, src, LEVEL_SCHEMA, files_per_batch=1)
    assert jobs.stream_max_level(spark, s, "ts", "id", _delta(), F.col("e") == "+").first()[0] == _level(rows)


def test_level_of_batches_without_steps(spark):
    rows = [(i, datetime(2024, 1, 1), ".") for i in range(5)]
    s = read_stream(spark, _shuffled_files(spark, rows, LEVEL_SCHEMA, 2), LEVEL_SCHEMA, files_per_batch=1)
    assert jobs.stream_max_level(spark, s, "ts", "id", _delta(), F.col("e") == "+").first()[0] == 0


def _plain_totals(rows):
    members, total = {}, {}
    for k, m, a in rows:
        members.setdefault(k, set()).add(m)
        total[k] = round(total.get(k, 0) + a, 2)
    return {(k, len(members[k]), total[k]) for k in members}


def test_distinct_members_over_compactions(spark):
    """Bitmaps of integers (negative, null and far apart ones too) and rows of strings, compacted twice."""
    rnd = random.Random(5)
    ids = [*range(-40, 40), 32767, 32768, 32769, -32768, 2**40, None]
    for kind, pick in (("bigint", lambda: rnd.choice(ids)), ("string", lambda: rnd.choice(["a", "b", None, "c"]))):
        rows = [(rnd.choice(["x", "y", None]), pick(), rnd.randrange(1000) / 100) for _ in range(700)]
        schema = f"k string, m {kind}, a double"
        src = _shuffled_files(spark, rows, schema, 5)
        s = read_stream(spark, src, schema, files_per_batch=1)
        got = jobs.stream_distinct_and_total(spark, s, "k", "m", "a", compact_every=2)
        assert {(r["k"], r["customers"], float(r["revenue"])) for r in got.collect()} == _plain_totals(rows)


def test_state_of_members_is_bounded_by_them(spark, monkeypatch):
    """Ten batches of the same members: what is read at the end does not grow with the batches."""
    rows = [("x", i, 1.0) for i in range(100)] * 10
    src = shared_scratch(spark, "same_members")
    for k in range(10):
        spark.createDataFrame(rows[:100], "k string, m bigint, a double").coalesce(1).write.mode("append").parquet(src)
    seen, real = [], jobs._merged_state
    monkeypatch.setattr(jobs, "_merged_state", lambda state, key, whole: seen.append(state.count()) or real(state, key, whole))
    s = read_stream(spark, src, "k string, m bigint, a double", files_per_batch=1)
    got = jobs.stream_distinct_and_total(spark, s, "k", "m", "a", compact_every=3)
    assert [tuple(r) for r in got.collect()] == [("x", 100, 1000)]
    # Two buckets (0 holds the member 0 alone): a compact table and fewer than three batches, always.
    assert seen[-1] == 2 * 2 and max(seen) <= 2 * 4


def test_late_events_are_listed_and_corrected(spark):
    """Two days close, then rows of the first day come late; the last day is flushed open."""
    d = datetime(2024, 3, 1)
    hour = timedelta(hours=1)
    groups = [
        [(1, d + 5 * hour, "a"), (2, d + 7 * hour, "b")],
        [(3, d + 30 * hour, "c")],  # the second day: the first one closes
        [(4, d + 2 * hour, "late, first"), (5, d + 9 * hour, "late"), (6, d + 26 * hour, "in time")],
        [(7, d + 55 * hour, "d"), (8, d + 3 * hour, "late")],
    ]
    schema = "event_id bigint, ts timestamp_ntz, e string"
    path = shared_scratch(spark, "late_events")
    for g in groups:
        spark.createDataFrame(g, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    s = read_stream(spark, path, schema, files_per_batch=1)
    out = jobs.stream_first_with_late(spark, s, ["event_id", "ts", "e"])

    def days(df, *cols):
        return sorted((str(r["day"])[-2:], *[r[c] for c in cols]) for r in df.collect())

    assert days(out["closed"], "batch", "event_id") == [("01", 1, 1), ("02", 3, 6)]
    assert sorted((r["batch"], r["event_id"]) for r in out["late"].collect()) == [(2, 4), (2, 5), (3, 8)]
    assert days(out["corrected"], "event_id") == [("01", 4)]
    assert days(out["final"], "n", "event_id", "closed") == [("01", 5, 4, True), ("02", 2, 6, True), ("03", 1, 7, False)]
    # No row is lost: in a day's count, whether late or not.
    assert sum(r["n"] for r in out["final"].collect()) == sum(map(len, groups))


def test_level_rereads_a_day_only_when_its_steps_have_doubled(spark, monkeypatch):
    """Ten batches that all touch the same day: its steps are read after 1, 2, 4 and 8 of them and at the end."""
    rnd = random.Random(14)
    day = datetime(2024, 6, 1)
    rows = [(i, day + timedelta(seconds=rnd.randrange(86_400)), rnd.choice("+-")) for i in range(400)]
    src = _shuffled_files(spark, rows, LEVEL_SCHEMA, 10)
    opened, real = [], jobs._get

    def get(spark_, path, group, names, *rest):
        if "steps" in path:
            opened.append((rest[-1], names))
        return real(spark_, path, group, names, *rest)

    monkeypatch.setattr(jobs, "_get", get)
    s = read_stream(spark, src, LEVEL_SCHEMA, files_per_batch=1)
    assert jobs.stream_max_level(spark, s, "ts", "id", _delta(), F.col("e") == "+").first()[0] == _level(rows)
    assert opened == [(n, ["20240601"]) for n in (0, 1, 3, 7, 10)]


def _tasks_of_state(spark, monkeypatch, name):
    """Rows of a query while the session shuffles into 40 partitions, and the state partitions of each batch."""
    seen, real = set(), jobs._sink

    def sink(spark_, df, name_, mode, write):
        def counted(batch, path):
            seen.add(batch.rdd.getNumPartitions())
            write(batch, path)

        return real(spark_, df, name_, mode, counted)

    monkeypatch.setattr(jobs, "_sink", sink)
    key = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(key)
    spark.conf.set(key, "40")
    try:
        rows = sorted(map(str, QUERIES[name](spark, SF).collect()))
        assert spark.conf.get(key) == "40"
    finally:
        spark.conf.set(key, usual)
    return rows, max(seen)


def test_hour_state_does_not_follow_the_shuffle_partitions(spark, monkeypatch):
    rows, parts = _tasks_of_state(spark, monkeypatch, "stream_hour_histogram")
    assert rows == sorted(map(str, QUERIES["hour_histogram"](spark, SF).collect())) and parts <= jobs.STATE_PARTITIONS


def test_day_state_does_not_follow_the_shuffle_partitions(spark, monkeypatch):
    rows, parts = _tasks_of_state(spark, monkeypatch, "stream_first_event_of_day")
    assert rows == sorted(map(str, QUERIES["first_event_of_day"](spark, SF).collect())) and parts <= jobs.STATE_PARTITIONS


def test_level_ranges_follow_the_steps(spark, monkeypatch):
    """900 steps of one hour: a single range, or several of about 200 steps; the same level."""
    rnd = random.Random(16)
    rows = [(i, datetime(2024, 5, 5, 5) + timedelta(seconds=rnd.randrange(3600)), rnd.choice("+-")) for i in range(900)]
    src = _shuffled_files(spark, rows, LEVEL_SCHEMA, 1)
    seen, real = [], jobs.range_buckets
    monkeypatch.setattr(jobs, "range_buckets", lambda df, by, n=None: seen.append(n) or real(df, by, n))
    for size in (100_000, 200):
        monkeypatch.setattr(jobs, "STEPS_PER_RANGE", size)
        s = read_stream(spark, src, LEVEL_SCHEMA, files_per_batch=1)
        assert jobs.stream_max_level(spark, s, "ts", "id", _delta(), F.col("e") == "+").first()[0] == _level(rows)
    assert seen == [1, 5]
