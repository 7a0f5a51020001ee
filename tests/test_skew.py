"""A key holding a large share of the rows is split across tasks, and results stay exact."""

from collections import Counter

from pyspark.sql import functions as F

from cobble.operators import ordered as O
from cobble.operators.joins import roster_outer_join


def _shares(df):
    sizes = Counter(r[0] for r in df.select(F.spark_partition_id()).collect())
    total = sum(sizes.values())
    return max(sizes.values()) / total, len(sizes)


def test_range_buckets_split_a_hot_key(spark):
    rows = [("hot" if i % 10 < 4 else f"k{i % 7}", i // 3, i) for i in range(20_000)]  # 40% one key
    df = spark.createDataFrame(rows, "k string, ts long, id long")
    b = O.range_buckets(df, ["k", "ts", "id"], 8)
    share, parts = _shares(b)
    assert parts == 8 and share < 0.25


def test_roster_sort_splits_a_hot_repeated_id(spark):
    roster = spark.createDataFrame([(7,)] * 8000 + [(i,) for i in range(12_000)], "pid long")  # id 7 is 40%
    res = spark.createDataFrame([(7, 5)], "pid long, n long")
    out = roster_outer_join(roster, res, "pid", ["n"], ordered=True, copies_per_row=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # these few rows would share a task
    try:
        made, _ = _shares(roster_outer_join(roster, res, "pid", ["n"], copies_per_row=100))
        share, parts = _shares(out)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert made < 0.25 and share < 0.25  # several tasks make the hot id's copies, and sort them
    assert [(r["pid"], r["copy"]) for r in out.collect()] == sorted((r["pid"], r["copy"]) for r in out.collect())
    got = Counter((r["pid"], r["n"]) for r in out.collect())
    assert got[(7, 5)] == 8001 and sum(got.values()) == 20_000


def test_change_runs_exact_with_hot_key(spark):
    rows = [("hot" if i % 10 < 4 else "cold", "ab"[(i // 5) % 2], i) for i in range(10_000)]
    df = spark.createDataFrame(rows, "k string, m string, t long")
    got = {r["k"]: r["runs"] for r in O.change_runs(df, "k", "m", ["t"], num_buckets=8).collect()}
    want = {}
    last = {}
    for k, m, _ in rows:
        if last.get(k) != m:
            want[k] = want.get(k, 0) + 1
        last[k] = m
    assert got == want
