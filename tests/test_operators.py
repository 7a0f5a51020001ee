"""Aggregation, ordering and join operators on small fixtures, including skew and
brute-force comparisons."""

import random
from collections import Counter
from itertools import accumulate

from pyspark.sql import functions as F

from cobble.operators import aggregates as A
from cobble.operators import ordered as O


def test_tie_rules(spark):
    counts = spark.createDataFrame([("g", "a", 3), ("g", "b", 3)], "g string, item string, n long")
    best = A.best_per_group(counts, "g", "item", "n").first()
    assert (best["item"], best["n"]) == ("a", 3)
    top = A.most_frequent(counts, "item", "n").first()
    assert (top["item"], top["n"]) == ("b", 3)
    k = O.top_k(counts, 2, F.desc("n"), F.asc("item")).collect()
    assert [r["item"] for r in k] == ["a", "b"]


def test_customer_runs(spark):
    df = spark.createDataFrame([("p", "c1", 1), ("p", "c1", 2), ("p", "c2", 3), ("p", "c1", 4)], "p string, c string, t long")
    assert O.change_runs(df, "p", "c", ["t"]).first()["runs"] == 3
    assert A.distinct_and_total(df.withColumn("amt", F.lit(1.0)), "p", "c", "amt").first()["customers"] == 2


def _brute_runs(rows):
    last, runs = {}, {}
    for key, member, t in sorted(rows, key=lambda r: (r[0], r[2])):
        if last.get(key, object()) != member:
            runs[key] = runs.get(key, 0) + 1
        last[key] = member
    return runs


def test_change_runs_random_against_scan(spark):
    rnd = random.Random(7)
    # one hot key holding most rows, plus a few small ones
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(4)}", rnd.choice("abc"), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, m string, t long")
    got = {r["k"]: r["runs"] for r in O.change_runs(df, "k", "m", ["t"], num_buckets=13).collect()}
    assert got == _brute_runs(rows)


def test_running_level_cases(spark):
    def level(events):
        df = spark.createDataFrame([(i, e) for i, e in enumerate(events)], "t long, e string")
        d = F.when(F.col("e") == "undock", 1).when(F.col("e") == "dock", -1).otherwise(0)
        return O.max_running_level(df, ["t"], d, F.col("e") == "undock").first()["max_level"]

    assert level(["undock", "undock", "dock", "undock", "other"]) == 2
    assert level(["dock", "undock"]) == 0


def test_running_level_random_against_scan(spark):
    rnd = random.Random(3)
    ev = [rnd.choice(["undock", "undock", "dock", "dock", "dock", "x"]) for _ in range(5000)]
    levels = accumulate({"undock": 1, "dock": -1}.get(e, 0) for e in ev)
    best = max([0, *(lv for lv, e in zip(levels, ev) if e == "undock")])
    df = spark.createDataFrame([(i, e) for i, e in enumerate(ev)], "t long, e string")
    d = F.when(F.col("e") == "undock", 1).when(F.col("e") == "dock", -1).otherwise(0)
    got = O.max_running_level(df, ["t"], d, F.col("e") == "undock", num_buckets=11).first()["max_level"]
    assert got == best


def test_max_concurrency_half_open(spark):
    df = spark.createDataFrame([(1, 5, 1), (5, 8, 2), (2, 6, 3)], "s long, e long, id long")
    # [1,5) [5,8) [2,6): at most 2 open at once (the stop at 5 comes before the start at 5)
    assert O.max_concurrency(df, "s", "e").first()["max_concurrent"] == 2


def test_max_concurrency_random_against_counting(spark):
    rnd = random.Random(8)
    spans = [(a, a + rnd.randrange(0, 6)) for a in (rnd.randrange(0, 40) for _ in range(2000))]
    df = spark.createDataFrame(spans, "s long, e long")
    # Stops of a time come before its starts; an empty span is both at once.
    events = Counter()
    for a, b in spans:
        events[a, 1] += 1
        events[b, 0] -= 1
    levels = list(accumulate(n for _, n in sorted(events.items())))
    got = O.max_concurrency(df, "s", "e", num_buckets=7).first()["max_concurrent"]
    assert got == max(lv for lv, (k, _) in zip(levels, sorted(events.items())) if k[1] == 1)


def test_change_runs_with_missing_members(spark):
    rows = [("p", m, t) for t, m in enumerate(["a", None, None, "a"])] + [("q", None, 1), ("q", None, 2)]
    df = spark.createDataFrame(rows, "p string, m string, t long")
    for n in (1, 3, 6):
        got = {r["p"]: r["runs"] for r in O.change_runs(df, "p", "m", ["t"], num_buckets=n).collect()}
        assert got == {"p": 3, "q": 1}


def test_money_stays_exact(spark):
    df = spark.createDataFrame([("p", 1), ("p", 2)], "p string, c int").withColumn("amt", F.lit("90071992547409.93"))
    total = A.distinct_and_total(df, "p", "c", "amt").first()["revenue"]
    assert str(total) == "180143985094819.86"


def test_first_per_group(spark):
    df = spark.createDataFrame([(1, "d1", 5), (2, "d1", 3), (3, "d2", 9), (4, "d1", 3)], "id long, day string, t long")
    got = {r["day"]: r["id"] for r in O.first_per_group(df, "day", ["t", "id"], "g").withColumnRenamed("g", "x").collect()}
    assert got == {"d1": 2, "d2": 3}


def test_weighted_mean(spark):
    df = spark.createDataFrame([("b", 400, 10), ("b", 500, 5)], "boro string, score long, takers long")
    assert A.weighted_mean_truncated(df, "boro", "score", "takers").first()["mean_score"] == 433


def test_complaints_report_two_levels(spark):
    rows = [("P", "2019-01-01", "a")] * 5 + [("P", "2019-02-01", "b")] * 3 + [("P", "2020-01-01", "a")] + [(None, "2019-01-01", "a")]
    df = spark.createDataFrame(rows, "product string, date string, company string")
    got = {(r["product"], r["year"]): (r["complaints"], r["companies"], r["top_share_pct"]) for r in A.complaints_report(df, "product", "date", "company").collect()}
    assert got == {("P", "2019"): (8, 2, 62), ("P", "2020"): (1, 1, 100)}


def test_roster_outer_join_keeps_repeats(spark):
    from cobble.operators.joins import roster_outer_join

    roster = spark.createDataFrame([(1,), (1,), (2,)], "pid long")
    res = spark.createDataFrame([(1, 3), (9, 4)], "pid long, n long")
    got = sorted((r["pid"], r["n"], r["copy"]) for r in roster_outer_join(roster, res, "pid", ["n"]).collect())
    assert got == [(1, 3, 1), (1, 3, 2), (2, 0, 1), (9, 4, 1)]


def test_revenue_report_header_and_money(spark):
    import glob

    from cobble.plans.queries import write_revenue_report
    from cobble.session import shared_scratch

    df = spark.createDataFrame([(7, 2, "10.5"), (8, 1, "0.1")], "product long, customers long, revenue string")
    df = df.withColumn("revenue", F.col("revenue").cast("decimal(28,2)"))
    path = shared_scratch(spark, "rev_test")
    write_revenue_report(df.coalesce(1), path)
    lines = open(sorted(glob.glob(path + "/part-*.csv"))[0]).read().splitlines()
    assert lines[0] == "Product ID, Customer Count, Total Revenue"
    assert sorted(lines[1:]) == ["7,2,10.50", "8,1,0.10"]


def test_first_lines_by_stored_ordinal(spark):
    # the first n lines by a stored input ordinal, independent of how the rows are split
    df = spark.createDataFrame([(i, f"w{i % 3}") for i in range(20)], "line_no long, value string").repartition(5)
    got = sorted(r["line_no"] for r in O.first_lines(df, "line_no", 7).collect())
    assert got == list(range(7))


def test_ordinal_counts_through_all_ranges(spark):
    df = spark.createDataFrame([(i * 7 % 1000, i) for i in range(1000)], "k long, v long")
    got = {r["k"]: r["ordinal"] for r in O.with_ordinal(df, ["k"], num_buckets=9).collect()}
    assert got == {k: k for k in range(1000)}
