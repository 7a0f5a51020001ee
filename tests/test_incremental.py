"""Violations that arrive file by file: the same report as from all files at once."""

import random

import pytest

from cobble.operators import violations as V
from cobble.operators.incremental import ViolationStore, write_bucketed
from cobble.operators.joins import street_index
from cobble.session import shared_scratch

FEATURES = "physicalid long, st_label string, full_stree string, borocode string, l_low_hn string, l_high_hn string, r_low_hn string, r_high_hn string, ord long"
PROBES = "year int, borough int, house string, street string"


@pytest.fixture(scope="module")
def city(spark):
    rnd = random.Random(21)
    feats = []
    for i in range(80):
        lo = rnd.randrange(0, 80)
        ends = (str(lo), str(lo + rnd.randrange(30))) * 2
        feats.append((100 + i, rnd.choice(["A ST", "B ST", "C AVE"]), rnd.choice(["ALPHA", "BETA"]), str(rnd.randrange(1, 3)), *ends, i))
    months = [
        [(rnd.choice(V.VIOLATION_YEARS), rnd.randrange(1, 3), str(rnd.randrange(120)), rnd.choice(["AST", "BST", "ALPHA", "NONE"])) for _ in range(n)]
        for n in (300, 1, 250, 300)
    ]
    segments, aliases = V.prepare_segments(spark.createDataFrame(feats, FEATURES))
    roster = spark.createDataFrame([(i,) for i in range(90, 200)] + [(105,)] * 3, "pid long")
    return segments, aliases, roster, [spark.createDataFrame(m, PROBES) for m in months]


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_adding_a_month_equals_the_full_run(spark, city):
    segments, aliases, roster, months = city
    index = street_index(segments, aliases)
    store = ViolationStore(shared_scratch(spark, "store"))
    table = write_bucketed(roster, "pid", 4)
    so_far = None
    for batch, month in enumerate(months):
        store.add(month, index, batch)
        if batch == 2:  # tried again, after the next could not start
            store.add(month, index, batch)
        so_far = month if so_far is None else so_far.unionByName(month)
        assert _rows(store.report(table, 4)) == _rows(V.violations_report(so_far, segments, aliases, roster))


def test_addresses_are_resolved_once(spark, city):
    segments, aliases, _, months = city
    index = street_index(segments, aliases)
    store = ViolationStore(shared_scratch(spark, "store"))
    for batch, month in enumerate([months[0], months[0], months[2]]):
        store.add(month, index, batch)
    resolved = spark.read.parquet(f"{store.path}/resolved").groupBy("batch").count().collect()
    new = {r["batch"]: r["count"] for r in resolved}
    seen = months[0].select(*V.ADDRESS_KEYS).distinct()
    assert new.get(1, 0) == 0 and new[0] == seen.count()
    assert new[2] == months[2].select(*V.ADDRESS_KEYS).distinct().join(seen, V.ADDRESS_KEYS, "left_anti").count()


def test_outer_join_of_bucketed_tables_has_no_exchange(spark, city):
    segments, aliases, roster, months = city
    store = ViolationStore(shared_scratch(spark, "store"))
    store.add(months[0], street_index(segments, aliases), 0)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = store.report(write_bucketed(roster, "pid", 4), 4, ordered=False)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    below = plan[plan.index("FullOuter"):]
    assert "Exchange" not in below and below.count("Bucketed: true") == 2
