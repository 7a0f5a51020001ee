"""Plan shape: broadcast range join, no extra shuffle after it, no Python UDF, no
unpartitioned window over raw rows, filters and pruning at the scan."""

import re

import pytest

from cobble.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_uses_broadcast_hash_join(spark):
    p = plan(QUERIES["resolve_segments"](spark, SF))
    assert "BroadcastHashJoin" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_running_level_window_is_partitioned(spark):
    p = plan(QUERIES["max_concurrent_events"](spark, SF))
    # the raw-row window is partitioned by the range bucket; only the per-range fold is global
    assert "rangepartitioning" in p
    window = next(line for line in p.splitlines() if "Window" in line and "sum(_d#" in line)
    assert re.search(r"windowspecdefinition\(_bucket#\d+", window), window


def test_scan_prunes_columns(spark):
    df = QUERIES["hour_histogram"](spark, SF)
    p = plan(df)
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


def test_first_match_adds_no_shuffle_after_broadcast_join(spark):
    df = QUERIES["resolve_segments"](spark, SF)
    df.write.format("noop").mode("overwrite").save()
    lines = plan(df).splitlines()
    # The whole chain, both picks and all five joins down to the address aggregate, is one stage.
    top = next(i for i, l in enumerate(lines) if "min_by(_pid" in l and "partial_" not in l)
    joins = [i for i, l in enumerate(lines[: lines.index("+- == Initial Plan ==") if "+- == Initial Plan ==" in lines else None]) if "BroadcastHashJoin" in l and i > top]
    assert len(joins) >= 5
    assert not any("Exchange" in l and "Broadcast" not in l for l in lines[top : joins[4]])


def test_flagship_has_no_window(spark):
    for name in ("violations_by_segment", "resolve_segments"):
        assert "Window" not in plan(QUERIES[name](spark, SF))


def test_trip_concurrency_orders_distinct_times_only(spark):
    df = QUERIES["max_concurrent_trips"](spark, SF)
    p = plan(df)
    below = p[p.index("rangepartitioning"):]
    assert "HashAggregate" in below and "partial_sum(d#" in below


def test_complaints_report_two_shuffles_after_partial_aggregation(spark):
    df = QUERIES["complaints_report"](spark, SF)
    df.collect()
    p = plan(df).split("== Initial Plan ==")[0]  # the final adaptive plan only
    shuffles = [l for l in p.splitlines() if "Exchange hashpartitioning" in l]
    assert len(shuffles) == 2
    lines = p.splitlines()
    for i, l in enumerate(lines):
        if "Exchange hashpartitioning" in l:
            below = next(x for x in lines[i + 1:] if "HashAggregate" in x or "Scan" in x or "Join" in x)
            assert "partial_" in below
