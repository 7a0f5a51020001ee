"""First-match range join: fixed cases and a randomized comparison with a plain restatement."""

import random

import pytest
from pyspark.sql import functions as F

from cobble.operators import violations as V
from cobble.operators.joins import dyadic_cover, first_match_segment, range_nodes, segment_ranges, street_index

FEATURE_SCHEMA = (
    "physicalid long, st_label string, full_stree string, borocode string, "
    "l_low_hn string, l_high_hn string, r_low_hn string, r_high_hn string, ord long"
)


def resolve(spark, features, probes, **index):
    """probes: (street_key, borough, house) -> {address: pid}."""
    segments, aliases = V.prepare_segments(spark.createDataFrame(features, FEATURE_SCHEMA))
    addr = spark.createDataFrame(probes, "street string, borough int, house string").distinct()
    addr = addr.withColumn("parts", V.house_parts("house")).filter(F.col("parts").isNotNull())
    m = first_match_segment(addr, street_index(segments, aliases, **index), V.ADDRESS_KEYS)
    return {(r["street"], r["borough"], r["house"]): r["pid"] for r in m.collect()}


def test_first_in_source_order(spark):
    feats = [
        (10, "MAIN ST", "MAIN STREET", "1", "1", "99", "2", "98", 0),
        (11, "MAIN ST", "MAIN STREET", "1", "1", "99", "2", "98", 1),
    ]
    assert resolve(spark, feats, [("MAINST", 1, "41")]) == {("MAINST", 1, "41"): 10}


def test_alias_used_only_when_label_fails(spark):
    feats = [
        (20, "A ST", "BIG ROAD", "1", "1", "9", "2", "8", 0),   # label A ST: wrong range for 51
        (21, "B ST", "BIG ROAD", "1", "41", "61", "40", "60", 1),
        (22, "BIGROAD", "OTHER", "1", "41", "61", "40", "60", 2),  # label equal to the alias key
    ]
    got = resolve(spark, feats, [("AST", 1, "51"), ("BIGROAD", 1, "51"), ("AST", 1, "5")])
    # 'AST' 51: A ST range fails; A ST is not an alias -> no match.
    # 'BIGROAD' 51: label BIGROAD matches first (priority 0) -> 22.
    # 'AST' 5: own label.
    assert got == {("BIGROAD", 1, "51"): 22, ("AST", 1, "5"): 20}


def test_alias_order(spark):
    feats = [
        (30, "X ST", "LONG AVE", "2", "1", "99", "2", "98", 5),
        (31, "Y ST", "LONG AVE", "2", "1", "99", "2", "98", 3),
    ]
    # alias LONGAVE lists Y ST first (source position 3) then X ST
    assert resolve(spark, feats, [("LONGAVE", 2, "10")]) == {("LONGAVE", 2, "10"): 31}


def test_unparseable_segment_dropped(spark):
    feats = [(40, "Z ST", "Z ST", "3", "1", "99", "2", "9A", 0)]
    assert resolve(spark, feats, [("ZST", 3, "5")]) == {}


def _plain_match(features, street, boro, numbers):
    """The id of the first feature in matching order whose range holds the house numbers."""
    hits = []
    for pid, label, alias, b, *ends, place in features:
        lows_highs = [[int(x) for x in e.split("-")] if "X" not in e else None for e in ends]
        if None in lows_highs or int(b) != boro:
            continue
        low, high = lows_highs[:2] if numbers[-1] % 2 else lows_highs[2:]
        if len(low) == len(numbers) == len(high) and all(x <= n <= y for x, n, y in zip(low, numbers, high)):
            own = label.replace(" ", "")
            hits.append(((0, 0, place), own, pid))
            hits += [((1, at, place), name, pid) for name, of, at in _names(features) if of == own != name]
    return min((rank, pid) for rank, name, pid in [*hits, ((9,), street, None)] if name == street)[1]


def _names(features):
    """(alias, label, place of the first readable feature that pairs them)."""
    first = {}
    for _, label, alias, _, *ends, place in features:
        if not any("X" in e for e in ends):
            pair = alias.replace(" ", ""), label.replace(" ", "")
            first[pair] = min(place, first.get(pair, place))
    return [(*pair, place) for pair, place in first.items()]


@pytest.mark.parametrize("plain", [0, 4, 64])
def test_random_against_plain_rules(spark, plain):
    rnd = random.Random(11)
    labels = ["A ST", "B ST", "C AVE", "D PL"]
    aliases = ["ALPHA", "BETA", "A ST"]
    feats = []
    for i in range(60):
        def end():
            lo = rnd.randrange(0, 60)
            if rnd.random() < 0.15:
                return f"{rnd.randrange(1, 3)}-{lo}-{rnd.randrange(4)}", f"{rnd.randrange(2, 5)}-{lo + rnd.randrange(40)}-{rnd.randrange(2, 9)}"
            if rnd.random() < 0.2:
                return f"{rnd.randrange(1, 5)}-{lo}", f"{rnd.randrange(5, 9)}-{lo + rnd.randrange(0, 40)}"
            return str(lo), str(lo + rnd.randrange(0, 40))
        (ll, lh), (rl, rh) = end(), end()
        if rnd.random() < 0.05:
            rh = rh + "X"
        feats.append((1000 + i, rnd.choice(labels), rnd.choice(aliases), str(rnd.randrange(1, 3)), ll, lh, rl, rh, i * 37 % 61))
    streets = ["AST", "BST", "CAVE", "DPL", "ALPHA", "BETA", "NONE"]
    # House numbers put together from known parts, and some that can't be read.
    probes = {}
    for _ in range(1500):
        kind = rnd.random()
        numbers = [rnd.randrange(99)] if kind < 0.5 else [rnd.randrange(1, 9), rnd.randrange(99)]
        if kind > 0.8:
            numbers = [rnd.randrange(1, 5), rnd.randrange(99), rnd.randrange(9)]
        house = "-".join(f"{n}{rnd.choice(['', '', 'A'])}" for n in numbers)
        probes[rnd.choice(streets), rnd.randrange(1, 3), house] = numbers
    bad = [(s, b, h) for s in streets for b in (1, 2) for h in ("", "A", "5-", "-5", "1AB", "A-5")]
    got = resolve(spark, feats, [*probes, *bad], plain=plain)
    want = {}
    for (s, b, h), numbers in probes.items():
        pid = _plain_match(feats, s, b, numbers)
        if pid is not None:
            want[(s, b, h)] = pid
    assert len(want) > 50
    assert got == want


def test_dyadic_cover(spark):
    """Blocks of a range, disjoint and together the range; a few at most, up to the largest number."""
    big = 2**63 - 1
    rnd = random.Random(3)
    pairs = [(a, b) for a in range(34) for b in range(34)]
    pairs += [(0, big), (1, big), (big, big), (big - 5, big), (0, big - 1), (2**62, 2**62 + 3), (5, 2**40)]
    pairs += [sorted(rnd.randrange(2**rnd.randrange(1, 63)) for _ in range(2)) for _ in range(200)]
    df = spark.createDataFrame([tuple(p) for p in pairs], "low bigint, high bigint")
    for low, high, blocks in df.select("low", "high", dyadic_cover("low", "high")).collect():
        spans = sorted((b["i"] << b["l"], (b["i"] + 1 << b["l"]) - 1) for b in blocks)
        if low > high:
            assert spans == []
            continue
        assert spans[0][0] == low and spans[-1][1] == high
        assert all(x[1] + 1 == y[0] for x, y in zip(spans, spans[1:]))
        assert len(spans) <= 2 * max(1, (high - low + 1).bit_length())


def _sweep(ranges, points):
    """First covering range (smallest place) of each point, by a heap over the ends."""
    import heapq

    starts = sorted((lo, place, hi) for place, (lo, hi) in enumerate(ranges))
    heap, k, out = [], 0, {}
    for p in sorted(points):
        while k < len(starts) and starts[k][0] <= p:
            heapq.heappush(heap, starts[k][1:])
            k += 1
        while heap and heap[0][1] < p:
            heapq.heappop(heap)
        if heap:
            out[p] = heap[0][0]
    return out


def test_one_street_with_very_many_ranges(spark):
    """100,000 ranges and 100,000 addresses of one street: a candidate a level at most, not 100,000."""
    n, top = 100_000, 1 << 20
    feats = spark.range(n).select(
        F.col("id").alias("physicalid"), F.lit("MAIN ST").alias("st_label"), F.lit("HIGH ST").alias("full_stree"), F.lit("1").alias("borocode"),
        (F.xxhash64("id") % 500_000 + 500_000).alias("low"), (F.xxhash64("id", F.lit(1)) % 3000 + 3000).alias("width"), "id",
    )
    feats = feats.withColumn("high", F.col("low") + F.col("width"))
    rows = feats.select("low", "high").collect()
    text = {c: F.col(s).cast("string") for c, s in (("l_low_hn", "low"), ("l_high_hn", "high"), ("r_low_hn", "low"), ("r_high_hn", "high"))}
    segments, aliases = V.prepare_segments(feats.withColumns(text).withColumn("ord", F.col("id")))
    index = street_index(segments, aliases)
    addr = spark.range(n).select((F.col("id") * 7919 % top).alias("h")).distinct()
    addr = addr.select(F.lit("MAINST").alias("street"), F.lit(1).alias("borough"), F.col("h").cast("string").alias("house"), "h")
    addr = addr.withColumn("parts", F.array("h"))
    got = {r["h"]: r["pid"] for r in first_match_segment(addr, index, V.ADDRESS_KEYS).collect()}
    assert got == _sweep([(r["low"], r["high"]) for r in rows], [i * 7919 % top for i in range(n)])
    # A node is one row, and an address meets at most one a level.
    key = [f"n_{c}" for c in ("label", "borough", "side", "n", "l1", "i1", "l2", "i2")]
    assert index.nodes.count() == index.nodes.select(*key).distinct().count()
    assert index.levels.selectExpr("max(size(v_levels))").first()[0] <= 14


def test_lookup_has_two_rows_a_segment(spark):
    """An alias of 10,000 labels adds names, not segments; it is only asked for where the label fails."""
    n = 10_000
    feats = [(i, f"L{i} ST", "BIG AVE", "1", str(2 * i + 1), str(2 * i + 1), str(2 * i), str(2 * i), n - i) for i in range(n)]
    feats.append((n, "BIG AVE", "OTHER", "1", "1", "9", "2", "8", n + 1))
    segments, aliases = V.prepare_segments(spark.createDataFrame(feats, FEATURE_SCHEMA))
    assert range_nodes(segment_ranges(segments)).count() == 2 * len(feats)
    probes = [("BIGAVE", 1, str(h)) for h in (5, 8, 9, 11, 12345, 2 * n + 5)]
    got = resolve(spark, feats, probes)
    assert got == {("BIGAVE", 1, "5"): n, ("BIGAVE", 1, "8"): n, ("BIGAVE", 1, "9"): n, ("BIGAVE", 1, "11"): 5, ("BIGAVE", 1, "12345"): 6172}


def test_label_match_without_an_id_does_not_go_on_to_aliases(spark):
    feats = [(None, "MAIN ST", "X", "1", "1", "9", "2", "8", 0), (7, "SIDE ST", "MAIN ST", "1", "1", "99", "2", "98", 1)]
    assert resolve(spark, feats, [("MAINST", 1, "5"), ("MAINST", 1, "51")]) == {("MAINST", 1, "51"): 7}


def _report(spark, features, houses, roster, **bounds):
    segments, aliases = V.prepare_segments(spark.createDataFrame(features, FEATURE_SCHEMA))
    probes = spark.createDataFrame([(2016, 1, h, "MAINST") for h in houses], "year int, borough int, house string, street string")
    ids = spark.createDataFrame([(i,) for i in roster], "pid long")
    return [(r["pid"], r["y2016"], r["copy"]) for r in V.violations_report(probes, segments, aliases, ids, **bounds).collect()]


def test_broadcast_off_gives_the_same(spark):
    feats = [(i, "MAIN ST", "HIGH ST", "1", str(2 * i + 1), str(2 * i + 1), str(2 * i), str(2 * i), i) for i in range(1, 50)]
    houses = [str(h) for h in range(120)] * 2
    on = _report(spark, feats, houses, range(1, 60))
    off = _report(spark, feats, houses, range(1, 60), max_broadcast_bytes=0)
    assert on == off and sum(n for _, n, _ in on) == 2 * 98


def test_first_match_without_an_id_is_no_match(spark):
    feats = [(None, "MAIN ST", "X", "1", "1", "9", "2", "8", 0), (7, "MAIN ST", "X", "1", "1", "99", "2", "98", 1)]
    assert _report(spark, feats, ["5", "51"], [7, 8]) == [(7, 1, 1), (8, 0, 1)]


def test_report_lines_print_like_python(spark):
    values = [0.0, 0.2, -6.8, 5.551115123125783e-18, -1.5e-05, 1e-05, 0.0001, 0.00012345678901234567, 12345678.9, 1e16, 1.5e22, 123456789012345.6, -0.1]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(V.python_float_text("v")).collect()] == [repr(v) for v in values]
