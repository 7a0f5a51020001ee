"""Joins: size-checked broadcast, first-match range join, roster outer join."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cobble.functions.streets import house_parity, in_box
from cobble.session import shared_scratch

# Default bound for shipping a lookup to every task (an explicit hint; Spark's own
# automatic limit is 10 MiB, and a city's street segments are just above that).
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024
DEFAULT_BROADCAST_ROWS = 20_000_000


@dataclass(frozen=True)
class SizeCheck:
    rows: int
    approx_bytes: int
    broadcast: bool


def _approx_width(field: T.StructField) -> Column:
    """Bytes one value takes in a row, close enough for a broadcast decision."""
    dt, c = field.dataType, F.col(field.name)
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + F.lit(8)
    if isinstance(dt, T.ArrayType):
        return F.coalesce(F.size(c), F.lit(0)) * F.lit(8) + F.lit(16)
    return F.lit(8)


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes) of a DataFrame, by one distributed aggregate."""
    width = None
    for f in df.schema.fields:
        w = _approx_width(f)
        width = w if width is None else width + w
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def broadcast_if_bounded(
    df: DataFrame,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
) -> tuple[DataFrame, SizeCheck]:
    """Hint ``broadcast`` only when the measured size is within bounds; otherwise leave the
    join to a shuffle (sort-merge, with AQE's skew handling).

    The table is written to the shared folder, measured there and joined from there: it is
    built once, and nothing stays in the executors' memory after the query."""
    spark = df.sparkSession
    path = shared_scratch(spark, "lookup")
    df.write.parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    rows, size = measure(written)
    ok = rows <= max_rows and size <= max_bytes
    return (F.broadcast(written) if ok else written), SizeCheck(rows, size, ok)


#: Ranges under one (street, borough, side, parts) that an address may be tested against one by one.
PLAIN_RANGES = 64


@dataclass(frozen=True)
class StreetIndex:
    """What an address is looked up in.

    ``nodes``: (label, borough, side, n, l1, i1, l2, i2, lo1 ... high, rank, pid), the ranges of every
    label; ``levels``: the distinct (l1, l2) of each (label, borough, side, n); ``names``: alias ->
    label. Column names begin with n_, v_ and a_. ``checks`` holds the size of each and whether it
    is broadcast.
    """

    nodes: DataFrame
    levels: DataFrame
    names: DataFrame
    checks: tuple[SizeCheck, SizeCheck, SizeCheck]


def segment_ranges(segments: DataFrame) -> DataFrame:
    """One row per side of a segment: (label, borough, side, n, low, high, rank, pid).

    ``segments``: label, borough, l_low, l_high, r_low, r_high (ARRAY<BIGINT>), pid, ord. The side
    comes from parity, so it is an equality key of the join. Of rows with the very same range
    only the first in source order can ever be chosen: an ordinary aggregate keeps it, map-side
    first, so no window numbers the rows of a hot street.
    """
    sides = F.array(
        F.struct(F.lit(1).alias("side"), F.col("l_low").alias("low"), F.col("l_high").alias("high")),
        F.struct(F.lit(0).alias("side"), F.col("r_low").alias("low"), F.col("r_high").alias("high")),
    )
    rows = segments.select("label", "borough", "pid", "ord", F.explode(sides).alias("s"))
    # Ends of unequal length can never hold a house number (its parts must match both).
    rows = rows.select("label", "borough", "s.side", "s.low", "s.high", "pid", "ord").filter(F.size("low") == F.size("high"))
    best = rows.groupBy("label", "borough", "side", "low", "high").agg(
        F.min("ord").alias("rank"), F.min_by("pid", "ord").alias("pid")
    )
    return best.select("label", "borough", "side", F.size("low").alias("n"), "low", "high", "rank", "pid")


def dyadic_cover(low: str, high: str) -> Column:
    """ARRAY<STRUCT<l INT, i BIGINT>>: the aligned blocks [i * 2**l, (i + 1) * 2**l) that make up
    [low, high] exactly, two a level at most; empty where low > high. Ends must not be negative.

    At level l the still uncovered blocks are first .. last; an odd first one, or an even last
    one, has no sibling left and is taken.
    """
    first = f"(shiftright({low} - 1L, l) + 1L)"
    full = f"(({high} & ~shiftleft(-1L, l)) = ~shiftleft(-1L, l))"
    last = f"(shiftright({high}, l) - IF({full}, 0L, 1L))"
    taken = (
        f"concat(IF({first} <= {last} AND ({first} & 1L) = 1L, array(named_struct('l', l, 'i', {first})), array()), "
        f"IF({first} <= {last} AND ({last} & 1L) = 0L, array(named_struct('l', l, 'i', {last})), array()))"
    )
    return F.expr(f"flatten(transform(sequence(0, 63), l -> {taken}))")


def range_nodes(ranges: DataFrame, plain: int = PLAIN_RANGES) -> DataFrame:
    """Ranges as index rows that an address meets by equality.

    A key (label, borough, side, n) with up to ``plain`` ranges keeps them as they are, at level
    -1: an address tests each. A key with more is indexed: every range is cut into dyadic blocks of
    its first part (and of its second one, where there is one), and a block keeps the first range in
    source order that covers it, a segment tree whose nodes are rows. An address then meets one
    row a level, whatever the number of ranges. Numbers of three or more parts keep the ranges of a
    block apart, as their further parts are tested one by one.
    """
    key = ["label", "borough", "side", "n"]
    crowded = ranges.groupBy(*key).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > plain)
    some = not crowded.isEmpty()
    if some:
        marked = crowded.select(*key, F.lit(True).alias("_many"))
        rows = ranges.join(marked, key, "left").withColumn("_many", F.coalesce("_many", F.lit(False)))
    else:
        rows = ranges.withColumn("_many", F.lit(False))
    one = F.array(F.struct(F.lit(0).alias("l"), F.lit(0).cast("bigint").alias("i")))
    flat = rows.filter(~F.col("_many")).select(
        *key,
        F.lit(-1).alias("l1"), F.lit(0).cast("bigint").alias("i1"), F.lit(-1).alias("l2"), F.lit(0).cast("bigint").alias("i2"),
        F.element_at("low", 1).alias("lo1"), F.element_at("high", 1).alias("hi1"),
        F.try_element_at("low", F.lit(2)).alias("lo2"), F.try_element_at("high", F.lit(2)).alias("hi2"),
        F.when(F.col("n") > 2, F.col("low")).alias("low"), F.when(F.col("n") > 2, F.col("high")).alias("high"), "rank", "pid",
    )
    if not some:
        return flat
    blocks = (
        rows.filter("_many")
        .select(*key, "low", "high", "rank", "pid", F.explode(dyadic_cover("low[0]", "high[0]")).alias("x"))
        .withColumn("y", F.explode(F.when(F.col("n") > 1, dyadic_cover("get(low, 1)", "get(high, 1)")).otherwise(one)))
        .select(
            *key, F.col("x.l").alias("l1"), F.col("x.i").alias("i1"), F.col("y.l").alias("l2"), F.col("y.i").alias("i2"),
            F.when(F.col("n") > 2, F.col("low")).alias("low"), F.when(F.col("n") > 2, F.col("high")).alias("high"), "rank", "pid",
        )
    )
    node = [*key, "l1", "i1", "l2", "i2", "low", "high"]
    first = blocks.groupBy(*node).agg(F.min("rank").alias("rank"), F.min_by("pid", "rank").alias("pid"))
    none = [F.lit(None).cast("bigint").alias(c) for c in ("lo1", "hi1", "lo2", "hi2")]
    return flat.unionByName(first.select(*key, "l1", "i1", "l2", "i2", *none, "low", "high", "rank", "pid"))


def street_index(
    segments: DataFrame,
    aliases: DataFrame,
    max_bytes: int = DEFAULT_BROADCAST_BYTES,
    max_rows: int = DEFAULT_BROADCAST_ROWS,
    plain: int = PLAIN_RANGES,
) -> StreetIndex:
    """The lookup of ``first_match_segment``: two rows a segment (more only where a street is
    indexed by blocks), and the alias names apart from them. ``aliases``: alias, label, aord (first
    source position of that pair). A name equal to its label adds nothing, as labels are tried first.
    """
    def named(df: DataFrame, mark: str) -> DataFrame:
        return df.toDF(*[f"{mark}_{c}" for c in df.columns])

    # Written once: the ranges are counted by street before they are laid out.
    path = shared_scratch(segments.sparkSession, "ranges")
    segment_ranges(segments).write.parquet(path)
    ranges = segments.sparkSession.read.parquet(path)
    nodes, c1 = broadcast_if_bounded(named(range_nodes(ranges, plain), "n"), max_bytes, max_rows)
    key = [F.col(f"n_{c}").alias(c) for c in ("label", "borough", "side", "n")]
    used = nodes.groupBy(*key).agg(F.collect_set(F.struct(F.col("n_l1").alias("l1"), F.col("n_l2").alias("l2"))).alias("levels"))
    levels, c2 = broadcast_if_bounded(named(used, "v"), max_bytes, max_rows)
    other = aliases.filter(F.col("alias") != F.col("label")).select("alias", "label", "aord")
    names, c3 = broadcast_if_bounded(named(other, "a"), max_bytes, max_rows)
    return StreetIndex(nodes, levels, names, (c1, c2, c3))


def _candidates(rows: DataFrame, index: StreetIndex, name: str, borough: str, parts: str) -> DataFrame:
    """``rows`` with ``_rank`` and ``_pid`` of each range that holds their house number under the label
    in column ``name`` (NULL where none does): the levels of that label, then a node a level."""
    c = F.col
    n, side = F.size(parts), house_parity(parts).cast("int")
    p1, p2 = F.element_at(parts, 1), F.try_element_at(parts, F.lit(2))
    keyed = (c(name) == c("v_label")) & (c(borough) == c("v_borough")) & (side == c("v_side")) & (n == c("v_n"))
    found = rows.join(index.levels, keyed, "left").select(*rows.columns, F.explode_outer("v_levels").alias("_l"))

    def place(p: Column, level: str) -> Column:
        # The block that holds a part at a level; 0 where ranges are kept as they are, or there is no such part.
        return F.when(c(level) < 0, 0).otherwise(F.coalesce(F.call_function("shiftright", p, c(level)), F.lit(0))).cast("bigint")

    probed = found.select(
        *rows.columns,
        side.alias("_side"), n.alias("_n"), p1.alias("_p1"), p2.alias("_p2"),
        c("_l.l1").alias("_l1"), place(p1, "_l.l1").alias("_i1"), c("_l.l2").alias("_l2"), place(p2, "_l.l2").alias("_i2"),
    )
    cond = (
        (c(name) == c("n_label")) & (c(borough) == c("n_borough")) & (c("_side") == c("n_side")) & (c("_n") == c("n_n"))
        & (c("_l1") == c("n_l1")) & (c("_i1") == c("n_i1")) & (c("_l2") == c("n_l2")) & (c("_i2") == c("n_i2"))
        & (c("n_lo1").isNull() | ((c("n_lo1") <= c("_p1")) & (c("_p1") <= c("n_hi1"))))
        & (c("n_lo2").isNull() | ((c("n_lo2") <= c("_p2")) & (c("_p2") <= c("n_hi2"))))
        & (c("n_low").isNull() | in_box(c(parts), c("n_low"), c("n_high")))
    )
    return probed.join(index.nodes, cond, "left").select(*rows.columns, c("n_rank").alias("_rank"), c("n_pid").alias("_pid"))


def first_match_segment(
    addresses: DataFrame,
    index: StreetIndex,
    address_keys: Sequence[str],
    street: str = "street",
    borough: str = "borough",
    parts: str = "parts",
    keep_all: bool = False,
) -> DataFrame:
    """Resolve each address row to the first segment whose range holds its house number.

    ``addresses`` must be distinct on ``address_keys``. The street is tried as a label first: its
    ranges in source order. Only an address that no range of the label holds goes on to the labels
    that its street is an alias of, in alias order; the aliases are never multiplied with the
    segments. Addresses with no candidate are dropped (the matching is an inner join), and so are
    those whose first match has no readable id; ``keep_all`` keeps both with a null id.

    Both picks are ``min_by`` aggregates by the address keys that the input is already partitioned
    on, so they add no shuffle after the (broadcast) joins.
    """
    others = [c for c in addresses.columns if c not in address_keys]
    kept = [F.first(c).alias(c) for c in others]
    own = _candidates(addresses, index, street, borough, parts)
    own = own.groupBy(*address_keys).agg(
        *kept, F.min_by("_pid", "_rank").alias("_own"), (F.count("_rank") > 0).alias("_done")
    )
    on = (~F.col("_done")) & (F.col(street) == F.col("a_alias"))
    named = own.join(index.names, on, "left").withColumnsRenamed({"a_label": "_label", "a_aord": "_aord"}).drop("a_alias")
    found = _candidates(named, index, "_label", borough, parts)
    order = F.when(F.col("_rank").isNotNull(), F.struct("_aord", "_rank"))
    picked = found.groupBy(*address_keys).agg(
        *kept, F.first("_own").alias("_own"), F.first("_done").alias("_done"), F.min_by("_pid", order).alias("_pid")
    )
    pid = F.when(F.col("_done"), F.col("_own")).otherwise(F.col("_pid"))
    matched = picked.select(*addresses.columns, pid.alias("pid"))
    return matched if keep_all else matched.filter(F.col("pid").isNotNull())


#: Copies of one roster id that a single row stands for until the last step.
COPIES_PER_ROW = 1000


def roster_outer_join(
    roster: DataFrame,
    results: DataFrame,
    key: str,
    fill_cols: Sequence[str],
    ordered: bool = False,
    copies_per_row: int = COPIES_PER_ROW,
) -> DataFrame:
    """Every roster id (repeats kept) plus every result id, with zeros where nothing matched.

    The roster is first reduced to (id, copies) so the outer join sees unique keys on both
    sides. An id becomes a row for each ``copies_per_row`` of its copies; these rows are
    dealt out anew and only then does each of them become its copies, so a hot id is
    expanded by many tasks and no array holds more than ``copies_per_row`` numbers.
    ``ordered`` sorts by (id, copy), which splits a hot id as well.
    """
    copies = roster.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
    joined = copies.join(results, key, "full")
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in fill_cols]
    n = F.coalesce(F.col("_copies"), F.lit(1)).cast("bigint")
    per = F.lit(int(copies_per_row)).cast("bigint")
    last = F.expr(f"(coalesce(_copies, 1L) - 1) div {int(copies_per_row)}L")
    rows = joined.select(key, *filled, n.alias("_n"), F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("_row"))
    first = F.col("_row") * per + 1
    upto = F.least(F.col("_n"), (F.col("_row") + 1) * per)
    full = rows.repartition(key, "_row").select(key, *fill_cols, F.explode(F.sequence(first, upto)).alias("copy"))
    return full.orderBy(key, "copy") if ordered else full
