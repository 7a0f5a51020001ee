"""Keyed aggregations (DataFrame -> DataFrame).

All of them are plain ``groupBy().agg()`` plans, so Catalyst splits each into a partial
(map-side) and a final aggregate: a hot key is collapsed before the shuffle, never sent
row by row to one task. No group is ever collected into a list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobble.functions.streets import slope_over_years


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def whole_percent(share: Column) -> Column:
    """round(share * 100) with Python's half-to-even rule (12.5 -> 12); share is divided first."""
    return F.bround(share * F.lit(100.0), 0).cast("int")


def top_share_report(df: DataFrame, group: Sequence[str], member: str) -> DataFrame:
    """Per group: rows, distinct members, and the largest member's share as a whole percent.

    Two aggregations: (group, member) counts, then per group sum / count / max of those
    counts. Both have partial aggregation, so only one row per (group, member) per task
    and one row per group per task cross the shuffles.
    """
    per_member = df.groupBy(*group, member).agg(F.count(F.lit(1)).alias("_n"))
    return per_member.groupBy(*group).agg(
        F.sum("_n").alias("complaints"),
        F.count(F.lit(1)).alias("companies"),
        whole_percent(F.max("_n") / F.sum("_n")).alias("top_share_pct"),
    )


def complaints_report(
    df: DataFrame,
    product: str,
    date: str,
    company: str,
    lowercase_product: bool = False,
) -> DataFrame:
    """(product, year) -> complaints, companies, top company's share in whole percent.

    Rows with a NULL product, company or date are dropped; year is the first four
    characters of the date string.
    """
    prod = F.lower(F.col(product)) if lowercase_product else F.col(product)
    base = df.dropna(subset=[product, company, date]).select(
        prod.alias("product"),
        F.substring(F.col(date).cast("string"), 1, 4).alias("year"),
        F.col(company).alias("company"),
    )
    return top_share_report(base, ["product", "year"], "company")


def distinct_and_total(
    df: DataFrame, key: str, member: str, amount: str, money_scale: int = 2, first_seen: str | None = None
) -> DataFrame:
    """key -> exact number of distinct members and the total amount (money stays decimal).

    Two-level: (key, member) partial sums first, then per key count and sum. This is the
    exact form that needs no clustering of the input; a key held by a third of all rows is
    spread over its members in the first shuffle and pre-combined before the second.
    ``first_seen`` names an input-order column; its minimum per key is kept as ``first_seen``
    (the order in which keys first appear).
    """
    money = F.col(amount).cast(f"decimal(18,{money_scale})")
    extra = [F.min(first_seen).alias("_first")] if first_seen else []
    per_member = df.groupBy(key, member).agg(F.sum(money).alias("_amt"), *extra)
    extra2 = [F.min("_first").alias("first_seen")] if first_seen else []
    return per_member.groupBy(key).agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("_amt").alias("revenue"),
        *extra2,
    )


def endpoint_counts(df: DataFrame, a: str, b: str, name: str = "station") -> DataFrame:
    """Each row counts once for each of its two endpoints (a round trip twice for its station)."""
    return (
        df.select(F.explode(F.array(F.col(a), F.col(b))).alias(name))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def pair_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Unordered pair counts, the pair given in lexical order."""
    return df.groupBy(
        F.least(F.col(a), F.col(b)).alias("station_a"), F.greatest(F.col(a), F.col(b)).alias("station_b")
    ).agg(F.count(F.lit(1)).alias("trips"))


def having_more_than(df: DataFrame, count_col: str, threshold: int) -> DataFrame:
    """HAVING count > threshold (strict)."""
    return df.filter(F.col(count_col) > F.lit(threshold))


def best_per_group(df: DataFrame, group: str, item: str, count_col: str) -> DataFrame:
    """Per group, the item with the largest count; ties go to the lexically smallest item.

    min(struct(-count, item)) is an ordinary aggregate with partial aggregation, so a group
    with very many items never lands whole in one task (a window would need that).
    """
    best = F.min(F.struct((-F.col(count_col)).alias("neg"), F.col(item).alias("item")))
    return df.groupBy(group).agg(best.alias("_b")).select(
        group, F.col("_b.item").alias(item), (-F.col("_b.neg")).alias(count_col)
    )


def most_frequent(df: DataFrame, item: str, count_col: str) -> DataFrame:
    """max((count, item)) over all rows: ties go to the lexically greatest item."""
    best = F.max(F.struct(F.col(count_col).alias("n"), F.col(item).alias("w")))
    return df.agg(best.alias("_b")).select(F.col("_b.n").alias(count_col), F.col("_b.w").alias(item))


def token_counts(df: DataFrame, tokens: Column, name: str = "word") -> DataFrame:
    """Explode a token array and count each token (partial aggregation does the combiner's job)."""
    return df.select(F.explode(tokens).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def weighted_mean_truncated(df: DataFrame, key: str, value: str, weight: str, out: str = "mean_score") -> DataFrame:
    """key -> int(sum(value * weight) / sum(weight)), truncated toward zero."""
    return df.groupBy(key).agg(
        (F.sum(F.col(value) * F.col(weight)).cast("double") / F.sum(F.col(weight)).cast("double"))
        .cast("bigint")
        .alias(out)
    )


def yearly_counts(df: DataFrame, key: str, year: str, years: Sequence[int], prefix: str = "y") -> DataFrame:
    """key -> one count column per listed year (zeros for years without rows).

    count_if per year instead of ``pivot``: the year list is fixed, so no extra job is run
    to find the pivot values and the aggregate stays one partial + final pair.
    """
    cols = [F.count_if(F.col(year) == F.lit(y)).cast("bigint").alias(f"{prefix}{y}") for y in years]
    return df.groupBy(key).agg(*cols)


def with_trend(df: DataFrame, years: Sequence[int], prefix: str = "y", out: str = "slope") -> DataFrame:
    """Append the least-squares slope of the yearly counts against the years."""
    return df.withColumn(out, slope_over_years([f"{prefix}{y}" for y in years], list(years)))


def sum_of_years(df: DataFrame, years: Sequence[int], prefix: str = "y") -> DataFrame:
    """Reconciliation: the total of every yearly count in the result."""
    total = None
    for y in years:
        total = F.col(f"{prefix}{y}") if total is None else total + F.col(f"{prefix}{y}")
    return df.agg(F.coalesce(F.sum(total), F.lit(0)).cast("bigint").alias("total"))
