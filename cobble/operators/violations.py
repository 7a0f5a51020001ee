"""Flagship: resolve violations to street segments, yearly counts, trend, full roster.

Plan shape (see README): scan -> filter -> project -> aggregate to distinct addresses
(partial + final) -> broadcast range join against the segment lookup -> first match per
address (no extra shuffle: same keys as the address aggregate) -> sum per segment id
(partial + final) -> full outer join with the roster -> range sort by (id, copy).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cobble.functions.streets import (
    ALL_BOROUGH_SPELLINGS,
    VIOLATION_YEARS,
    borough_code,
    house_parts,
    range_ends,
    street_key,
)
from cobble.operators.aggregates import with_trend
from cobble.operators.joins import (
    DEFAULT_BROADCAST_BYTES,
    DEFAULT_BROADCAST_ROWS,
    first_match_segment,
    roster_outer_join,
    street_index,
)

ADDRESS_KEYS = ["street", "borough", "house"]


def _blank(c: Column) -> Column:
    # The reference treats exactly '' and ' ' (and a missing field) as blank.
    return c.isNull() | c.isin("", " ")


def prepare_violations(
    raw: DataFrame,
    date: str,
    borough: str,
    house: str,
    street: str,
    years: Sequence[int] = VIOLATION_YEARS,
) -> DataFrame:
    """Valid violations as (year INT, borough INT code, house STRING, street key)."""
    d, b, h, s = F.col(date), F.col(borough), F.col(house), F.col(street)
    year_text = F.substring(d, -4, 4)
    valid = (
        ~_blank(d)
        & ~_blank(b)
        & ~_blank(h)
        & ~_blank(s)
        & year_text.isin(*[str(y) for y in years])
        & b.isin(*ALL_BOROUGH_SPELLINGS)
    )
    return raw.filter(valid).select(
        year_text.cast("int").alias("year"),
        borough_code(borough).alias("borough"),
        h.alias("house"),
        street_key(street).alias("street"),
    )


def prepare_segments(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Segment features -> (segments, aliases).

    ``features`` columns: physicalid, st_label, full_stree, borocode, l_low_hn, l_high_hn,
    r_low_hn, r_high_hn, and ``ord`` (source position: any orderable type, such as a number
    or a (file, position) struct). A feature is dropped when its label, alias or borough is
    missing or when any of its four range ends is not all integers.
    """
    f = features.select(
        street_key("st_label", strip_ordinals=False).alias("label"),
        street_key("full_stree", strip_ordinals=False).alias("alias"),
        F.col("borocode").cast("string").try_cast("int").alias("borough"),
        range_ends("l_low_hn").alias("l_low"),
        range_ends("l_high_hn").alias("l_high"),
        range_ends("r_low_hn").alias("r_low"),
        range_ends("r_high_hn").alias("r_high"),
        F.col("physicalid").cast("string").try_cast("bigint").alias("pid"),
        F.col("ord"),
    ).dropna(subset=["label", "alias", "borough", "l_low", "l_high", "r_low", "r_high"])
    segments = f.select("label", "borough", "l_low", "l_high", "r_low", "r_high", "pid", "ord")
    aliases = f.groupBy("alias", "label").agg(F.min("ord").alias("aord"))
    return segments, aliases


def address_counts(violations: DataFrame, years: Sequence[int] = VIOLATION_YEARS) -> DataFrame:
    """Distinct (street, borough, house) with one count per year; unparseable houses dropped.

    Matching depends only on the address, so it is resolved once per distinct address
    instead of once per violation; the aggregate combines map-side, so a hot address costs
    one row per task in the shuffle.
    """
    counts = [F.count_if(F.col("year") == F.lit(y)).cast("bigint").alias(f"y{y}") for y in years]
    return (
        violations.groupBy(*ADDRESS_KEYS)
        .agg(*counts)
        .withColumn("parts", house_parts("house"))
        .filter(F.col("parts").isNotNull())
    )


def segment_year_counts(
    violations: DataFrame,
    segments: DataFrame,
    aliases: DataFrame,
    years: Sequence[int] = VIOLATION_YEARS,
    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """pid -> yearly counts and slope, for every segment that matched at least once."""
    addr = address_counts(violations, years)
    index = street_index(segments, aliases, max_broadcast_bytes, max_broadcast_rows)
    matched = first_match_segment(addr, index, ADDRESS_KEYS)
    ycols = [f"y{y}" for y in years]
    per_pid = matched.groupBy("pid").agg(*[F.sum(c).cast("bigint").alias(c) for c in ycols])
    return with_trend(per_pid, years)


def violations_report(
    violations: DataFrame,
    segments: DataFrame,
    aliases: DataFrame,
    roster: DataFrame,
    years: Sequence[int] = VIOLATION_YEARS,
    ordered: bool = True,
    **bounds,
) -> DataFrame:
    """Every roster id (repeats kept) and every matched id: yearly counts and slope, zeros
    where nothing matched, in order of (id, copy) if ``ordered``."""
    per_pid = segment_year_counts(violations, segments, aliases, years, **bounds)
    ycols = [f"y{y}" for y in years]
    full = roster_outer_join(roster.select(F.col("pid").cast("bigint")), per_pid, "pid", [*ycols, "slope"], ordered)
    return full.select("pid", *[F.col(c).cast("bigint").alias(c) for c in ycols], F.col("slope").cast("double"), "copy")


def python_float_text(c: str) -> Column:
    """A double as Python prints it: plain digits from 1e-4 to below 1e16, else an exponent
    of two or more digits (Spark turns to exponents at 1e-3 and 1e7, and writes E-5)."""
    x = F.col(c)
    plain = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
    e = F.regexp_replace(F.regexp_replace(x.cast("string"), r"\.0E", "E"), r"E(\d)", r"E+$1")
    short = F.regexp_replace(F.regexp_replace(e, r"E([+-])(\d)$", r"E$10$2"), "E", "e")
    inside = ((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16)) | (x == 0)
    return F.when(inside, plain).otherwise(short)


def report_lines(report: DataFrame, years: Sequence[int] = VIOLATION_YEARS) -> DataFrame:
    """'pid, y1, ..., y5, slope' text lines of an ordered report, in its order; an unmatched id
    prints its slope as 0."""
    ycols = [f"y{y}" for y in years]
    hits = None
    for c in ycols:
        hits = F.col(c) if hits is None else hits + F.col(c)
    slope_text = F.when(hits == 0, F.lit("0")).otherwise(python_float_text("slope"))
    return report.select(
        F.concat_ws(", ", F.col("pid").cast("string"), *[F.col(c).cast("string") for c in ycols], slope_text).alias("value")
    )
