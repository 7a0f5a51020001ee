"""Street and house-number functions for address resolution (all built-in expressions)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
# Borough spellings accepted on a violation, and the borough code each one means
# (1 Manhattan, 2 Bronx, 3 Brooklyn, 4 Queens, 5 Staten Island); exact, case-sensitive:
BOROUGH_SPELLINGS = {
    1: ("MAN", "MH", "MN", "NEWY", "NEW Y", "NY"),
    2: ("BRONX", "BX"),
    3: ("BK", "K", "KING", "KINGS"),
    4: ("Q", "QN", "QNS", "QU", "QUEEN"),
    5: ("R", "RICHMOND"),
}
# Ordinal suffixes removed from a street word that starts with a digit (RD is not among them):
ORDINAL_SUFFIXES = ("TH", "ST", "ND")
# Years a violation may carry:
VIOLATION_YEARS = (2015, 2016, 2017, 2018, 2019)

ALL_BOROUGH_SPELLINGS = tuple(s for names in BOROUGH_SPELLINGS.values() for s in names)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def borough_code(name: str) -> Column:
    """Spelling in the named column -> borough code 1..5; NULL for any other spelling."""
    arms = " ".join(
        "WHEN {} IN ({}) THEN {}".format(_q(name), ", ".join("'" + n + "'" for n in names), code)
        for code, names in BOROUGH_SPELLINGS.items()
    )
    return F.expr(f"CASE {arms} END")


def street_key_sql(text: str, strip_ordinals: bool = True) -> str:
    """SQL of a street key: upper-case, drop TH/ST/ND from whitespace-separated words that
    start with a digit, then remove all whitespace: 'w  8th st' -> 'W8ST'.

    The look-behind/look-ahead pair makes each rewrite act on one whole word, so adjacent
    ordinals ('1ST 2ND') are both handled.
    """
    key = f"upper({text})"
    if strip_ordinals:
        suffix = "|".join(ORDINAL_SUFFIXES)
        key = rf"regexp_replace({key}, '(?U)(?<!\\S)(\\d\\S*?)(?:{suffix})(?!\\S)', '$1')"
    return rf"regexp_replace({key}, '(?U)\\s+', '')"


def street_key(name: str, strip_ordinals: bool = True) -> Column:
    """Street key of the named column."""
    return F.expr(street_key_sql(_q(name), strip_ordinals))


def blank_to_null(c) -> Column:
    """'' and ' ' (and any all-whitespace value) become NULL."""
    return F.when(F.trim(_c(c)) == F.lit(""), F.lit(None)).otherwise(_c(c))


def house_parts(name: str) -> Column:
    """House number in the named column -> ARRAY<BIGINT>, or NULL when it cannot match any
    segment.

    Split on '-'. A part of two or more characters ending in a non-digit loses that last
    character ('35A' -> 35). The number is rejected when a part is empty ('3-'), or when a
    one-character part occurs while the (trimmed) first part is not all digits. Every part
    must then read as an integer ('12AB' -> '12A' -> rejected).

    Numbers of one or two parts (nearly all) take a scalar path that stays in generated
    code; longer ones use the array form.
    """
    raw = f"split({_q(name)}, '-', -1)"

    def trim(p: str) -> str:
        return f"(CASE WHEN length({p}) >= 2 AND NOT substring({p}, -1, 1) RLIKE '[0-9]' THEN substr({p}, 1, length({p}) - 1) ELSE {p} END)"

    r1, r2 = f"element_at({raw}, 1)", f"try_element_at({raw}, 2)"
    t1, t2 = trim(r1), trim(r2)
    first_digits = rf"({t1} RLIKE '\\A[0-9]+\\z')"

    def bad(r: str) -> str:
        return f"(length({r}) = 0 OR (length({r}) = 1 AND NOT {first_digits}))"

    i1, i2 = f"try_cast({t1} AS BIGINT)", f"try_cast({t2} AS BIGINT)"
    ints = f"transform({raw}, p -> try_cast({trim('p')} AS BIGINT))"
    return F.expr(
        f"CASE WHEN size({raw}) = 1 THEN (CASE WHEN {bad(r1)} OR {i1} IS NULL THEN NULL ELSE array({i1}) END) "
        f"WHEN size({raw}) = 2 THEN (CASE WHEN {bad(r1)} OR {bad(r2)} OR {i1} IS NULL OR {i2} IS NULL THEN NULL "
        f"ELSE array({i1}, {i2}) END) "
        f"ELSE (CASE WHEN exists({raw}, r -> {bad('r')}) OR exists({ints}, v -> v IS NULL) THEN NULL ELSE {ints} END) END"
    )


def range_ends(name: str) -> Column:
    """Segment end '12' or '12-34' in the named column -> ARRAY<BIGINT>; NULL when any part is
    not an integer."""
    ints = f"transform(split({_q(name)}, '-', -1), p -> try_cast(p AS BIGINT))"
    return F.expr(f"CASE WHEN {_q(name)} IS NULL OR exists({ints}, v -> v IS NULL) THEN NULL ELSE {ints} END")


def house_parity(parts) -> Column:
    """1 when the last part is odd (left side of the street), 0 when even (right side)."""
    return F.element_at(_c(parts), -1).bitwiseAND(F.lit(1))


def in_box(parts, low, high) -> Column:
    """Same number of parts as both ends, and every part inside its own [low, high] range.

    A box test per component, not a lexicographic one: [92, 29] is not inside [91, 1]..[93, 15].
    """
    p, lo, hi = _c(parts), _c(low), _c(high)
    same_len = (F.size(p) == F.size(lo)) & (F.size(p) == F.size(hi))
    per_part = F.transform(
        p, lambda v, i: (F.try_element_at(lo, i + 1) <= v) & (v <= F.try_element_at(hi, i + 1))
    )
    return F.when(same_len, F.forall(per_part, lambda b: b)).otherwise(F.lit(False))


def slope_over_years(counts: list, years: list | None = None) -> Column:
    """Least-squares slope of counts against years: each count's distance from the mean count,
    weighted by its year's distance from the mean year; the sum of squared year distances
    divides at the end, and terms are added in year order."""
    xs = [float(x) for x in (years if years is not None else range(len(counts)))]
    away = [x - sum(xs) / len(xs) for x in xs]
    ys = [_c(c).cast("double") for c in counts]
    mean = reduce(Column.__add__, ys) / F.lit(float(len(ys)))
    terms = [F.lit(w) * (y - mean) for w, y in zip(away, ys, strict=True)]
    return reduce(Column.__add__, terms, F.lit(0.0)) / F.lit(sum(w * w for w in away))
