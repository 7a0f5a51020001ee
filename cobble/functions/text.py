"""Text column functions: tokenising, number tests, keyword phrases, list helpers.

Every function maps Columns to a Column built from Spark's own expressions, so the work
stays inside whole-stage code generation; none of them calls back into Python per row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
# Stopwords allowed inside a keyword phrase (never at its start), compared case-insensitively:
KEYWORD_STOPWORDS = ("the", "of", "when", "in")
# Labels of the natural-number test:
NUMBER_LABEL = "Number"
NOT_NUMBER_LABEL = "Not a Number"

# Python's \w is letters, numbers and '_' of any script; spelled out so Java (and the
# DuckDB oracle) use the same class (Java's (?U)\w would also take combining marks).
WORD_PATTERN = r"[\p{L}\p{N}_]+"
WORD_APOS_PATTERN = r"[\p{L}\p{N}_']+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def natural_number_label(c) -> Column:
    """'Number' when the whole string is ASCII digits (at least one), else 'Not a Number'.

    ``\\A...\\z`` anchors the whole value; ``^...$`` would accept a trailing newline.
    """
    return F.when(_c(c).rlike(r"\A[0-9]+\z"), F.lit(NUMBER_LABEL)).otherwise(F.lit(NOT_NUMBER_LABEL))


def split_on(c, sep: str) -> Column:
    """Split on a literal separator (escaped for the regex engine); empties are kept, as str.split(sep)."""
    return F.split(_c(c), re.escape(sep), -1)


def whitespace_tokens(c) -> Column:
    """str.split() with no argument: runs of whitespace separate, no empty tokens."""
    return F.filter(F.split(_c(c), r"(?U)\s+", -1), lambda w: w != F.lit(""))


def space_tokens(c) -> Column:
    """line.strip().split(' ') with empty tokens dropped (single spaces separate)."""
    return F.filter(F.split(F.trim(_c(c)), " ", -1), lambda w: w != F.lit(""))


def word_tokens(c, with_apostrophe: bool = False) -> Column:
    """All Unicode word tokens (``\\w+`` or ``[\\w']+``) of a string, in order."""
    pat = WORD_APOS_PATTERN if with_apostrophe else WORD_PATTERN
    return F.regexp_extract_all(_c(c), F.lit(pat), 0)


def keywords_sql(text: str) -> str:
    """SQL of all keyword phrases of a text, as an array of strings.

    Sentences are split on '.', and phrases never cross one. Words are ``\\w+`` tokens. A word
    stays when it starts with a capital or is a stopword; every other word becomes '*', which
    no token holds, and breaks the phrase. Leading stopwords of a phrase are dropped, and a
    phrase needs two or more words. Stopwords at the end of a phrase stay.
    """
    stop = "(" + ", ".join(f"'{w}'" for w in KEYWORD_STOPWORDS) + ")"
    word = r"'[\\p{L}\\p{N}_]+'"
    return f"""
flatten(transform(split({text}, '[.]', -1), s ->
  transform(
    filter(
      transform(
        transform(
          split(array_join(transform(regexp_extract_all(s, {word}, 0),
                  w -> CASE WHEN w RLIKE '^\\\\p{{Lu}}' OR lower(w) IN {stop} THEN w ELSE '*' END), ' '), '[*]', -1),
          ch -> filter(split(ch, ' ', -1), x -> x != '')),
        ws -> CASE WHEN array_position(transform(ws, y -> NOT lower(y) IN {stop}), true) > 0
                   THEN slice(ws, CAST(array_position(transform(ws, y -> NOT lower(y) IN {stop}), true) AS INT), size(ws))
                   ELSE CAST(array() AS ARRAY<STRING>) END),
      ws -> size(ws) >= 2),
    ws -> array_join(ws, ' '))))
"""


def keywords(name: str) -> Column:
    """All keyword phrases of the named text column."""
    return F.expr(keywords_sql(f"`{name}`"))


def words_not_in(x, y) -> Column:
    """Lower-cased space-separated words of x that are not words of y; order and repeats kept."""
    ys = F.split(F.lower(_c(y)), " ", -1)
    return F.filter(
        F.split(F.lower(_c(x)), " ", -1),
        lambda w: (w != F.lit("")) & ~F.array_contains(ys, w),
    )


def distinct_count(c) -> Column:
    """len(set(x)) for an array column, or for the characters of a string column."""
    return F.size(F.array_distinct(_c(c)))


def distinct_chars(c) -> Column:
    """len(set(s)) for a string: split('') yields [''] for an empty string, hence the guard."""
    s = _c(c)
    return F.when(F.length(s) == 0, F.lit(0)).otherwise(F.size(F.array_distinct(F.split(s, "", -1))))


def status_line_parts(line) -> tuple[Column, Column]:
    """'A,B : status' -> (array of line names, status)."""
    halves = F.split(_c(line), " : ", -1)
    return F.split(F.element_at(halves, 1), ",", -1), F.try_element_at(halves, F.lit(2))
