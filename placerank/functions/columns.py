"""Column expressions shared by the operators. All are built-in Spark SQL functions, so
they stay inside whole-stage code generation; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_or_empty(c: str | Column) -> Column:
    """True when a cell is NULL or the empty string. Compared as a string so that numeric
    columns do not raise CAST_INVALID_INPUT under ANSI mode."""
    c = col_(c)
    return c.isNull() | (c.cast("string") == F.lit(""))


def count_distinct_values(c: str | Column, approx_rsd: float | None = None) -> Column:
    """``count(DISTINCT c)`` (NULL not counted); with ``approx_rsd`` a HyperLogLog++ sketch
    of that relative standard deviation, merged partially per task instead of shuffling
    every distinct value."""
    c = col_(c)
    if approx_rsd is None:
        return F.count_distinct(c)
    return F.approx_count_distinct(c, rsd=approx_rsd)


def count_values_with_null(c: str | Column, approx_rsd: float | None = None) -> Column:
    """``count(DISTINCT c)`` plus one when a NULL is present: the value count that
    ``select(c).distinct().count()`` gives, as one aggregate expression."""
    c = col_(c)
    has_null = F.coalesce(F.max(c.isNull().cast("int")), F.lit(0)).cast("long")
    return count_distinct_values(c, approx_rsd) + has_null


def desc_keys(score: str, *keys: str) -> list[Column]:
    """A total order: score descending (NULLs last), then the keys ascending (NULLs first)."""
    return [F.col(score).desc_nulls_last()] + [F.col(k).asc_nulls_first() for k in keys]


def substring_hits(text: str | Column, keyword: str) -> Column:
    """Non-overlapping occurrences of ``keyword`` (a literal, not a pattern) in ``text``:
    characters removed by a literal replace-all, divided by the keyword length."""
    text = col_(text)
    removed = F.length(text) - F.length(F.replace(text, F.lit(keyword), F.lit("")))
    return (removed / F.lit(max(len(keyword), 1))).cast("long")


def pattern_hits(text: str | Column, pattern: str) -> Column:
    """Characters removed by deleting every match of ``pattern`` (a Java regular
    expression), divided by the pattern's length: the reference's keyword frequency when
    keywords are taken as patterns (a fraction when matches differ in length)."""
    text = col_(text)
    removed = F.length(text) - F.length(F.regexp_replace(text, F.lit(pattern), F.lit("")))
    return removed / F.lit(float(max(len(pattern), 1)))


def keyword_hits(text: str | Column, keywords: Sequence[str], match: str = "literal") -> Column:
    """Total hits of all keywords in one text; NULL text gives NULL (ignored by ``sum``).
    ``match="regex"`` takes each keyword as a regular expression (``pattern_hits``)."""
    if match not in ("literal", "regex"):
        raise ValueError("match must be 'literal' or 'regex'")
    one = substring_hits if match == "literal" else pattern_hits
    terms = [one(text, k) for k in keywords]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def clean_keywords(keywords: Sequence[str] | None) -> list[str]:
    """Trim, lowercase and drop blank keywords, keeping the order and repeats given."""
    return [k.strip().lower() for k in (keywords or []) if k and k.strip()]
