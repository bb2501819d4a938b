"""Scalar text functions as Column expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The 29 code points that Python's str.strip, str.split and \s see as white space.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
NOT_WS = r"[^\s\x1c-\x1f\x85\p{Z}]"


def utc_iso(c: Column) -> Column:
    """A time in UTC as ISO 8601 text; a fraction only where there is one.  The session's zone is UTC."""
    fraction = F.date_format(c, "SSSSSS")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == "000000", "").otherwise(F.concat(F.lit("."), fraction)), F.lit("+00:00"))


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"{WS}+$", "")


def is_text(c: Column) -> Column:
    """Not null and not blank."""
    return c.isNotNull() & F.coalesce(c.rlike(NOT_WS), F.lit(False))


@F.pandas_udf(T.StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


def nfkc(c: Column) -> Column:
    """Compatibility normal form.  ASCII is its own, so only other texts leave the JVM."""
    return F.coalesce(_nfkc(F.when(c.rlike(r"[^\x00-\x7F]"), c)), c)


def collapse(c: Column) -> Column:
    """Strip, lower case, and one blank for every run of white space."""
    return F.regexp_replace(F.lower(strip(c)), f"{WS}+", " ")


def normalize_text(c: Column) -> Column:
    return collapse(nfkc(c))


def ws_tokens(c: Column) -> Column:
    """White-space-separated tokens; none of a blank text, null of null."""
    return F.filter(F.split(c, f"{WS}+"), lambda x: x != "")


def numbered_tokens(tokens: Column) -> Column:
    """Every token with the number of its occurrence, so that a multiset becomes a set."""
    ordered = F.array(F.sort_array(tokens))
    return F.element_at(F.transform(ordered, lambda s: F.transform(s, lambda x, i: F.concat_ws(" ", x, (i - F.array_position(s, x) + 1).cast("string")))), 1)


def multiset_overlap(a: Column, b: Column) -> Column:
    """Size of the intersection of two token arrays as multisets."""
    return F.size(F.array_intersect(numbered_tokens(a), numbered_tokens(b)))


def f1_of(overlap: Column, n_a: Column, n_b: Column) -> Column:
    """F1 of an overlap, 2o / (a + b); two empty sides agree, one empty side doesn't.  The overlap
    occurs once, so it is computed once."""
    return F.coalesce(F.try_divide(2.0 * overlap, n_a + n_b), F.lit(1.0))


def token_f1(a: Column, b: Column) -> Column:
    """Token F1 of two token arrays within one row; for texts of thousands of words see
    ``operators.metrics.token_f1_by_id``."""
    return f1_of(multiset_overlap(a, b), F.size(a), F.size(b))


def generated_id(split: Column, row_index: Column) -> Column:
    return F.format_string("%s-%08d", split, row_index)


def format_metric(v: Column) -> Column:
    """Compact number: three digits of mantissa where very small or large, else at most four decimals.

    Rounding of ties is Java's (half up)."""
    size = F.abs(v)
    short = F.regexp_replace(F.format_string("%.4f", v), r"\.?0+$", "")
    exponent = F.regexp_replace(F.format_string("%.3e", v), r"e([+-])(\d)$", "e$10$2")
    return F.when(F.isnan(v), "nan").when((v != 0) & ((size < 1e-4) | (size >= 1e4)), exponent).otherwise(short)
