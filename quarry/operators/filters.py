"""Filters / predicates: F1-F12.

Every predicate is a plain Column expression so Catalyst can push it into the
Parquet scan (``PushedFilters``) where the column is a scan column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.semantics import not_in


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exclude_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """drop rows whose value is in the list; null rows are kept (N-3)."""
    return df.filter(not_in(column, values))


def include_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Keep rows whose value is in the list (pushable IN)."""
    return df.filter(_col(column).isin(list(values)))


def not_null(df: DataFrame, column: str) -> DataFrame:
    """keep rows where the column is not null."""
    return df.filter(_col(column).isNotNull())


def is_flagged(c: str | Column) -> Column:
    """truthiness of a 0/1 or boolean column (int == True matches 1, N-6)."""
    return F.coalesce(_col(c).cast("boolean"), F.lit(False))


def flagged(df: DataFrame, column: str) -> DataFrame:
    """keep flagged rows."""
    return df.filter(is_flagged(column))


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """inclusive range; nulls drop."""
    return df.filter(_col(column).between(low, high))


def rolling_days(df: DataFrame, column: str, days: int, as_of=None) -> DataFrame:
    """``ts >= start of (as_of - days)``. ``as_of`` defaults to today; pass a
    fixed date for reproducible runs."""
    anchor = F.current_date() if as_of is None else F.to_date(F.lit(str(as_of)))
    return df.filter(_col(column) >= F.date_sub(anchor, days))


def any_cell_contains(columns: Sequence[str], needle: str) -> Column:
    """F8 predicate: some cell, as text, contains ``needle`` case-insensitively.
    Nulls never match. An OR of per-column tests (no lambda), so it stays inside
    whole-stage codegen."""
    low = needle.lower()
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.lower(F.col(f"`{c}`").cast("string")).contains(low), F.lit(False))
    return hit


def drop_rows_containing(df: DataFrame, needle: str, columns: Sequence[str] | None = None) -> DataFrame:
    """F8: drop rows where any cell contains ``needle`` (case-insensitive)."""
    return df.filter(~any_cell_contains(columns or df.columns, needle))


def non_blank(c: str | Column) -> Column:
    """F9 predicate: the line has a non-whitespace character (Python ``strip``)."""
    return F.coalesce(_col(c).rlike(r"\S"), F.lit(False))


def drop_any_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Listwise deletion (optionally on a feature subset)."""
    return df.na.drop("any", subset=list(subset) if subset else None)


def drop_all_null(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """drop rows where every listed column is null (only if all are present)."""
    if not all(c in df.columns for c in subset):
        return df
    return df.na.drop("all", subset=list(subset))
