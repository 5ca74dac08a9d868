"""Projections: P1-P9. Pure DataFrame -> DataFrame, no actions.

Column pruning reaches the Parquet scan through Catalyst, so selecting early is
free; these helpers only add the tolerance rules pandas users rely on.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> str:
    return f"`{name}`"


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Plain selection (errors on a missing column)."""
    return df.select(*[F.col(_q(c)) for c in cols])


def select_present(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Selection that skips columns the frame does not have."""
    present = set(df.columns)
    return df.select(*[F.col(_q(c)) for c in cols if c in present])


def select_except(df: DataFrame, *cols: str) -> DataFrame:
    """``SELECT * EXCEPT(...)`` / ``drop``; absent names are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map, only names that are present (pandas ``rename``)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def with_derived(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Derived arithmetic columns (use ``semantics.safe_div`` for ratios)."""
    return df.withColumns(dict(exprs))


def with_constant(df: DataFrame, name: str, value, dtype: str | None = None) -> DataFrame:
    """A constant / per-run value; pass run timestamps in for determinism."""
    c = F.lit(value)
    return df.withColumn(name, c.cast(dtype) if dtype else c)


def project_to(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Project onto a fixed (name, type) list; absent columns become typed nulls."""
    present = set(df.columns)
    return df.select(*[
        (F.col(_q(n)).cast(t) if n in present else F.lit(None).cast(t)).alias(n)
        for n, t in fields
    ])
