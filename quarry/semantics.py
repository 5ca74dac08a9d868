"""Null and arithmetic rules where the source pipelines (pandas / warehouse SQL)
differ from Spark defaults. Decided once here and used everywhere.

N-1  pandas group-by drops null keys           -> group_non_null
N-2  pandas merge matches null = null           -> null_safe_on
N-3  pandas ~isin keeps null rows               -> not_in
N-4  pandas aggregates skip NaN                 -> nan_to_null
N-5  pandas CSV reader null tokens              -> NA_TOKENS / na_to_null
N-7  pandas round is half-even                  -> round_half_even
N-8  coerce errors to null                      -> functions.scalars (try_cast)
N-9  division by zero gives inf/NaN, not error  -> safe_div
N-11 unspecified tie order                      -> callers add key tie-breakers
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

# The strings pandas.read_csv turns into missing values by default
# (note that "-" is not one of them).
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def group_non_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any group key, as a pandas group-by does (N-1).

    Not for warehouse-SQL semantics, where GROUP BY keeps a null group.
    """
    return df.na.drop("any", subset=list(keys))


def not_in(c: str | Column, values: Iterable) -> Column:
    """``~isin`` that keeps null rows (N-3)."""
    return ~F.coalesce(_col(c).isin(list(values)), F.lit(False))


def null_safe_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Join condition where null keys match each other (N-2)."""
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(right[k])
        cond = term if cond is None else cond & term
    return cond


def nan_to_null(c: str | Column) -> Column:
    """NaN -> null so aggregates skip it as pandas does (N-4)."""
    col = _col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col)


def nans_to_nulls(df: DataFrame) -> DataFrame:
    """Apply nan_to_null to every float/double column."""
    cols = [
        nan_to_null(f.name).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ]
    return df.select(*cols)


def na_to_null(c: str | Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Map the pandas missing-value tokens to null on a string column (N-5).

    The match is exact, as in pandas: ``'  '``, ``' NA'`` or ``'NA '`` stay text.
    """
    col = _col(c)
    return F.when(col.isin(list(tokens)), F.lit(None)).otherwise(col)


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields null on a zero denominator instead of raising (N-9)."""
    return F.try_divide(_col(num), _col(den))


def round_half_even(c: str | Column, digits: int = 0) -> Column:
    """pandas/numpy rounding: ties go to the even digit (N-7)."""
    return F.bround(_col(c), digits)
