"""Column -> Column scalar functions. All are JVM-side built-ins,
so they stay inside whole-stage codegen; none is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.semantics import round_half_even


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- C: casts and cleaning -------------------------------------------------------------


def bool_to_int(c: str | Column) -> Column:
    """Boolean -> int. Null stays null here; ``require_not_null`` enforces the
    reference's failure on nulls when wanted."""
    return _col(c).cast("boolean").cast("int")


def coerce_numeric(c: str | Column, to: str = "double") -> Column:
    """Numeric coercion, unparsable -> null (pandas ``errors='coerce'``). A number with a
    type letter behind it (``5D``, ``12f``) is a code, not a number."""
    text = _col(c).cast("string")
    return text if to == "string" else F.when(~text.rlike(TYPE_LETTER), text).try_cast(to)


#: A number as Spark's cast would read it, with a trailing type letter.
TYPE_LETTER = r"(?i)^\s*[+-]?[0-9.][0-9.e+-]*[dfl]\s*$"


def to_bool_default_false(c: str | Column) -> Column:
    """text/number -> boolean with null -> false.

    ``'true'/'false'/'1'/'0'/'t'/'f'/'yes'/'no'`` parse; everything else (and null)
    becomes false. Unlike the source pipeline, the string ``'false'`` is false (H-4).
    """
    as_text = F.lower(F.trim(_col(c).cast("string")))
    numeric = F.when(as_text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$"), as_text).try_cast("double")
    parsed = F.coalesce(as_text.try_cast("boolean"), numeric != F.lit(0.0))
    return F.coalesce(parsed, F.lit(False))


def parse_timestamp_utc(c: str | Column) -> Column:
    """C4: string -> UTC timestamp. Strip, drop a literal ``Z``, map ``''``/``None``/
    ``nan`` to null, and let anything unparsable become null."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), "Z", "")
    text = F.when(text.isin("", "None", "nan", "NaN", "NaT"), F.lit(None)).otherwise(text)
    return F.try_to_timestamp(text)


def epoch_to_timestamp(c: str | Column, unit: str = "s") -> Column:
    """Epoch number -> timestamp with an explicit unit (fixes H-5)."""
    col = _col(c)
    if unit == "s":
        return F.timestamp_seconds(col)
    if unit == "ms":
        return F.timestamp_millis(col.cast("long"))
    if unit == "us":
        return F.timestamp_micros(col.cast("long"))
    if unit == "ns":
        return F.timestamp_micros(F.floor(col / F.lit(1000)).cast("long"))
    raise ValueError(f"unknown epoch unit {unit!r}")


def timestamp_to_epoch_micros(c: str | Column) -> Column:
    """Timestamp (zoned or NTZ, interpreted as UTC) -> epoch microseconds."""
    return F.unix_micros(_col(c).cast("timestamp"))


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Per-column null defaults, only for columns present."""
    present = {k: v for k, v in defaults.items() if k in df.columns}
    return df.fillna(present) if present else df


def parse_date(c: str | Column, fmt: str | None = None) -> Column:
    """text/timestamp -> date; bad -> null."""
    col = _col(c)
    return F.try_to_date(col.cast("string"), fmt) if fmt else col.try_cast("date")


def float_to_nullable_long(c: str | Column) -> Column:
    """Float -> nullable integer, truncating toward zero like ``int()``; NaN, infinities and
    numbers beyond the range of a long -> null."""
    col = _col(c)
    return F.when(F.isnan(col), F.lit(None)).otherwise(col).try_cast("long")


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Per-column half-even rounding, pandas ``DataFrame.round({...})``."""
    return df.withColumns({c: round_half_even(c, d) for c, d in digits.items() if c in df.columns})


def nan_to_null_text(c: str | Column) -> Column:
    """C11: NaN -> null, then number -> text via integer (``2022.0`` -> ``"2022"``)."""
    col = _col(c)
    cleaned = F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return cleaned.cast("long").cast("string")


def week_start_monday(c: str | Column) -> Column:
    """Calendar week start (Monday) as a date."""
    return F.to_date(F.date_trunc("week", _col(c)))


# --- T: text normalisation ---------------------------------------------------------------


def norm_lower_trim(c: str | Column) -> Column:
    """Null -> '', lower, strip."""
    return F.trim(F.lower(F.coalesce(_col(c), F.lit(""))))


def contains_any_label(c: str | Column, needles: Sequence[str], label: str) -> Column:
    """Any needle contained -> one canonical label, else the value itself."""
    col = _col(c)
    hit = None
    for n in needles:
        term = col.contains(n)
        hit = term if hit is None else hit | term
    return F.when(hit, F.lit(label)).otherwise(col)


def reverse_name(c: str | Column, sep: str = ", ") -> Column:
    """``Last, First`` -> ``First Last``; every ``, ``-separated part is reversed.
    Values without the separator are returned unchanged."""
    col = _col(c)
    flipped = F.array_join(F.reverse(F.split(col, sep, -1)), " ")
    return F.when(col.contains(sep), flipped).otherwise(col)


def last_token(c: str | Column) -> Column:
    """T4: last whitespace-separated token; blank/whitespace-only -> null (H-11)."""
    return F.nullif(F.regexp_extract(_col(c), r"(\S+)\s*$", 1), F.lit(""))


def normalize_year(c: str | Column) -> Column:
    """T5: ``a-b`` -> ``b`` as an integer text; ``2022.0`` -> ``2022``; else unchanged.

    A second part that is not an integer gives null instead of an exception (H-10).
    """
    col = _col(c).cast("string")
    after_dash = F.trim(F.split_part(col, F.lit("-"), F.lit(2))).try_cast("int").cast("string")
    return (
        F.when(col.contains("-"), after_dash)
        .when(col.contains(".0"), F.replace(col, F.lit(".0"), F.lit("")))
        .otherwise(col)
    )


def replace_values(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Exact whole-value replacement map; other values unchanged."""
    col = _col(c)
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return col if out is None else out.otherwise(col)


# Fixed value: year or year range as found in index names.
YEAR_PATTERN = r"\d{4}(?:-\d{4})?"


def year_or_unknown(c: str | Column, pattern: str = YEAR_PATTERN) -> Column:
    """First regex match, default ``unknown``."""
    return F.coalesce(F.nullif(F.regexp_extract(_col(c), f"({pattern})", 1), F.lit("")),
                      F.lit("unknown"))


def unknown_fill(c: str | Column, default: str = "Unknown") -> Column:
    """Null -> ``Unknown``, strip."""
    return F.trim(F.coalesce(_col(c).cast("string"), F.lit(default)))


def row_summary(columns: Sequence[str]) -> Column:
    """``col: n, col: n`` over (pivoted) count columns."""
    parts = [F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("long").cast("string")) for c in columns]
    return F.concat_ws(", ", *parts)


# --- X: nested data ----------------------------------------------------------------------


def explode_children(df: DataFrame, array_col: str, alias: str = "child",
                     keep: Sequence[str] = ()) -> DataFrame:
    """One row per array element, carrying parent fields. Null/empty arrays yield
    no rows, like iterating an empty list."""
    return df.select(*[F.col(k) for k in keep], F.explode(F.col(array_col)).alias(alias))


def field_or_null(struct_path: str) -> Column:
    """Missing-safe nested access: a null parent gives null, never an error."""
    return F.col(struct_path)
