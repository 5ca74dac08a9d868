"""Country time-series analysis: clean -> latest-per-country summary, series,
correlation matrix, OLS regression (SURVEY 3.3).

Spark shape: S1 -> F1,F3 -> {F2 -> A9 -> P6 -> C10 -> C9 ; F2 -> A14 ; F2 -> F12 -> A15 ;
F12 -> M1 -> M2 -> M3 -> M4/M5}.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import parse_date
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import stats as M
from quarry.semantics import round_half_even, safe_div
from quarry.sinks.tables import write_csv
from quarry.sources.files import read_csv

# Aggregate entities that are not countries.
EXCLUDED_ENTITIES = (
    "World", "Africa", "Asia", "Europe", "European Union", "International",
    "Low income", "High income", "North America", "Oceania", "South America",
)
# The countries compared in the analysis.
FOCUS_COUNTRIES = ("Finland", "South Africa", "India", "United States", "Brazil")
# The columns of the summary, the correlation matrix and the regression.
SUMMARY_TOTALS = ("total_cases", "total_deaths", "total_vaccinations")
CORR_COLUMNS = ("new_cases_per_million", "new_deaths_per_million", "stringency_index",
                "positive_rate", "people_fully_vaccinated_per_hundred", "gdp_per_capita")
REG_FEATURES = ("gdp_per_capita", "human_development_index", "median_age", "population_density",
                "hospital_beds_per_thousand", "stringency_index")
REG_TARGET = "people_fully_vaccinated_per_hundred"


def clean(df: DataFrame, country: str = "country", code: str = "code") -> DataFrame:
    """F1 + F3: drop aggregate entities (a null country is kept) and rows without a code."""
    return FL.not_null(FL.exclude_values(df, country, EXCLUDED_ENTITIES), code)


def latest_summary(df: DataFrame, key: str = "country", date_col: str = "date",
                   totals: Sequence[str] = SUMMARY_TOTALS, population: str = "population",
                   tiebreak: Sequence[str] = ()) -> DataFrame:
    """A9 + P6 + C10 + C9: newest non-null value of each total per country, rates
    per million (null on zero population), half-even rounding, integer population."""
    present = [c for c in totals if c in df.columns]
    last = A.last_non_null(df, [key], date_col, [*present, population], tiebreak)
    out = last.withColumns({
        f"{c.split('_', 1)[1]}_per_million": safe_div(F.col(c), F.col(population)) * F.lit(1_000_000.0)
        for c in present[:2]})
    digits = {**{c: 0 for c in present[:2]}, **{f"{c.split('_', 1)[1]}_per_million": 1 for c in present[:2]}}
    out = out.withColumns({c: round_half_even(c, d) for c, d in digits.items()})
    casts = {population: F.col(population).cast("long")}
    if len(present) > 2:  # rounded to 0 digits, then a nullable integer
        casts[present[2]] = round_half_even(present[2], 0).cast("long")
    return out.withColumns(casts)


def series(df: DataFrame, measure: str, date_col: str = "date", key: str = "country") -> DataFrame:
    """Mean of a measure per (date, country) -- the data behind a line chart."""
    return A.mean_by(df, [date_col, key], [measure])


def correlations(df: DataFrame, columns: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """F12 + A15."""
    return A.corr_matrix(df, [c for c in columns if c in df.columns])


def regression(spark: SparkSession, df: DataFrame, features: Sequence[str] = REG_FEATURES,
               target: str = REG_TARGET, key_cols: Sequence[str] = ("country", "date"),
               scale: float = 10.0) -> tuple[DataFrame, DataFrame]:
    """F12 + P6 + M1-M5: listwise deletion, target x10 (per thousand), exact 80/20
    split, OLS fit, test metrics and the coefficient table."""
    data = FL.drop_any_null(df.select(*key_cols, *features, target), [*features, target])
    data = data.withColumn("label", F.col(target) * F.lit(scale))
    data = M.split_exact(data, key_cols)
    model = M.fit_ols(data.filter(~F.col("is_test")), features, "label")
    metrics = M.regression_metrics(M.score(model, data.filter("is_test"), features, "label"))
    return metrics, M.coefficient_table(spark, model, features)


def run(spark: SparkSession, raw_csv: str, clean_csv: str,
        measures: Sequence[str] = ("new_cases_smoothed", "people_fully_vaccinated_per_hundred")) -> dict[str, DataFrame]:
    """S1 -> F1/F3 -> K1, then the analysis of the cleaned table: the focus countries' summary, one
    series a measure and the correlations; the regression over all countries."""
    write_csv(clean(read_csv(spark, raw_csv)), clean_csv)
    df = read_csv(spark, clean_csv)
    df = df.withColumn("date", parse_date("date"))
    focus = FL.include_values(df, "country", FOCUS_COUNTRIES)
    out = {"summary": latest_summary(focus)}
    if sum(c in df.columns for c in CORR_COLUMNS) > 1:
        out["correlations"] = correlations(focus)
    out |= {f"series_{m}": series(focus, m) for m in measures if m in df.columns}
    if all(c in df.columns for c in (*REG_FEATURES, REG_TARGET)):
        out["metrics"], out["coefficients"] = regression(spark, df)
    return out
