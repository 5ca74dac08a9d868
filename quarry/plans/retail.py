"""Retail inventory: clean -> five per-category reports.

The two-group-bys-then-divide ratio (J8) is one conditional aggregate (A3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.scalars import bool_to_int
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import projections as P
from quarry.operators import windows as W
from quarry.operators.quality import null_profile
from quarry.sinks.tables import write_csv
from quarry.sources.files import read_csv

# Raw -> cleaned column names.
RENAMES = {
    "discountPercent": "discount_percent",
    "availableQuantity": "available_quantity",
    "discountedSellingPrice": "discounted_selling_price",
    "weightInGms": "weight_in_gms",
    "outOfStock": "out_of_stock",
}


def clean(raw: DataFrame) -> DataFrame:
    """P4 + C1: rename, out-of-stock flag boolean -> int. A missing flag raises when the rows are
    read, as the source's cast does."""
    df = P.rename_columns(raw, RENAMES)
    if "out_of_stock" not in df.columns:
        return df
    flag = bool_to_int("out_of_stock")
    return df.withColumn("out_of_stock", F.when(flag.isNull(), F.raise_error(
        F.lit("out_of_stock is missing")).cast("int")).otherwise(flag))


def run(spark: SparkSession, raw_path: str, clean_csv: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    """S1 -> Q2 -> P4/C1 -> K1: the missing values per raw column, and the reports on the cleaned
    table that was written."""
    raw = read_csv(spark, raw_path)
    missing = null_profile(raw)
    write_csv(clean(raw), clean_csv)
    return missing, reports(read_csv(spark, clean_csv))


def avg_discount(df: DataFrame, category: str = "Category") -> DataFrame:
    """Q1 report: mean discount per category, highest first."""
    return W.sort_desc(A.mean_by(df, [category], ["discount_percent"]), "discount_percent", [category])


def out_of_stock_counts(df: DataFrame, category: str = "Category") -> DataFrame:
    """Q2 report: out-of-stock items per category (categories with none are absent)."""
    return W.sort_desc(A.count_where(df, [category], FL.is_flagged("out_of_stock"), "n"), "n", [category])


def avg_mrp(df: DataFrame, category: str = "Category") -> DataFrame:
    return W.sort_desc(A.mean_by(df, [category], ["mrp"]), "mrp", [category])


def avg_stock(df: DataFrame, category: str = "Category") -> DataFrame:
    return W.sort_desc(A.mean_by(df, [category], ["available_quantity"]), "available_quantity", [category])


def out_of_stock_pct(df: DataFrame, category: str = "Category") -> DataFrame:
    """Q5 report: share of out-of-stock items per category in percent, zero-filled."""
    return W.sort_desc(A.flagged_share(df, [category], "out_of_stock", "pct"), "pct", [category])


def reports(df: DataFrame, category: str = "Category") -> dict[str, DataFrame]:
    return {"avg_discount": avg_discount(df, category), "out_of_stock": out_of_stock_counts(df, category),
            "avg_mrp": avg_mrp(df, category), "avg_stock": avg_stock(df, category),
            "out_of_stock_pct": out_of_stock_pct(df, category)}

