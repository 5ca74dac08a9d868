"""Sales load: CSV -> drop incomplete rows -> line total -> replace warehouse table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.filters import drop_any_null
from quarry.operators.quality import describe_exact
from quarry.sinks.tables import replace_table
from quarry.sources.files import read_csv

SALES_SCHEMA = {"date": "date", "product": "string", "quantity": "bigint", "price": "double"}


def clean(df: DataFrame) -> DataFrame:
    """F10 + P6: drop rows with any null, add ``total = quantity * price``."""
    return drop_any_null(df).withColumn("total", F.col("quantity") * F.col("price"))


def run(spark: SparkSession, csv_path: str, table: str) -> DataFrame:
    """S1 -> F10/P6 -> K5."""
    out = clean(read_csv(spark, csv_path, SALES_SCHEMA))
    replace_table(out, table)
    return spark.table(table)


def preview_stats(df: DataFrame) -> DataFrame:
    """Q5 on the numeric columns (the notebook's ``describe``)."""
    return describe_exact(df, [c for c, t in df.dtypes if t in ("bigint", "int", "double")])
