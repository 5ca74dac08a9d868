"""Scans: S1, S2, S3, S5, S6.

Readers return lazy DataFrames; schemas are explicit wherever the caller knows
them, because inference costs an extra pass over the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quarry.functions.scalars import TYPE_LETTER
from quarry.semantics import NA_TOKENS, na_to_null


def read_csv_text(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                  na_tokens: Sequence[str] = NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """S1 first half: CSV with a header row, every column as text, the pandas
    missing-value tokens mapped to null (N-5).

    Files stay splittable by default; ``multi_line=True`` accepts quoted newlines
    inside fields (as pandas does) at the cost of one task per file."""
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    df = reader.csv(path)
    return df.select(*[na_to_null(F.col(f"`{c}`"), na_tokens).alias(c) for c in df.columns])


# The spellings pandas reads as booleans.
BOOL_TOKENS = ("True", "TRUE", "true", "False", "FALSE", "false")


def infer_types(df: DataFrame) -> dict[str, str]:
    """S1 second half: pandas-like type inference over text columns in one pass:
    ``boolean`` if every non-null value is a pandas boolean spelling, else
    ``bigint`` if every one parses as an integer, else ``double`` if every one
    parses as a number, else ``string``. (An integer column with gaps stays a
    nullable integer rather than becoming float as in pandas.)"""
    aggs = []
    for i, c in enumerate(df.columns):
        v = F.col(f"`{c}`")
        aggs.append(F.count_if(v.isNotNull() & ~v.isin(*BOOL_TOKENS)).alias(f"b{i}"))
        aggs.append(F.count_if(v.isNotNull() & v.try_cast("bigint").isNull()).alias(f"i{i}"))
        aggs.append(F.count_if(v.isNotNull() & (v.try_cast("double").isNull() | v.rlike(TYPE_LETTER))).alias(f"d{i}"))
        aggs.append(F.count(v).alias(f"n{i}"))
    r = df.agg(*aggs).first()
    out = {}
    for i, c in enumerate(df.columns):
        if r[f"n{i}"] > 0 and r[f"b{i}"] == 0:
            out[c] = "boolean"
        else:
            out[c] = "bigint" if r[f"i{i}"] == 0 else "double" if r[f"d{i}"] == 0 else "string"
    return out


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: dict[str, str] | None = None,
             na_tokens: Sequence[str] = NA_TOKENS, multi_line: bool = False) -> DataFrame:
    """``pd.read_csv`` equivalent. With ``schema`` ({column: type}) values are
    ``try_cast`` (bad -> null); without it types are inferred (one extra pass)."""
    text = read_csv_text(spark, path, na_tokens=na_tokens, multi_line=multi_line)
    types = schema or infer_types(text)
    return text.select(*[
        (F.col(f"`{c}`").try_cast(types[c]) if types.get(c, "string") != "string"
         else F.col(f"`{c}`")).alias(c)
        for c in text.columns])


def read_json_documents(spark: SparkSession, path: str | Sequence[str], schema: StructType,
                        multi_line: bool = False) -> DataFrame:
    """Nested JSON documents with a declared schema (no inference pass).

    Landed documents are compact one-line JSON, so files are read line by line:
    every document of a file is read and files stay splittable. ``multi_line=True``
    is for pretty-printed files holding a single document (one task per file)."""
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def list_files(spark: SparkSession, directory: str, suffix: str = "") -> list[str]:
    """File names under ``directory`` via the Hadoop FileSystem API (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(p)
                  if s.isFile() and str(s.getPath().getName()).endswith(suffix))


def latest_file(spark: SparkSession, directory: str, suffix: str = "") -> str:
    """S3: lexicographically greatest file name under a prefix; error if none."""
    files = list_files(spark, directory, suffix)
    if not files:
        raise ValueError(f"no files found under {directory}")
    return files[-1]


def latest_rows(df: DataFrame, column: str) -> DataFrame:
    """S3 for tables: rows whose ``column`` equals its maximum (e.g. the newest
    snapshot date). The maximum is a one-row aggregate, broadcast back (bounded)."""
    m = df.agg(F.max(F.col(f"`{column}`")).alias("__max"))
    return df.join(F.broadcast(m), F.col(f"`{column}`") == F.col("__max"), "left_semi")


def read_parquet_glob(spark: SparkSession, pattern: str, merge_schema: bool = False) -> DataFrame:
    """Multi-file Parquet load by wildcard."""
    return spark.read.option("mergeSchema", merge_schema).parquet(pattern)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Catalog table scan."""
    return spark.table(name)
