"""S4 (+F9): CSV files with free text above the header row.

Rule: the header is the first line containing the first pattern; only when no
line of the file contains it, the first line containing the second pattern.
Lines above the header are dropped, and so are blank lines. A file with no
header line is left untouched.

Work is expressed over a *lines frame* ``(file, pos, line)`` so it runs the same
whether the lines come from large splittable text files (ordered by block
start + in-split position, never one file per task) or from text cells that
hold whole small files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.filters import non_blank
from quarry.sources.records import parse_records

# The two header spellings of the yearly book indexes, in priority order.
BOOK_HEADERS = ("Author,Title", "Title,Author")


def lines_from_files(spark: SparkSession, path: str | Sequence[str],
                     split_bytes: int | None = None) -> DataFrame:
    """Lines of text files with a per-file order key ``pos`` (block start, then the
    position inside the split). Files stay splittable; ``split_bytes`` reads them in
    splits of that size (through a session of its own) instead of the session's."""
    if split_bytes:
        own = spark.newSession()
        for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.shuffle.partitions"):
            own.conf.set(key, spark.conf.get(key))
        own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        own.conf.set("spark.sql.files.openCostInBytes", "0")
        spark = own
    df = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__blk"),
        F.monotonically_increasing_id().alias("__id"),
        F.col("value").alias("line"))
    return df.select("file", F.struct("__blk", "__id").alias("pos"), "line")


def lines_from_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Lines of whole texts held in a column (one row per text), 0-based ``pos``."""
    return df.select(F.col(id_col).alias("file"),
                     F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))


def header_positions(lines: DataFrame, patterns: Sequence[str] = BOOK_HEADERS) -> DataFrame:
    """Per file: the position of the header line (null when none matches), and
    which pattern won. One grouped aggregate with partial combining."""
    mins = [F.min(F.when(F.col("line").contains(p), F.col("pos"))).alias(f"__p{i}")
            for i, p in enumerate(patterns)]
    agg = lines.groupBy("file").agg(*mins)
    which = None
    for i in reversed(range(len(patterns))):
        which = (F.when(F.col(f"__p{i}").isNotNull(), F.lit(i)) if which is None
                 else F.when(F.col(f"__p{i}").isNotNull(), F.lit(i)).otherwise(which))
    return agg.select("file",
                      F.coalesce(*[F.col(f"__p{i}") for i in range(len(patterns))]).alias("header_pos"),
                      which.alias("header_pattern"))


def strip_preamble(lines: DataFrame, patterns: Sequence[str] = BOOK_HEADERS) -> DataFrame:
    """Keep the header line and the non-blank lines after it; files without a
    header keep every line. Adds ``is_header``."""
    heads = header_positions(lines, patterns)
    j = lines.join(heads, "file", "left")
    keep = F.when(F.col("header_pos").isNull(), F.lit(True)).otherwise(
        (F.col("pos") >= F.col("header_pos")) & non_blank("line"))
    return j.filter(keep).select("file", "pos", "line",
                                 (F.col("pos") == F.col("header_pos")).alias("is_header"))


def csv_layouts(kept: DataFrame) -> dict[str, tuple[list[str], DataFrame]]:
    """Per file: its column names and its parsed rows ``(file, pos, <columns>)``.

    ``kept`` holds records, or lines where no field spans lines. Header lines are one per
    file, so only (file, header) pairs reach the driver to build each layout's schema; data
    is parsed on the executors.
    """
    heads = kept.filter("is_header").select("file", "line").collect()
    by_header: dict[str, list[str]] = {}
    for r in heads:
        by_header.setdefault(r["line"], []).append(r["file"])
    data = kept.filter(~F.coalesce(F.col("is_header"), F.lit(False)))
    out: dict[str, tuple[list[str], DataFrame]] = {}
    for header, files in by_header.items():
        names = next(iter(_split_header(header)))
        rows = parse_records(data.filter(F.col("file").isin(files)), names)
        for f in files:
            out[f] = (names, rows)
    return out


def parse_csv_lines(kept: DataFrame) -> DataFrame:
    """All files' rows under their own headers, unioned by column name."""
    layouts = {}
    for names, rows in csv_layouts(kept).values():
        layouts[tuple(names)] = rows
    if not layouts:
        raise ValueError("no header line found in any file")
    frames = list(layouts.values())
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _split_header(line: str):
    import csv

    return csv.reader([line])
