"""Book index pipeline: three yearly CSV indexes with preambles -> cleaned ->
outer-merged on (Title, Author) -> CSV + dimension/fact tables -> dashboard
aggregates (SURVEY 3.2).

Spark shape: S4 x3 -> F8,F11,T3,P5,T6,T4 -> J1 -> J2 -> T1,T2,T5 -> fact;
A13 + J7 -> dimension; A6/A8/A10/A12/O2 on the persisted fact.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import joins as J
from quarry.operators import projections as P
from quarry.operators import quality as Q
from quarry.operators import windows as W
from quarry.sources import preamble as PR
from quarry.sources.records import records

KEYS = ("Title", "Author")

# Renames that harmonise older index layouts.
LAYOUT_RENAMES = {"Type of Ban": "Ban Status", "Initiating Action": "Origin of Challenge"}
# Origin-of-challenge replacements.
ORIGIN_REPLACEMENTS = {
    "Administrator": "Administration",
    "Formal Challenge, Administration": "Administration/Formal Challenge",
    "Informal Challenge, Administration": "Administration/Informal Challenge",
}
# Fixed value: the canonical label for library/classroom bans.
LIBRARY_CLASSROOM_BAN = "banned from libraries and classrooms"
# Ban status descriptions of the dimension table.
BAN_STATUS_DESCRIPTIONS = {
    "banned": "Books that have been completely prohibited",
    "banned pending investigation": "Books that are pending a review to determine what restrictions, if any, to implement on them",
    "banned by restriction": "Grade-level or school-level restrictions or books that require parental permissions",
    "banned from libraries and classrooms": "Books that are banned from libraries or classrooms",
}
# The two status classes of the dashboard.
BANNED_CLASS = ("banned", "banned from libraries and classrooms")
CHALLENGED_CLASS = ("banned by restriction", "banned pending investigation")
# CSV column -> table column.
FACT_RENAMES = {
    "Author": "author", "Title": "title", "Secondary Author(s)": "secondary_author",
    "Translator(s)": "translator", "Illustrator(s)": "illustrator", "State": "state",
    "District": "district", "Date of Challenge/Removal": "date_of_challenge", "Year": "year",
    "Origin of Challenge": "origin_of_challenge", "Ban Status": "ban_status", "Series Name": "series_name",
}
# Fact table fields in insert order, with their VARCHAR limits.
FACT_FIELDS = (
    ("title", 255), ("author", 255), ("secondary_author", 500), ("illustrator", 255),
    ("translator", 255), ("series_name", 255), ("state", 50), ("district", 100),
    ("date_of_challenge", 50), ("year", 4), ("ban_status", 50), ("origin_of_challenge", 255),
)
# US state name -> postal code (the per-state map of the dashboard).
STATE_CODES = {
    "Alabama": "AL", "Alaska": "AK", "Arizona": "AZ", "Arkansas": "AR", "California": "CA",
    "Colorado": "CO", "Connecticut": "CT", "Delaware": "DE", "Florida": "FL", "Georgia": "GA",
    "Hawaii": "HI", "Idaho": "ID", "Illinois": "IL", "Indiana": "IN", "Iowa": "IA",
    "Kansas": "KS", "Kentucky": "KY", "Louisiana": "LA", "Maine": "ME", "Maryland": "MD",
    "Massachusetts": "MA", "Michigan": "MI", "Minnesota": "MN", "Mississippi": "MS",
    "Missouri": "MO", "Montana": "MT", "Nebraska": "NE", "Nevada": "NV", "New Hampshire": "NH",
    "New Jersey": "NJ", "New Mexico": "NM", "New York": "NY", "North Carolina": "NC",
    "North Dakota": "ND", "Ohio": "OH", "Oklahoma": "OK", "Oregon": "OR", "Pennsylvania": "PA",
    "Rhode Island": "RI", "South Carolina": "SC", "South Dakota": "SD", "Tennessee": "TN",
    "Texas": "TX", "Utah": "UT", "Vermont": "VT", "Virginia": "VA", "Washington": "WA",
    "West Virginia": "WV", "Wisconsin": "WI", "Wyoming": "WY",
}


def q(c: str) -> str:
    return f"`{c}`"


# --- per-index cleaning ------------------------------------------------------------------

def read_indexes(spark: SparkSession, paths: Sequence[str], quoted_newlines: bool = True,
                 split_bytes: int | None = None) -> list[DataFrame]:
    """S4 for each yearly file: header discovery, preamble and blank lines dropped,
    parsed under its own header (only that file's columns). One frame per path.

    Files stay splittable end to end. ``quoted_newlines=True`` (the source's behaviour)
    puts quoted fields that span lines together, also across splits; ``False`` saves that
    step where it is known that no field does.
    """
    from quarry.session import shared_path

    kept = PR.strip_preamble(PR.lines_from_files(spark, list(paths), split_bytes))
    # Written once, read by every step that follows (header lines, one frame per file).
    landed = shared_path(spark, f"book-records-{uuid.uuid4().hex}")
    (records(kept) if quoted_newlines else kept).write.parquet(landed)
    layouts = PR.csv_layouts(spark.read.parquet(landed))
    out = []
    for p in paths:
        name = p.rstrip("/").split("/")[-1]
        hits = [f for f in layouts if f.endswith("/" + name) or f == p]
        if not hits:
            raise ValueError(f"no header line found in {p}")
        names, rows = layouts[hits[0]]
        out.append(rows.filter(F.col("file") == hits[0]).select(*[F.col(q(c)) for c in names]))
    return out


def clean_index(df: DataFrame) -> DataFrame:
    """F8, F11, T3, P5, T6, T4 on one index, in the source's order."""
    out = FL.drop_rows_containing(df, "PEN America")
    out = FL.drop_all_null(out, list(KEYS))
    if "Author" in out.columns:
        out = out.withColumn("Author", S.reverse_name("Author"))
    out = P.rename_columns(out, LAYOUT_RENAMES)
    if "Origin of Challenge" in out.columns:
        out = out.withColumn("Origin of Challenge", S.replace_values("Origin of Challenge", ORIGIN_REPLACEMENTS))
    if "Date of Challenge/Removal" in out.columns:
        out = out.withColumn("Year", S.last_token("Date of Challenge/Removal"))
    return out


def merge(frames: Sequence[DataFrame], skew_rows: int | None = 1_000_000) -> DataFrame:
    """J1 + J2 + T1/T2 + T5: null-safe many-to-many outer merge on (Title, Author),
    earliest index wins per column, ban status and year normalised."""
    merged = J.merge_indexes(frames, list(KEYS), null_safe=True, skew_rows=skew_rows)
    if "Ban Status" in merged.columns:
        status = S.norm_lower_trim("Ban Status")
        merged = merged.withColumn("Ban Status", S.contains_any_label(
            status, ["classrooms", "libraries"], LIBRARY_CLASSROOM_BAN))
    if "Year" in merged.columns:
        merged = merged.withColumn("Year", S.normalize_year("Year"))
    return merged


# --- tables --------------------------------------------------------------------------------

def ban_status_dimension(merged: DataFrame) -> DataFrame:
    """A13 + J7: (status, description) for each distinct non-empty status."""
    statuses = A.distinct_values(merged.select(F.nullif(F.lower(F.col("`Ban Status`")), F.lit(""))
                                 .alias("status")), "status")
    return statuses.withColumn("description", J.lookup_or_template(
        "status", BAN_STATUS_DESCRIPTIONS, "Description for "))


def fact_table(merged: DataFrame) -> DataFrame:
    """P4 + P8 + C11 + H-12/H-13: table column names and order, empty text -> null,
    year as integer text, a stable row id (seeded per partition, stable on retry)."""
    renamed = P.rename_columns(merged, FACT_RENAMES)
    fixed = P.project_to(renamed, [(n, "string") for n, _ in FACT_FIELDS])
    fixed = fixed.select(*[F.nullif(F.col(n), F.lit("")).alias(n) for n, _ in FACT_FIELDS])
    year = F.when(F.col("year").rlike(r"^\d+(\.0+)?$"), F.col("year").cast("double").cast("long").cast("string")) \
        .otherwise(F.col("year"))
    return fixed.withColumn("year", year).select(F.expr("uuid()").alias("id"), *[n for n, _ in FACT_FIELDS])


def constraint_report(fact: DataFrame, dimension: DataFrame) -> DataFrame:
    """Q7: PK, NOT NULL title, VARCHAR limits and the ban-status FK."""
    return Q.constraint_violations(fact, primary_key=["id"], not_null=["title"],
                                   max_length=dict(FACT_FIELDS),
                                   foreign_keys=[("ban_status", dimension, "status")])


# --- dashboard (the data behind every chart) ------------------------------------------------

def _class(df: DataFrame, statuses: Sequence[str]) -> DataFrame:
    return FL.include_values(df, "Ban Status", statuses)


def top_titles(df: DataFrame, statuses: Sequence[str] = BANNED_CLASS, n: int = 5) -> DataFrame:
    """F5 + A8 + O2 + W2: most frequent (Title, Author) in a status class, ranked."""
    counts = A.count_by(_class(df, statuses), ["Title", "Author"], "Ban Count")
    return W.top_n(counts, n, "Ban Count", ["Title", "Author"], rank_col="Rank")


def top_by(df: DataFrame, key: str, statuses: Sequence[str] = BANNED_CLASS, n: int = 5) -> DataFrame:
    counts = A.count_by(_class(df, statuses), [key], "Count")
    return W.top_n(counts, n, "Count", [key], rank_col="Rank")


def top_one(df: DataFrame, key: str, statuses: Sequence[str] = BANNED_CLASS) -> DataFrame:
    """O3: the single (key, count) pair with the most rows."""
    return W.top1_pair(A.count_by(_class(df, statuses), [key], "Count"), key, "Count")


def by_state_pivot(df: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """J6 + A10 + A11 + T9: per state code, distinct titles per status, total and
    a summary string. Status columns are in sorted order, as a pivot lays them out.
    Without ``statuses`` every status present counts, beside the known four (a small
    dimension). (H-14: the per-state views use codes; the treemap and top-k use names.)"""
    if statuses is None:
        present = {r[0] for r in df.select("Ban Status").distinct().collect() if r[0] is not None}
        statuses = [*{*BANNED_CLASS, *CHALLENGED_CLASS, *present}]
    coded = df.withColumn("State", J.lookup_or_keep("State", STATE_CODES))
    statuses = sorted(statuses)
    wide = A.pivot_distinct(coded, "State", "Ban Status", statuses, "Title")
    return A.with_row_total(A.with_row_summary(wide, list(statuses), "Ban Status Summary"),
                            list(statuses), "Total Count")


def dashboard(df: DataFrame) -> dict[str, DataFrame]:
    """Every aggregate the two dashboard pages draw."""
    # H-14: the per-state line series is drawn after the state names were recoded.
    filled = df.withColumns({"State": S.unknown_fill(J.lookup_or_keep("State", STATE_CODES)),
                             "District": S.unknown_fill("District")})
    return {
        "headline": A.distinct_counts(df, {"titles": "Title", "states": "State", "districts": "District"}),
        "by_year": A.distinct_count_by(df, ["Year", "Ban Status"], "Title", "Titles"),
        "by_origin": A.distinct_count_by(df, ["Origin of Challenge", "Ban Status"], "Title", "Titles"),
        "top_banned_titles": top_titles(df, BANNED_CLASS),
        "top_challenged_titles": top_titles(df, CHALLENGED_CLASS),
        "top_banned_authors": top_by(df, "Author", BANNED_CLASS),
        "top_challenged_authors": top_by(df, "Author", CHALLENGED_CLASS),
        "treemap": A.hierarchy_totals(df, ["State", "District"], "Title", root="USA"),
        "top_state": top_one(df, "State"),
        "top_states": top_by(df, "State"),
        "top_district": top_one(df, "District"),
        "top_districts": top_by(df, "District"),
        "by_state_map": by_state_pivot(df),
        "by_state_line": A.distinct_count_by(filled, ["State"], "Title", "Titles"),
        "by_district_line": A.distinct_count_by(filled, ["District"], "Title", "Titles"),
    }


def run(spark: SparkSession, index_paths: Sequence[str], merged_csv: str,
        dim_table: str, fact_table_name: str) -> dict[str, DataFrame]:
    """S4 x3 -> clean -> merge -> K1 CSV -> K8 dimension then fact -> dashboard."""
    from quarry.sinks.tables import recreate_dimension_and_fact, write_csv

    frames = [clean_index(f) for f in read_indexes(spark, index_paths)]
    merged = merge(frames)
    write_csv(merged, merged_csv)
    from quarry.sources.files import read_csv_text

    merged_back = read_csv_text(spark, merged_csv)
    dim = ban_status_dimension(merged_back)
    recreate_dimension_and_fact(dim, dim_table, fact_table(merged_back), fact_table_name,
                                foreign_key=("ban_status", "status"), primary_key=["id"])
    return dashboard(merged_back.cache())


def download_plan(pages: DataFrame, landed: DataFrame | None = None, prefix: str = "index-") -> DataFrame:
    """S7 + S8 + T7 + S9, the ingest planning step: for every page that has the
    download link, the CSV export link, the year taken from the page's slug and the
    file name to land it under; pages whose file is already landed (a ``file_name``
    column in ``landed``) are skipped. Downloading itself is outside Spark."""
    from quarry.sources import links as L

    plan = L.download_links(pages).select(
        "page_id", "url", "href", L.export_link("href").alias("export_url"),
        S.year_or_unknown("url").alias("year"))
    plan = plan.withColumn("file_name", F.concat(F.lit(prefix), F.col("year"), F.lit(".csv")))
    return L.not_yet_landed(plan, landed, "file_name") if landed is not None else plan
