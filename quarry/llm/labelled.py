"""Bounded labelled samples to fit classifiers on, and the split that holds rows out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import column_type

#: Every fifth remainder of crc32(id as text) is held out.
FOLDS = 5


def held_out(id_col: str | Column) -> Column:
    """Whether crc32(id as text) mod 5 is 0; a null id is not held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % FOLDS == 0, F.lit(False))


@dataclass(frozen=True)
class Sample:
    """Labelled texts, in order of id, and how many labelled rows each class has in all."""

    ids: list[int]
    labels: list[int]
    texts: list[str]
    totals: tuple[int, int]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, id_col: str = "doc_id",
                    text: str = "text") -> Sample:
    """At most ``per_class`` not-held-out documents of label 0 and of label 1, chosen by a hash of
    their id. Rows whose id or label is null or not 0 or 1 don't count; of repeated labels the
    larger, of repeated ids the smallest text. The ids are chosen first, so documents are read
    once and only chosen texts leave the executors.
    """
    spark = docs.sparkSession
    known = (labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
             .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("id"))
             .groupBy("id").agg(F.max("label").alias("label")))
    totals = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    mark = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    chosen: list[tuple] = []
    for value, n in sorted(totals.items()):
        share = min(1 << 30, int((1 << 30) * 1.3 * per_class / n) + 1)
        some = known.filter((F.col("label") == value) & (mark < share)).select("id", "label", mark.alias("mark"))
        chosen += [(r["id"], r["label"]) for r in some.orderBy("mark", "id").limit(per_class).collect()]
    kind = column_type(docs, id_col)
    ids = F.broadcast(spark.createDataFrame(chosen, f"id {kind}, label int"))  # 2 * per_class rows at most
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(ids, "id")
            .groupBy("id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text")).collect())
    rows.sort(key=lambda r: r["id"])
    return Sample([r["id"] for r in rows], [r["label"] for r in rows], [r["text"] for r in rows],
                  (totals.get(0, 0), totals.get(1, 0)))
