"""Corpus pipeline: documents -> without toxic ones -> one of each near-duplicate group -> without
repeated passages -> without benchmark copies -> token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All stages but the last return the columns of their input.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, decontaminate, simhash, substrings, toxicity
from quarry.llm.common import drop_written, read
from quarry.llm.queries import tokenizer_path
from quarry.session import ensure_checkpoint_dir


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't predict to be toxic. Texts that are null or
    empty have no evidence and stay; rows with null or repeated ids are judged each."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one of the smallest id. Null and empty texts
    are copies of each other; rows with a null id stay only where no other row of the group has one."""
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the words of 20-word windows that start earlier in the corpus. Null
    texts stay null; a text of nothing but repeats stays as an empty one."""
    return substrings.cut_repeats(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item. Null and empty texts stay."""
    return decontaminate.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, n_tokens, token_ids, decoded_sha256) of every document; null and
    empty texts have no ids."""
    encoded = bpe.encode(docs, tokenizer_path(), keep=("lang", "source"))
    return encoded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids",
                          F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_benchmark_copies),
    ("bpe", encode_tokens),
]

#: SQL expresses neither the classifier nor XXH64 with a seed; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again; only the
    last one's table stays there."""
    docs = read(spark, sf_dir, "documents")
    base, before = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}", None
    for i, (_, stage) in enumerate(STAGES):
        path = f"{base}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_written(spark, before)
        before = path
    return docs
