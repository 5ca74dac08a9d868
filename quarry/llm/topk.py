"""Exact top-k inner products by a three-phase uniform threshold.

Each shard of vectors keeps its score lists by ranges of dimensions: a list holds the part of
every score that its dimensions make. (1) Every list gives its local best entries; their exact
totals yield a score that k candidates reach, the safe cutoff. (2) The cutoff, divided evenly
over the lists, is broadcast: a total that reaches it has a part that reaches its share in some
list, so the entries at or above the share suffice. (3) Their totals are resolved exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, map_arrow

SCALE = 1024
LIST_WIDTH = 16
#: Queries that are broadcast together, and vectors that a task scores together.
QUERY_BLOCK, VECTOR_BLOCK = 1024, 2048
_LONG = (-(1 << 63), (1 << 63) - 1)


def quantised(vectors: DataFrame, id_col: str, vector: str, scale: int = SCALE) -> DataFrame:
    """(row, id, v array<double>): floor(scale * x) of each component as a double, exact whole numbers.

    Rows whose id or vector is null, or whose vector holds a null or non-finite component, take
    no part. ``row`` tells rows of one id apart; it is fixed once the result is checkpointed.
    """
    def run(batches):
        for batch in batches:
            col = batch.column("v")
            flat = np.floor(col.flatten().to_numpy(zero_copy_only=False) * float(scale))
            sizes = np.fromiter((len(x) for x in col), np.int32, len(col))
            made = pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), made], names=["id", "v"])

    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull()))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.filter(~F.coalesce(bad, F.lit(False)))
    made = map_arrow(rows, run, "id long, v array<double>")
    return made.select(F.monotonically_increasing_id().alias("row"), "id", "v")


def _matrix(vectors: list, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _blocks(batches, dims: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, VECTOR_BLOCK):
            part = batch.slice(lo, VECTOR_BLOCK)
            ids = [part.column(c).to_numpy(zero_copy_only=False) for c in ("row", "id")]
            sizes = np.fromiter((len(x) for x in part.column("v")), np.int64, part.num_rows)
            flat = part.column("v").flatten().to_numpy(zero_copy_only=False)
            if len(sizes) and (sizes == dims).all():
                yield ids, flat.reshape(-1, dims)
            else:
                yield ids, _matrix(np.split(flat, np.cumsum(sizes)[:-1]), dims)


def _lists(queries: np.ndarray, vectors: np.ndarray, width: int) -> np.ndarray:
    """Parts of the scores: list x query x vector. Whole numbers, exact in doubles while they
    stay below 2**53, else as Python integers."""
    dims = vectors.shape[1]
    edges = range(0, dims, width) if dims else [0]
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(dims, 1)
    if not most < 2.0 ** 53:
        whole = np.frompyfunc(int, 1, 1)
        queries, vectors = whole(queries), whole(vectors)
    return np.stack([queries[:, e:e + width] @ vectors[:, e:e + width].T for e in edges])


_FOUND = ("query_row", "query_id", "vec_id", "score")


def _emit(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(_FOUND)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=list(_FOUND))


def _clamped(x) -> int:
    return min(max(int(x), _LONG[0]), _LONG[1])


def _phase_one(vectors: DataFrame, sent, dims: int, k: int, width: int) -> DataFrame:
    """Per shard and query the exact totals of the best entries of its local lists."""
    def run(batches):
        asked, queries = sent.value
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        for (keys, ids), matrix in _blocks(batches, dims):
            parts = _lists(queries, matrix, width)
            total = parts.sum(axis=0)
            for q, (own, _) in enumerate(asked):
                top = set()
                for part in parts[:, q, :]:
                    top.update(range(len(part)) if len(part) <= k + 1 else
                               np.argpartition(part, len(part) - k - 1)[len(part) - k - 1:].tolist())
                found = [(_clamped(total[q, i]), int(ids[i])) for i in top if keys[i] != own]
                best[q] = sorted(best[q] + found, key=lambda x: (-x[0], x[1]))[:k]
        yield _emit([(*asked[q], i, s) for q, b in enumerate(best) for s, i in b])

    return map_arrow(vectors, run, ", ".join(f"{c} long" for c in _FOUND))


def _phase_three(vectors: DataFrame, sent, dims: int, width: int) -> DataFrame:
    """Entries whose part reaches the broadcast share in some list, with totals resolved."""
    def run(batches):
        asked, queries, cutoffs = sent.value
        for (keys, ids), matrix in _blocks(batches, dims):
            parts = _lists(queries, matrix, width)
            rows = []
            for q, (own, query_id) in enumerate(asked):
                cutoff = cutoffs[q]
                if cutoff is None or cutoff <= _LONG[0] or cutoff >= _LONG[1]:
                    some = range(len(ids))
                else:
                    some = np.flatnonzero((parts[:, q, :] * len(parts) >= cutoff).any(axis=0))
                for i in some:
                    total = _clamped(parts[:, q, i].sum())
                    if keys[i] != own and (cutoff is None or total >= cutoff):
                        rows.append((own, query_id, int(ids[i]), total))
            yield _emit(rows)

    return map_arrow(vectors, run, ", ".join(f"{c} long" for c in _FOUND))


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10,
          width: int = LIST_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every``, its
    ``k`` best other vectors by integer inner product, ties to the smaller id.

    Queries go against all vectors in blocks of at most about ``QUERY_BLOCK``, which bounds what
    is broadcast and what reaches the driver (block vectors and one cutoff each). Shorter vectors
    count as padded with zeros. Scores beyond the range of a long are clamped to it.
    """
    spark = vectors.sparkSession
    rows = checkpointed(quantised(vectors, id_col, vector))
    dims = rows.agg(F.max(F.size("v"))).first()[0] or 0
    asked = rows.filter(F.col("id") % every == 0)
    n_blocks = -(-asked.count() // QUERY_BLOCK)
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    for b in range(n_blocks):
        block = asked.filter(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == b).collect()
        if not block:
            continue
        ids = [(r["row"], r["id"]) for r in block]
        matrix = _matrix([r["v"] for r in block], dims)
        first = _phase_one(rows, spark.sparkContext.broadcast((ids, matrix)), dims, k, width)
        cut = dict(first.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") == k)
                   .select("query_row", "score").collect())
        sent = spark.sparkContext.broadcast((ids, matrix, [cut.get(row) for row, _ in ids]))
        found = (_phase_three(rows, sent, dims, width)
                 .withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
        out = out.unionByName(checkpointed(found))
    return out
