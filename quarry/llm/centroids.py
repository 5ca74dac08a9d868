"""Centroid clustering with a LAESA pivot table: vector distances to fixed pivots, computed once,
bound the distances to all centroids of every round from below, and only the centroids that
survive the bound receive exact integer distances.

By the triangle inequality |d(x, p) - d(c, p)| <= d(x, c) for every pivot p. Each round the driver
sends the centroids (a fixed number) and their distances to the pivots; a task takes the exact
distance to the centroid of the least bound and then to those whose bound doesn't exceed it.
Sums of vectors are added up inside the tasks, and per centroid and component by Spark.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import checkpointed, drop_written, map_arrow, written

#: Centroids, rounds, components, the scale of the whole numbers, the seed of the start.
CENTROIDS, ROUNDS, DIMS, SCALE, SEED = 40, 5, 64, 256, 2
#: Pivots of the table, and vectors that a task handles together.
PIVOTS, VECTOR_BLOCK = 8, 1024
#: Exact sums leave a task in digits of this many bits, so that Spark adds them up in longs.
_DIGIT = 30
_LONG = (1 << 63) - 1
#: Components up to this size have squared distances (64 of them) within 64-bit integers.
_SMALL = 1 << 27


def whole_vectors(vectors: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v array<double>): floor(scale * x) of every component as a double, which holds it exactly.

    Vectors of another length, null ones and those with a null or non-finite component take no
    part, nor do those whose scaled components leave the range of doubles.
    """
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * F.lit(float(scale))) == F.lit(float("inf"))))
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            flat = np.floor(batch.column("v").flatten().to_numpy(zero_copy_only=False) * float(scale))
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(flat, dims)], names=["id", "v"])

    return map_arrow(rows.filter(F.col("v").isNotNull() & (F.size(v) == dims)).filter(~bad), run, "id long, v array<double>")


def _lists(flat: np.ndarray, width: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width or 1, dtype=np.int32)), pa.array(flat))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


_python_int = np.frompyfunc(int, 1, 1)


def integers(rows: list[list[int]], dims: int) -> np.ndarray:
    """Python integers as a matrix that holds them exactly."""
    return np.array([x for row in rows for x in row], dtype=object).reshape(-1, dims)


def alike(vectors: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole doubles and a matrix of Python integers, both as 64-bit integers where squared
    distances fit, else both as Python integers."""
    if max(np.abs(vectors).max(initial=0), float(np.abs(marks).max(initial=0))) < _SMALL:
        return vectors.astype(np.int64), marks.astype(np.int64)
    return _python_int(vectors.astype(object)), marks


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of two integer matrices."""
    d = a - b
    return (d * d).sum(axis=1) if len(d) else np.zeros(0, a.dtype)


def pick_pivots(starts: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the starting centroids, each the farthest from those before it."""
    if not len(starts):
        return starts
    chosen = [0]
    near = squared(starts, starts[[0] * len(starts)])
    while len(chosen) < min(n, len(starts)):
        chosen.append(int(near.argmax()))
        near = np.minimum(near, squared(starts, starts[[chosen[-1]] * len(starts)]))
    return starts[chosen]


def distances(matrix: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all rows to all pivots as doubles."""
    out = [np.sqrt(squared(matrix, pivots[[i] * len(matrix)]).astype(float)) for i in range(len(pivots))]
    return np.stack(out, axis=1) if out else np.zeros((len(matrix), 0))


def nearest(matrix: np.ndarray, table: np.ndarray, centroids: np.ndarray, reach: np.ndarray):
    """(cluster, exact squared distance, exact distances computed) of every row, ties to the smaller
    number. ``table`` and ``reach`` are the rows' and the centroids' distances to the pivots."""
    n = len(matrix)
    low = np.zeros((n, len(centroids)))
    for p in range(table.shape[1]):
        np.maximum(low, np.abs(table[:, p:p + 1] - reach[None, :, p]), out=low)
    # Rounded distances may be off by a few units in the last place; the slack is far beyond that.
    low -= 1e-9 * (1 + max(table.max(initial=0), reach.max(initial=0)))
    first = low.argmin(axis=1)
    best = squared(matrix, centroids[first])
    cluster = first.copy()
    rows, others = np.nonzero(low <= np.sqrt(best.astype(float))[:, None] * (1 + 1e-12))
    ask = others != first[rows]
    rows, others = rows[ask], others[ask]
    found = squared(matrix[rows], centroids[others])
    for r, c, d in zip(*(x[found <= best[rows]] for x in (rows, others, found))):
        if d < best[r] or (d == best[r] and c < cluster[r]):
            best[r], cluster[r] = d, c
    return cluster, best, n + len(rows)


def digits(value: int) -> list[tuple[int, int]]:
    """(place, digit) of a whole number, its sign on every digit, without zero digits."""
    sign, value, out = (-1 if value < 0 else 1), abs(int(value)), []
    place = 0
    while value:
        if value & ((1 << _DIGIT) - 1):
            out.append((place, sign * (value & ((1 << _DIGIT) - 1))))
        value >>= _DIGIT
        place += 1
    return out


def _blocks(batches, dims: int, pivots: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, VECTOR_BLOCK):
            part = batch.slice(lo, VECTOR_BLOCK)
            yield part.column("id"), _matrix(part.column("v"), dims), _matrix(part.column("d"), pivots)


def _sums(rows: DataFrame, sent, dims: int) -> dict[tuple[int, int], int]:
    """(cluster, component) -> exact sum of the vectors assigned to it; component -1 counts them."""
    def run(batches):
        marks, reach = sent.value
        total: dict[tuple[int, int], int] = {}
        for _, v, d in _blocks(batches, dims, reach.shape[1]):
            matrix, centroids = alike(v, marks)
            cluster, _, _ = nearest(matrix, d, centroids, reach)
            for c in np.unique(cluster):
                own = matrix[cluster == c]
                for j, x in enumerate([*own.sum(axis=0), len(own)]):
                    at = int(c), (j if j < dims else -1)
                    total[at] = total.get(at, 0) + int(x)
        made = [(c, j, place, x) for (c, j), t in total.items() for place, x in digits(t)]
        yield pa.RecordBatch.from_pylist([dict(zip(("c", "j", "place", "x"), m)) for m in made], schema=pa.schema(
            [("c", pa.int32()), ("j", pa.int32()), ("place", pa.int32()), ("x", pa.int64())]))

    parts = map_arrow(rows, run, "c int, j int, place int, x long")
    out: dict[tuple[int, int], int] = {}
    for r in parts.groupBy("c", "j", "place").agg(F.sum("x").alias("x")).collect():  # centroids x components
        out[r.c, r.j] = out.get((r.c, r.j), 0) + (r.x << (_DIGIT * r.place))
    return out


def _started(rows: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of the least hashes of their ids; ties (rows of one id) by the vector."""
    named = rows.filter("id IS NOT NULL").withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256))
    return [[int(x) for x in r.v] for r in named.orderBy("h", "v").limit(k).select("v").collect()]


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = CENTROIDS, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, seed: int = SEED, pivots: int = PIVOTS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that
    takes part: its centroid after ``rounds`` rounds of exact k-means and its squared distance.

    Centroids start as the ``k`` vectors (all, if fewer) of the least SHA-256 of ``seed:id``; a round
    assigns every vector and replaces each centroid that has vectors by the floor of their mean.
    Ties go to the smaller number. Rows that share an id are vectors of their own; a row with a
    null id is clustered but starts no centroid. An empty table, or one with null ids alone, gives
    no rows. Distances and inertias beyond the range of a long are clamped to it. Other columns
    are not read.

    The driver holds the centroids and their sums alone.
    """
    spark = vectors.sparkSession
    base = whole_vectors(vectors, id_col, vector, dims, scale)
    now = _started(base, k, seed)
    if not now:
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    chosen = pick_pivots(integers(now, dims), pivots)
    fixed = spark.sparkContext.broadcast(chosen)

    def tabled(batches):
        marks = fixed.value
        for batch in batches:
            for lo in range(0, batch.num_rows, VECTOR_BLOCK):
                part = batch.slice(lo, VECTOR_BLOCK)
                d = distances(*alike(_matrix(part.column("v"), dims), marks))
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), _lists(d.ravel(), len(marks))],
                                                 names=["id", "v", "d"])

    rows, path = written(map_arrow(base, tabled, "id long, v array<double>, d array<double>"), "pivot-table")

    def send(centroids):
        marks = integers(centroids, dims)
        return spark.sparkContext.broadcast((marks, distances(marks, chosen)))

    for _ in range(rounds):
        sent = send(now)
        sums = _sums(rows, sent, dims)
        now = [[sums.get((c, j), 0) // sums[c, -1] for j in range(dims)] if (c, -1) in sums else old
               for c, old in enumerate(now)]
        sent.unpersist()
    sent = send(now)

    def assigned(batches):
        marks, reach = sent.value
        for ids, v, d in _blocks(batches, dims, reach.shape[1]):
            matrix, centroids = alike(v, marks)
            own, best, _ = nearest(matrix, d, centroids, reach)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(own.astype(np.int32)), pa.array([min(int(x), _LONG) for x in best], pa.int64())],
                names=["id", "cluster", "distance"])

    found = checkpointed(map_arrow(rows, assigned, "id long, cluster int, distance long"))
    drop_written(spark, path)
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    totals = {r.cluster: int(r.s) for r in found.groupBy("cluster").agg(wide.alias("s")).collect()}  # one a centroid
    every = min(sum(totals.values()), _LONG)
    named = spark.createDataFrame(
        [(c, min(totals.get(c, 0), _LONG), every, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest())
         for c, v in enumerate(now)], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return (found.join(F.broadcast(named), "cluster")
            .select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))
