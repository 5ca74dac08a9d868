"""SimHash near duplicates: fingerprints, pigeonhole blocks, verified Hamming links, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import (byte_texts, checkpointed, column_type, hinted, lower_ascii, map_arrow, slices,
                               word_pieces)
from quarry.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one block value that a task compares with each other at once.
TILE = 4096


def fingerprint(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a whole text: a bit is 1 if set in over half of the hashes of
    its shingles, repeats included. Fewer words than a shingle hash as they are; none give zero."""
    ones, total = np.zeros(64, dtype=np.int64), 0
    carry: list[bytes] = []
    digest = xxhash.xxh64_digest
    for piece in word_pieces(lower_ascii(text)):
        piece = carry + piece
        joined = b" ".join(piece)
        if len(piece) >= words:
            sizes = np.fromiter(map(len, piece), np.int64, len(piece)) + 1
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            lo = starts[: len(piece) - words + 1].tolist()
            hi = (starts[words - 1:] + sizes[words - 1:] - 1).tolist()
            raw = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in zip(lo, hi)]), np.uint8)
            ones += np.unpackbits(raw.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
            total += len(lo)
            carry = piece[len(piece) - words + 1:] if words > 1 else []
        else:
            carry = piece
    if not total:
        return xxhash.xxh64_intdigest(b" ".join(carry), seed) if carry else 0
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, version, fp) for every row: ``fp`` the fingerprint as a signed long (null texts count
    as empty), ``version`` a hash that tells rows of one id apart by their text."""
    def run(batches):
        for batch in slices(batches):
            fps = np.array([fingerprint(t) for t in byte_texts(batch, "text")], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("version"), pa.array(fps.view(np.int64))],
                                             names=["id", "version", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    return map_arrow(rows, run, f"id {column_type(docs, id_col)}, version long, fp long")


def block_masks(max_bits: int = MAX_BITS, spare: int = 2) -> list[int]:
    """Masks over ``spare`` of ``max_bits + spare`` bit blocks: two fingerprints within
    ``max_bits`` agree under at least one, as each differing bit spoils one block at most."""
    n = max_bits + spare
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(n)]
    masks = [sum(c) for c in combinations(blocks, spare)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(values: list[int], max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links (value, least value of its component) among distinct signed 64-bit values, from all
    comparisons of them: a spanning set, not all pairs."""
    if len(values) <= 6:
        out, left = [], sorted(values)
        while left:
            root, queue = left[0], [left.pop(0)]
            while queue and left:
                x = queue.pop()
                near = [y for y in left if ((x ^ y) & 0xFFFFFFFFFFFFFFFF).bit_count() <= max_bits]
                left = [y for y in left if y not in near]
                queue += near
                out += [(y, root) for y in near]
        return out
    left = np.sort(np.array(values, dtype=np.int64))
    out = []
    while len(left):
        root, queue, left = int(left[0]), [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count((left ^ queue.pop()).view(np.uint64)) <= max_bits
            if near.any():
                queue.extend(left[near])
                out += [(int(y), root) for y in left[near]]
                left = left[~near]
    return out


def links(fps: DataFrame, max_bits: int = MAX_BITS, tile: int = TILE) -> DataFrame:
    """(u, v) links among the distinct values of ``fps.fp`` that keep all components whole.

    Values meet in the blocks they share. A block value with over ``tile`` members is dealt to
    pairs of tiles, each compared in one task, so neither one task nor one row holds it all.
    """
    masks = block_masks(max_bits)
    keys = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
                      .alias("block", "part"))
    sizes = keys.groupBy("block", "part").agg(F.count("*").alias("n")).filter("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    dealt = (keys.join(sizes, ["block", "part"])
             .withColumn("own", F.pmod(F.xxhash64("fp"), tiles).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
             .groupBy("block", "part", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"))
             .agg(F.collect_list("fp").alias("fps"))
             .filter(F.size("fps") > 1).select("fps"))

    def run(batches):
        for batch in batches:
            pairs = [p for v in batch.column("fps").to_pylist() for p in forest(v, max_bits)]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)],
                                             names=["u", "v"])

    return map_arrow(dealt, run, "u long, v long")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """(id, version, fp, root, component_id) for every row of ``docs``: ``root`` names the
    component (its least fingerprint), ``component_id`` is its smallest id."""
    rows = checkpointed(fingerprints(docs, id_col, text))
    nodes = checkpointed(rows.groupBy("fp").agg(F.min("id").alias("first")))
    roots = components(links(nodes, max_bits))
    member = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    named = member.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(member.join(named, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id, fingerprint, component_id) for every row of ``docs``.

    Fingerprints within ``max_bits`` link; ``component_id`` is the smallest id reachable over
    links. Rows of equal fingerprint are one node, so groups of exact copies cost one row each.
    Null and empty texts have fingerprint zero and link as any other. A row with a null id is
    linked too; it gives no name, so a component of such rows only has a null component_id.
    Repeated rows and ids each keep their row; other columns are unused; an empty table gives none.
    """
    return classes(docs, id_col, text, max_bits).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they are: the row of the smallest id
    (rows with an id before rows without, then by a hash of the text); of rows equal in id and
    text any one. An empty table gives none."""
    rows = checkpointed(classes(docs, id_col, text, max_bits).select("id", "version", "root"))
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "version")).alias("one"))
    copies = rows.groupBy("id", "version").agg(F.count("*").alias("n"))
    first = first.select(F.col("one.id").alias("id"), F.col("one.version").alias("version"))
    chosen = checkpointed(first.join(copies, first["id"].eqNullSafe(copies["id"]) & (first["version"] == copies["version"]))
                          .select(first["id"].alias("_kept_id"), first["version"].alias("_kept_version"), "n"))
    chosen = hinted(chosen.withColumnRenamed("n", "_kept_n"), 128)  # of a row in a broadcast table, with its key
    found = docs.withColumn("_version", F.xxhash64(text)).join(
        chosen, F.col(id_col).eqNullSafe(F.col("_kept_id")) & (F.col("_version") == F.col("_kept_version")))
    single = found.filter("_kept_n = 1")
    repeated = found.filter("_kept_n > 1").dropDuplicates(["_kept_id", "_kept_version"])
    return single.unionByName(repeated).select(*docs.columns)
