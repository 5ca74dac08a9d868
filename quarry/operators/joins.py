"""Joins and lookups: J1-J8.

Scale rules applied here:
* broadcast only what has a counted bound (a literal map, a list of hot keys whose
  rows were counted); every other join strategy is left to Spark's size-checked
  broadcast threshold or a sort-merge join;
* many-to-many full outer merges cut hot keys into a grid of tiles, because AQE's
  skew-join split does not apply to FULL OUTER joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir


def _q(name: str) -> str:
    return f"`{name}`"


def _eq(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def key_counts(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows per key in each frame (``n0, n1, ...``; null when the frame lacks the
    key), from one shuffle of the key columns only. Null keys group together,
    which is exactly the null-safe matching of the merge."""
    tagged = None
    for i, f in enumerate(frames):
        t = f.select(*[F.col(_q(k)).alias(k) for k in keys], F.lit(i).alias("__f"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return tagged.groupBy(*keys).agg(*[
        F.nullif(F.count_if(F.col("__f") == i), F.lit(0)).alias(f"n{i}") for i in range(len(frames))])


def _left_rows(upto: int) -> Column:
    """Rows the merge of frames ``0..upto-1`` holds for a key (0 if none has it)."""
    prod = F.lit(1).cast("long")
    for i in range(upto):
        prod = prod * F.coalesce(F.col(f"n{i}"), F.lit(1))
    present = F.greatest(*[F.coalesce(F.col(f"n{i}"), F.lit(0)) for i in range(upto)]) > 0 \
        if upto > 1 else F.col("n0").isNotNull()
    return F.when(present, prod).otherwise(F.lit(0))


#: Hot keys that are broadcast; more of them are joined by a shuffle, which Spark splits where skewed.
BROADCAST_KEYS = 100_000


def hot_keys(counts: DataFrame, keys: Sequence[str], upto: int, most: int) -> DataFrame:
    """The keys for which step ``upto`` of the merge makes more than ``most`` rows, each with its
    grid: ``tiles_l`` x ``tiles_r`` tiles that make about ``most`` rows each, and whether ``both``
    sides have the key. All of them, however many; a key on one side alone is dealt as well."""
    n, m = _left_rows(upto), F.coalesce(F.col(f"n{upto}"), F.lit(0))
    side = F.lit(float(most) ** 0.5)
    table = counts.select(*keys, n.alias("__n"), m.alias("__m"))
    n, m = F.col("__n"), F.col("__m")
    made = F.when((n > 0) & (m > 0), n.cast("double") * m).otherwise(F.greatest(n, m).cast("double"))
    whole = F.ceil(made / F.lit(most))
    narrow_l, narrow_r = n <= side, m <= side
    tiles_l = F.when(m == 0, whole).when(n == 0, F.lit(1)).when(narrow_l, F.lit(1)).when(narrow_r, whole).otherwise(F.ceil(n / side))
    tiles_r = F.when(n == 0, whole).when(m == 0, F.lit(1)).when(narrow_l, whole).when(narrow_r, F.lit(1)).otherwise(F.ceil(m / side))
    # No more tiles along a side than it has rows.
    return table.filter(made > most).select(
        *keys, F.least(tiles_l, F.greatest(n, F.lit(1))).cast("long").alias("tiles_l"),
        F.least(tiles_r, F.greatest(m, F.lit(1))).cast("long").alias("tiles_r"), ((n > 0) & (m > 0)).alias("both"))


def _dealt(side: DataFrame, hot: DataFrame, keys: Sequence[str], named: dict[str, str], own: str, other: str,
           null_safe: bool) -> DataFrame:
    """``side`` with a tile (``own`` and ``other`` coordinate) per row. Rows of a hot key are dealt
    over the tiles of their side in turn, whatever they hold, and copied to those of the other side
    if it has the key. Their tiles are checkpointed: they follow from the order of the rows,
    which a task that runs again may not repeat."""
    h = hot.withColumnsRenamed({k: f"{k}__h" for k in keys})
    cond = None
    for k in keys:
        term = _eq(side[_q(named[k])], h[_q(f"{k}__h")], null_safe)
        cond = term if cond is None else cond & term
    found = side.join(h, cond, "left").drop(*[f"{k}__h" for k in keys])
    grid = ["tiles_l", "tiles_r", "both"]
    cold = (found.filter(F.col("both").isNull()).drop(*grid)
            .withColumns({own: F.lit(0).cast("long"), other: F.lit(0).cast("long"), f"{own}__both": F.lit(False)}))
    along, across = ("tiles_l", "tiles_r") if own == "__l" else ("tiles_r", "tiles_l")
    heavy = (found.filter(F.col("both").isNotNull())
             .withColumn(own, F.pmod(F.monotonically_increasing_id(), F.col(along))).checkpoint(eager=True))
    copies = F.when(F.col("both"), F.sequence(F.lit(0).cast("long"), F.col(across) - 1)).otherwise(F.array(F.lit(0).cast("long")))
    heavy = (heavy.withColumn(other, F.explode(copies)).withColumn(f"{own}__both", F.col("both")).drop(*grid))
    return cold.unionByName(heavy)


def full_outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     null_safe: bool = True, hot: DataFrame | None = None) -> DataFrame:
    """Full outer equi-join on ``keys`` that keeps one copy of each key column
    (``coalesce(left.k, right.k)``); many-to-many matches yield every pair.

    With ``hot`` (see ``hot_keys``), the pairs of a hot key form a grid: left rows are dealt
    over its rows of tiles, right rows over its columns, each copied along the other side, so
    every pair meets in exactly one tile and no task holds more than a few tiles. All rows of a
    key that both sides have match, so copies in tiles without a partner are dropped.
    The result equals the plain join.
    """
    lk = {k: f"{k}__l" for k in keys}
    rk = {k: f"{k}__r" for k in keys}
    a = left.withColumnsRenamed(lk)
    b = right.withColumnsRenamed(rk)
    if hot is not None:
        a = _dealt(a, hot, keys, lk, "__l", "__r", null_safe)
        b = _dealt(b, hot, keys, rk, "__r", "__l", null_safe).withColumnsRenamed({"__l": "__l2", "__r": "__r2"})
    cond = None
    for k in keys:
        term = _eq(a[_q(lk[k])], b[_q(rk[k])], null_safe)
        cond = term if cond is None else cond & term
    if hot is not None:
        cond = cond & (a["__l"] == b["__l2"]) & (a["__r"] == b["__r2"])
    joined = a.join(b, cond, "full")
    if hot is not None:
        alone_l = F.col("__l__both") & F.col("__l2").isNull()
        alone_r = F.col("__r__both") & F.col("__l").isNull()
        joined = joined.filter(~F.coalesce(alone_l, F.lit(False)) & ~F.coalesce(alone_r, F.lit(False)))
    dealt = ("__l", "__r", "__l2", "__r2", "__l__both", "__r__both")
    rest = [c for c in joined.columns
            if c not in lk.values() and c not in rk.values() and c not in dealt]
    return joined.select(
        *[F.coalesce(F.col(_q(lk[k])), F.col(_q(rk[k]))).alias(k) for k in keys],
        *[F.col(_q(c)) for c in rest])


def hot_key_tables(frames: Sequence[DataFrame], keys: Sequence[str], most: int) -> dict[int, DataFrame | None]:
    """For each join step of a left-deep merge the hot keys with their grids, or None where no key
    makes more than ``most`` rows.

    One key-only aggregate over all inputs; the heavy keys stay a (checkpointed) table of at
    most input rows / sqrt(``most``) rows, of which only the number per step reaches the driver.
    """
    ensure_checkpoint_dir(frames[0].sparkSession)
    counts = key_counts(frames, keys)
    steps = range(1, len(frames))
    made = None
    for st in steps:
        n, m = _left_rows(st), F.coalesce(F.col(f"n{st}"), F.lit(0))
        hot = F.greatest(n.cast("double") * m, n.cast("double"), m.cast("double")) > most
        made = hot if made is None else made | hot
    heavy = counts.filter(made).checkpoint(eager=True)
    out: dict[int, DataFrame | None] = {}
    for st in steps:
        hot = hot_keys(heavy, keys, st, most)
        n = hot.count()
        out[st] = None if n == 0 else F.broadcast(hot) if n <= BROADCAST_KEYS else hot
    return out


def merge_indexes(frames: Sequence[DataFrame], keys: Sequence[str], null_safe: bool = True,
                  skew_rows: int | None = 1_000_000) -> DataFrame:
    """J1 + J2: outer-merge several frames on ``keys`` (nulls match, many-to-many),
    then fold each column that several frames share into one column where the
    earliest frame's non-null value wins (``coalesce(f0.c, f1.c, ...)``).

    With ``skew_rows``, per-key counts of every input are computed once (a
    key-only aggregate) and each join step cuts the keys that make more than
    ``skew_rows`` rows into tiles, whichever side they are heavy on and however
    many there are; steps without such keys stay plain joins.
    """
    tagged = []
    owners: dict[str, list[int]] = {}
    for i, f in enumerate(frames):
        others = [c for c in f.columns if c not in keys]
        for c in others:
            owners.setdefault(c, []).append(i)
        tagged.append(f.select(*[F.col(_q(k)) for k in keys],
                               *[F.col(_q(c)).alias(f"{c}__{i}") for c in others]))
    hot = (hot_key_tables(frames, keys, skew_rows)
           if (skew_rows and null_safe and len(frames) > 1) else {})
    out = tagged[0]
    for step, t in enumerate(tagged[1:], start=1):
        out = full_outer_merge(out, t, keys, null_safe, hot.get(step))
    return out.select(*[F.col(_q(k)) for k in keys],
                      *[F.coalesce(*[F.col(_q(f"{c}__{i}")) for i in idx]).alias(c)
                        if len(idx) > 1 else F.col(_q(f"{c}__{idx[0]}")).alias(c)
                        for c, idx in owners.items()])


def key_multiplicity(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows the merge will produce per key (product of per-frame counts, a frame
    without the key counting 1) -- the blow-up report to read before merging."""
    return key_counts(frames, keys).withColumn("merged_rows", _left_rows(len(frames)))


def exists_in(df: DataFrame, column: str, ref: DataFrame, ref_column: str,
              negate: bool = False) -> DataFrame:
    """Semi (or anti) join against the distinct referenced keys."""
    keys = ref.select(F.col(_q(ref_column)).alias("__k")).distinct()
    how = "left_anti" if negate else "left_semi"
    return df.join(keys, F.col(_q(column)) == F.col("__k"), how)


def _literal_map(mapping: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def lookup_or_keep(c: str | Column, mapping: Mapping[str, str]) -> Column:
    """Dictionary lookup, falling back to the original value. The dictionary is
    a literal map inside the expression: no join, no shuffle."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.element_at(_literal_map(mapping), col), col)


def lookup_or_template(c: str | Column, mapping: Mapping[str, str], prefix: str) -> Column:
    """Dictionary lookup with a templated default ``prefix + value``."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.element_at(_literal_map(mapping), col), F.concat(F.lit(prefix), col))
