"""Data quality and profiling: Q1-Q7.

Profiles are single-pass aggregates returned in long form (one row per column),
so they stay one small DataFrame however wide the input is.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window


def _q(name: str) -> str:
    return f"`{name}`"


# --- Q1: rule-based validation --------------------------------------------------------

Rule = tuple[str, Column]  # (rule name, predicate that is TRUE when the row violates it)


def with_violations(df: DataFrame, rules: Sequence[Rule], out: str = "violations") -> DataFrame:
    """Q1: add ``violations array<string>`` listing every rule a row breaks.

    A rule predicate that evaluates to null counts as passed (the field is absent
    and the rule is about its value, not its presence); presence rules use isNull.
    """
    empty = F.array().cast("array<string>")
    flags = [F.when(F.coalesce(pred, F.lit(False)), F.array(F.lit(name))).otherwise(empty)
             for name, pred in rules]
    return df.withColumn(out, F.flatten(F.array(*flags)))


def violation_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Q1: one pass, one ``count_if`` per rule, returned long: (rule, violations)."""
    aggs = [F.count_if(F.coalesce(pred, F.lit(False))).alias(f"r{i}") for i, (_, pred) in enumerate(rules)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{name}', r{i}" for i, (name, _) in enumerate(rules))
    return wide.selectExpr(f"stack({len(rules)}, {stack}) as (rule, violations)")


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Q1 quarantine mode: (valid rows, rejected rows with their violations)."""
    tagged = with_violations(df, rules)
    valid = tagged.filter(F.size("violations") == 0).drop("violations")
    rejected = tagged.filter(F.size("violations") > 0)
    return valid, rejected


def assert_valid(df: DataFrame, rules: Sequence[Rule]) -> None:
    """Q1 fail-batch mode (the source behaviour): raise if any row breaks any rule."""
    bad = violation_counts(df, rules).filter(F.col("violations") > 0).collect()
    if bad:
        detail = ", ".join(f"{r['rule']}={r['violations']}" for r in bad)
        raise ValueError(f"schema validation failed: {detail}")


# --- Q2-Q4: profiles ------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """Q2: null count per column, long form (column, nulls), one pass."""
    cols = df.columns
    wide = df.agg(*[F.count_if(F.col(_q(c)).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    stack = ", ".join(f"'{c}', n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, nulls)")


def table_shape(df: DataFrame) -> DataFrame:
    """Q3: (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)).cast("long"))


def column_info(df: DataFrame) -> DataFrame:
    """Q4: pandas ``info()`` in long form: (position, column_name, dtype, non_null)."""
    fields = df.schema.fields
    wide = df.agg(*[F.count(F.col(_q(f.name))).alias(f"n{i}") for i, f in enumerate(fields)])
    stack = ", ".join(
        f"{i}L, '{f.name}', '{f.dataType.simpleString()}', n{i}" for i, f in enumerate(fields))
    return wide.selectExpr(f"stack({len(fields)}, {stack}) as (position, column_name, dtype, non_null)")


# --- Q5: exact describe ---------------------------------------------------------------


def _in_gap(v, lo, hi):
    cond = v.isNotNull() & ~F.isnan(v)
    if lo is not None:
        cond = cond & (v > F.lit(lo))
    if hi is not None:
        cond = cond & (v < F.lit(hi))
    return cond


def _place_among(v, edges: Sequence[float]):
    """(at: how many of the ascending ``edges`` are no larger than ``v``, there: whether ``v`` is the
    last of them) by binary steps; null for values that don't count."""
    known = F.array(*[F.lit(e) for e in edges])
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(edges).bit_length()))])
    at = F.aggregate(steps, F.lit(0), lambda p, s: F.when(F.get(known, p + s - 1) <= v, p + s).otherwise(p))
    return F.struct(F.when(_in_gap(v, None, None), at).alias("at"),
                    F.coalesce(F.array_contains(known, v), F.lit(False)).alias("there"))


def exact_quantiles_multi(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                          fetch_limit: int = 200_000, grid: int = 256,
                          accuracy: int = 100_000) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles (pandas / ``quantile_cont``) of several
    columns, without gathering any column anywhere.

    A wanted rank lives in a *gap* (lo, hi) of known size and offset. While a gap
    holds more than ``fetch_limit`` rows, one aggregate draws an equi-depth grid
    inside every open gap of every column (``percentile_approx``), and a second
    counts rows between and at its values, found by binary steps; each rank then either lands exactly on
    a grid value or in a sub-gap about ``grid`` times smaller. Gaps at or under
    ``fetch_limit`` rows are ranked in one tagged scan (a window per gap) and only
    the wanted positions reach the driver. All columns share
    the same passes: 10^12 rows need three levels (two scans each) plus the
    count and the fetch, whatever the number of columns.
    """
    cols = list(columns)
    vals = df.select(*[F.col(_q(c)).cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    vcol = [F.col(f"v{i}") for i in range(len(cols))]
    counts = vals.agg(*[F.count_if(_in_gap(vcol[i], None, None)).alias(f"n{i}")
                        for i in range(len(cols))]).first()
    n = [counts[f"n{i}"] for i in range(len(cols))]
    found: list[dict[int, float]] = [{} for _ in cols]
    # open gap: (column index, lo, hi, offset = rows <= lo, size = rows strictly inside, ranks)
    pending = []
    for i in range(len(cols)):
        if n[i]:
            ranks = sorted({r for p in probs for r in (math.floor(p * (n[i] - 1)), math.ceil(p * (n[i] - 1)))})
            pending.append((i, None, None, 0, n[i], ranks))
    qs = [j / grid for j in range(1, grid)]
    while pending:
        small = [g for g in pending if g[4] <= fetch_limit]
        big = [g for g in pending if g[4] > fetch_limit]
        pending = []
        if small:
            tagged = []
            for i in sorted({g[0] for g in small}):
                tag = None
                for j, g in enumerate(small):
                    if g[0] != i:
                        continue
                    cond = _in_gap(vcol[i], g[1], g[2])
                    tag = F.when(cond, F.lit(j)) if tag is None else tag.when(cond, F.lit(j))
                tagged.append(F.struct(tag.alias("g"), vcol[i].alias("v")))
            # Rank the rows of each small gap inside Spark (one window partition
            # per gap, at most ``fetch_limit`` rows) and bring back only the
            # wanted positions.
            in_gaps = (vals.select(F.explode(F.array(*tagged)).alias("t"))
                       .filter(F.col("t.g").isNotNull()).select("t.g", "t.v"))
            ranked = in_gaps.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v")))
            wanted = None
            for j, (_i, _lo, _hi, off, _size, ranks) in enumerate(small):
                term = (F.col("g") == j) & F.col("rn").isin([r - off + 1 for r in ranks])
                wanted = term if wanted is None else wanted | term
            for r in ranked.filter(wanted).collect():
                i, off = small[r["g"]][0], small[r["g"]][3]
                found[i][off + r["rn"] - 1] = r["v"]
        if not big:
            break
        grids = vals.agg(*[
            F.percentile_approx(F.when(_in_gap(vcol[g[0]], g[1], g[2]), vcol[g[0]]), qs, accuracy).alias(f"g{j}")
            for j, g in enumerate(big)]).first()
        edges = [sorted(set(grids[f"g{j}"])) for j in range(len(big))]
        # Grid values of a column's gaps together; each row is counted once, between two of them.
        known = {i: sorted({e for j, g in enumerate(big) if g[0] == i for e in edges[j]}) for i in {g[0] for g in big}}
        places = F.explode(F.array(*[_place_among(vcol[i], es).withField("c", F.lit(i)) for i, es in known.items()]))
        rows = (vals.select(places.alias("t")).filter("t.at IS NOT NULL").groupBy("t.c", "t.at", "t.there").count().collect())
        for j, (i, lo, hi, off, size, ranks) in enumerate(big):
            es = edges[j]
            at = [known[i].index(e) for e in es]
            lt = [sum(r["count"] for r in rows if r["c"] == i and r["at"] <= k) for k in at]
            le = [n_lt + sum(r["count"] for r in rows if r["c"] == i and r["at"] == k + 1 and r["there"])
                  for n_lt, k in zip(lt, at)]
            gaps: dict[tuple, list[int]] = {}
            for r in ranks:
                for k, e in enumerate(es):
                    if lt[k] <= r < le[k]:
                        found[i][r] = e
                        break
                    if r < lt[k]:
                        a, a_off = (es[k - 1], le[k - 1]) if k else (lo, off)
                        gaps.setdefault((a, e, a_off, lt[k] - a_off), []).append(r)
                        break
                else:
                    gaps.setdefault((es[-1], hi, le[-1], off + size - le[-1]), []).append(r)
            pending.extend((i, a, b, o, sz, rs) for (a, b, o, sz), rs in gaps.items())
    out: dict[str, list[float | None]] = {}
    for i, name in enumerate(cols):
        if not n[i]:
            out[name] = [None for _ in probs]
            continue
        res = []
        for p in probs:
            pos = p * (n[i] - 1)
            lo_r, hi_r = math.floor(pos), math.ceil(pos)
            # equal ranks need no interpolation, which infinities would make NaN
            res.append(found[i][lo_r] if lo_r == hi_r else
                       found[i][lo_r] + (found[i][hi_r] - found[i][lo_r]) * (pos - lo_r))
        out[name] = res
    return out


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    fetch_limit: int = 200_000, grid: int = 256,
                    accuracy: int = 100_000) -> list[float | None]:
    """Exact quantiles of one column (see ``exact_quantiles_multi``)."""
    return exact_quantiles_multi(df, [column], probs, fetch_limit, grid, accuracy)[column]


def _double_literal(x: float | None) -> str:
    return "CAST(NULL AS DOUBLE)" if x is None else f"CAST('{x!r}' AS DOUBLE)"


def describe_exact(df: DataFrame, columns: Sequence[str] | None = None,
                   fetch_limit: int = 200_000, accuracy: int | None = None) -> DataFrame:
    """Q5: count, mean, sample std, min, 25/50/75 %, max per numeric column, exact,
    one row per column. Moments for all columns come from one aggregate, the
    quartiles from ``exact_quantiles_multi`` (shared passes for all columns).

    ``accuracy`` (opt-in) switches the quartiles to ``percentile_approx`` with that
    accuracy, computed in the same single aggregate as the moments."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    cols = list(columns)
    if accuracy is not None:
        return _describe_approx(df, cols, accuracy)
    quart = exact_quantiles_multi(df, cols, [0.25, 0.5, 0.75], fetch_limit=fetch_limit)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(_q(c)).cast("double")
        clean = F.when(v.isNotNull() & ~F.isnan(v), v)
        aggs += [F.count(clean).alias(f"c{i}"), F.avg(clean).alias(f"m{i}"),
                 F.stddev_samp(clean).alias(f"s{i}"), F.min(clean).alias(f"lo{i}"),
                 F.max(clean).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    parts = []
    for i, c in enumerate(cols):
        q25, q50, q75 = quart[c]
        parts.append(f"'{c}', c{i}, m{i}, s{i}, lo{i}, {_double_literal(q25)}, {_double_literal(q50)}, "
                     f"{_double_literal(q75)}, hi{i}")
    return wide.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) as "
                           "(column_name, count, mean, std, min, p25, p50, p75, max)")


def _describe_approx(df: DataFrame, cols: Sequence[str], accuracy: int) -> DataFrame:
    """One-pass describe with approximate quartiles (sketch error ~ 1/accuracy)."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(_q(c)).cast("double")
        clean = F.when(v.isNotNull() & ~F.isnan(v), v)
        aggs += [F.count(clean).alias(f"c{i}"), F.avg(clean).alias(f"m{i}"),
                 F.stddev_samp(clean).alias(f"s{i}"), F.min(clean).alias(f"lo{i}"),
                 F.max(clean).alias(f"hi{i}"),
                 F.percentile_approx(clean, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}")]
    wide = df.agg(*aggs)
    parts = [f"'{c}', c{i}, m{i}, s{i}, lo{i}, q{i}[0], q{i}[1], q{i}[2], hi{i}" for i, c in enumerate(cols)]
    return wide.selectExpr(f"stack({len(cols)}, {', '.join(parts)}) as "
                           "(column_name, count, mean, std, min, p25, p50, p75, max)")


# --- Q6: preview ----------------------------------------------------------------------


def preview(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """Q6: deterministic head(n): explicit order, so Spark plans a TakeOrderedAndProject."""
    return df.orderBy(*[F.col(_q(c)) for c in order_by]).limit(n)


# --- Q7: relational constraints -------------------------------------------------------


def constraint_violations(df: DataFrame, *, primary_key: Sequence[str] = (),
                          not_null: Sequence[str] = (),
                          max_length: Mapping[str, int] | None = None,
                          foreign_keys: Sequence[tuple[str, DataFrame, str]] = ()) -> DataFrame:
    """Q7: (check, column_name, violations) for PK uniqueness, NOT NULL, VARCHAR(n)
    and FK existence. A null FK passes, as in SQL.

    NOT NULL and length checks share one pass; PK is a grouped count (partial
    aggregation before the shuffle); each FK is a left-anti join, which Spark
    broadcasts only when the referenced side is provably small.
    """
    max_length = dict(max_length or {})
    parts = []
    simple = ([("not_null", c, F.count_if(F.col(_q(c)).isNull())) for c in not_null]
              + [("max_length", c, F.count_if(F.length(F.col(_q(c))) > F.lit(n)))
                 for c, n in max_length.items()])
    if simple:
        wide = df.agg(*[e.alias(f"v{i}") for i, (_, _, e) in enumerate(simple)])
        stack = ", ".join(f"'{k}', '{c}', v{i}" for i, (k, c, _) in enumerate(simple))
        parts.append(wide.selectExpr(f"stack({len(simple)}, {stack}) as (check, column_name, violations)"))
    if primary_key:
        pk = [F.col(_q(c)) for c in primary_key]
        dup = (df.groupBy(*pk).count().filter(F.col("count") > 1)
               .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("violations")))
        parts.append(dup.select(F.lit("primary_key").alias("check"),
                                F.lit(",".join(primary_key)).alias("column_name"), "violations"))
    for col, ref, ref_col in foreign_keys:
        keys = ref.select(F.col(_q(ref_col)).alias("__ref")).distinct()
        orphans = (df.select(F.col(_q(col)).alias("__fk")).filter(F.col("__fk").isNotNull())
                   .join(keys, F.col("__fk") == F.col("__ref"), "left_anti"))
        parts.append(orphans.agg(F.count(F.lit(1)).alias("violations"))
                     .select(F.lit("foreign_key").alias("check"), F.lit(col).alias("column_name"),
                             "violations"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Raise if any listed column holds a null (C1's failure mode)."""
    bad = constraint_violations(df, not_null=columns).filter(F.col("violations") > 0).collect()
    if bad:
        raise ValueError(f"null values in {[r['column_name'] for r in bad]}")
    return df


