"""Driver query catalog: every operator of the inventory run over the driver
tables, each paired with an independent DuckDB SQL text computing the same
result (the correctness oracle).

Conventions: computed columns carry the same alias on both sides; doubles that
come out of sums/averages are rounded to 6 places on both sides (partial sums
differ with partitioning); nulls are injected with ``nullif`` where a rule is
about nulls and the tables have none; ties are broken by key columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import scalars as S
from quarry.operators import aggregates as A
from quarry.operators import filters as FL
from quarry.operators import joins as J
from quarry.operators import projections as P
from quarry.operators import quality as Q
from quarry.operators import stats as M
from quarry.operators import upsert as U
from quarry.operators import windows as W
from quarry.operators.documents import judged, read_documents, rule_counts, rule_names
from quarry.plans import bike
from quarry.plans.views import STATION_STATUS_SQL, station_status, table
from quarry.sources import links as L
from quarry.sources import preamble as PR

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def r6(c):
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


AS_OF = "2024-01-31"

# --- BIKE: weekly utilisation, dedup, upsert -------------------------------------------

_STATUS = f"WITH status AS ({STATION_STATUS_SQL})"


@query("weekly_utilization", _STATUS + f"""
SELECT station_id, network_id, CAST(date_trunc('week', "timestamp") AS DATE) AS week_start,
       count(*) FILTER (WHERE empty_slots = 0) / count(*) > 0.8 AS is_frequently_full,
       count(*) FILTER (WHERE free_bikes = 0) / count(*) > 0.8 AS is_frequently_empty,
       round(avg(free_bikes), 6) AS avg_free_bikes,
       round(avg(empty_slots), 6) AS avg_empty_slots
FROM status
WHERE "timestamp" >= CAST(DATE '{AS_OF}' - INTERVAL 7 DAY AS TIMESTAMP)
GROUP BY 1, 2, 3
""")
def q_weekly_utilization(spark, sf):
    # F7 on the raw event time (hour truncation keeps a midnight bound exact), so
    # the bound is pushed into the Parquet scan.
    recent = FL.rolling_days(table(spark, sf, "events"), "ts", 7, AS_OF)
    gold = bike.gold_weekly(station_status(recent), days=None)
    return gold.withColumns({"avg_free_bikes": r6("avg_free_bikes"),
                             "avg_empty_slots": r6("avg_empty_slots")})


@query("gold_weekly_all", _STATUS + """
SELECT station_id, network_id, CAST(date_trunc('week', "timestamp") AS DATE) AS week_start,
       count(*) FILTER (WHERE empty_slots = 0) / count(*) > 0.8 AS is_frequently_full,
       count(*) FILTER (WHERE free_bikes = 0) / count(*) > 0.8 AS is_frequently_empty,
       round(avg(free_bikes), 6) AS avg_free_bikes,
       round(avg(empty_slots), 6) AS avg_empty_slots
FROM status GROUP BY 1, 2, 3
""")
def q_gold_weekly_all(spark, sf):
    gold = bike.gold_weekly(station_status(table(spark, sf, "events")), days=None)
    return gold.withColumns({"avg_free_bikes": r6("avg_free_bikes"),
                             "avg_empty_slots": r6("avg_empty_slots")})


@query("dedup_latest", _STATUS + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp"
                               ORDER BY snapshot_time DESC, extra_uid DESC) AS rn
  FROM status) WHERE rn = 1
""")
def q_dedup_latest(spark, sf):
    return W.dedup_latest(station_status(table(spark, sf, "events")), ["station_id", "timestamp"],
                          ["snapshot_time"], ["extra_uid"])


_MASTER_COLS = ", ".join(f'"{c}"' for c in bike.MASTER_COLUMNS)
_MERGE_SELECT = ",\n  ".join(
    (f'CASE WHEN s.present THEN s."{c}" ELSE t."{c}" END AS "{c}"' if c in bike.UPDATED_COLUMNS
     else f'CASE WHEN t.present THEN t."{c}" ELSE s."{c}" END AS "{c}"')
    for c in bike.MASTER_COLUMNS)


@query("upsert_merge", _STATUS + f""",
tgt AS (SELECT {_MASTER_COLS}, true AS present FROM status
        WHERE event_type IN ('view', 'click', 'signup')),
src AS (SELECT {_MASTER_COLS}, true AS present FROM (
          SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp"
                                       ORDER BY snapshot_time DESC, extra_uid DESC) AS rn
          FROM status WHERE event_type IN ('error', 'purchase')) WHERE rn = 1)
SELECT {_MERGE_SELECT}
FROM tgt t FULL OUTER JOIN src s
  ON t.station_id = s.station_id AND t."timestamp" = s."timestamp"
""")
def q_upsert_merge(spark, sf):
    status = station_status(table(spark, sf, "events"))
    master = status.filter(F.col("event_type").isin("view", "click", "signup")).select(*bike.MASTER_COLUMNS)
    batch = status.filter(F.col("event_type").isin("error", "purchase")).drop("event_type")
    return U.merge_upsert(master, batch, bike.MERGE_KEYS, bike.UPDATED_COLUMNS,
                          order_desc=["snapshot_time"], tiebreak=["extra_uid"],
                          drop_from_source=["snapshot_time"])


_BATCHES = ("event_type <> 'error'", "event_type = 'error' AND network_id = 'net-3'",
            "event_type = 'error' AND network_id <> 'net-3'")


def _batches_sql(batches, last: str) -> str:
    """The master after all batches: a key's row comes from its first batch, the six mutable columns
    from the batch that is ``last``; rows with a null station are inserted once a batch."""
    parts = " UNION ALL ".join(f"""SELECT *, {i} AS b FROM (
          SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY snapshot_time DESC, extra_uid DESC) AS rn
          FROM status WHERE {when}) WHERE rn = 1""" for i, when in enumerate(batches))
    cols = ", ".join(f'CASE WHEN f.station_id IS NULL THEN f."{c}" ELSE l."{c}" END AS "{c}"' if c in bike.UPDATED_COLUMNS
                     else f'f."{c}" AS "{c}"' for c in bike.MASTER_COLUMNS)
    return f"""
d AS ({parts}),
r AS (SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY b) AS up,
             row_number() OVER (PARTITION BY station_id, "timestamp" ORDER BY {last}) AS down FROM d),
m AS (SELECT {cols}, CASE WHEN f.station_id IS NULL THEN f.snapshot_time ELSE l.snapshot_time END AS snapshot_time
      FROM r f LEFT JOIN r l ON l.station_id = f.station_id AND l."timestamp" = f."timestamp" AND l.down = 1
      WHERE f.up = 1 OR f.station_id IS NULL)
"""


@query("upsert_files", _STATUS + "," + _batches_sql(_BATCHES, "b DESC") + f"""
SELECT {_MASTER_COLS}, CAST("timestamp" AS DATE) AS ts_date, true AS kept_files FROM m
""")
def q_upsert_files(spark, sf):
    """K11 by file: a load clustered by network, then two batches into its partitions, of which the
    first touches one network's files only."""
    from quarry.sinks.tables import create_table_if_missing

    status = station_status(table(spark, sf, "events"))
    status = status.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    name, base = f"upsert_master_{uuid.uuid4().hex[:12]}", _scratch(spark, "upsert_files")
    ddl = ", ".join(f"{n} {t}" for n, t in bike.MASTER_FIELDS) + ", ts_date date"
    create_table_if_missing(spark, name, ddl, partition_by=("ts_date",), location=base)
    how = dict(order_desc=["snapshot_time"], tiebreak=["extra_uid"])
    first = W.dedup_latest(status.filter(_BATCHES[0]), list(bike.MERGE_KEYS), **how)
    (first.withColumn("ts_date", F.to_date("timestamp")).repartition(16, "network_id")
     .select(*bike.MASTER_COLUMNS, "ts_date").write.insertInto(name))
    reports = [U.upsert_into_table(spark, name, status.filter(b).drop("event_type"), bike.MERGE_KEYS, bike.UPDATED_COLUMNS,
                                   "ts_date", F.to_date("timestamp"), drop_from_source=["snapshot_time"],
                                   cluster_by=["station_id"], **how) for b in _BATCHES[1:]]
    return spark.table(name).withColumns({"timestamp": F.col("timestamp").cast("timestamp_ntz"),
                                          "kept_files": F.lit(reports[0]["files_kept"] > 0)})


@query("gold_from_states", _STATUS + "," + _batches_sql(_BATCHES, "b DESC") + """
SELECT station_id, network_id, CAST(date_trunc('week', "timestamp") AS DATE) AS week_start,
       count(*) FILTER (WHERE empty_slots = 0) / count(*) > 0.8 AS is_frequently_full,
       count(*) FILTER (WHERE free_bikes = 0) / count(*) > 0.8 AS is_frequently_empty,
       round(avg(free_bikes), 6) AS avg_free_bikes, round(avg(empty_slots), 6) AS avg_empty_slots
FROM m GROUP BY 1, 2, 3
""")
def q_gold_from_states(spark, sf):
    """A5 kept up to date over three batches: after each, the daily states of its days alone are
    computed anew; the gold rows are those of a full recomputation."""
    from quarry.sinks.tables import create_table_if_missing

    status = station_status(table(spark, sf, "events"))
    status = status.withColumn("timestamp", F.col("timestamp").cast("timestamp")).drop("event_type")
    kinds = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("extra_uid"), "event_type")
    status = status.join(kinds, "extra_uid")
    tag, base = uuid.uuid4().hex[:12], _scratch(spark, "gold_from_states")
    ddl = ", ".join(f"{n} {t}" for n, t in bike.MASTER_FIELDS) + ", ts_date date"
    create_table_if_missing(spark, f"gold_master_{tag}", ddl, partition_by=("ts_date",), location=f"{base}/master")
    for when in _BATCHES:
        batch = status.filter(when).drop("event_type")
        U.upsert_into_table(spark, f"gold_master_{tag}", batch, bike.MERGE_KEYS, bike.UPDATED_COLUMNS, "ts_date",
                            F.to_date("timestamp"), order_desc=["snapshot_time"], tiebreak=["extra_uid"],
                            drop_from_source=["snapshot_time"], cluster_by=["station_id"])
        bike.refresh_states(spark, f"gold_master_{tag}", f"gold_states_{tag}", batch.select(F.to_date("timestamp")),
                            location=f"{base}/states")
    gold = A.utilization_of(spark.table(f"gold_states_{tag}"))
    return gold.withColumns({"avg_free_bikes": r6("avg_free_bikes"), "avg_empty_slots": r6("avg_empty_slots")})


@query("insert_ignore", """
SELECT DISTINCT o_custkey, 'customer ' || CAST(o_custkey AS VARCHAR) AS label
FROM orders n
WHERE o_orderstatus = 'O'
  AND NOT EXISTS (SELECT 1 FROM orders e WHERE e.o_orderstatus = 'F' AND e.o_custkey = n.o_custkey)
""")
def q_insert_ignore(spark, sf):
    orders = table(spark, sf, "orders")
    existing = orders.filter(F.col("o_orderstatus") == "F").select("o_custkey")
    new = orders.filter(F.col("o_orderstatus") == "O").select(
        "o_custkey", F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("label"))
    return U.insert_ignore(existing, new, ["o_custkey"])


# --- BOOK: outer merge of three indexes -------------------------------------------------

def _order_index(orders: DataFrame, lo: str | None, hi: str | None) -> DataFrame:
    d = orders
    if lo:
        d = d.filter(F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
    if hi:
        d = d.filter(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
    return d.select(F.col("o_custkey").alias("k1"),
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("k2"),
                    "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


_IDX = """
d{i} AS (SELECT o_custkey AS k1, nullif(o_orderpriority, '5-LOW') AS k2,
               o_orderkey AS ok{i}, o_orderstatus AS os{i}, o_totalprice AS tp{i}, o_orderdate AS od{i}
        FROM orders WHERE {cond})"""


@query("three_way_index_merge", "WITH " + ",".join([
    _IDX.format(i=1, cond="o_orderdate < TIMESTAMP '1997-01-01'"),
    _IDX.format(i=2, cond="o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'"),
    _IDX.format(i=3, cond="o_orderdate >= TIMESTAMP '1999-01-01'"),
]) + """,
m1 AS (SELECT coalesce(d1.k1, d2.k1) AS k1, coalesce(d1.k2, d2.k2) AS k2,
              ok1, os1, tp1, od1, ok2, os2, tp2, od2
       FROM d1 FULL OUTER JOIN d2 ON d1.k1 IS NOT DISTINCT FROM d2.k1 AND d1.k2 IS NOT DISTINCT FROM d2.k2)
SELECT coalesce(m1.k1, d3.k1) AS k1, coalesce(m1.k2, d3.k2) AS k2,
       coalesce(ok1, ok2, ok3) AS o_orderkey, coalesce(os1, os2, os3) AS o_orderstatus,
       coalesce(tp1, tp2, tp3) AS o_totalprice, coalesce(od1, od2, od3) AS o_orderdate
FROM m1 FULL OUTER JOIN d3 ON m1.k1 IS NOT DISTINCT FROM d3.k1 AND m1.k2 IS NOT DISTINCT FROM d3.k2
""")
def q_three_way_index_merge(spark, sf):
    orders = table(spark, sf, "orders")
    frames = [_order_index(orders, None, "1997-01-01"),
              _order_index(orders, "1997-01-01", "1999-01-01"),
              _order_index(orders, "1999-01-01", None)]
    return J.merge_indexes(frames, ["k1", "k2"])


@query("index_merge_salted", ORACLE["three_way_index_merge"])
def q_index_merge_salted(spark, sf):
    """The three-way merge with a low skew threshold, so every key with 3+ left rows
    takes the salted path; must equal the plain merge (same oracle)."""
    orders = table(spark, sf, "orders")
    frames = [_order_index(orders, None, "1997-01-01"),
              _order_index(orders, "1997-01-01", "1999-01-01"),
              _order_index(orders, "1999-01-01", None)]
    return J.merge_indexes(frames, ["k1", "k2"], skew_rows=3)


@query("merge_multiplicity", "WITH " + ",".join([
    "c{i} AS (SELECT o_custkey AS k1, nullif(o_orderpriority, '5-LOW') AS k2, count(*) AS n{i} "
    "FROM orders WHERE {cond} GROUP BY 1, 2)".format(i=i, cond=c) for i, c in [
        (0, "o_orderdate < TIMESTAMP '1997-01-01'"),
        (1, "o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'"),
        (2, "o_orderdate >= TIMESTAMP '1999-01-01'")]]) + """
SELECT coalesce(a.k1, c2.k1) AS k1, coalesce(a.k2, c2.k2) AS k2, n0, n1, n2,
       CAST(coalesce(n0, 1) * coalesce(n1, 1) * coalesce(n2, 1) AS BIGINT) AS merged_rows
FROM (SELECT coalesce(c0.k1, c1.k1) AS k1, coalesce(c0.k2, c1.k2) AS k2, n0, n1
      FROM c0 FULL OUTER JOIN c1 ON c0.k1 IS NOT DISTINCT FROM c1.k1 AND c0.k2 IS NOT DISTINCT FROM c1.k2) a
FULL OUTER JOIN c2 ON a.k1 IS NOT DISTINCT FROM c2.k1 AND a.k2 IS NOT DISTINCT FROM c2.k2
""")
def q_merge_multiplicity(spark, sf):
    orders = table(spark, sf, "orders")
    frames = [_order_index(orders, None, "1997-01-01").select("k1", "k2"),
              _order_index(orders, "1997-01-01", "1999-01-01").select("k1", "k2"),
              _order_index(orders, "1999-01-01", None).select("k1", "k2")]
    return J.key_multiplicity(frames, ["k1", "k2"])


# --- nested / semi-structured ------------------------------------------------------------

@query("json_flatten", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.missing.deeper') AS missing_field
FROM events
""")
def q_json_flatten(spark, sf):
    ev = table(spark, sf, "events")
    parsed = ev.select("event_id", F.from_json("props", "k string, missing struct<deeper: string>").alias("p"))
    return parsed.select("event_id", S.coerce_numeric(F.col("p.k"), "bigint").alias("k"),
                         S.field_or_null("p.missing.deeper").alias("missing_field"))


@query("array_explode", """
SELECT vec_id, label, pos, value FROM (
  SELECT vec_id, label, unnest(range(len(embedding))) AS pos, unnest(embedding) AS value FROM embeddings)
""")
def q_array_explode(spark, sf):
    emb = table(spark, sf, "embeddings")
    return emb.select("vec_id", "label", F.posexplode("embedding").alias("pos", "value")) \
        .withColumn("pos", F.col("pos").cast("long"))


@query("explode_children", """
SELECT vec_id, label, unnest(embedding) AS value FROM embeddings
""")
def q_explode_children(spark, sf):
    return S.explode_children(table(spark, sf, "embeddings"), "embedding", "value", ["vec_id", "label"])


# --- quality -----------------------------------------------------------------------------

def _customer_rules():
    return [
        ("c_name.pattern", ~F.col("c_name").rlike(r"^Customer#[0-9]{9}$")),
        ("c_acctbal.min", F.col("c_acctbal") < 0),
        ("c_acctbal.max", F.col("c_acctbal") > 9000),
        ("c_nationkey.range", ~F.col("c_nationkey").between(0, 19)),
        ("c_mktsegment.enum", ~F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY")),
    ]


@query("schema_violations", """
SELECT 'c_name.pattern' AS rule, count(*) FILTER (WHERE NOT regexp_full_match(c_name, '^Customer#[0-9]{9}$')) AS violations FROM customer
UNION ALL SELECT 'c_acctbal.min', count(*) FILTER (WHERE c_acctbal < 0) FROM customer
UNION ALL SELECT 'c_acctbal.max', count(*) FILTER (WHERE c_acctbal > 9000) FROM customer
UNION ALL SELECT 'c_nationkey.range', count(*) FILTER (WHERE NOT (c_nationkey BETWEEN 0 AND 19)) FROM customer
UNION ALL SELECT 'c_mktsegment.enum', count(*) FILTER (WHERE c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')) FROM customer
""")
def q_schema_violations(spark, sf):
    return Q.violation_counts(table(spark, sf, "customer"), _customer_rules())


@query("quarantine_split", """
SELECT * FROM (
SELECT c_custkey,
       list_filter([
         CASE WHEN NOT regexp_full_match(c_name, '^Customer#[0-9]{9}$') THEN 'c_name.pattern' END,
         CASE WHEN c_acctbal < 0 THEN 'c_acctbal.min' END,
         CASE WHEN c_acctbal > 9000 THEN 'c_acctbal.max' END,
         CASE WHEN NOT (c_nationkey BETWEEN 0 AND 19) THEN 'c_nationkey.range' END,
         CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') THEN 'c_mktsegment.enum' END
       ], lambda x: x IS NOT NULL)[1] AS first_violation,
       len(list_filter([
         CASE WHEN NOT regexp_full_match(c_name, '^Customer#[0-9]{9}$') THEN 1 END,
         CASE WHEN c_acctbal < 0 THEN 1 END,
         CASE WHEN c_acctbal > 9000 THEN 1 END,
         CASE WHEN NOT (c_nationkey BETWEEN 0 AND 19) THEN 1 END,
         CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY') THEN 1 END
       ], lambda x: x IS NOT NULL)) AS n_violations
FROM customer) WHERE n_violations > 0
""")
def q_quarantine_split(spark, sf):
    _, rejected = Q.split_valid(table(spark, sf, "customer"), _customer_rules())
    return rejected.select("c_custkey", F.element_at("violations", 1).alias("first_violation"),
                           F.size("violations").cast("bigint").alias("n_violations"))


def _orders_with_nulls(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", "o_custkey",
                    F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
                    "o_totalprice", "o_orderdate",
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"))


_ORDERS_NULLS = """WITH o AS (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
  o_totalprice, o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders)"""


@query("null_profile", _ORDERS_NULLS + """
SELECT 'o_orderkey' AS column_name, count(*) - count(o_orderkey) AS nulls FROM o
UNION ALL SELECT 'o_custkey', count(*) - count(o_custkey) FROM o
UNION ALL SELECT 'o_orderstatus', count(*) - count(o_orderstatus) FROM o
UNION ALL SELECT 'o_totalprice', count(*) - count(o_totalprice) FROM o
UNION ALL SELECT 'o_orderdate', count(*) - count(o_orderdate) FROM o
UNION ALL SELECT 'o_orderpriority', count(*) - count(o_orderpriority) FROM o
""")
def q_null_profile(spark, sf):
    return Q.null_profile(_orders_with_nulls(spark, sf))


@query("table_shape", _ORDERS_NULLS + """
SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM o
""")
def q_table_shape(spark, sf):
    return Q.table_shape(_orders_with_nulls(spark, sf))


@query("column_info", _ORDERS_NULLS + """
SELECT CAST(0 AS BIGINT) AS position, 'o_orderkey' AS column_name, 'bigint' AS dtype, count(o_orderkey) AS non_null FROM o
UNION ALL SELECT 1, 'o_custkey', 'bigint', count(o_custkey) FROM o
UNION ALL SELECT 2, 'o_orderstatus', 'string', count(o_orderstatus) FROM o
UNION ALL SELECT 3, 'o_totalprice', 'double', count(o_totalprice) FROM o
UNION ALL SELECT 4, 'o_orderdate', 'timestamp_ntz', count(o_orderdate) FROM o
UNION ALL SELECT 5, 'o_orderpriority', 'string', count(o_orderpriority) FROM o
""")
def q_column_info(spark, sf):
    return Q.column_info(_orders_with_nulls(spark, sf))


_DESCRIBE = """
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
       round(quantile_cont({c}, 0.75), 6) AS p75, CAST(max({c}) AS DOUBLE) AS max
FROM part"""


@query("describe_exact", " UNION ALL ".join(_DESCRIBE.format(c=c) for c in ("p_size", "p_retailprice")))
def q_describe_exact(spark, sf):
    d = Q.describe_exact(table(spark, sf, "part"), ["p_size", "p_retailprice"])
    return d.withColumns({c: r6(c) for c in ("mean", "std", "p25", "p50", "p75")})


@query("constraint_checks", _ORDERS_NULLS + """
SELECT 'not_null' AS "check", 'o_orderstatus' AS column_name, count(*) FILTER (WHERE o_orderstatus IS NULL) AS violations FROM o
UNION ALL SELECT 'not_null', 'o_orderpriority', count(*) FILTER (WHERE o_orderpriority IS NULL) FROM o
UNION ALL SELECT 'max_length', 'o_orderpriority', count(*) FILTER (WHERE length(o_orderpriority) > 8) FROM o
UNION ALL SELECT 'primary_key', 'o_orderkey', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
          FROM (SELECT o_orderkey, count(*) AS n FROM o GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'primary_key', 'o_custkey', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
          FROM (SELECT o_custkey, count(*) AS n FROM o GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'foreign_key', 'o_custkey', count(*) FROM o
          WHERE o_custkey IS NOT NULL AND NOT EXISTS (
            SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_mktsegment <> 'AUTOMOBILE')
""")
def q_constraint_checks(spark, sf):
    o = _orders_with_nulls(spark, sf)
    cust = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    checks = Q.constraint_violations(o, primary_key=["o_orderkey"],
                                     not_null=["o_orderstatus", "o_orderpriority"],
                                     max_length={"o_orderpriority": 8},
                                     foreign_keys=[("o_custkey", cust, "c_custkey")])
    dup_cust = Q.constraint_violations(o, primary_key=["o_custkey"])
    return checks.unionByName(dup_cust)


# --- BOOK: preamble CSV, links, text normalisation ---------------------------------------

HEADER_PATTERNS = ("license", "@")


@query("header_discovery", r"""
WITH lines AS (
  SELECT doc_id AS file, unnest(range(len(string_split(text, chr(10))))) AS pos,
         unnest(string_split(text, chr(10))) AS line
  FROM documents),
heads AS (
  SELECT file, coalesce(min(pos) FILTER (WHERE contains(line, 'license')),
                        min(pos) FILTER (WHERE contains(line, '@'))) AS header_pos
  FROM lines GROUP BY file)
SELECT l.file, l.pos, l.line, l.pos = h.header_pos AS is_header
FROM lines l JOIN heads h ON l.file = h.file
WHERE h.header_pos IS NULL OR (l.pos >= h.header_pos AND regexp_matches(l.line, '\S'))
""")
def q_header_discovery(spark, sf):
    lines = PR.lines_from_texts(table(spark, sf, "documents"), "doc_id", "text") \
        .withColumn("pos", F.col("pos").cast("long"))
    return PR.strip_preamble(lines, HEADER_PATTERNS)


def _quoted_csv(docs: DataFrame, path: str, files: int = 4, file_bytes: int = 64 << 20) -> None:
    """Lands documents as CSV files, each with a preamble (holding a stray quote), a header and the
    documents' texts as quoted fields that span lines; at least ``files`` of them, and so many that
    one, which a task writes, has about ``file_bytes`` of text."""
    held = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(files, -(-held // file_bytes))
    text = F.regexp_replace(F.coalesce("text", F.lit("")), r"\r", " ")
    quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
    rows = docs.select(F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("f"), F.col("doc_id").alias("at"), F.lit(3).alias("k"),
                       F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), quoted, F.lit('5" pipe'), "lang").alias("value"))
    head = (docs.sparkSession.range(files).select(F.col("id").alias("f"), F.lit(None).cast("long").alias("at"), F.posexplode(F.array(
        F.lit('Index of "texts, not parsed'), F.lit(""), F.lit("doc_id,body,size,lang"))).alias("k", "value")))
    (head.unionByName(rows).repartition(files, "f").sortWithinPartitions("f", "k", "at")
     .select("f", "value").write.partitionBy("f").text(path))


@query("quoted_records", r"""
WITH d AS (
  SELECT doc_id, lang, string_split(regexp_replace(coalesce(text, ''), '\r', ' ', 'g'), chr(10)) AS ls FROM documents),
k AS (
  SELECT doc_id, lang, [ls[i] FOR i IN range(1, len(ls) + 1)
                        IF i = 1 OR i = len(ls) OR regexp_matches(ls[i], '\S')] AS kept FROM d)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, len(kept) AS n_lines, md5(array_to_string(kept, chr(10))) AS body_md5,
       '5" pipe' AS size, lang
FROM k
""")
def q_quoted_records(spark, sf):
    """Files of many splits, records across lines and splits, parsed without a task per file."""
    from quarry.sources.records import records

    base = _scratch(spark, "quoted_records")
    _quoted_csv(table(spark, sf, "documents"), base)
    kept = PR.strip_preamble(PR.lines_from_files(spark, base, split_bytes=1 << 18), ["doc_id,body"])
    rows = PR.parse_csv_lines(records(kept))
    body = F.coalesce("body", F.lit(""))
    return rows.select("doc_id", F.size(F.split(body, "\n", -1)).cast("long").alias("n_lines"),
                       F.md5(body).alias("body_md5"), "size", "lang")


# Ways to write a plain anchor, and what becomes of its href; pages take them in turn.
_ANCHOR = '<a href="([^"]*)">'
_SPELLINGS = ['<a href="$1">', "<A HREF='$1'>", "<a href=$1>", '<a\n href = "$1" >', '<!-- <a href="/no">de</a> --><a href="$1">',
              '<a data-href="/no" href="$1"><b>', '<a href="&#x2F;.&#47;$1">', "<a title='>' href=\"it's$1\">",
              '<script>"<a href=\'/no\'>de</a>"</script><a href="$1">']


@query("anchor_link", f"""
WITH p AS (SELECT page_id, url, page_id % {len(_SPELLINGS)} AS k, string_split(html, '<a href="')[2:] AS parts FROM pages),
a AS (SELECT page_id, url, k, [x FOR x IN parts IF starts_with(substr(x, strpos(x, '"') + 1), '>de</a>')] AS hits FROM p)
SELECT page_id, url, CASE k WHEN 6 THEN '/./' WHEN 7 THEN 'it''s' ELSE '' END
                     || substr(hits[1], 1, strpos(hits[1], '"') - 1) AS href
FROM a WHERE len(hits) > 0
""")
def q_anchor_link(spark, sf):
    pages = table(spark, sf, "pages")
    html = F.col("html")
    for k, spelling in enumerate(_SPELLINGS):
        html = F.when(F.col("page_id") % len(_SPELLINGS) == k, F.regexp_replace("html", _ANCHOR, spelling)).otherwise(html)
    return L.download_links(pages.withColumn("html", html), text="de")


@query("url_rewrite", """
SELECT page_id, url,
       CASE WHEN contains(url, 'example.com') AND NOT contains(url, 'ref=')
            THEN split_part(url, '?', 1) || '/export?format=csv' ELSE url END AS export_url
FROM pages
""")
def q_url_rewrite(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", "url", L.export_link("url", host="example.com", exclude="ref=",
                                                        cut="?").alias("export_url"))


@query("slug_year", r"""
SELECT page_id, coalesce(nullif(regexp_extract(html, '\d{4}(?:-\d{4})?', 0), ''), 'unknown') AS year
FROM pages
""")
def q_slug_year(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.year_or_unknown("html").alias("year"))


@query("skip_existing", """
SELECT page_id, url FROM pages p
WHERE NOT EXISTS (SELECT 1 FROM pages q WHERE q.url LIKE 'https%' AND q.url = p.url)
""")
def q_skip_existing(spark, sf):
    pages = table(spark, sf, "pages")
    landed = pages.filter(F.col("url").startswith("https")).select("url")
    return L.not_yet_landed(pages.select("page_id", "url"), landed, "url")


@query("author_reverse", """
WITH a AS (
  SELECT c_custkey,
         CASE WHEN c_nationkey = 24 THEN c_name
              WHEN c_nationkey < 5 THEN c_mktsegment || ', ' || c_name || ', ' || CAST(c_nationkey AS VARCHAR)
              ELSE c_mktsegment || ', ' || c_name END AS author
  FROM customer)
SELECT c_custkey, author,
       CASE WHEN contains(author, ', ') THEN array_to_string(list_reverse(string_split(author, ', ')), ' ')
            ELSE author END AS author_display
FROM a
""")
def q_author_reverse(spark, sf):
    c = table(spark, sf, "customer")
    author = (F.when(F.col("c_nationkey") == 24, F.col("c_name"))
              .when(F.col("c_nationkey") < 5, F.concat_ws(", ", "c_mktsegment", "c_name",
                                                          F.col("c_nationkey").cast("string")))
              .otherwise(F.concat_ws(", ", "c_mktsegment", "c_name")))
    return c.select("c_custkey", author.alias("author")).withColumn(
        "author_display", S.reverse_name("author"))


def _year_text():
    y = F.year("o_orderdate")
    return (F.when(F.col("o_orderstatus") == "F",
                   F.concat((y - 1).cast("string"), F.lit("-"), y.cast("string")))
            .when(F.col("o_orderstatus") == "O", F.concat(y.cast("string"), F.lit(".0")))
            .otherwise(y.cast("string")))


_YEAR_TEXT_SQL = """CASE WHEN o_orderstatus = 'F' THEN CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR)
            WHEN o_orderstatus = 'O' THEN CAST(year(o_orderdate) AS VARCHAR) || '.0'
            ELSE CAST(year(o_orderdate) AS VARCHAR) END"""


@query("year_token", r"""
WITH d AS (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN '   '
              ELSE o_orderpriority || ' ' || CAST(year(o_orderdate) AS VARCHAR)
                   || CASE WHEN o_orderstatus = 'F' THEN '  ' ELSE '' END END AS date_text
  FROM orders)
SELECT o_orderkey, date_text, nullif(regexp_extract(date_text, '(\S+)\s*$', 1), '') AS year
FROM d
""")
def q_year_token(spark, sf):
    o = table(spark, sf, "orders")
    text = (F.when(F.col("o_orderstatus") == "P", F.lit("   "))
            .otherwise(F.concat(F.col("o_orderpriority"), F.lit(" "), F.year("o_orderdate").cast("string"),
                                F.when(F.col("o_orderstatus") == "F", F.lit("  ")).otherwise(F.lit("")))))
    return o.select("o_orderkey", text.alias("date_text")).withColumn("year", S.last_token("date_text"))


@query("year_normalize", f"""
WITH d AS (SELECT o_orderkey, {_YEAR_TEXT_SQL} AS year_text,
                  CASE WHEN o_orderstatus = 'P' THEN CAST('NaN' AS DOUBLE)
                       ELSE CAST(year(o_orderdate) AS DOUBLE) END AS year_float
           FROM orders)
SELECT o_orderkey, year_text,
       CASE WHEN contains(year_text, '-') THEN CAST(TRY_CAST(trim(split_part(year_text, '-', 2)) AS INTEGER) AS VARCHAR)
            WHEN contains(year_text, '.0') THEN replace(year_text, '.0', '')
            ELSE year_text END AS year,
       CASE WHEN isnan(year_float) THEN NULL ELSE CAST(CAST(year_float AS BIGINT) AS VARCHAR) END AS year_from_float
FROM d
""")
def q_year_normalize(spark, sf):
    o = table(spark, sf, "orders")
    yf = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(
        F.year("o_orderdate").cast("double"))
    return o.select("o_orderkey", _year_text().alias("year_text"), yf.alias("yf")).select(
        "o_orderkey", "year_text", S.normalize_year("year_text").alias("year"),
        S.nan_to_null_text("yf").alias("year_from_float"))


@query("status_normalize", """
WITH d AS (SELECT o_orderkey, trim(lower(coalesce(nullif(o_orderpriority, '3-MEDIUM'), ''))) AS s FROM orders)
SELECT o_orderkey, CASE WHEN contains(s, 'urgent') OR contains(s, 'high') THEN 'expedited' ELSE s END AS status
FROM d
""")
def q_status_normalize(spark, sf):
    o = table(spark, sf, "orders")
    s = S.norm_lower_trim(F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")))
    return o.select("o_orderkey", S.contains_any_label(s, ["urgent", "high"], "expedited").alias("status"))


@query("value_replace", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Economy' WHEN 'PROMO' THEN 'Promotion'
                              WHEN 'SMALL' THEN 'Small' ELSE p_type END AS p_type
FROM part
""")
def q_value_replace(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.replace_values(
        "p_type", {"ECONOMY": "Economy", "PROMO": "Promotion", "SMALL": "Small"}).alias("p_type"))


@query("unknown_fill", """
SELECT p_partkey, trim(coalesce(nullif(p_brand, 'Brand#1'), 'Unknown')) AS brand FROM part
""")
def q_unknown_fill(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", S.unknown_fill(F.nullif(F.col("p_brand"), F.lit("Brand#1"))).alias("brand"))


@query("map_fallback", """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN 'MACH' WHEN 'BUILDING' THEN 'BLDG'
                                   WHEN 'HOUSEHOLD' THEN 'HH' ELSE c_mktsegment END AS segment_code
FROM customer
""")
def q_map_fallback(spark, sf):
    c = table(spark, sf, "customer")
    return c.select("c_custkey", J.lookup_or_keep(
        "c_mktsegment", {"MACHINERY": "MACH", "BUILDING": "BLDG", "HOUSEHOLD": "HH"}).alias("segment_code"))


@query("map_default", """
SELECT DISTINCT lower(p_type) AS status,
       CASE lower(p_type) WHEN 'economy' THEN 'Low-cost parts' WHEN 'promo' THEN 'Promotional parts'
            ELSE 'Description for ' || lower(p_type) END AS description
FROM part
""")
def q_map_default(spark, sf):
    statuses = A.distinct_values(table(spark, sf, "part").select(F.lower("p_type").alias("status")), "status")
    return statuses.withColumn("description", J.lookup_or_template(
        "status", {"economy": "Low-cost parts", "promo": "Promotional parts"}, "Description for "))


# --- projections and filters -------------------------------------------------------------

@query("schema_project", """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_phone, c_acctbal, CAST(NULL AS VARCHAR) AS c_comment,
       'USA' AS country
FROM customer
""")
def q_schema_project(spark, sf):
    c = P.select_except(table(spark, sf, "customer"), "c_nationkey")
    fixed = P.project_to(c, [("c_custkey", "bigint"), ("c_name", "string"), ("c_phone", "string"),
                             ("c_acctbal", "double"), ("c_comment", "string")])
    present = P.select_present(fixed, ["c_custkey", "c_name", "c_phone", "c_acctbal", "c_comment", "c_address"])
    return P.with_constant(present, "country", "USA")


@query("rename_harmonize", """
SELECT s_suppkey AS supplier_id, s_name AS name, s_nationkey, s_acctbal FROM supplier
""")
def q_rename_harmonize(spark, sf):
    return P.rename_columns(table(spark, sf, "supplier"),
                            {"s_suppkey": "supplier_id", "s_name": "name", "Type of Ban": "Ban Status"})


@query("line_total", """
SELECT l_orderkey, l_linenumber, product, quantity, price, quantity * price AS total FROM (
  SELECT l_orderkey, l_linenumber, nullif(l_returnflag, 'N') AS product,
         nullif(l_quantity, 1.0) AS quantity, l_extendedprice AS price FROM lineitem)
WHERE product IS NOT NULL AND quantity IS NOT NULL
""")
def q_line_total(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_returnflag"), F.lit("N")).alias("product"),
        F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("quantity"), F.col("l_extendedprice").alias("price"))
    return P.with_derived(FL.drop_any_null(li), {"total": F.col("quantity") * F.col("price")})


@query("exclude_list_nullsafe", """
SELECT c_custkey, country, code FROM (
  SELECT c_custkey, nullif(c_mktsegment, 'MACHINERY') AS country, nullif(c_nationkey, 0) AS code FROM customer)
WHERE NOT coalesce(country IN ('AUTOMOBILE', 'BUILDING'), false) AND code IS NOT NULL
""")
def q_exclude_list_nullsafe(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("country"),
        F.nullif(F.col("c_nationkey"), F.lit(0)).alias("code"))
    return FL.not_null(FL.exclude_values(c, "country", ["AUTOMOBILE", "BUILDING"]), "code")


@query("include_list", """
SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
""")
def q_include_list(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return FL.include_values(o, "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query("range_filter", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1997-12-31'
""")
def q_range_filter(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return FL.in_range(o, "o_orderdate", F.lit("1996-01-01").cast("timestamp_ntz"),
                       F.lit("1997-12-31").cast("timestamp_ntz"))


@query("any_cell_contains", """
SELECT * FROM part WHERE NOT (
  coalesce(contains(lower(CAST(p_partkey AS VARCHAR)), 'red'), false)
  OR coalesce(contains(lower(p_name), 'red'), false)
  OR coalesce(contains(lower(p_brand), 'red'), false)
  OR coalesce(contains(lower(p_type), 'red'), false)
  OR coalesce(contains(lower(CAST(p_size AS VARCHAR)), 'red'), false)
  OR coalesce(contains(lower(CAST(p_retailprice AS VARCHAR)), 'red'), false))
""")
def q_any_cell_contains(spark, sf):
    return FL.drop_rows_containing(table(spark, sf, "part"), "RED")


@query("drop_all_null", """
SELECT c_custkey, title, author FROM (
  SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS title,
         CAST(nullif(c_nationkey, 3) AS VARCHAR) AS author FROM customer)
WHERE title IS NOT NULL OR author IS NOT NULL
""")
def q_drop_all_null(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("title"),
        F.nullif(F.col("c_nationkey"), F.lit(3)).cast("string").alias("author"))
    return FL.drop_all_null(c, ["title", "author"])


@query("latest_snapshot", """
SELECT *, CAST(ts AS DATE) AS snap_date FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def q_latest_snapshot(spark, sf):
    from quarry.sources.files import latest_rows

    ev = table(spark, sf, "events").withColumn("snap_date", F.to_date("ts"))
    return latest_rows(ev, "snap_date")


@query("select_preview", """
SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10
""")
def q_select_preview(spark, sf):
    p = P.select_columns(table(spark, sf, "part"), ["p_partkey", "p_name", "p_retailprice"])
    return W.sort_desc(p, "p_retailprice", ["p_partkey"]).limit(10)


@query("preview_head", """
SELECT * FROM part ORDER BY p_brand, p_partkey LIMIT 5
""")
def q_preview_head(spark, sf):
    return Q.preview(table(spark, sf, "part"), 5, ["p_brand", "p_partkey"])


@query("rank_all_lines", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS "Rank"
FROM lineitem
""")
def q_rank_all_lines(spark, sf):
    """W2 over a whole frame: ranges of the order, numbered range by range."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), *[F.col(c).asc() for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]]
    return W.rank_frame(lines, order).drop("l_partkey", "l_suppkey")


_SETS = {"whole": [], "by_status": ["o_orderstatus"], "by_status_priority": ["o_orderstatus", "o_orderpriority"],
         "by_priority": ["o_orderpriority"], "by_year": ["year"], "by_year_status": ["year", "o_orderstatus"]}


def _sets_sql() -> str:
    keys = ["o_orderstatus", "o_orderpriority", "year"]
    return """WITH o AS (SELECT nullif(o_orderstatus, 'P') AS o_orderstatus, nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
      CAST(year(o_orderdate) AS INTEGER) AS year, nullif(o_custkey % 100, 7) AS cust FROM orders)
""" + "\nUNION ALL ".join(
        f"SELECT '{label}' AS \"set\", " + ", ".join(k if k in own else f"NULL AS {k}" for k in keys)
        + ", count(DISTINCT cust) AS n FROM o" + "".join(f" {'WHERE' if i == 0 else 'AND'} {k} IS NOT NULL" for i, k in enumerate(own))
        + (f" GROUP BY {', '.join(own)}" if own else "") for label, own in _SETS.items())


@query("distinct_sets", _sets_sql())
def q_distinct_sets(spark, sf):
    """Distinct counts of six key sets from one scan and one shuffle of the rows."""
    o = table(spark, sf, "orders").select(
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("o_orderstatus"),
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("o_orderpriority"),
        F.year("o_orderdate").alias("year"), F.nullif(F.col("o_custkey") % 100, F.lit(7)).alias("cust"))
    return A.distinct_count_sets(o, _SETS, "cust", "n").select("set", "o_orderstatus", "o_orderpriority", "year", "n")


# --- aggregates, top-k, pivot, rollup ----------------------------------------------------

@query("avg_by_category", """
SELECT p_type, round(avg(p_retailprice), 6) AS p_retailprice_avg, round(avg(p_size), 6) AS p_size_avg,
       round(avg(p_partkey), 6) AS p_partkey_avg
FROM part WHERE p_type IS NOT NULL GROUP BY p_type
""")
def q_avg_by_category(spark, sf):
    m = A.mean_by(table(spark, sf, "part"), ["p_type"], ["p_retailprice", "p_size", "p_partkey"], suffix="_avg")
    m = m.withColumns({c: r6(c) for c in ("p_retailprice_avg", "p_size_avg", "p_partkey_avg")})
    return W.sort_desc(m, "p_retailprice_avg", ["p_type"])


def _flag_lines(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(F.concat("l_returnflag", "l_linestatus").alias("category"),
                     F.when((F.col("l_returnflag") == "A") & (F.col("l_discount") >= 0.05), F.lit(1))
                     .otherwise(F.lit(0)).alias("flag"))


@query("flagged_count", """
SELECT l_returnflag || l_linestatus AS category, count(*) AS n_flagged
FROM lineitem WHERE l_returnflag = 'A' AND l_discount >= 0.05 GROUP BY 1
""")
def q_flagged_count(spark, sf):
    return A.count_where(_flag_lines(spark, sf), ["category"], FL.is_flagged("flag"), "n_flagged")


@query("flagged_pct", """
SELECT l_returnflag || l_linestatus AS category,
       round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE l_returnflag = 'A' AND l_discount >= 0.05) / count(*), 6) AS pct
FROM lineitem GROUP BY 1
""")
def q_flagged_pct(spark, sf):
    return A.flagged_share(_flag_lines(spark, sf), ["category"], "flag", "pct").withColumn("pct", r6("pct"))


@query("distinct_by_keys", """
SELECT p_brand, p_type, count(DISTINCT p_name) AS n_titles FROM part GROUP BY 1, 2
""")
def q_distinct_by_keys(spark, sf):
    return A.distinct_count_by(table(spark, sf, "part"), ["p_brand", "p_type"], "p_name", "n_titles")


@query("distinct_global", """
SELECT count(DISTINCT p_name) AS n_names, count(DISTINCT p_brand) AS n_brands, count(DISTINCT p_type) AS n_types
FROM part
""")
def q_distinct_global(spark, sf):
    return A.distinct_counts(table(spark, sf, "part"), {"n_names": "p_name", "n_brands": "p_brand",
                                                        "n_types": "p_type"})


@query("distinct_values", """
SELECT DISTINCT nullif(p_type, 'SMALL') AS p_type FROM part WHERE nullif(p_type, 'SMALL') IS NOT NULL
""")
def q_distinct_values(spark, sf):
    p = table(spark, sf, "part").select(F.nullif(F.col("p_type"), F.lit("SMALL")).alias("p_type"))
    return A.distinct_values(p, "p_type")


def _part_counts(spark, sf, flags, keys, name):
    """Counts of lineitems per part attribute set, pre-aggregated per part key before
    the join so the join moves one row per part, not one per line."""
    li = FL.include_values(table(spark, sf, "lineitem"), "l_returnflag", flags)
    per_part = A.count_by(li, ["l_partkey"], "n")
    part = table(spark, sf, "part")
    joined = per_part.join(part, per_part["l_partkey"] == part["p_partkey"])
    return joined.groupBy(*keys).agg(F.sum("n").alias(name))


_TOP = """
WITH c AS (SELECT {keys}, count(*) AS {name} FROM lineitem JOIN part ON l_partkey = p_partkey
           WHERE l_returnflag IN ({flags}) GROUP BY {keys})
SELECT {keys}, {name}, row_number() OVER (ORDER BY {name} DESC, {keys}) AS "rank"
FROM c ORDER BY {name} DESC, {keys} LIMIT {n}
"""


@query("top5_titles", _TOP.format(keys="p_name, p_brand", name="ban_count", flags="'R', 'A'", n=5))
def q_top5_titles(spark, sf):
    c = _part_counts(spark, sf, ["R", "A"], ["p_name", "p_brand"], "ban_count")
    return W.top_n(c, 5, "ban_count", ["p_name", "p_brand"], rank_col="rank") \
        .withColumn("rank", F.col("rank").cast("long"))


@query("top5_authors", _TOP.format(keys="p_brand", name="n", flags="'N'", n=5))
def q_top5_authors(spark, sf):
    c = _part_counts(spark, sf, ["N"], ["p_brand"], "n")
    return W.top_n(c, 5, "n", ["p_brand"], rank_col="rank").withColumn("rank", F.col("rank").cast("long"))


@query("top1", """
SELECT p_type, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE l_returnflag IN ('R', 'A') GROUP BY p_type ORDER BY n DESC, p_type LIMIT 1
""")
def q_top1(spark, sf):
    return W.top1_pair(_part_counts(spark, sf, ["R", "A"], ["p_type"], "n"), "p_type", "n")


@query("latest_non_null", """
SELECT user_id,
       arg_max(v, ts) FILTER (WHERE v IS NOT NULL) AS v,
       arg_max(k, ts) FILTER (WHERE k IS NOT NULL) AS k
FROM (SELECT user_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v,
             CASE WHEN event_type = 'view' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
      FROM events)
GROUP BY user_id
""")
def q_latest_non_null(spark, sf):
    ev = table(spark, sf, "events").select(
        "user_id", "ts", "event_id",
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("v"),
        F.when(F.col("event_type") == "view", F.lit(None))
        .otherwise(F.get_json_object("props", "$.k").cast("long")).alias("k"))
    return A.last_non_null(ev, ["user_id"], "ts", ["v", "k"], tiebreak=["event_id"])


@query("latest_summary", """
WITH last AS (
  SELECT user_id,
         arg_max(v, ts) FILTER (WHERE v IS NOT NULL) AS total_cases,
         arg_max(k, ts) FILTER (WHERE k IS NOT NULL) AS total_deaths
  FROM (SELECT user_id, ts, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v,
               CASE WHEN event_type = 'view' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k
        FROM events)
  GROUP BY user_id)
SELECT user_id, round_even(total_cases, 0) AS total_cases, round_even(total_deaths, 0) AS total_deaths,
       CAST(user_id * 1000 + 500 AS BIGINT) AS population,
       round_even(total_cases / CAST(user_id * 1000 + 500 AS DOUBLE) * 1000000, 1) AS cases_per_million,
       round_even(total_deaths / CAST(user_id * 1000 + 500 AS DOUBLE) * 1000000, 1) AS deaths_per_million
FROM last
""")
def q_latest_summary(spark, sf):
    from quarry.plans import covid

    ev = table(spark, sf, "events").select(
        F.col("user_id"), F.col("ts"), F.col("event_id"),
        F.when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value")).alias("total_cases"),
        F.when(F.col("event_type") == "view", F.lit(None))
        .otherwise(F.get_json_object("props", "$.k").cast("double")).alias("total_deaths"),
        (F.col("user_id") * 1000 + 500).cast("double").alias("population"))
    return covid.latest_summary(ev, key="user_id", date_col="ts", tiebreak=["event_id"],
                                totals=("total_cases", "total_deaths"))


PIVOT_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("pivot_status", "WITH p AS (SELECT p_brand, " + ", ".join(
    f"count(DISTINCT CASE WHEN p_type = '{t}' THEN p_name END) AS \"{t}\"" for t in PIVOT_TYPES)
    + " FROM part GROUP BY p_brand)\nSELECT *, " + " + ".join(f'"{t}"' for t in PIVOT_TYPES)
    + " AS total, concat_ws(', ', " + ", ".join(f"'{t}: ' || CAST(\"{t}\" AS VARCHAR)" for t in PIVOT_TYPES)
    + ") AS summary FROM p")
def q_pivot_status(spark, sf):
    wide = A.pivot_distinct(table(spark, sf, "part"), "p_brand", "p_type", PIVOT_TYPES, "p_name")
    return A.with_row_summary(A.with_row_total(wide, PIVOT_TYPES), PIVOT_TYPES)


@query("treemap_rollup", """
WITH leaves AS (SELECT p_type, p_brand, count(DISTINCT p_name) AS leaf FROM part GROUP BY 1, 2)
SELECT 'ALL' AS root, p_type, p_brand,
       CAST(2 - grouping(p_type) - grouping(p_brand) AS INTEGER) AS level, CAST(sum(leaf) AS BIGINT) AS n
FROM leaves GROUP BY ROLLUP (p_type, p_brand)
""")
def q_treemap_rollup(spark, sf):
    return A.hierarchy_totals(table(spark, sf, "part"), ["p_type", "p_brand"], "p_name")


@query("daily_series", """
SELECT CAST(ts AS DATE) AS day, event_type, round(avg(value), 6) AS avg_value FROM events GROUP BY 1, 2
""")
def q_daily_series(spark, sf):
    ev = table(spark, sf, "events").select(S.parse_date("ts").alias("day"), "event_type", "value")
    return A.mean_by(ev, ["day", "event_type"], ["value"]).select("day", "event_type",
                                                                   r6("value").alias("avg_value"))


CORR_COLS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("corr_matrix", "WITH d AS (SELECT " + ", ".join(CORR_COLS) + " FROM lineitem WHERE "
       + " AND ".join(f"{c} IS NOT NULL" for c in CORR_COLS) + ")\n"
       + "\nUNION ALL ".join(
           [f"SELECT '{c}' AS x, '{c}' AS y, CAST(1.0 AS DOUBLE) AS corr" for c in CORR_COLS]
           + [f"SELECT '{a}', '{b}', round(corr({a}, {b}), 6) FROM d"
              for a in CORR_COLS for b in CORR_COLS if a != b]))
def q_corr_matrix(spark, sf):
    return A.corr_matrix(table(spark, sf, "lineitem"), CORR_COLS).withColumn("corr", r6("corr"))


# --- scalar casts ------------------------------------------------------------------------

@query("ts_clean", """
WITH d AS (
  SELECT event_id,
         CASE event_type WHEN 'click' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
                         WHEN 'error' THEN ''
                         WHEN 'view' THEN 'nan'
                         WHEN 'signup' THEN ' ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' '
                         ELSE 'not a time' END AS raw
  FROM events),
p AS (SELECT event_id, raw,
             TRY_CAST(nullif(nullif(nullif(replace(trim(raw), 'Z', ''), ''), 'None'), 'nan') AS TIMESTAMP) AS t
      FROM d)
SELECT event_id, raw, epoch_us(t) AS epoch_us FROM p
WHERE t BETWEEN TIMESTAMP '2000-01-01' AND TIMESTAMP '2100-01-01'
""")
def q_ts_clean(spark, sf):
    ev = table(spark, sf, "events")
    raw = (F.when(F.col("event_type") == "click",
                  F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
           .when(F.col("event_type") == "error", F.lit(""))
           .when(F.col("event_type") == "view", F.lit("nan"))
           .when(F.col("event_type") == "signup",
                 F.concat(F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" ")))
           .otherwise(F.lit("not a time")))
    parsed = ev.select("event_id", raw.alias("raw")).withColumn("t", S.parse_timestamp_utc("raw"))
    kept = FL.in_range(parsed, "t", F.lit("2000-01-01").cast("timestamp"), F.lit("2100-01-01").cast("timestamp"))
    return kept.select("event_id", "raw", S.timestamp_to_epoch_micros("t").alias("epoch_us"))


@query("epoch_convert", """
SELECT event_id, epoch_us(ts) AS epoch_us, epoch_us(ts) // 1000 AS epoch_ms,
       epoch_us(epoch_ms(epoch_us(ts) // 1000)) AS from_ms_us,
       epoch_us(make_timestamp(CAST((epoch_us(ts) // 1000000) * 1000000 AS BIGINT))) AS from_s_us
FROM events
""")
def q_epoch_convert(spark, sf):
    ev = table(spark, sf, "events").select("event_id", S.timestamp_to_epoch_micros("ts").alias("epoch_us"))
    ms = F.floor(F.col("epoch_us") / 1000).cast("long")
    secs = F.floor(F.col("epoch_us") / 1_000_000).cast("long")
    return ev.select("event_id", "epoch_us", ms.alias("epoch_ms"),
                     S.timestamp_to_epoch_micros(S.epoch_to_timestamp(ms, "ms")).alias("from_ms_us"),
                     S.timestamp_to_epoch_micros(S.epoch_to_timestamp(secs, "s")).alias("from_s_us"))


@query("fill_defaults", """
SELECT l_orderkey, l_linenumber, coalesce(nullif(l_quantity, 1.0), 0.0) AS quantity,
       coalesce(nullif(l_returnflag, 'N'), 'X') AS flag
FROM lineitem
""")
def q_fill_defaults(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.nullif(F.col("l_quantity"), F.lit(1.0)).alias("quantity"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"))
    return S.fill_defaults(li, {"quantity": 0.0, "flag": "X", "absent_column": 0})


@query("bool_cast", """
WITH d AS (
  SELECT event_id, event_type <> 'error' AS renting,
         CASE event_type WHEN 'click' THEN 'true' WHEN 'view' THEN ' 1' WHEN 'error' THEN 'False'
                         WHEN 'purchase' THEN NULL ELSE 'yes' END AS flag_text
  FROM events)
SELECT event_id, flag_text,
       CASE WHEN lower(trim(flag_text)) IN ('t', 'true', 'y', 'yes', '1') THEN true
            WHEN lower(trim(flag_text)) IN ('f', 'false', 'n', 'no', '0') THEN false
            WHEN TRY_CAST(lower(trim(flag_text)) AS DOUBLE) IS NOT NULL THEN TRY_CAST(lower(trim(flag_text)) AS DOUBLE) <> 0
            ELSE false END AS flag,
       CAST(renting AS INTEGER) AS renting_int
FROM d
""")
def q_bool_cast(spark, sf):
    ev = table(spark, sf, "events")
    text = (F.when(F.col("event_type") == "click", F.lit("true"))
            .when(F.col("event_type") == "view", F.lit(" 1"))
            .when(F.col("event_type") == "error", F.lit("False"))
            .when(F.col("event_type") == "purchase", F.lit(None).cast("string"))
            .otherwise(F.lit("yes")))
    return ev.select("event_id", text.alias("flag_text"), S.to_bool_default_false(text).alias("flag"),
                     S.bool_to_int(F.col("event_type") != "error").alias("renting_int"))


@query("round_half_even", """
SELECT l_orderkey, l_linenumber, l_quantity / 4 AS x, round_even(l_quantity / 4, 1) AS r1,
       round_even(l_quantity / 4, 0) AS r0, CAST(trunc(l_quantity / 4) AS BIGINT) AS x_int
FROM lineitem
""")
def q_round_half_even(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 4).alias("x"))
    r = S.round_columns(li.withColumns({"r1": F.col("x"), "r0": F.col("x")}), {"r1": 1, "r0": 0})
    return r.withColumn("x_int", S.float_to_nullable_long("x"))


# --- statistics ----------------------------------------------------------------------------

@query("ols_single", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
       round(regr_r2(l_extendedprice, l_quantity), 6) AS r2,
       CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n
FROM lineitem
""")
def q_ols_single(spark, sf):
    m = M.ols_single(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return m.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"), r6("r2").alias("r2"),
                    F.col("n").cast("long").alias("n"))


@query("ols_metrics", """
WITH d AS (SELECT l_quantity AS x, l_extendedprice AS y, l_shipdate >= TIMESTAMP '2000-06-01' AS is_test FROM lineitem),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM d WHERE NOT is_test),
s AS (SELECT y, a + b * x AS p FROM d, m WHERE is_test)
SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse,
       round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       count(*) AS n
FROM s
""")
def q_ols_metrics(spark, sf):
    # M1 as a time split: fit on earlier shipments, test on the latest ~20 %.
    li = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("y"),
        (F.col("l_shipdate") >= F.lit("2000-06-01").cast("timestamp_ntz")).alias("is_test"))
    model = M.ols_single(li.filter(~F.col("is_test")), "x", "y").first()
    scored = li.filter("is_test").select(
        F.col("y").alias("actual"),
        (F.lit(model["intercept"]) + F.lit(model["slope"]) * F.col("x")).alias("predicted"))
    met = M.regression_metrics(scored)
    return met.select(F.round("rmse", 4).alias("rmse"), r6("r2").alias("r2"), F.col("n").cast("long").alias("n"))


@query("split_and_score", """
WITH d AS (
  SELECT l_quantity AS x, l_extendedprice AS y,
         CAST('0x' || substr(md5(concat_ws(':', l_orderkey, l_linenumber, l_partkey)), 1, 15) AS BIGINT) AS mark,
         l_orderkey, l_linenumber, l_partkey FROM lineitem),
t AS (SELECT *, row_number() OVER (ORDER BY mark, l_orderkey, l_linenumber, l_partkey)
             <= ceil(0.2 * (SELECT count(*) FROM lineitem)) AS is_test FROM d),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t WHERE NOT is_test),
s AS (SELECT y, a + b * x AS p FROM t, m WHERE is_test)
SELECT round(sqrt(avg((y - p) * (y - p))), 4) AS rmse, round(1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2,
       count(*) AS n FROM s
""")
def q_split_and_score(spark, sf):
    """M1 (exactly a fifth, rounded up), M2, M3 and M4 through the library."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey"]
    li = table(spark, sf, "lineitem").select(*keys, "l_quantity", "l_extendedprice")
    mark = F.conv(F.substring(F.md5(F.concat_ws(":", *[F.col(k).cast("string") for k in keys])), 1, 15), 16, 10).cast("long")
    data = M.split_exact(li, keys, 0.2, mark=mark)
    model = M.fit_ols(data.filter("NOT is_test"), ["l_quantity"], "l_extendedprice")
    met = M.regression_metrics(M.score(model, data.filter("is_test"), ["l_quantity"], "l_extendedprice"))
    return met.select(F.round("rmse", 4).alias("rmse"), r6("r2").alias("r2"), F.col("n").cast("long").alias("n"))


OLS_FEATURES = ("l_quantity", "l_discount", "l_tax")


def _ols3_sql() -> str:
    """Three-feature OLS in SQL: Cramer's rule on the covariance matrix."""
    f = OLS_FEATURES
    c = [[f"c{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]

    def det(m):
        return (f"({m[0][0]} * ({m[1][1]} * {m[2][2]} - {m[1][2]} * {m[2][1]})"
                f" - {m[0][1]} * ({m[1][0]} * {m[2][2]} - {m[1][2]} * {m[2][0]})"
                f" + {m[0][2]} * ({m[1][0]} * {m[2][1]} - {m[1][1]} * {m[2][0]}))")

    def replaced(col):
        return [[f"cy{i}" if j == col else c[i][j] for j in range(3)] for i in range(3)]

    stats = ", ".join(
        [f"avg(l_extendedprice) AS my"]
        + [f"avg({f[i]}) AS m{i}" for i in range(3)]
        + [f"covar_pop({f[i]}, l_extendedprice) AS cy{i}" for i in range(3)]
        + [f"covar_pop({f[i]}, {f[j]}) AS c{i}{j}" for i in range(3) for j in range(i, 3)])
    notnull = " AND ".join(f"{x} IS NOT NULL" for x in (*f, "l_extendedprice"))
    betas = ", ".join(f"{det(replaced(i))} / {det(c)} AS b{i}" for i in range(3))
    rows = "\nUNION ALL ".join(
        [f"SELECT '{f[i]}' AS feature, round(b{i}, 4) AS coefficient FROM b" for i in range(3)]
        + ["SELECT 'intercept', round(my - (b0 * m0 + b1 * m1 + b2 * m2), 4) FROM b"])
    return (f"WITH s AS (SELECT {stats} FROM lineitem WHERE {notnull}),\n"
            f"b AS (SELECT *, {betas} FROM s)\n{rows}")


@query("ols_multi", _ols3_sql())
def q_ols_multi(spark, sf):
    li = table(spark, sf, "lineitem")
    feats = list(OLS_FEATURES)
    model = M.fit_ols(li, feats, "l_extendedprice")
    return M.coefficient_table(spark, model).withColumn("coefficient", F.round("coefficient", 4))


# --- sinks read back, streaming ingest ---------------------------------------------------

def _scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local)."""
    from quarry.session import shared_path

    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("append_history", """
SELECT *, CASE WHEN event_type IN ('view', 'click') THEN '20240101_000000' ELSE '20240102_000000' END AS run_ts
FROM events
""")
def q_append_history(spark, sf):
    from datetime import datetime

    from quarry.operators.windows import union_snapshots
    from quarry.sinks.tables import append_history
    from quarry.sources.files import read_parquet_glob

    ev = table(spark, sf, "events")
    path = _scratch(spark, "append_history")
    first = ev.filter(F.col("event_type").isin("view", "click"))
    second = ev.filter(~F.col("event_type").isin("view", "click"))
    append_history(first, path, datetime(2024, 1, 1))
    append_history(second, path, datetime(2024, 1, 2))
    back = read_parquet_glob(spark, path)
    # The read-back history equals the bag union of the two runs.
    return union_snapshots([back.filter(F.col("run_ts") == "20240101_000000"),
                            back.filter(F.col("run_ts") != "20240101_000000")])


@query("csv_roundtrip", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE WHEN c_mktsegment IN ('MACHINERY', 'BUILDING', 'FURNITURE') THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
""")
def q_csv_roundtrip(spark, sf):
    from quarry.sinks.tables import write_csv
    from quarry.sources.files import read_csv

    c = table(spark, sf, "customer")
    seg = (F.when(F.col("c_mktsegment") == "MACHINERY", F.lit("NA"))
           .when(F.col("c_mktsegment") == "BUILDING", F.lit("n/a"))
           .when(F.col("c_mktsegment") == "FURNITURE", F.lit(""))
           .otherwise(F.col("c_mktsegment")))
    path = _scratch(spark, "csv_roundtrip")
    write_csv(c.withColumn("c_mktsegment", seg), path, empty_as_null=False)
    return read_csv(spark, path, {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                                  "c_acctbal": "double", "c_mktsegment": "string"})


@query("stream_ingest", _STATUS + f""",
d AS (SELECT *, row_number() OVER (PARTITION BY station_id, "timestamp"
                                   ORDER BY snapshot_time DESC, extra_uid DESC) AS rn FROM status)
SELECT {_MASTER_COLS}, snapshot_time, CAST("timestamp" AS DATE) AS ts_date FROM d WHERE rn = 1
""")
def q_stream_ingest(spark, sf):
    from quarry.streaming import snapshot_ingest as ST

    base = _scratch(spark, "stream_ingest")
    docs = ST.documents_from_status(station_status(table(spark, sf, "events")))
    docs.write.mode("overwrite").text(f"{base}/landing")
    name = f"stream_master_{uuid.uuid4().hex[:12]}"
    q = ST.start(spark, f"{base}/landing", name, checkpoint=f"{base}/checkpoint", multi_line=False,
                 table_location=f"{base}/master")
    q.awaitTermination()
    out = spark.table(name)
    return out.withColumns({"timestamp": F.col("timestamp").cast("timestamp_ntz"),
                            "snapshot_time": F.col("snapshot_time").cast("timestamp_ntz")})


@query("latest_replaced", """
SELECT 'replaced' AS state, n_nationkey, n_name FROM nation WHERE n_regionkey >= 2
UNION ALL SELECT 'cleared', count(*) FILTER (WHERE false), NULL FROM nation
""")
def q_latest_replaced(spark, sf):
    """The latest dataset is what was written last, then empty with its schema."""
    from quarry.sinks.tables import clear_dataset, write_latest_parquet

    path, nation = f"{_scratch(spark, 'latest_replaced')}/latest", table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    write_latest_parquet(nation, path)
    write_latest_parquet(nation.filter("n_regionkey >= 2"), path)
    replaced = spark.read.parquet(path).select(F.lit("replaced").alias("state"), F.col("n_nationkey").cast("long"), "n_name")
    replaced = replaced.checkpoint(eager=True)  # before the files go
    clear_dataset(spark, nation, path)
    left = spark.read.parquet(path)
    assert left.schema == nation.schema
    return replaced.unionByName(left.agg(F.lit("cleared").alias("state"), F.count("*").alias("n_nationkey"),
                                         F.max("n_name").alias("n_name")))


_LANDED = ("event_type IN ('view', 'click', 'signup')", "event_type NOT IN ('view', 'click', 'signup')")


@query("stream_two_batches", _STATUS + "," + _batches_sql(_LANDED, "snapshot_time DESC, b DESC") + f"""
SELECT {_MASTER_COLS}, snapshot_time, CAST("timestamp" AS DATE) AS ts_date FROM m
""")
def q_stream_two_batches(spark, sf):
    """ST1: two landings, two runs of the stream, then both batches once more, as after a failure:
    the ledger leaves them out."""
    from quarry.streaming import snapshot_ingest as ST

    base, name = _scratch(spark, "stream_two_batches"), f"stream_master_{uuid.uuid4().hex[:12]}"
    status = station_status(table(spark, sf, "events"))
    for landed in _LANDED:
        docs = ST.documents_from_status(status.filter(landed))
        docs.write.mode("append").text(f"{base}/landing")
        q = ST.start(spark, f"{base}/landing", name, checkpoint=f"{base}/checkpoint", table_location=f"{base}/master")
        q.awaitTermination()
    again = (spark.read.schema(ST.STREAM_SCHEMA).json(f"{base}/landing")
             .select("network", ST.snapshot_time_of_document().alias("snapshot_time")))
    assert all(ST.merge_batch(spark, again, name, (q.id, n))["skipped"] for n in (0, 1))
    return spark.table(name).withColumns({"timestamp": F.col("timestamp").cast("timestamp_ntz"),
                                          "snapshot_time": F.col("snapshot_time").cast("timestamp_ntz")})


@query("dimension_fact_swap", """
SELECT 'after the refused pair' AS state, c_custkey, c_mktsegment, 'first ' || c_mktsegment AS description FROM customer
UNION ALL
SELECT 'after the second pair', c_custkey, c_mktsegment, 'second ' || c_mktsegment FROM customer WHERE c_acctbal >= 0
""")
def q_dimension_fact_swap(spark, sf):
    """K8: a pair, one that breaks the foreign key and changes nothing, and a second sound one."""
    from quarry.sinks.tables import recreate_dimension_and_fact

    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    names = [f"swap_{t}_{uuid.uuid4().hex[:12]}" for t in ("segment", "customer")]

    def pair(label, dim, fact):
        dim = A.distinct_values(dim, "c_mktsegment").withColumn(
            "description", F.concat(F.lit(label + " "), F.col("c_mktsegment")))
        recreate_dimension_and_fact(dim, names[0], fact, names[1], foreign_key=("c_mktsegment", "c_mktsegment"),
                                    primary_key=["c_custkey"], not_null=["c_mktsegment"], max_length={"c_mktsegment": 12})

    def held(state):
        kept = spark.table(names[1]).join(spark.table(names[0]), "c_mktsegment")
        return kept.select(F.lit(state).alias("state"), "c_custkey", "c_mktsegment", "description")
    pair("first", cust, cust)
    try:
        pair("refused", cust.filter("c_mktsegment <> 'BUILDING'"), cust)
        raise AssertionError("the broken pair was taken")
    except ValueError:
        path = _scratch(spark, "dimension_fact_swap")
        held("after the refused pair").write.parquet(path)
    pair("second", cust, cust.filter("c_acctbal >= 0"))
    return spark.read.parquet(path).unionByName(held("after the second pair"))


@query("table_sinks", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, 'replace' AS batch FROM orders
UNION ALL
SELECT o_orderkey, o_custkey, NULL, o_totalprice, 'append' FROM orders
""")
def q_table_sinks(spark, sf):
    from quarry.sinks.tables import append_existing, clear_dataset, replace_table, write_latest_parquet
    from quarry.sources.files import read_table

    base = _scratch(spark, "table_sinks")
    orders = table(spark, sf, "orders")
    # K2 + K12: a 'latest' dataset that is replaced, then cleared keeping its schema.
    write_latest_parquet(orders, f"{base}/latest")
    clear_dataset(spark, orders, f"{base}/latest")
    assert spark.read.parquet(f"{base}/latest").columns == orders.columns
    # K5/K7: replace a table; K4: append into it (unknown column ignored, missing -> null).
    name = f"sink_orders_{uuid.uuid4().hex[:12]}"
    replace_table(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                F.lit("replace").alias("batch")), name, location=f"{base}/table")
    append_existing(spark, orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                         F.lit("append").alias("batch")), name)
    return read_table(spark, name)


@query("silver_validation", _STATUS + """
SELECT 'station.id' AS rule, count(*) FILTER (WHERE station_id IS NULL) AS violations FROM status
UNION ALL SELECT 'station.latitude', count(*) FILTER (WHERE latitude < 40.4 OR latitude > 40.9) FROM status
UNION ALL SELECT 'station.longitude', count(*) FILTER (WHERE longitude < -74.3 OR longitude > -73.7) FROM status
UNION ALL SELECT 'station.free_bikes', count(*) FILTER (WHERE free_bikes < 0) FROM status
UNION ALL SELECT 'station.empty_slots', count(*) FILTER (WHERE empty_slots < 0) FROM status
UNION ALL SELECT 'silver.rows', count(*) FROM status
UNION ALL SELECT 'silver.renting', count(*) FILTER (WHERE renting) FROM status
UNION ALL SELECT 'silver.empty', count(*) FILTER (WHERE free_bikes = 0) FROM status
""")
def q_silver_validation(spark, sf):
    """Q1 + S2 + X1/X2 + C2-C4: snapshot documents landed as JSON, read back with
    the declared schema, validated per station, then typed into silver rows."""
    from quarry.sources.files import read_json_documents
    from quarry.streaming.snapshot_ingest import STREAM_SCHEMA, documents_from_status

    base = _scratch(spark, "silver_validation")
    documents_from_status(station_status(table(spark, sf, "events"))).write.text(base)
    docs = read_json_documents(spark, base, STREAM_SCHEMA, multi_line=False)
    stations = docs.select(F.explode("network.stations").alias("st"))
    names = {"station.id", "station.latitude", "station.longitude", "station.free_bikes", "station.empty_slots"}
    rules = [r for r in bike.station_rules() if r[0] in names]
    counts = Q.violation_counts(stations, rules)
    silver = bike.type_silver(bike.flatten_stations(docs, carry=("snapshot_time",)))
    summary = silver.agg(F.count(F.lit(1)).alias("rows"), F.count_if("renting").alias("renting"),
                         F.count_if(F.col("free_bikes") == 0).alias("empty"))
    tail = summary.selectExpr("stack(3, 'silver.rows', rows, 'silver.renting', renting, "
                              "'silver.empty', empty) as (rule, violations)")
    return counts.unionByName(tail)


# A sound second station and network of every landed document, and faults: (text, its replacement,
# the rule that the change breaks, if any). A document's fault follows from its event's value.
_PROBE = ('{"empty_slots":12,"extra":{"uid":"77","ebikes":13,"has_ebikes":true,"last_updated":1700000001},"free_bikes":11,'
          '"id":"probe","latitude":40.75,"longitude":-73.95,"name":"probe","timestamp":"2024-05-01T10:00:00Z"}')
_NETWORK = ('{"network":{"company":["op"],"href":"http://x","id":"citi-bike-nyc","location":{"city":"New York, NY","country":"US",'
            '"latitude":40.71,"longitude":-74.01},"name":"Citi Bike","stations":[')
_ST, _LOC = "network.stations[]", "network.location"
_FAULTS = [
    ("", "", None),
    ('"empty_slots":12,"extra":{"uid":"77","ebikes":13', '"empty_slots":-1,"extra":{"uid":"77","ebikes":13', f"{_ST}.empty_slots least"),
    ('"empty_slots":12,"extra":{"uid":"77","ebikes":13', '"empty_slots":"12","extra":{"uid":"77","ebikes":13', f"{_ST}.empty_slots type"),
    ('"free_bikes":11,"id":"probe"', '"free_bikes":-5,"id":"probe"', f"{_ST}.free_bikes least"),
    ('"free_bikes":11,"id":"probe"', '"id":"probe"', f"{_ST}.free_bikes required"),
    ('"id":"probe"', '"id":""', f"{_ST}.id shortest"),
    ('"id":"probe"', '"id":7', f"{_ST}.id type"),
    ('"latitude":40.75,"longitude":-73.95', '"latitude":99.0,"longitude":-73.95', f"{_ST}.latitude most"),
    ('"latitude":40.75,"longitude":-73.95', '"latitude":4,"longitude":-73.95', f"{_ST}.latitude least"),
    ('"longitude":-73.95', '"longitude":-73.6', f"{_ST}.longitude most"),
    ('"longitude":-73.95', '"longitude":"-73.95"', f"{_ST}.longitude type"),
    ('"name":"probe"', '"name":null', f"{_ST}.name type"),
    ('"2024-05-01T10:00:00Z"', "5", f"{_ST}.timestamp type"),
    ('"ebikes":13', '"ebikes":-1', f"{_ST}.extra.ebikes least"),
    ('"has_ebikes":true,"last_updated":1700000001', '"has_ebikes":1,"last_updated":1700000001', f"{_ST}.extra.has_ebikes type"),
    ("1700000001", "999999999", f"{_ST}.extra.last_updated least"),
    ('"uid":"77","ebikes":13', '"uid":"x7","ebikes":13', f"{_ST}.extra.uid fits"),
    ('"uid":"77","ebikes":13', '"uid":0,"ebikes":13', f"{_ST}.extra.uid fits"),
    ('"uid":"77","ebikes":13', '"uid":5,"ebikes":13', None),
    ('"uid":"77","ebikes":13', '"ebikes":13', f"{_ST}.extra.uid required"),
    ("New York, NY", "Boston", f"{_LOC}.city pattern"),
    ('"country":"US"', '"country":"USA"', f"{_LOC}.country pattern"),
    ('"latitude":40.71,"longitude":-74.01}', '"latitude":30,"longitude":-74.01}', f"{_LOC}.latitude least"),
    ('"longitude":-74.01}', '"longitude":true}', f"{_LOC}.longitude type"),
    ("citi-bike-nyc", "citi-bike", "network.id pattern"),
    ("Citi Bike", "Bike", "network.name pattern"),
    ('"href":"http://x",', "", "network.href required"),
    ('["op"]', "[]", "network.company fewest"),
    ('["op"]', "[5]", "network.company[] type"),
    ('"latitude":40.75,"longitude":-73.95', '"latitude":4.075e1,"longitude":-73.95', None),
    ('"free_bikes":11,"id":"probe"', '"free_bikes":11.5,"id":"probe"', None),
    # From here on nothing below is judged.
    ('"stations":[', '"station":[', "network.stations required"),
    ('{"network":', '{"net":', "network required"),
    ('{"network":', '{network:', "json"),
]
_FAULT_SQL = f"CAST(floor(value) AS BIGINT) % {len(_FAULTS)}"


def _snapshot_rules_sql() -> str:
    broken = [f"SELECT event_id, '{rule}' AS rule FROM e WHERE k = {i}" for i, (_, _, rule) in enumerate(_FAULTS) if rule]
    own = {f"{_ST}.id required": "station_id IS NULL", f"{_ST}.latitude most": "latitude > 40.9",
           f"{_ST}.longitude least": "longitude < -74.3", f"{_ST}.empty_slots required": "empty_slots IS NULL",
           f"{_ST}.extra.ebikes required": "ebikes IS NULL", f"{_ST}.extra.has_ebikes required": "has_ebikes IS NULL"}
    broken += [f"SELECT event_id, '{rule}' AS rule FROM e WHERE {when} AND k < {len(_FAULTS) - 3}" for rule, when in own.items()]
    names = ", ".join(f"('{n}')" for n in ["json", *rule_names(bike.SNAPSHOT_SHAPE)])
    return f"""
{_STATUS},
e AS (SELECT s.*, e.event_id, {_FAULT_SQL.replace("value", "e.value")} AS k
      FROM status s JOIN events e ON CAST(e.event_id AS VARCHAR) = s.extra_uid),
b AS ({" UNION ALL ".join(broken)}),
n(rule) AS (VALUES {names})
SELECT n.rule, count(b.event_id) AS violations, count(DISTINCT b.event_id) AS documents
FROM n LEFT JOIN b ON n.rule = b.rule GROUP BY n.rule
"""


def _snapshots_with_faults(events: DataFrame) -> DataFrame:
    status = station_status(events)
    station = F.to_json(F.struct(
        "empty_slots", F.struct(F.col("extra_uid").alias("uid"), "ebikes", "has_ebikes",
                                F.lit(1700000000).alias("last_updated")).alias("extra"),
        "free_bikes", F.col("station_id").alias("id"), "latitude", "longitude", F.lit("st").alias("name"),
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")))
    text = F.concat(F.lit(_NETWORK), station, F.lit("," + _PROBE + "]}}"))
    fault = events.select(F.col("event_id").cast("string").alias("extra_uid"), F.expr(_FAULT_SQL).alias("fault"))
    whole = status.join(fault, "extra_uid").select("fault", text.alias("text"))
    value = F.col("text")
    for i, (old, new, _) in enumerate(_FAULTS):
        if old:
            value = F.when(F.col("fault") == i, F.replace("text", F.lit(old), F.lit(new))).otherwise(value)
    return whole.select(value.alias("value"))


@query("snapshot_rules", _snapshot_rules_sql())
def q_snapshot_rules(spark, sf):
    """Q1: every rule of the snapshot shape over landed documents of two stations each."""
    base = _scratch(spark, "snapshot_rules")
    _snapshots_with_faults(table(spark, sf, "events")).write.text(base)
    return rule_counts(judged(read_documents(spark, base), bike.SNAPSHOT_SHAPE), bike.SNAPSHOT_SHAPE)


# --- BOOK: whole index job (clean each index, merge, normalise) ---------------------------

_BOOK_WINDOWS = [(None, "1997-01-01"), ("1997-01-01", "1999-01-01"), ("1999-01-01", None)]


def _book_frames(orders: DataFrame) -> list[DataFrame]:
    """Three yearly indexes from orders: customer = title, priority = author (written
    'Last, First', null for 5-LOW), status = ban type; the oldest index uses the
    old layout and a free-text date, the newer ones a Year column."""
    title = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "5-LOW"), F.lit(None)) \
        .otherwise(F.concat(F.lit("Title "), F.col("o_custkey").cast("string")))
    author = F.when(F.col("o_orderpriority") == "5-LOW", F.lit(None)) \
        .otherwise(F.concat(F.lit("Priority, "), F.col("o_orderpriority")))
    ban = (F.when(F.col("o_orderstatus") == "F", F.lit("Banned from Libraries"))
           .when(F.col("o_orderstatus") == "O", F.lit(" banned "))
           .otherwise(F.lit("Banned by Restriction")))
    state = F.concat(F.lit("S"), F.pmod(F.col("o_custkey"), F.lit(7)).cast("string"))
    district = F.when((F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"),
                      F.lit("PEN America office")) \
        .otherwise(F.concat(F.lit("D"), F.pmod(F.col("o_custkey"), F.lit(13)).cast("string")))
    origin = (F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("Administrator"))
              .when(F.col("o_orderpriority") == "2-HIGH", F.lit("Formal Challenge, Administration"))
              .otherwise(F.lit("Parent")))
    y = F.year("o_orderdate")
    frames = []
    for i, (lo, hi) in enumerate(_BOOK_WINDOWS):
        d = orders
        if lo:
            d = d.filter(F.col("o_orderdate") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            d = d.filter(F.col("o_orderdate") < F.lit(hi).cast("timestamp_ntz"))
        if i == 0:
            frames.append(d.select(author.alias("Author"), title.alias("Title"), ban.alias("Type of Ban"),
                                   state.alias("State"), district.alias("District"),
                                   F.concat(F.date_format("o_orderdate", "MMMM"), F.lit(" "), y.cast("string"))
                                   .alias("Date of Challenge/Removal"),
                                   origin.alias("Initiating Action")))
        elif i == 1:
            frames.append(d.select(title.alias("Title"), author.alias("Author"), ban.alias("Ban Status"),
                                   state.alias("State"), district.alias("District"),
                                   F.concat(y.cast("string"), F.lit(".0")).alias("Year"),
                                   origin.alias("Origin of Challenge")))
        else:
            frames.append(d.select(title.alias("Title"), author.alias("Author"), ban.alias("Ban Status"),
                                   state.alias("State"), district.alias("District"),
                                   F.concat((y - 1).cast("string"), F.lit("-"), y.cast("string")).alias("Year")))
    return frames


def _book_sql() -> str:
    conds = ["o_orderdate < TIMESTAMP '1997-01-01'",
             "o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'",
             "o_orderdate >= TIMESTAMP '1999-01-01'"]
    title = ("CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN NULL "
             "ELSE 'Title ' || CAST(o_custkey AS VARCHAR) END")
    author = "CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE 'Priority, ' || o_orderpriority END"
    ban = ("CASE o_orderstatus WHEN 'F' THEN 'Banned from Libraries' WHEN 'O' THEN ' banned ' "
           "ELSE 'Banned by Restriction' END")
    state = "'S' || CAST(o_custkey % 7 AS VARCHAR)"
    district = ("CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P' THEN 'PEN America office' "
                "ELSE 'D' || CAST(o_custkey % 13 AS VARCHAR) END")
    origin = ("CASE o_orderpriority WHEN '1-URGENT' THEN 'Administrator' "
              "WHEN '2-HIGH' THEN 'Formal Challenge, Administration' ELSE 'Parent' END")
    origin_clean = ("CASE o WHEN 'Administrator' THEN 'Administration' "
                    "WHEN 'Formal Challenge, Administration' THEN 'Administration/Formal Challenge' "
                    "WHEN 'Informal Challenge, Administration' THEN 'Administration/Informal Challenge' ELSE o END")
    t3 = ("CASE WHEN contains(a, ', ') THEN array_to_string(list_reverse(string_split(a, ', ')), ' ') "
          "ELSE a END")

    def pen(cols):
        return "NOT (" + " OR ".join(f"coalesce(contains(lower({c}), 'pen america'), false)" for c in cols) + ")"

    raw0 = (f"SELECT {author} AS a, {title} AS t, {ban} AS b, {state} AS s, {district} AS d, "
            f"strftime(o_orderdate, '%B') || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS dt, {origin} AS o "
            f"FROM orders WHERE {conds[0]}")
    raw1 = (f"SELECT {title} AS t, {author} AS a, {ban} AS b, {state} AS s, {district} AS d, "
            f"CAST(year(o_orderdate) AS VARCHAR) || '.0' AS y, {origin} AS o FROM orders WHERE {conds[1]}")
    raw2 = (f"SELECT {title} AS t, {author} AS a, {ban} AS b, {state} AS s, {district} AS d, "
            f"CAST(year(o_orderdate) - 1 AS VARCHAR) || '-' || CAST(year(o_orderdate) AS VARCHAR) AS y "
            f"FROM orders WHERE {conds[2]}")
    return rf"""
WITH r0 AS ({raw0}), r1 AS ({raw1}), r2 AS ({raw2}),
c0 AS (SELECT t, {t3} AS a, b AS b0, s AS s0, d AS d0, dt AS dt0,
              nullif(regexp_extract(dt, '(\S+)\s*$', 1), '') AS y0, {origin_clean} AS o0
       FROM r0 WHERE {pen(['a', 't', 'b', 's', 'd', 'dt', 'o'])} AND NOT (t IS NULL AND a IS NULL)),
c1 AS (SELECT t, {t3} AS a, b AS b1, s AS s1, d AS d1, y AS y1, {origin_clean} AS o1
       FROM r1 WHERE {pen(['t', 'a', 'b', 's', 'd', 'y', 'o'])} AND NOT (t IS NULL AND a IS NULL)),
c2 AS (SELECT t, {t3} AS a, b AS b2, s AS s2, d AS d2, y AS y2
       FROM r2 WHERE {pen(['t', 'a', 'b', 's', 'd', 'y'])} AND NOT (t IS NULL AND a IS NULL)),
m1 AS (SELECT coalesce(c0.t, c1.t) AS t, coalesce(c0.a, c1.a) AS a, b0, s0, d0, dt0, y0, o0, b1, s1, d1, y1, o1
       FROM c0 FULL OUTER JOIN c1 ON c0.t IS NOT DISTINCT FROM c1.t AND c0.a IS NOT DISTINCT FROM c1.a),
m2 AS (SELECT coalesce(m1.t, c2.t) AS t, coalesce(m1.a, c2.a) AS a,
              coalesce(b0, b1, b2) AS b, coalesce(s0, s1, s2) AS s, coalesce(d0, d1, d2) AS d,
              dt0 AS dt, coalesce(y0, y1, y2) AS y, coalesce(o0, o1) AS o
       FROM m1 FULL OUTER JOIN c2 ON m1.t IS NOT DISTINCT FROM c2.t AND m1.a IS NOT DISTINCT FROM c2.a),
n AS (SELECT *, trim(lower(coalesce(b, ''))) AS bn FROM m2)
SELECT t AS "Title", a AS "Author",
       CASE WHEN contains(bn, 'classrooms') OR contains(bn, 'libraries')
            THEN 'banned from libraries and classrooms' ELSE bn END AS "Ban Status",
       s AS "State", d AS "District", dt AS "Date of Challenge/Removal",
       CASE WHEN contains(y, '-') THEN CAST(TRY_CAST(trim(split_part(y, '-', 2)) AS INTEGER) AS VARCHAR)
            WHEN contains(y, '.0') THEN replace(y, '.0', '') ELSE y END AS "Year",
       o AS "Origin of Challenge"
FROM n
"""


@query("book_index_merge", _book_sql())
def q_book_index_merge(spark, sf):
    from quarry.plans import books

    frames = [books.clean_index(f) for f in _book_frames(table(spark, sf, "orders"))]
    return books.merge(frames)


_MERGED = f"(\n{_book_sql()}\n) merged"


def _book_merged(spark, sf):
    from quarry.plans import books

    return books.merge([books.clean_index(f) for f in _book_frames(table(spark, sf, "orders"))])


@query("book_top_titles", f"""
WITH c AS (SELECT "Title", "Author", count(*) AS "Ban Count" FROM {_MERGED}
           WHERE "Ban Status" IN ('banned', 'banned from libraries and classrooms')
             AND "Title" IS NOT NULL AND "Author" IS NOT NULL
           GROUP BY 1, 2)
SELECT *, row_number() OVER (ORDER BY "Ban Count" DESC, "Title", "Author") AS "Rank"
FROM c ORDER BY "Ban Count" DESC, "Title", "Author" LIMIT 5
""")
def q_book_top_titles(spark, sf):
    from quarry.plans import books

    return books.top_titles(_book_merged(spark, sf)).withColumn("Rank", F.col("Rank").cast("long"))


_STATUSES = ("banned", "banned by restriction", "banned from libraries and classrooms",
             "banned pending investigation")


@query("book_state_pivot", f"""
WITH p AS (
  SELECT "State", {", ".join(f'''count(DISTINCT CASE WHEN "Ban Status" = '{s}' THEN "Title" END) AS "{s}"''' for s in _STATUSES)}
  FROM {_MERGED} WHERE "State" IS NOT NULL AND "Ban Status" IS NOT NULL GROUP BY "State")
SELECT *, concat_ws(', ', {", ".join(f"""'{s}: ' || CAST("{s}" AS VARCHAR)""" for s in _STATUSES)}) AS "Ban Status Summary",
       {" + ".join(f'"{s}"' for s in _STATUSES)} AS "Total Count"
FROM p
""")
def q_book_state_pivot(spark, sf):
    from quarry.plans import books

    return books.by_state_pivot(_book_merged(spark, sf))


@query("book_treemap", f"""
WITH leaves AS (SELECT "State", "District", count(DISTINCT "Title") AS leaf FROM {_MERGED}
                WHERE "State" IS NOT NULL AND "District" IS NOT NULL GROUP BY 1, 2)
SELECT 'USA' AS root, "State", "District",
       CAST(2 - grouping("State") - grouping("District") AS INTEGER) AS level, CAST(sum(leaf) AS BIGINT) AS n
FROM leaves GROUP BY ROLLUP ("State", "District")
""")
def q_book_treemap(spark, sf):
    from quarry.plans import books

    return books.dashboard(_book_merged(spark, sf))["treemap"]


# --- retail and sales jobs -------------------------------------------------------------------

def _inventory(spark, sf):
    """Parts as an inventory export in the raw layout (camelCase names, boolean
    out-of-stock flag, a category that is null for one brand)."""
    p = table(spark, sf, "part")
    return p.select(F.nullif(F.col("p_type"), F.when(F.col("p_brand") == "Brand#1", F.col("p_type")))
                    .alias("Category"),
                    F.col("p_size").cast("double").alias("discountPercent"),
                    F.pmod(F.col("p_partkey"), F.lit(97)).alias("availableQuantity"),
                    F.col("p_retailprice").alias("mrp"),
                    (F.col("p_size") > 45).alias("outOfStock"))


_INVENTORY_SQL = """WITH inv AS (
  SELECT CASE WHEN p_brand = 'Brand#1' THEN NULL ELSE p_type END AS "Category",
         CAST(p_size AS DOUBLE) AS discount_percent, p_partkey % 97 AS available_quantity,
         p_retailprice AS mrp, CAST(p_size > 45 AS INTEGER) AS out_of_stock
  FROM part)"""


@query("inventory_reports", _INVENTORY_SQL + """
SELECT "Category", 'avg_discount' AS report, round(avg(discount_percent), 6) AS value FROM inv
WHERE "Category" IS NOT NULL GROUP BY 1
UNION ALL SELECT "Category", 'out_of_stock', CAST(count(*) AS DOUBLE) FROM inv
WHERE "Category" IS NOT NULL AND out_of_stock = 1 GROUP BY 1
UNION ALL SELECT "Category", 'avg_mrp', round(avg(mrp), 6) FROM inv WHERE "Category" IS NOT NULL GROUP BY 1
UNION ALL SELECT "Category", 'avg_stock', round(avg(available_quantity), 6) FROM inv
WHERE "Category" IS NOT NULL GROUP BY 1
UNION ALL SELECT "Category", 'out_of_stock_pct',
       round(CAST(100 AS DOUBLE) * count(*) FILTER (WHERE out_of_stock = 1) / count(*), 6)
FROM inv WHERE "Category" IS NOT NULL GROUP BY 1
""")
def q_inventory_reports(spark, sf):
    from quarry.plans import retail

    reps = retail.reports(retail.clean(_inventory(spark, sf)))
    measure = {"avg_discount": "discount_percent", "out_of_stock": "n", "avg_mrp": "mrp",
               "avg_stock": "available_quantity", "out_of_stock_pct": "pct"}
    out = None
    for name, df in reps.items():
        part = df.select("Category", F.lit(name).alias("report"),
                         r6(F.col(measure[name]).cast("double")).alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


@query("sales_totals", """
SELECT CAST(l_shipdate AS DATE) AS date, product, quantity, price, quantity * price AS total FROM (
  SELECT l_shipdate, nullif(l_returnflag || l_linestatus, 'NO') AS product,
         CAST(l_quantity AS BIGINT) AS quantity, l_extendedprice / l_quantity AS price
  FROM lineitem)
WHERE product IS NOT NULL
""")
def q_sales_totals(spark, sf):
    from quarry.plans import sales

    li = table(spark, sf, "lineitem").select(
        F.to_date("l_shipdate").alias("date"),
        F.nullif(F.concat("l_returnflag", "l_linestatus"), F.lit("NO")).alias("product"),
        F.col("l_quantity").cast("long").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    return sales.clean(li)
