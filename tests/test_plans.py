"""Physical-plan regression tests: the properties the operators were designed for
(pushdown, pruning, partial aggregation, partial window limits, no extra shuffles,
no lambdas on hot paths) are asserted on the formatted plans."""

import io
import re
from contextlib import redirect_stdout

import pytest

from conftest import SF_SMOKE

import __spark_entry__ as entry


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def tree(text: str) -> str:
    """The operator tree part of a formatted plan (before the numbered details)."""
    return text.split("\n\n")[0]


@pytest.fixture(scope="module")
def q():
    return entry.queries()


def test_rolling_filter_reaches_the_scan(spark, q):
    p = plan(q["weekly_utilization"](spark, SF_SMOKE))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(ts,", p)


def test_status_class_filter_pushed_and_columns_pruned(spark, q):
    p = plan(q["top5_titles"](spark, SF_SMOKE))
    assert "In(l_returnflag, [A,R])" in p
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in p
    t = tree(p)
    assert "TakeOrderedAndProject" in t
    # line items are aggregated per part key before the join with the part dimension
    join_at = min(i for i in (t.find("BroadcastHashJoin"), t.find("SortMergeJoin")) if i >= 0)
    assert "HashAggregate" in t[join_at:]


def test_dedup_limits_each_key_before_the_shuffle(spark, q):
    p = plan(q["dedup_latest"](spark, SF_SMOKE))
    blocks = [b for b in p.split("\n\n") if re.match(r"\(\d+\) WindowGroupLimit", b.strip())]
    assert any("Partial" in b for b in blocks)
    t = tree(p)
    assert t.rfind("WindowGroupLimit") > t.rfind("Exchange")  # a WindowGroupLimit sits below the exchange


def test_upsert_join_reuses_the_dedup_partitioning(spark, q):
    t = tree(plan(q["upsert_merge"](spark, SF_SMOKE)))
    # target side 1, batch dedup 1, null-key batch branch 1 (same dedup, reused at
    # run time); the merge join itself adds no exchange on the batch side.
    assert t.count("Exchange") == 3


def test_hot_predicates_stay_lambda_free(spark, q):
    for name in ("any_cell_contains", "quarantine_split"):  # anchor_link folds over a page's tokens
        p = plan(q[name](spark, SF_SMOKE))
        assert "lambdafunction" not in p.lower(), name


def test_aggregates_are_partial_before_exchange(spark, q):
    for name in ("gold_weekly_all", "distinct_by_keys", "pivot_status", "latest_non_null"):
        t = tree(plan(q[name](spark, SF_SMOKE)))
        last_exchange = t.rfind("Exchange")
        assert last_exchange >= 0 and re.search(r"(Hash|Sort|ObjectHash)Aggregate", t[last_exchange:]), name
