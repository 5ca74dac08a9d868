"""Findings of round 3 on the library's own operators."""

import numpy as np

from pyspark.sql import functions as F

from quarry.operators import quality as Q
from quarry.operators.documents import Num, Rec, judged, problems, rule_counts
from quarry.plans.checks import _quoted_csv
from quarry.sources import preamble as PR
from quarry.sources.records import records


def test_f2_describe_counts_each_row_once(spark, monkeypatch):
    """The grid's counts are one grouped count, not two conditions a grid value for every row."""
    rng = np.random.default_rng(2)
    x = [None, float("nan"), float("inf"), -float("inf"), *np.round(rng.normal(0, 50, 3000), 1).tolist()]
    y = rng.integers(0, 9, len(x)).tolist()
    df = spark.createDataFrame(list(zip(x, y)), "x double, y int")
    asked, agg = [], type(df).agg
    monkeypatch.setattr(type(df), "agg", lambda self, *e: (asked.append(len(e)), agg(self, *e))[1])
    got = Q.exact_quantiles_multi(df, ["x", "y"], [0.1, 0.25, 0.5, 0.75], fetch_limit=20)
    known = np.array([v for v in x if v is not None and v == v])
    assert np.allclose(got["x"], np.quantile(known, [0.1, 0.25, 0.5, 0.75])) and np.allclose(got["y"], np.quantile(y, [0.1, 0.25, 0.5, 0.75]))
    assert len(asked) > 1 and max(asked) < 50


def test_f3_nested_fields_are_read_once(spark):
    """A field's expression stands once in the rules below it: every further level of records adds
    about as much as the last one, and the rules found are those of every level."""
    def shape(depth):
        return Rec({"n": Num(0), "in": shape(depth - 1)} if depth else {"n": Num(0)})

    sizes = [len(str(problems(shape(d), F.col("doc")))) for d in (2, 4, 6)]
    assert sizes[2] - sizes[1] < 1.5 * (sizes[1] - sizes[0])
    texts = ['{"n":1,"in":{"n":-1,"in":{"n":2}}}', '{"n":1,"in":{"in":{"n":"x"}}}', '{"n":1,"in":{"n":1,"in":5}}', "[]", '{"n":1,"in":{"n":0,"in":{"n":0}}}']
    docs = spark.createDataFrame([(t,) for t in texts], "value string").select("value", F.try_parse_json("value").alias("doc"))
    tagged = judged(docs, shape(2))
    assert [r.violations for r in tagged.collect()] == [["in.n least"], ["in.n required", "in.in.n type"], ["in.in type"], [" type"], []]
    assert {r.rule: r.violations for r in rule_counts(tagged, shape(2)).collect() if r.violations} == {
        "in.n least": 1, "in.n required": 1, "in.in.n type": 1, "in.in type": 1, " type": 1}


def test_f4_quoted_files_grow_in_number(spark, tmp_dir):
    """No task writes more than about ``file_bytes`` of text, and every document is landed once."""
    docs = spark.createDataFrame([(8 * i, "wörd \"x\"\n" * 100, "en") for i in range(200)], "doc_id long, text string, lang string")
    _quoted_csv(docs, f"{tmp_dir}/csv", file_bytes=20_000)
    lines = spark.read.text(f"{tmp_dir}/csv")
    sizes = [r["n"] for r in lines.groupBy("f").agg(F.sum(F.length("value") + 1).alias("n")).collect()]
    assert len(sizes) == 10 and max(sizes) < 60_000
    rows = PR.parse_csv_lines(records(PR.strip_preamble(PR.lines_from_files(spark, f"{tmp_dir}/csv"), ["doc_id,body"]))).collect()
    assert sorted(int(r.doc_id) for r in rows) == [8 * i for i in range(200)]
