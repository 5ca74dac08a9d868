"""Q1: nested documents against a declared shape, and the station gate."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarry.operators.documents import (Either, Flag, Many, Num, Rec, Text, assert_documents, judged, problems,
                                        read_documents, rule_counts, rule_names)
from quarry.plans import bike
from test_jobs import _doc, _station


def _broken(spark, shape, values):
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i int, value string")
    df = df.select("i", F.try_parse_json("value").alias("doc"))
    return [r.v for r in df.select("i", problems(shape, F.col("doc"), "v").alias("v")).orderBy("i").collect()]


@pytest.mark.parametrize("shape, good, bad", [
    (Num(least=0, most=9), [0, 9, 3.5, 1e0], {"v type": ["5", True, None, [], {}], "v least": [-1, -0.1], "v most": [9.5]}),
    (Text(pattern="^a+$", shortest=2), ["aa"], {"v type": [1, None, ["aa"]], "v shortest": ["a", ""], "v pattern": ["ab"]}),
    (Flag(), [True, False], {"v type": ["true", 1, None]}),
    (Many(Num(least=0), fewest=1), [[1], [0, 2]], {"v type": [{}, "x", 1, None], "v fewest": [[]], "v[] least": [[1, -1]],
                                                    "v[] type": [["x"], [None]]}),
    (Rec({"a": Num()}, optional={"b": Flag()}), [{"a": 1}, {"a": 1, "b": True, "c": []}],
     {"v type": [1, [], "x", None], "v.a required": [{}, {"b": True}], "v.a type": [{"a": None}], "v.b type": [{"a": 1, "b": None}]}),
    (Either((Num(least=1), Text("^[0-9]+$"))), [1, "0"], {"v fits": [0, "x", True, None, {}]}),
])
def test_each_kind(spark, shape, good, bad):
    values = [*good, *[v for vs in bad.values() for v in vs]]
    want = [[] for _ in good] + [[name] for name, vs in bad.items() for _ in vs]
    assert _broken(spark, shape, values) == want
    assert {n for w in want for n in w} <= set(rule_names(shape, "v"))


def test_rules_of_items_count_each_item(spark):
    shape = Rec({"xs": Many(Rec({"n": Num(least=0)}))})
    docs = [{"xs": [{"n": -1}, {"n": -2}, {}]}, {"xs": [{"n": 1}]}, {"xs": []}]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs] + [("{broken",)], "value string")
    tagged = judged(df.select("value", F.try_parse_json("value").alias("doc")), shape)
    got = {r.rule: (r.violations, r.documents) for r in rule_counts(tagged, shape).collect() if r.violations}
    assert got == {"xs[].n least": (2, 1), "xs[].n required": (1, 1), "json": (1, 1)}
    assert rule_counts(tagged.limit(0), shape).filter("violations > 0").count() == 0
    assert_documents(tagged.filter("size(violations) = 0"), shape)


def _land(folder, docs):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "station_status_2024-05-01_10-00-00.json"), "w") as f:
        f.writelines(json.dumps(d) + "\n" for d in docs)


def _bad(**fields):
    return {**_station("b", "2024-05-01T10:00:00Z", 3, 1), **fields}


@pytest.mark.parametrize("station, rule", [
    (_bad(latitude=99.0), "latitude most"), (_bad(free_bikes=-5), "free_bikes least"), (_bad(free_bikes="5"), "free_bikes type"),
    (_bad(name=""), "name shortest"), (_bad(extra={"uid": "1"}), "extra.ebikes required"), ({}, "id required")])
def test_the_gate_rejects_a_bad_station(spark, tmp_dir, station, rule):
    good = _station("a", "2024-05-01T10:00:00Z", 3, 1)
    _land(f"{tmp_dir}/raw", [_doc([good, station]), _doc([good])])
    docs = read_documents(spark, f"{tmp_dir}/raw")
    with pytest.raises(ValueError, match=f"network.stations\\[\\].{rule}=1"):
        bike.gate(docs)
    kept = bike.gate(docs, quarantine=True)
    assert [len(r.network.stations) for r in kept.collect()] == [1]
    assert [r.violations for r in bike.rejected(docs).collect()][0].count(f"network.stations[].{rule}") == 1
    with pytest.raises(ValueError):
        bike.run(spark, f"{tmp_dir}/raw", "gate_master", "gate_gold", snapshot_time=datetime(2024, 5, 1, 10, 5))
    assert not spark.catalog.tableExists("gate_master")


def test_pretty_printed_documents(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/pretty")
    with open(f"{tmp_dir}/pretty/a.json", "w") as f:
        json.dump(_doc([_station("a", "2024-05-01T10:00:00Z", 3, 1)]), f, indent=2)
    docs = bike.gate(read_documents(spark, f"{tmp_dir}/pretty", multi_line=True))
    assert docs.first().network.stations[0].id == "a"


def test_a_file_of_twenty_rules_has_them_all(spark):
    names = list(rule_names(bike.SNAPSHOT_SHAPE))
    assert len(names) == len(set(names)) and sum("stations[]" in n for n in names) >= 20
