"""Stages: order, one-step commits, resuming, and everything from raw files to the privacy report; Feather files; stored lists."""

import json
import math

import pyarrow as pa
import pytest
from pyarrow import feather
from pyspark.sql import functions as F

from cohortloom.operators import shape
from cohortloom.plans import stages
from cohortloom.sources import tables


def test_stages_run_once_in_order_and_commit_whole(spark, tmp_path):
    made = []

    def make(name, fails=False):
        def run(spark, given, to, path):
            made.append((name, sorted(given)))
            tables.write_json(spark, name, f"{to}/part.json")
            if fails:
                raise RuntimeError("lost")

        return run

    def graph(fails=False, setting=1):
        return [stages.Stage("c", make("c", fails), None, ("a", "b")), stages.Stage("b", make("b"), setting, ("a",)), stages.Stage("a", make("a"))]

    folder = str(tmp_path)
    with pytest.raises(RuntimeError):
        stages.run(spark, graph(fails=True), folder)
    assert [m[0] for m in made] == ["a", "b", "c"] and made[2][1] == ["a", "b"]
    where = stages.paths(graph(), folder)
    assert tables.path_exists(spark, where["b"]) and not tables.path_exists(spark, where["c"])
    assert stages.run(spark, graph(), folder) == where and [m[0] for m in made[3:]] == ["c"]
    stages.run(spark, graph(), folder)
    assert len(made) == 4
    other = stages.run(spark, graph(setting=2), folder)  # b is another, and so is c
    assert [m[0] for m in made[4:]] == ["b", "c"] and other["a"] == where["a"] and other["c"] != where["c"]
    with pytest.raises(ValueError):
        stages.paths([stages.Stage("x", make("x"), None, ("y",)), stages.Stage("y", make("y"), None, ("x",))], folder)
    with pytest.raises(ValueError, match="no stages"):
        stages.paths([stages.Stage("x", make("x"), None, ("z",))], folder)


def test_from_raw_files_to_the_privacy_report(spark, tmp_path):
    people = spark.range(300).select(F.col("id").alias("pid"), F.when(F.col("id") % 3 == 0, "m").otherwise("f").alias("sex"), (40 + F.col("id") % 37).alias("age"), F.to_timestamp(F.lit("2020-06-01")).alias("ref"))
    labs = spark.range(1500).select((F.col("id") % 310).alias("person"), F.when(F.col("id") % 2 == 0, "HB").otherwise("K").alias("code"), (F.col("id") % 13 + 0.5).alias("result"), F.expr("timestampadd(DAY, id % 400, timestamp'2020-01-01')").alias("ts"))
    people.write.option("header", True).csv(f"{tmp_path}/people.csv")
    labs.write.parquet(f"{tmp_path}/labs.parquet")
    etl = {"name": "t", "absolute_path": str(tmp_path), "people.csv": ["pid", "sex", "age", "ref"], "labs.parquet": ["person", "code", {"result": {"HB": "hb", "K": "k"}}, ["ts"]], "ref_date": "ref", "tuple_vals_after": ["hb"], "tuple_vals_anybefore": ["k"]}
    columns = ["sex", "age", "hb_first_after", "k_any_before"]
    settings = {"folder": f"{tmp_path}/out", "key": "pid", "etl": etl, "convert": {"least_mb": 0.0001}, "features": {"categories": {"sex": ["m", "f"]}}, "train": {"mid_size": 4, "latent_size": 2, "epochs": 1, "batches": 2}, "synth": {"columns": columns, "num_points": 200, "synth_type": "RTF"}}
    (tmp_path / "all.json").write_text(json.dumps(settings))
    where = stages.everything(spark, f"{tmp_path}/all.json")
    assert list(where)[0] == "converted" and set(where) == {"converted", "preprocessed", "selected", "imputed", "trained", "synthetic", "audit", "privacy"}
    moved = tables.read_json(spark, f"{where['converted']}/conversion_map.json")
    assert len(moved) == 1 and all(tables.path_exists(spark, p) for p in moved.values())
    rows = spark.read.parquet(f"{where['selected']}/rows")
    first = labs.where("code = 'HB' and ts >= '2020-06-01'").groupBy("person").agg(F.min_by("result", "ts").alias("v"))
    assert {r.pid: r.hb_first_after for r in rows.collect() if r.hb_first_after is not None} == {r.person: r.v for r in first.where("person < 300").collect()}
    assert spark.read.parquet(f"{where['synthetic']}/rows").count() == 200
    report = tables.read_json(spark, f"{where['privacy']}/privacy_report.json")
    assert "control_rate" in report["linkability"][""] and "quality" in tables.read_json(spark, f"{where['audit']}/audit_report.json")
    assert stages.everything(spark, settings) == where  # all of it is there


def test_feather_files_are_read_by_record_batch(spark, tmp_path):
    table = pa.table({"i": list(range(1000)), "x": [None if i % 10 == 0 else math.nan if i % 10 == 1 else i / 3 for i in range(1000)], "s": [f"t{i % 7}" for i in range(1000)], "t": pa.array([i * 1_000_000 for i in range(1000)], pa.timestamp("us")), "c": pa.array([f"c{i % 3}" for i in range(1000)]).dictionary_encode()})
    feather.write_feather(table, f"{tmp_path}/many.feather", chunksize=100)
    df = tables.read(spark, f"{tmp_path}/many.feather")
    assert df.rdd.getNumPartitions() == 10 and df.count() == 1000
    assert dict(df.dtypes) == {"i": "bigint", "x": "double", "s": "string", "t": "timestamp_ntz", "c": "string"}
    got = sorted(df.collect())
    assert [r.i for r in got] == list(range(1000)) and got[0].x is None and got[1].x is None and got[5].x == 5 / 3 and got[8].s == "t1" and got[4].c == "c1"
    feather.write_feather(table.select(["i", "x", "s"]), f"{tmp_path}/old.feather", version=1)
    assert tables.read(spark, f"{tmp_path}/old.feather").agg(F.sum("i")).first()[0] == 499_500
    (tmp_path / "folder.feather").mkdir()
    for k in range(3):
        feather.write_feather(table.slice(k * 10, 10), f"{tmp_path}/folder.feather/{k}.feather")
    assert tables.read(spark, f"{tmp_path}/folder.feather").count() == 30
    feather.write_feather(table.slice(0, 0), f"{tmp_path}/none.feather")
    assert tables.read(spark, f"{tmp_path}/none.feather").count() == 0


def test_stored_lists(spark):
    cells = [
        ("[(7.1, '2020-03-01'), (5.5, '2020-01-01'), (nan, '2019-01-01')]", 7.1, 5.5),
        ("['(2, \"2020-05-01 10:00:00\")', '(3, \"2020-04-01\")']", 3.0, None),
        ("[('high', '2020-01-05'), (4, '2020-09-01')]", 1.0, 1.0),
        ("[(None, '2020-01-05')]", None, None),
        ("[(1.5, 'no date'), (2.5, '2021-01-01', 'extra')]", 2.5, None),
        ("7.25", 7.25, 7.25),
        ("[]", None, None),
        ("", None, None),
        (None, None, None),
    ]
    df = spark.createDataFrame([(i, c[0], "2020-02-01") for i, c in enumerate(cells)], "id int, v string, ref string").withColumn("ref", F.col("ref").cast("timestamp_ntz"))
    df = shape.as_of(shape.as_of(df, ["v"], "ref", "after", "ts"), ["v"], "ref", "anybefore", "ts")
    assert [(r.v_first_after, r.v_any_before) for r in df.orderBy("id").collect()] == [c[1:] for c in cells]
