"""Golden cases of the transforms, the as-of rule, merging, scores and settings."""

import datetime as dt
import json
import math

import pytest
from pyspark.sql import functions as F, types as T

from cohortloom.functions.codesets import CODE_SETS, codes_of
from cohortloom.operators import features, shape, stats, transforms
from cohortloom.plans import audit, pipeline, privacy, synthesis
from cohortloom.scores.maggic import INPUTS, maggic
from cohortloom.scores.stumps import stump_score
from cohortloom.sources import tables


def day(d):
    return dt.datetime(2024, 1, d)


CELL = "array<struct<ts:timestamp_ntz,value:double>>"


@pytest.mark.parametrize(
    "cell, ref, after, before",
    [
        ([(day(3), 5.0), (day(1), 7.0), (day(5), 9.0)], day(3), 5.0, 7.0),
        ([(day(1), 1.0), (day(2), 2.0)], day(3), None, 1.0),
        ([(day(2), 4.0), (day(1), 3.0)], None, 3.0, 3.0),
        (None, day(1), None, None),
        ([(day(1), None)], day(1), None, None),
        ([(None, 8.0)], day(1), None, None),
    ],
)
def test_as_of_rule(spark, cell, ref, after, before):
    df = spark.createDataFrame([(1, cell, ref)], f"id long, x {CELL}, ref timestamp_ntz")
    row = shape.as_of(shape.as_of(df, ["x"], "ref", "after", "ts"), ["x"], "ref", "anybefore", "ts").first()
    assert (row.x_first_after, row.x_any_before) == (after, before)


def test_as_of_text_counts_as_one_and_numbers_pass_through(spark):
    df = spark.createDataFrame([(1, [(day(1), "ace")], day(2), 6.5)], "id long, x array<struct<ts:timestamp_ntz,value:string>>, ref timestamp_ntz, y double")
    row = shape.as_of(shape.as_of(df, ["x", "y"], "ref", "after", "ts"), ["x", "y"], "ref", "anybefore", "ts").first()
    assert (row.x_first_after, row.x_any_before, row.y_first_after, row.y_any_before) == (None, 1.0, 6.5, 6.5)


def test_fused_as_of_equals_arrays(spark):
    rows = [(i % 7, str(i % 3), float(i * 37 % 101), day(1 + i * 11 % 28)) for i in range(200)] + [(None, "1", 1.0, day(1)), (1, "1", None, day(1)), (1, "1", 2.0, None)]
    long = spark.createDataFrame(rows, "id long, code string, value double, ts timestamp_ntz")
    refs = spark.createDataFrame([(i, day(15) if i != 3 else None) for i in range(6)], "id long, ref timestamp_ntz")
    wide = shape.expand(long, "id", "code", "value", {"0": "a", "1": "b"}, ["ts"]).join(refs, "id", "left")
    arrays = shape.as_of(shape.as_of(wide, ["a"], "ref", "after", "ts"), ["b"], "ref", "anybefore", "ts").select("id", "a_first_after", "b_any_before")
    fused = shape.as_of_fused(long, refs, "id", "code", "value", "ts", "ref", {"0": "a_first_after"}, {"1": "b_any_before"})
    assert sorted(map(tuple, arrays.collect()), key=str) == sorted([tuple(r) for r in fused.collect() if r.id is not None], key=str)


def test_expansion_counts(spark):
    rows = [(1, 120.5, 1), (2, 130.0, 1), (3, 110.0, 1), (1, 5.1, 2), (2, 5.3, 2), (3, 5.5, 2), (1, 90.0, 3), (3, 95.0, 3)]
    df = spark.createDataFrame([(i, v, t, day(k + 1)) for k, (i, v, t) in enumerate(rows)], "id long, m double, t long, d timestamp_ntz")
    wide = {r.id: r for r in shape.expand(df, "id", "t", "m", {"1": "pressure", "2": "cholesterol", "3": "glucose"}, ["d"]).collect()}
    assert len(wide) == 3 and wide[2].glucose is None and wide[1].pressure[0].value == 120.5


def test_keepfirst_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, None, 9), (1, 3, 2), (1, 3, 1), (2, None, 4)], "k long, s long, x long")
    assert sorted(map(tuple, transforms.keepfirst(df, "s", "k").collect())) == [(1, 3, 1), (2, None, 4)]


def test_classify_exact_prefix_and_many(spark):
    df = spark.createDataFrame([("E11.9",), ("I48.0",), ("Z00",), (None,), ("C10AA05",)], "code string")
    one = transforms.classify(df, ["t2dm", "af", "statins"], "code", "c")
    assert [r.c for r in one.collect()] == ["t2dm", "af", "Other", "Other", "Other"]
    assert transforms.classify(df, ["t2dm", "af", "statins"], "code", "c", match="prefix").collect()[4].c == "statins"
    many = transforms.classify(df, {"a": ["E11.9"], "b": ["E11.9", "Z00"]}, "code", "c", multi=True).collect()
    assert many[0].c == ["a", "b"] and many[3].c == []
    with pytest.raises(ValueError):
        codes_of(["no such set"])
    assert len(CODE_SETS) == 39 and "C09DX04" not in CODE_SETS["arb"] and len(CODE_SETS["ace"]) == 47 and "I21.A1" in CODE_SETS["mace"]


def test_medication_flags_are_grouped(spark):
    df = spark.createDataFrame([(1, "C09AA05"), (1, "X"), (2, "NA"), (2, None), (None, "C09AA05"), (3, "C07AB02")], "id long, atc string")
    assert sorted(map(tuple, transforms.apply(df, "ace", meds="atc", out_col="f", id_col="id").collect())) == [(1, 1), (2, 0), (3, 0)]
    assert sorted(map(tuple, transforms.apply(df, "beta", meds="atc", out_col="f", id_col="id").collect())) == [(1, 0), (2, 0), (3, 1)]


def test_days_round_down_and_years_are_calendar_years(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2), dt.datetime(2020, 1, 1, 0, 30), 1950)], "a timestamp_ntz, b timestamp_ntz, y long")
    assert df.select(transforms.whole_days(F.col("a"), F.col("b"))).first()[0] == -1
    assert transforms.diff(df.withColumn("e", F.lit(dt.datetime(2020, 12, 31)).cast("timestamp_ntz")), "y", "e", "d", "year").first().d == 70


def test_value_transforms(spark):
    df = spark.createDataFrame([(1, "Man", "12.5", True), (2, "Onbekend", "x", None), (3, None, None, False)], "id long, sex string, v string, b boolean")
    assert [r.c for r in transforms.map_values(df, {"Man": 0, "Vrouw": 1}, "sex").withColumnRenamed("sex", "c").collect()] == [0, None, None]
    assert [r.v for r in transforms.to_numeric(df, ["v"]).collect()] == [12.5, None, None]
    with pytest.raises(Exception):
        transforms.to_numeric(df, ["v"], errors="raise").collect()
    assert [r.b for r in transforms.bool_to_int(df, ["b"], fill_na=True).collect()] == [1, 0, 0]
    assert transforms.dropna(df, ["v"]).count() == 2 and transforms.fillna(df, {"v": "0"}).where("v = '0'").count() == 1
    plain = spark.createDataFrame([("20",), ("x",), (None,), ("100",)], "BMI string")
    assert [r.BMI for r in transforms.plausible(plain).collect()] == ["20"]
    with pytest.raises(KeyError):
        transforms.apply(df, "no such transform")


def test_pattern_match_by_id(spark):
    df = spark.createDataFrame([(1, "Hartfalen", 2, "b"), (1, None, 1, "a"), (2, "niets", 3, None)], "id long, text string, o long, other string")
    got = sorted(tuple(r) for r in transforms.pattern_match(df, "text", {"hit": "hart|plots"}, "id", order_col="o").select("id", "hit", "other").collect())
    assert got == [(1, 1, "a"), (2, 0, None)]
    assert transforms.pattern_match(df, "text", {"hit": "hart"}, "id", case_sensitive=True, group_by_id=False).where("hit = 1").count() == 0


def test_chain_is_a_full_join(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "ya")], "id long, code string, text string")
    kwargs = [{"input_col": "code", "codes": ["a"], "out_col": "f", "id_col": "id"}, {"disease": "y", "search_col": "text", "id_col": "id"}]
    got = transforms.chain(df, ["code_flag", "diagnoseprocess_simple"], kwargs, "id")
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0), (2, 0, 1)]


def test_merge_keeps_the_first_source_and_refuses_shared_columns(spark):
    a = spark.createDataFrame([(1, 5), (2, 6)], "id long, PATIENTCONTACTID long")
    b = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "id long, v string")
    assert shape.merge([a, b], "id").count() == 3 and shape.merge([a, b], "id").columns == ["id", "v"]
    with pytest.raises(ValueError):
        shape.merge([b, b], "id")
    with pytest.raises(Exception):
        shape.merge([a, b], "id", strict_unique=True).collect()
    with pytest.raises(ValueError):
        shape.subset(b, "id", ["absent"])


MAGGIC_ROWS = [
    ((1, 0, 0, 0, 0, 0, 0, 55, 1, 80, 30, 130, 50), (0, 0.039, 0.015)),
    ((0, 0, 0, 0, 0, 0, 0, 35, 3, 120, 22, 115, 72), (24, 0.342, 0.147)),
    ((0, 1, 1, 1, 1, 1, 1, 15, 4, 250, 14, 100, 80), (57, None, None)),
    ((1, 0, 0, 0, 0, 0, 0, None, 1, 80, 30, 130, 50), (None, None, None)),
]


def test_maggic(spark):
    schema = T.StructType([T.StructField(i, T.DoubleType()) for i in INPUTS])
    df = spark.createDataFrame([[None if v is None else float(v) for v in r] for r, _ in MAGGIC_ROWS], schema)
    got = [tuple(r)[-3:] for r in maggic(df, {i: i for i in INPUTS}).collect()]
    assert got == [w for _, w in MAGGIC_ROWS]
    assert maggic(df, {i: i for i in INPUTS}, published=True).first().maggic == 6
    with pytest.raises(ValueError):
        maggic(df, {"sex": "sex"})


def test_stumps(spark):
    names = ["bpdias", "creatn", "bun", "hgb", "wbc", "plt", "alb", "rdw"]
    rows = [(60.0, 1.0, 20.0, 13.0, 8.0, 200.0, 4.0, 13.0), (121.0, 1.0, 20.0, 13.0, 8.0, 200.0, 4.0, 13.0), (60.0, None, 20.0, 13.0, 8.0, 200.0, 4.0, 13.0), (60.0, float("nan"), 20.0, 13.0, 8.0, 200.0, 4.0, 13.0)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    trees = [(0.5, "one", 6, True, 3.5, 0, False, 0.0), (0.25, "constant", 0, False, 0.0, 0, False, 0.0)]
    assert [r.s for r in stump_score(df, {n: n for n in names}, trees, 0.5, "s").collect()] == [-0.5, -99.0, -99.0, -99.0]


def test_statistics_against_pandas(spark):
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.normal(size=300).round(1), "b": rng.normal(size=300), "c": rng.choice(list("xyz"), 300)})
    pdf.loc[::7, "a"] = np.nan
    df = tables.nan_to_null(spark.createDataFrame(pdf))
    d = {r.column: r for r in stats.describe(df).collect()}
    assert math.isclose(d["a"].std, pdf["a"].std()) and math.isclose(d["a"].q25, pdf["a"].quantile(0.25))
    assert math.isclose(stats.correlations(df).first().r, pdf["a"].corr(pdf["b"]))
    assert {r.column: r.n_null for r in stats.null_profile(df).collect()} == pdf.isna().sum().to_dict()
    x, y = pdf["a"].dropna().to_numpy(), pdf["b"].to_numpy()
    grid = np.sort(np.concatenate([x, y]))
    f, g = np.searchsorted(np.sort(x), grid, "right") / len(x), np.searchsorted(np.sort(y), grid, "right") / len(y)
    other = df.select(F.col("b").alias("a"))
    assert math.isclose(stats.ks_statistic(df, other, "a").first().ks, np.abs(f - g).max())
    assert math.isclose(stats.wasserstein(df, other, "a").first().w1, (np.abs(f - g)[:-1] * np.diff(grid)).sum())
    assert sum(r.n for r in stats.histogram(df, "b", 30).collect()) == 300
    assert stats.histogram(df.limit(0), "b", 30).count() == 0
    p = spark.range(1).select(stats.ks_p_value(F.lit(0.5), F.lit(100.0), F.lit(100.0))).first()[0]
    assert 0 <= p < 1e-6


def test_features(spark):
    df = spark.createDataFrame([(1, 1.0, "M", "a"), (2, 3.0, "V", "b"), (3, None, "__", "c"), (4, 5.0, None, None)], "id long, x double, sex string, k string")
    got = {r.id: r for r in features.impute_scale_categorize(df, "id", {"sex": ["M", "V"], "k": ["a", "b", "c"]}).collect()}
    assert got[1].x == -1.0 and got[3].x == 0.0 and got[3].sex == 0.5 and got[2].k_b == 1.0 and got[4].k_a == 0.0
    ids = features.split(spark.range(1000).withColumnRenamed("id", "key"), "key")
    assert 150 < ids.where("is_test").count() < 250
    assert features.sample_n(df, 2).count() == 2


def test_audit_rules(spark):
    a = spark.createDataFrame([(i, float(i % 7), "xy"[i % 2]) for i in range(100)], "id long, v double, c string")
    b = spark.createDataFrame([(i, float(i % 7), "xy"[i % 2]) for i in range(50)], "id long, v double, c string")
    q = {r.property: r.score for r in audit.quality(a, b, ["v", "c"]).collect()}
    assert q["shape"] > 0.97
    same = {r.property: r.score for r in audit.quality(a, a, ["id", "v", "c"]).collect()}
    assert same == {"shape": 1.0, "trend": 1.0, "overall": 1.0}
    with pytest.raises(ValueError):
        audit.common_columns(a, b.drop("v"), ["v"])
    assert audit.common_columns(a, b, []) == ["id", "v", "c"]
    made = audit.audit(a, b, ["v", "c"])
    assert {"quality", "nulls", "real_histogram_v", "synthetic_counts_c"} <= set(made)


def test_privacy(spark):
    a = spark.createDataFrame([(i, float(i), float(i % 5), "xy"[i % 2], "pq"[i % 2]) for i in range(60)], "id long, v double, w double, c string, d string")
    metrics = {(r.section, r.column, r.metric): r.value for r in privacy.evaluate(a, a, "id").collect()}
    assert metrics["new_rows", "", "share"] == 0 and metrics["closest", "", "max"] == 0 and metrics["cap", "d", "protection"] == 0
    assert metrics["attribute", "w", "risk"] == 1.0
    bands = spark.createDataFrame([(0.0999,), (0.1,), (0.3,)], "r double").select(privacy.risk_band(F.col("r")).alias("b"))
    assert [r.b for r in bands.collect()] == ["low", "medium", "high"]
    with pytest.raises(ValueError):
        privacy.evaluate(a.select("id"), a.select("id", "v"), "id")


def test_synthesis_keeps_margins_and_correlation_and_is_repeatable(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    x = rng.normal(size=3000)
    rows = [(float(v), int(round(10 * (v + 0.3 * e))), "abc"[k]) for v, e, k in zip(x, rng.normal(size=3000), rng.choice(3, 3000, p=[0.6, 0.3, 0.1]))]
    df = spark.createDataFrame(rows + [(None, 1, "a")] * 300, "x double, y long, c string")
    one = synthesis.synthesize(df, ["x", "y", "c"], 3000)
    assert one.count() == 3000 and sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, synthesis.synthesize(df, ["x", "y", "c"], 3000).collect()), key=str)
    assert stats.ks_statistic(df, one, "x").first().ks < 0.06 and stats.tv_complement(df, one, "c").first()[0] > 0.95
    assert one.select(F.corr("x", "y")).first()[0] > 0.8
    assert 0.05 < one.where("x is null").count() / 3000 < 0.14
    with pytest.raises(ValueError):
        synthesis.synthesize(df, ["x"], 1, "CTGAN")


def test_readers_and_sinks(spark, tmp_path):
    import gzip

    from pyarrow import Table, feather

    (tmp_path / "a.csv").write_text("id,v\n1,x\n2,\n")
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("id,v\n1,2.5\n")
    feather.write_feather(Table.from_pydict({"id": [1, 2], "v": [float("nan"), 1.0]}), str(tmp_path / "c.feather"))
    assert tables.read(spark, str(tmp_path / "a.csv")).where("v is null").count() == 1
    assert tables.read(spark, str(tmp_path / "b.csv.gz"), "id long, v double").first().v == 2.5
    assert tables.read(spark, str(tmp_path / "c.feather")).where("v is null").count() == 1
    done = tables.convert_large(spark, {"a": str(tmp_path / "a.csv")}, str(tmp_path / "out"), least_mb=0)
    assert json.loads((tmp_path / "out/conversion_map.json").read_text()) == done
    assert tables.read(spark, done[str(tmp_path / "a.csv")]).count() == 2
    assert tables.converted(spark, str(tmp_path / "a.csv"), str(tmp_path / "out")) == done[str(tmp_path / "a.csv")]
    assert tables.converted(spark, "other", str(tmp_path / "out")) == tables.converted(spark, "other", None) == "other"
    settings = pipeline.parse({"absolute_path": str(tmp_path), "conversions": str(tmp_path / "out"), "a.csv": ["id", "v"]})
    (tmp_path / "a.csv").write_text("id,v\n9,z\n")
    assert sorted(r.id for r in pipeline.load_source(spark, settings, settings.sources[0]).collect()) == [1, 2]
    tables.write_csv(spark.range(2), str(tmp_path / "d.csv"))
    assert tables.read(spark, str(tmp_path / "d.csv")).count() == 2
    assert tables.create_table_as(spark, "made_of_a_view", "select id from range(5) where id > 1").count() == 3
    spark.sql("drop table made_of_a_view")
    spark.range(3).selectExpr("id", "id as v").createOrReplaceTempView("t_view")
    assert tables.read_table(spark, "t_view", ["v", "absent"]).columns == ["v"] and tables.table_exists(spark, "t_view")
    with pytest.raises(ValueError):
        tables.read(spark, "x.orc")


def test_configured_pipeline_end_to_end(spark, tmp_path):
    spark.createDataFrame([("p1", 1950, "Man", day(10)), ("p2", 1960, "Vrouw", None)], "pseudo_id string, year int, sex string, ref timestamp_ntz").write.parquet(str(tmp_path / "Patient.parquet"))
    lab = [("p1", 7, 1.5, day(1)), ("p1", 7, 2.5, day(12)), ("p2", 7, 3.5, day(2)), ("p1", 8, 9.0, day(3)), ("p3", 7, 1.0, day(1))]
    spark.createDataFrame(lab, "pseudo_id string, code long, v double, ts timestamp_ntz").write.parquet(str(tmp_path / "Lab.parquet"))
    raw = {
        "name": "t", "absolute_path": str(tmp_path), "preprocessing": str(tmp_path / "pp"),
        "Patient.parquet": ["pseudo_id", "year", "sex", "ref"],
        "Lab.parquet": ["pseudo_id", "code", {"v": [{"7": "hb"}, {"8": "crp"}]}, ["ts"]],
        "PreTransforms": {"sex": {"func": "map", "kwargs": {"map": {"Man": 0, "Vrouw": 1}, "out_col": "sex"}}},
        "MergedTransforms": {"age": {"func": "diff", "kwargs": {"start": "year", "end": "ref", "level": "year"}}},
        "ref_date": "ref", "tuple_vals_after": ["hb"], "tuple_vals_anybefore": ["hb", "crp"], "final_cols": ["sex", "age", "ref", "hb", "crp"],
    }
    got = {r.pseudo_id: r for r in pipeline.run(spark, raw).collect()}
    assert set(got) == {"p1", "p2"}
    assert (got["p1"].sex, got["p1"].age, got["p1"].hb_first_after, got["p1"].hb_any_before, got["p1"].crp_any_before) == (0, 74, 2.5, 1.5, 9.0)
    assert (got["p2"].hb_first_after, got["p2"].crp_any_before) == (3.5, None)
    assert pipeline.run(spark, raw).count() == 2
    with pytest.raises(ValueError):
        pipeline.parse(raw | {"PreTransforms": {"sex": {"func": "nope"}}})
    with pytest.raises(ValueError):
        pipeline.parse({"x.parquet": ["id", "c", {"v": {}}, ["a"], ["b"]]})
