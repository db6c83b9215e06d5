"""The autoencoder: derivatives against differences, training that is summed by Spark, checkpoints and the stage."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.plans import autoencoder as ae


def frame(spark, n=600):
    return spark.range(n).select(F.col("id").alias("key"), F.sin(F.col("id") / 9).alias("a"), (2 * F.sin(F.col("id") / 9) + 1).alias("b"), F.when(F.col("id") % 5 > 0, F.cos(F.col("id") / 7)).alias("c"), F.lit(3).alias("constant"), F.lit(None).cast("double").alias("nothing"))


COLUMNS = ["a", "b", "c", "constant", "nothing"]


def small(spark, df, seed=1):
    return ae.new_autoencoder(COLUMNS, ae.column_ends(df, COLUMNS), 6, 2, seed)


def test_gradients_equal_differences(spark):
    df = frame(spark, 50)
    model = small(spark, df)
    rows = ae.dataset(df, "key", None, 0)[0].repartition(7)
    loss, by = ae.gradient(rows, model)
    assert ae.mean_loss(rows, model) == pytest.approx(loss, abs=1e-12)
    x, known = model.scaled(np.array([r.x for r in rows.collect()], float))
    assert known[:, 4].sum() == 0 and known[:, 2].sum() == 40
    for layer, w in enumerate(model.weights):
        for at in list(np.ndindex(w.shape))[:: max(1, w.size // 5)]:
            values = []
            for step in (1e-5, -1e-5):
                moved = [np.zeros_like(v) for v in model.weights]
                moved[layer][at] = step
                total, n = model.moved(moved).loss(x, known)
                values.append(total / n)
            assert by[layer][at] == pytest.approx((values[0] - values[1]) / 2e-5, abs=1e-6)


def test_loss_falls_and_a_broken_run_goes_on_as_if_it_had_not(spark, tmp_path):
    df = frame(spark)
    settings = ae.Training(8, 2, 4, 3, rate=0.02, seed=5)
    whole = ae.train(df, "key", COLUMNS, f"{tmp_path}/whole", settings)
    losses = [h["val_loss"] for h in whole.history]
    assert len(losses) == 4 and losses[-1] < 0.7 * losses[0]
    ae.train(df, "key", COLUMNS, f"{tmp_path}/parts", ae.Training(8, 2, 2, 3, rate=0.02, seed=5))
    rest = ae.train(df, "key", COLUMNS, f"{tmp_path}/parts", settings)
    for a, b in zip(whole.weights, rest.weights):
        np.testing.assert_allclose(a, b, atol=1e-9)
    assert [h["epoch"] for h in rest.history] == [1, 2, 3, 4]
    # what is there already is not trained again, and other settings are another run
    assert ae.train(df.limit(0), "key", COLUMNS, f"{tmp_path}/parts", settings).weights[0].tolist() == rest.weights[0].tolist()
    with pytest.raises(ValueError, match="no rows"):
        ae.train(df.limit(0), "key", COLUMNS, f"{tmp_path}/none", settings)


def test_a_saved_network_gives_the_same_codes(spark, tmp_path):
    df = frame(spark, 40)
    model = small(spark, df)
    ae.save(spark, model, f"{tmp_path}/model.json")
    again = ae.load(spark, f"{tmp_path}/model.json")
    a, b = ({r.key: r for r in ae.apply(df, "key", m).collect()} for m in (model, again))
    assert a == b and len(a) == 40 and all(len(r.code) == 2 and len(r.rebuilt) == 5 for r in a.values())
    x, known = model.scaled(np.array([[r.a, r.b, np.nan if r.c is None else r.c, 3, np.nan] for r in df.orderBy("key").collect()], float))
    for k in (0, 5, 39):
        assert a[k].error == pytest.approx((((model.decode(x)[k] - x[k]) * known[k]) ** 2).sum() / known[k].sum())
    # a row without any value has no error
    assert ae.apply(df.select("key", *[F.lit(None).cast("double").alias(c) for c in COLUMNS]), "key", model).first().error is None


def test_the_split_and_the_stage(spark, tmp_path):
    df = frame(spark).withColumn("label", F.col("key") % 2).drop("nothing")
    train, test, columns = ae.dataset(df, "key", "label")
    assert columns == ["a", "b", "c", "constant"] and train.count() + test.count() == 600 and 60 < test.count() < 180
    ids = {r.key for r in test.collect()}
    assert ids == {r.key for r in ae.dataset(df.repartition(9), "key", "label")[1].collect()} and {r.y for r in train.collect()} == {0.0, 1.0}
    ae.save_dataset(train, test, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/test_X.parquet").count() == len(ids)
    df.write.parquet(f"{tmp_path}/input.parquet")
    settings = {"name": "small", "absolute_path": str(tmp_path), "datatype": "tabular", "data_args": {"inputfile": f"{tmp_path}/input.parquet", "index_id": "key", "label": "label"}, "model": "vanilla_ae", "model_args": {"mid_size": 5, "latent_size": 2}, "epochs": 2, "batchlim": 2}
    (tmp_path / "train.json").write_text(json.dumps(settings))
    model = ae.run(spark, f"{tmp_path}/train.json")
    assert json.loads((tmp_path / "results/small/history.json").read_text()) == model.history and len(model.history) == 2
    with pytest.raises(ValueError, match="no model"):
        ae.run(spark, settings | {"model": "other"})
