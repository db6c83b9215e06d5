"""Stages that depend on one another: each result is committed in one step, found again by its settings, and made only if it is not there.

A stage's path carries a hash of its settings and of those of every stage before it, so a changed setting makes that stage and what follows
anew and nothing else. A stage writes beside its path and is renamed when it is whole: a run that breaks off leaves no half
results, and the next one goes on from the last whole stage.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import SparkSession, functions as F

from cohortloom.operators import features
from cohortloom.plans import audit, autoencoder, pipeline, privacy, synthesis
from cohortloom.sources import tables


@dataclass(frozen=True)
class Stage:
    """make(spark, paths of the required stages by name, folder to write to, path that this folder will have)."""

    name: str
    make: Callable[[SparkSession, dict[str, str], str, str], None]
    settings: object = None
    requires: tuple[str, ...] = ()


def paths(stages: list[Stage], folder: str) -> dict[str, str]:
    """The path of each stage, in an order in which they can be made."""
    by = {s.name: s for s in stages}
    if unknown := {r for s in stages for r in s.requires} - set(by):
        raise ValueError(f"no stages {sorted(unknown)}")
    out: dict[str, str] = {}
    for name in TopologicalSorter({s.name: s.requires for s in stages}).static_order():  # a circle is an error
        out[name] = tables.stage_path(folder, name, [by[name].settings, [out[r] for r in by[name].requires]]).removesuffix(".parquet")
    return out


def run(spark: SparkSession, stages: list[Stage], folder: str, reuse: bool = True) -> dict[str, str]:
    """Makes every stage that is not there (all, without reuse) and gives their paths."""
    where, by = paths(stages, folder), {s.name: s for s in stages}
    for name, path in where.items():
        if reuse and tables.path_exists(spark, path):
            continue
        tables.remove(spark, f"{path}.new")
        by[name].make(spark, {r: where[r] for r in by[name].requires}, f"{path}.new", path)
        tables.rename(spark, f"{path}.new", path)
    return where


def _rows(spark: SparkSession, path: str):
    return spark.read.parquet(f"{path}/rows")


def everything(spark: SparkSession, settings: dict | str) -> dict[str, str]:
    """From raw files to the privacy report in one call; gives the path of each stage's folder.

    settings (or a JSON file of them): folder, key, etl (settings of pipeline.py), time (name of the date in expanded entries), convert {least_mb},
    features {categories, columns}, train (Training's fields), synth {columns, num_points, synth_type, seed}, tolerance. Without train there is no training.
    convert -> preprocessed -> selected -> imputed -> trained; selected -> synthetic -> audit, privacy.
    """
    if isinstance(settings, str):
        with open(settings) as f:
            settings = json.load(f)
    etl, key, time, synth, shaped = settings["etl"], settings["key"], settings.get("time", "ts"), settings["synth"], settings.get("features", {})
    parsed = pipeline.parse(etl)
    columns = synth["columns"]

    def convert(spark, given, to, path):
        files = {} if parsed.tables else {s.name.rpartition("/")[2].partition(".")[0]: f"{parsed.folder.rstrip('/')}/{s.name}" if parsed.folder else s.name for s in parsed.sources}
        tables.convert_large(spark, files, to, settings.get("convert", {}).get("least_mb", 500), path)

    def preprocessed(spark, given, to, path):
        tables.write_parquet(pipeline.preprocess(spark, pipeline.parse(etl | {"conversions": given["converted"]})), f"{to}/rows")

    def selected(spark, given, to, path):
        tables.write_parquet(pipeline.select_values(_rows(spark, given["preprocessed"]), parsed, time), f"{to}/rows")

    def imputed(spark, given, to, path):
        rows = _rows(spark, given["selected"]).select(key, *shaped.get("columns", columns))
        tables.write_parquet(features.impute_scale_categorize(rows, key, shaped.get("categories"), store=f"{to}/fitted"), f"{to}/rows")

    def trained(spark, given, to, path):
        rows = _rows(spark, given["imputed"])
        model = autoencoder.train(rows, key, autoencoder.dataset(rows, key)[2], f"{to}/training", autoencoder.Training(**settings["train"]))
        autoencoder.save(spark, model, f"{to}/model.json")

    def synthetic(spark, given, to, path):
        rows = _rows(spark, given["selected"])
        made = synthesis.run(rows, columns, synth["num_points"], to, synth.get("synth_type", "GC"), synth.get("seed", 42))
        tables.write_parquet(made.withColumnRenamed("id", key), f"{to}/rows")

    def pair(spark, given):
        return _rows(spark, given["selected"]).select(key, *columns), _rows(spark, given["synthetic"]).select(key, *columns)

    def audited(spark, given, to, path):
        audit.run(*pair(spark, given), to, columns)

    def private(spark, given, to, path):
        real, made = pair(spark, given)
        real = real.withColumn(key, F.xxhash64(key)) if dict(real.dtypes)[key] == "string" else real
        privacy.run(real, made, key, to, tolerance=settings.get("tolerance", 0.01))

    stages = [
        Stage("converted", convert, [etl, settings.get("convert")]),
        Stage("preprocessed", preprocessed, etl, ("converted",)),
        Stage("selected", selected, time, ("preprocessed",)),
        Stage("imputed", imputed, [key, shaped], ("selected",)),
        *([Stage("trained", trained, settings["train"], ("imputed",))] if "train" in settings else []),
        Stage("synthetic", synthetic, synth, ("selected",)),
        Stage("audit", audited, columns, ("selected", "synthetic")),
        Stage("privacy", private, [key, settings.get("tolerance")], ("selected", "synthetic")),
    ]
    return run(spark, stages, settings["folder"])
