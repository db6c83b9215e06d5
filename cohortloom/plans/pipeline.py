"""The configured pipeline: sources -> transforms -> expansion -> merge -> as-of selection -> projection.

The settings are a dictionary (or a JSON file):

    {"name": ..., "key": "pseudo_id", "absolute_path": "/data", "preprocessing": "/out",
     "Patient.parquet": ["pseudo_id", "Geboortejaar"],                                   flat
     "Labuitslag.csv":  ["pseudo_id", "BepalingCode", {"UitslagNumeriek": {"HB": "hb"}}, ["Datum"]],  expand
     "InitTransforms" / "PreTransforms": {column: {"func": name, "kwargs": {...}}},
     "MergedTransforms": {...}, "final_cols": [...],
     "ref_date": "OpnameDatum", "tuple_vals_after": [...], "tuple_vals_anybefore": [...]}

"conversions": the folder that convert_large() wrote its Parquet files and their map to; these are read instead.
A code map may also be a list of dictionaries. Transforms run in the order of the settings. With SOURCE
"TABLES", sources are catalogue tables {"table_name": ..., "columns": [...]}.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from cohortloom.operators import shape, transforms
from cohortloom.sources import tables


@dataclass(frozen=True)
class Source:
    name: str
    key: str
    columns: tuple[str, ...] = ()
    code_col: str | None = None
    value_col: str | None = None
    code_map: dict[str, str] = field(default_factory=dict)
    extra_cols: tuple[str, ...] = ()
    table: str | None = None

    @property
    def names(self) -> set[str]:
        """What a transform's key may name to apply to this source."""
        return {self.key, *self.columns, *self.code_map.values(), *([self.code_col, self.value_col] if self.code_col else [])}


@dataclass(frozen=True)
class Step:
    column: str
    func: str
    kwargs: dict


@dataclass(frozen=True)
class Settings:
    name: str
    sources: tuple[Source, ...]
    init: tuple[Step, ...]
    pre: tuple[Step, ...]
    merged: tuple[Step, ...]
    final: tuple[str, ...]
    ref_date: str
    after: tuple[str, ...]
    any_before: tuple[str, ...]
    folder: str
    output: str
    tables: bool
    conversions: str | None = None

    @property
    def key(self) -> str:
        return self.sources[0].key


def _source(name: str, spec: list | dict) -> Source:
    table = None
    if isinstance(spec, dict):
        table, spec = spec["table_name"], spec["columns"]
    key, rest = spec[0], spec[1:]
    at = next((i for i, x in enumerate(rest) if isinstance(x, dict)), None)
    if at is None:
        return Source(name, key, tuple(rest), table=table)
    if at != 1 or len(rest) > 3:
        raise ValueError(f"{name}: an expanded source is [key, code column, {{value column: codes}}, [extra columns]]")
    if len(rest[1]) != 1:
        raise ValueError(f"{name}: one value column is expected")
    ((value, codes),) = rest[1].items()
    if isinstance(codes, list):
        codes = {k: v for d in codes for k, v in d.items()}
    return Source(name, key, (), rest[0], value, {str(k): v for k, v in codes.items()}, tuple(rest[2]) if len(rest) == 3 else (), table)


def parse(settings: dict | str) -> Settings:
    """Checks everything that can be checked before any data is read."""
    if isinstance(settings, str):
        with open(settings) as f:
            settings = json.load(f)
    by_table = settings.get("SOURCE", "FILES").upper() != "FILES"
    is_source = lambda k, v: (isinstance(v, dict) and "table_name" in v) if by_table else any(k.lower().endswith(e) for e in tables.FORMATS)
    sources = tuple(_source(k, v) for k, v in settings.items() if is_source(k, v))
    if not sources:
        raise ValueError("no sources in the settings")
    steps = {}
    for part in ("InitTransforms", "PreTransforms", "MergedTransforms"):
        steps[part] = tuple(Step(c, s["func"], dict(s.get("kwargs", {}))) for c, s in (settings.get(part) or {}).items())
        for s in steps[part]:
            if s.func not in transforms.REGISTRY:
                raise ValueError(f"{part}: unknown transform {s.func!r} for {s.column}; known: {sorted(transforms.REGISTRY)}")
    return Settings(settings.get("name", "cohort"), sources, steps["InitTransforms"], steps["PreTransforms"], steps["MergedTransforms"], tuple(settings.get("final_cols", ())), settings.get("ref_date", "OpnameDatum"), tuple(settings.get("tuple_vals_after", ())), tuple(settings.get("tuple_vals_anybefore", ())), settings.get("absolute_path", ""), settings.get("preprocessing", f"data/{settings.get('name', 'cohort')}/preprocessing"), by_table, settings.get("conversions"))


def _apply(df: DataFrame, steps: tuple[Step, ...], names: set[str] | None) -> DataFrame:
    for s in steps:
        if names is None or s.column in names:
            kwargs = dict(s.kwargs)
            if s.func in ("map", "diff", "classify", "to_numeric", "bool_to_int") and names is None:
                kwargs.setdefault("out_col", s.column)
            df = transforms.apply(df, s.func, **kwargs)
    return df


def load_source(spark: SparkSession, settings: Settings, source: Source) -> DataFrame:
    if source.table:
        df = tables.read_table(spark, source.table)
    else:
        path = f"{settings.folder.rstrip('/')}/{source.name}" if settings.folder else source.name
        df = tables.read(spark, tables.converted(spark, path, settings.conversions))
    df = _apply(df, settings.init, source.names)
    if source.code_col:
        df = shape.expand(df, source.key, source.code_col, source.value_col, source.code_map, list(source.extra_cols))
    else:
        df = shape.subset(df, source.key, list(source.columns))
    return _apply(df, settings.pre, source.names)


def preprocess(spark: SparkSession, settings: Settings, strict_unique: bool = False) -> DataFrame:
    """One wide row per key of the first source, lazily; nothing is read before an action."""
    frames = [load_source(spark, settings, s) for s in settings.sources]
    frames = [f if s.key == settings.key else f.withColumnRenamed(s.key, settings.key) for f, s in zip(frames, settings.sources)]
    merged = _apply(shape.merge(frames, settings.key, strict_unique), settings.merged, None)
    return shape.subset(merged, settings.key, list(settings.final)) if settings.final else merged


def select_values(df: DataFrame, settings: Settings, time: str) -> DataFrame:
    """First values after, and earliest before, the reference date."""
    df = shape.as_of(df, list(settings.after), settings.ref_date, "after", time)
    return shape.as_of(df, list(settings.any_before), settings.ref_date, "anybefore", time)


def run(spark: SparkSession, raw: dict | str, time: str = "ts", reuse: bool = True) -> DataFrame:
    """Runs the stages; each is written under a hash of the settings and read again, and reused if it is there."""
    settings = parse(raw)
    for stage, make in (("preprocessed", lambda _: preprocess(spark, settings)), ("selected", lambda df: select_values(df, settings, time))):
        path = tables.stage_path(settings.output, f"{settings.name}_{stage}", [stage, raw, time])
        if not (reuse and tables.path_exists(spark, f"{path}/_SUCCESS")):
            tables.write_parquet(make(df if stage != "preprocessed" else None), path)
        df = spark.read.parquet(path)
    return df

