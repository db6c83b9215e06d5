"""The registry of named transforms, each DataFrame -> DataFrame and lazy.

All of them take the frame first and keyword arguments after. What is missing is NULL; rows whose id is
NULL leave a grouping transform; "first" always has a total order.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.codesets import codes_of, in_codes

Transform = Callable[..., DataFrame]
REGISTRY: dict[str, Transform] = {}


def register(name: str) -> Callable[[Transform], Transform]:
    """Adds a transform; users extend the registry in the same way."""

    def add(f: Transform) -> Transform:
        REGISTRY[name] = f
        return f

    return add


def apply(df: DataFrame, name: str, **kwargs) -> DataFrame:
    if name not in REGISTRY:
        raise KeyError(f"unknown transform {name!r}; known: {sorted(REGISTRY)}")
    return REGISTRY[name](df, **kwargs)


def _timestamp(c: Column, formats: list[str] | None = None) -> Column:
    """Lenient: what does not parse is NULL."""
    text = c.cast("string")
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats or []] or [F.try_to_timestamp(text)]
    return F.coalesce(*tries).cast("timestamp_ntz")


def _per_id(df: DataFrame, id_col: str, flag: Column, out: str) -> DataFrame:
    """One row per id: the largest of a 0/1 flag."""
    return df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.max(flag.cast("int")).alias(out))


@register("datetime")
def datetime(df: DataFrame, col_to_date: str, formats: list[str] | None = None) -> DataFrame:
    return df.withColumn(col_to_date, _timestamp(F.col(col_to_date), formats))


@register("keepfirst")
def keepfirst(df: DataFrame, sort_col: str, drop_col: str) -> DataFrame:
    """The row with the smallest sort_col (nulls last) of each drop_col; all other columns break ties. A minimum, so rows are reduced before the shuffle."""
    others = [c for c in df.columns if c not in (sort_col, drop_col) and not df.schema[c].dataType.simpleString().startswith("map")]
    order = F.struct(*[x for k, c in enumerate([sort_col, *others]) for x in (F.col(c).isNull().alias(f"n{k}"), F.col(c).alias(f"c{k}"))])
    return df.groupBy(F.col(drop_col).alias("__of")).agg(F.min_by(F.struct(*df.columns), order).alias("__row")).select("__row.*")


@register("datetime_keepfirst")
def datetime_keepfirst(df: DataFrame, col_to_date: str, sort_col: str, drop_col: str, formats: list[str] | None = None) -> DataFrame:
    return keepfirst(datetime(df, col_to_date, formats), sort_col, drop_col)


@register("diagnoseprocess_simple")
def diagnose(df: DataFrame, disease: str, search_col: str, id_col: str) -> DataFrame:
    """Whether any text of an id, in lower case, has the needle as it is given."""
    return _per_id(df, id_col, F.lower(F.coalesce(F.col(search_col).cast("string"), F.lit("0"))).contains(disease), disease)


@register("smokerprocess")
def smoker(df: DataFrame, smoking: str, id_col: str | None = None) -> DataFrame:
    return map_values(df.withColumn(smoking, F.coalesce(F.col(smoking).cast("string"), F.lit("missing"))), {"missing": 0, "Nee": 0, "N.b.": 0, "Ja": 1}, smoking)


def _medication(default: str) -> Transform:
    def flag(df: DataFrame, meds: str, out_col: str, id_col: str, code_set: str = default, match: str = "exact") -> DataFrame:
        code = F.when(F.col(meds).cast("string") == "NA", F.lit("missing")).otherwise(F.col(meds).cast("string"))
        return _per_id(df, id_col, in_codes(code, codes_of([code_set])[code_set], match), out_col)

    return flag


register("ace")(_medication("ace"))
register("beta")(_medication("beta"))


@register("code_flag")
def code_flag(df: DataFrame, input_col: str, codes: list[str], out_col: str, id_col: str, match: str = "exact") -> DataFrame:
    """The shape of ace and beta for any list of codes."""
    return _per_id(df, id_col, in_codes(F.col(input_col), codes, match), out_col)


@register("classify")
def classify(df: DataFrame, classification_map: list[str] | dict[str, list[str]], input_col: str, out_col: str, id_col: str | None = None, match: str = "exact", multi: bool = False) -> DataFrame:
    """The first class that holds the code, else 'Other'; with `multi`, an array of all of them."""
    sets = classification_map if isinstance(classification_map, dict) else codes_of(classification_map)
    hit = {name: in_codes(F.col(input_col), codes, match) for name, codes in sets.items()}
    if multi:
        return df.withColumn(out_col, F.array_compact(F.array(*[F.when(h, F.lit(n)) for n, h in hit.items()])))
    first = reduce(lambda rest, nh: F.when(nh[1], F.lit(nh[0])).otherwise(rest), reversed(list(hit.items())), F.lit("Other"))
    return df.withColumn(out_col, first)


@register("chain")
def chain(df: DataFrame, funcs: list[str], kwargs: list[dict], merge_id: str) -> DataFrame:
    """Several transforms of the same frame, joined in full on merge_id."""
    parts = [apply(df, f, **k) for f, k in zip(funcs, kwargs, strict=True)]
    return reduce(lambda a, b: a.join(b, merge_id, "full_outer"), parts)


@register("diff")
def diff(df: DataFrame, start: str, end: str, out_col: str, level: str | None = None) -> DataFrame:
    """end - start: an interval, or with level 'year' the difference of calendar years (numbers are years already)."""
    if level != "year":
        return df.withColumn(out_col, F.col(end) - F.col(start))
    year = lambda c: F.year(c) if "timestamp" in dict(df.dtypes)[c] or dict(df.dtypes)[c] == "date" else F.col(c)
    return df.withColumn(out_col, (year(end) - year(start)).cast("long"))


def whole_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down (-23.5 hours are -1)."""
    return F.floor(F.timestamp_diff("MICROSECOND", start, end) / F.lit(86_400_000_000.0)).cast("long")


@register("map")
def map_values(df: DataFrame, map: dict, out_col: str) -> DataFrame:  # noqa: A002
    """Values by a dictionary, compared as text; what is not in it is NULL."""
    table = F.create_map(*[F.lit(x) for k, v in map.items() for x in (str(k), v)])
    return df.withColumn(out_col, F.try_element_at(table, F.col(out_col).cast("string")))


@register("bool_to_int")
def bool_to_int(df: DataFrame, columns: list[str], fill_na: bool = False, out_col: str | None = None) -> DataFrame:
    value = lambda c: F.coalesce(F.col(c).cast("int"), F.lit(0)) if fill_na else F.col(c).cast("int")
    return df.withColumns({(out_col or c) if len(columns) == 1 else c: value(c) for c in columns})


@register("to_numeric")
def to_numeric(df: DataFrame, columns: list[str], errors: str = "coerce", out_col: str | None = None) -> DataFrame:
    """Doubles; with errors='coerce' what is no number is NULL, with 'raise' it is an error."""
    value = lambda c: F.col(c).try_cast("double") if errors == "coerce" else F.col(c).cast("double")
    made = {(out_col or c) if len(columns) == 1 else c: value(c) for c in columns}
    return df.withColumns({k: F.when(~F.isnan(v), v) for k, v in made.items()})


@register("fillna")
def fillna(df: DataFrame, values: dict) -> DataFrame:
    return df.na.fill(values)


@register("dropna")
def dropna(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop(subset=subset)


@register("pattern_match")
def pattern_match(df: DataFrame, search_col: str, pattern_dict: dict[str, str], id_col: str, case_sensitive: bool = False, group_by_id: bool = True, order_col: str | None = None) -> DataFrame:
    """A 0/1 column for each pattern; by id, its largest value, and other columns of the first row (by order_col)."""
    text = F.coalesce(F.col(search_col).cast("string"), F.lit(""))
    flags = {out: text.rlike(p if case_sensitive else f"(?i){p}").cast("int") for out, p in pattern_dict.items()}
    marked = df.withColumns(flags)
    if not group_by_id:
        return marked
    rest = [c for c in df.columns if c not in (id_col, search_col)]
    order = F.struct(F.col(order_col), *[c for c in rest if c != order_col]) if order_col else None
    first = lambda c: F.min_by(c, order) if order_col else F.min(c)
    return marked.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*[F.max(f).alias(f) for f in flags], *[first(c).alias(c) for c in rest])


def plausible(df: DataFrame, part_of_name: str = "BMI", below: float = 100) -> DataFrame:
    """Rows whose first column with that name part is a number below the limit; without such a column, all rows."""
    found = [c for c in df.columns if part_of_name in c]
    return df.where(F.col(found[0]).try_cast("double") < below) if found else df


def intervals_to_days(df: DataFrame) -> DataFrame:
    """Day-time intervals become whole days, rounded down."""
    start = F.lit("1970-01-01").cast("timestamp_ntz")
    return df.withColumns({c: whole_days(start, start + F.col(c)) for c, t in df.dtypes if t.startswith("interval day")})


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c, t in df.dtypes if t.startswith("decimal")})


def mask_tokens(df: DataFrame, tokens: tuple[str, ...] = ("", "_", "__", "___")) -> DataFrame:
    """NULL for tokens that stand for missing, in all text columns."""
    return df.withColumns({c: F.when(~F.col(c).isin(*tokens), F.col(c)) for c, t in df.dtypes if t == "string"})
