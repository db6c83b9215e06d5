"""Projection, expansion of long tables, as-of selection and merging by key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def subset(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The key and the columns; columns that are not there are an error up front."""
    if missing := [c for c in [key, *columns] if c not in df.columns]:
        raise ValueError(f"no columns {missing} among {df.columns}")
    return df.select(key, *[c for c in columns if c != key])


def literals_like(df: DataFrame, column: str, values: list[str]) -> Column:
    """column in values, with the values cast to the column's type if all can be, so that the scan can filter."""
    kind = dict(df.dtypes)[column]
    if kind in ("int", "bigint", "smallint", "tinyint") and all(v.lstrip("-").isdigit() for v in values):
        return F.col(column).isin(*[int(v) for v in values])
    return F.col(column).cast("string").isin(*values)


def expand(df: DataFrame, key: str, code_col: str, value_col: str, code_map: dict[str, str], extra_cols: list[str] | None = None) -> DataFrame:
    """A long table as one row per key with an array of (value, extra...) for each name of the code map.

    Arrays are in the order of the extra columns, then the value. The names are given, so nothing has to be
    looked up before the pivot, and aggregation starts before the shuffle.
    """
    extra = extra_cols or []
    code_map = {str(k): v for k, v in code_map.items()}
    names = list(dict.fromkeys(code_map.values()))
    name = F.create_map(*[F.lit(x) for kv in code_map.items() for x in kv])[F.col(code_col).cast("string")]
    entry = F.struct(*[F.col(c) for c in extra], F.col(value_col).alias("value"))
    rows = df.where(literals_like(df, code_col, list(code_map)) & F.col(key).isNotNull()).select(key, name.alias("__name"), entry.alias("__entry"))
    lists = [F.array_sort(F.collect_list(F.when(F.col("__name") == n, F.col("__entry")))) for n in names]
    # an id without a code has NULL there, not an empty array
    return rows.groupBy(key).agg(*[F.when(F.size(a) > 0, a).alias(n) for a, n in zip(lists, names)])


#: An entry (value, date, ...) of a stored list; values and dates may be quoted.
STORED_ENTRY = r"""\(\s*('(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|[^\s,()'"]+)\s*,\s*('[^']*'|"[^"]*"|[^\s,()'"]+)[^()]*\)"""


def stored_entries(cell: Column, time: str) -> Column:
    """The entries of a list that was stored as text, like [(7.1, '2020-01-31'), ...], as an array of (value, time).

    Entries whose value is nan, NaN or None are left out. If one value of a cell is text, all of them are 1.0, as a measurement that is
    there. A date that does not parse is NULL.
    """
    values, dates = (F.regexp_extract_all(cell, F.lit(STORED_ENTRY), F.lit(k)) for k in (1, 2))
    bare = lambda t: F.regexp_replace(t, "^['\"]|['\"]$", "")
    entries = F.filter(F.arrays_zip(values.alias("v"), dates.alias("t")), lambda e: ~F.lower(e["v"]).isin("nan", "none", "'nan'"))
    text = F.exists(entries, lambda e: F.coalesce(e["v"].try_cast("double"), F.lit(float("nan"))) != F.coalesce(e["v"].try_cast("double"), F.lit(0.0)))
    value = lambda e: F.when(text, F.lit(1.0)).otherwise(e["v"].try_cast("double"))
    return F.transform(entries, lambda e: F.struct(value(e).alias("value"), F.try_to_timestamp(bare(e["t"])).cast("timestamp_ntz").alias(time)))


def _selected(entries: Column, keep, is_text: bool) -> Column:
    found = F.get(F.filter(entries, keep), F.lit(0))
    return F.when(found.isNotNull(), F.lit(1.0)) if is_text else found["value"].cast("double")


def as_of(df: DataFrame, columns: list[str], ref: str, kind: str, time: str) -> DataFrame:
    """For each array column its first value at or after ("after") or its earliest before ("anybefore") the reference.

    Without a reference it is the earliest value. Entries without value or time do not count; text
    values count as 1.0; a text column holds stored lists (stored_entries) or numbers; a column of another type passes through.
    """
    if kind not in ("after", "anybefore"):
        raise ValueError("kind is 'after' or 'anybefore'")
    made = {}
    for c in columns:
        out = f"{c}_first_after" if kind == "after" else f"{c}_any_before"
        type_, stored = df.schema[c].dataType, F.col(c)
        if type_.typeName() == "string":
            stored = stored_entries(F.col(c), time)
        elif type_.typeName() != "array":
            made[out] = F.col(c).cast("double")
            continue
        is_text = type_.typeName() == "array" and type_.elementType["value"].dataType.typeName() == "string"
        use = F.filter(stored, lambda t: t["value"].isNotNull() & t[time].isNotNull())
        ordered = F.array_sort(F.transform(use, lambda t: F.struct(t[time].alias(time), t["value"].alias("value"))))
        at = F.col(ref)
        keep = (lambda t: at.isNull() | (t[time] >= at)) if kind == "after" else (lambda t: at.isNull() | (t[time] < at))
        made[out] = _selected(ordered, keep, is_text)
        if type_.typeName() == "string":
            made[out] = F.coalesce(F.col(c).try_cast("double"), made[out])  # a cell that is a number passes through
    return df.withColumns(made)


def as_of_fused(long: DataFrame, refs: DataFrame, key: str, code_col: str, value_col: str, time: str, ref: str, after: dict[str, str], before: dict[str, str], counts: dict[str, str] | None = None) -> DataFrame:
    """The same straight from the long table, without arrays: partial minima by key, one shuffle.

    after, before: code -> output column; counts: code -> a column with the number of its rows. refs has one row per key with the reference.
    """
    counts = counts or {}
    codes = [str(c) for c in {**after, **before, **counts}]
    whole = F.col(value_col).isNotNull() & F.col(time).isNotNull()
    rows = long.where(literals_like(long, code_col, codes) & (F.lit(True) if counts else whole)).join(refs.select(key, ref), key, "left")
    order, code = F.struct(time, value_col), F.col(code_col).cast("string")
    late = F.col(ref).isNull() | (F.col(time) >= F.col(ref))
    early = F.col(ref).isNull() | (F.col(time) < F.col(ref))
    value = F.col(value_col).cast("double")
    pick = lambda c, cond: F.min_by(F.when((code == str(c)) & cond & whole, value), F.when((code == str(c)) & cond & whole, order))
    found = [*[pick(c, late).alias(o) for c, o in after.items()], *[pick(c, early).alias(o) for c, o in before.items()], *[F.count_if(code == str(c)).alias(o) for c, o in counts.items()]]
    return rows.groupBy(key).agg(*found)


#: Visit ids that never take part in a merge, whatever their case.
VISIT_IDS = ("patientcontactid",)


def merge(frames: list[DataFrame], key: str, strict_unique: bool = False) -> DataFrame:
    """The first frame with all others joined to it from the left on the key alone.

    Shared other columns are an error rather than silent join keys. A repeated key multiplies rows, as a
    join does, unless strict_unique.
    """
    frames = [f.drop(*[c for c in f.columns if c.lower() in VISIT_IDS]) for f in frames]
    if strict_unique:
        frames = [frames[0], *[f.where(F.col(key).isNotNull()).groupBy(key).agg(*[_single(c) for c in f.columns if c != key]) for f in frames[1:]]]

    def join(a: DataFrame, b: DataFrame) -> DataFrame:
        if shared := (set(a.columns) & set(b.columns)) - {key}:
            raise ValueError(f"columns {sorted(shared)} are in several sources; rename them first")
        return a.join(b, key, "left")

    return reduce(join, frames)


def _single(c: str) -> Column:
    return F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("repeated key"))).otherwise(F.first(c)).alias(c)
