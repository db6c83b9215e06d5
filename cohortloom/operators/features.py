"""Scaling, encoding, imputing and splitting; fitted parameters are a small table that can be written and read."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom.operators import stats
from cohortloom.operators.transforms import mask_tokens
from cohortloom.sources import tables


#: The seeded order of a sample is a multiplication modulo this prime.
SAMPLE_PRIME = 2_147_483_647


def fit(df: DataFrame, columns: list[str], ddof: int = 1) -> DataFrame:
    """column, mean, scale, median (of the values as they are). A row for each column: it can be written, and read for new rows."""
    spread = F.stddev_samp if ddof else F.stddev_pop
    row = df.agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (("m", F.avg), ("s", spread))]).first()
    medians = stats.exact_quantiles(df, columns, [0.5])
    rows = [(c, row[f"m_{i}"], row[f"s_{i}"] if (row[f"s_{i}"] or 0) > 0 else 1.0, medians[c][0]) for i, c in enumerate(columns)]
    return df.sparkSession.createDataFrame(rows, "column string, mean double, scale double, median double")


def scale(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Standard scores. fitted has a row for each column, so it comes to the driver."""
    by = {r["column"]: r for r in fitted.collect()}
    return df.withColumns({c: (F.col(c) - F.lit(r["mean"])) / F.lit(r["scale"]) for c, r in by.items() if c in df.columns})


def encode(df: DataFrame, categories: dict[str, list]) -> DataFrame:
    """Two declared values become 0 and 1; any other number of them a 0/1 column each."""
    for c, values in categories.items():
        if len(values) == 2:
            code = F.when(F.col(c) == F.lit(values[0]), 0).when(F.col(c) == F.lit(values[1]), 1)
            df = df.withColumn(c, code)
        else:
            df = df.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for v in values}).drop(c)
    return df


def impute_median(df: DataFrame, columns: list[str], fitted: dict[str, float | None] | None = None) -> DataFrame:
    """Exact medians of all columns, or fitted ones, are filled in."""
    medians = fitted or {c: q[0] for c, q in stats.exact_quantiles(df, columns, [0.5]).items()}
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(medians[c]).cast("double")) for c in columns})


def impute_mean(df: DataFrame, columns: list[str]) -> DataFrame:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(row[c]).cast("double")) for c in columns})


def impute_scale_categorize(df: DataFrame, key: str, categories: dict[str, list] | None = None, do_scale: bool = True, do_impute: bool = True, ddof: int = 1, store: str | None = None) -> DataFrame:
    """Mask, cast, scale, encode, impute: scaling comes before imputing, and encoded columns are imputed too.

    store: a folder for what is fitted. If it is there already, it is used instead of being fitted anew, so that new rows are
    scaled and imputed as those it was fitted on.
    """
    categories, spark = categories or {}, df.sparkSession
    restored = store is not None and tables.path_exists(spark, f"{store}/imputer")
    df = mask_tokens(df)
    numeric = [c for c in df.columns if c != key and c not in categories]
    df = df.withColumns({c: F.col(c).try_cast("double") for c in numeric})
    if do_scale and numeric:
        fitted = spark.read.parquet(f"{store}/scaler") if restored else fit(df, numeric, ddof)
        if store and not restored:
            fitted.coalesce(1).write.mode("overwrite").parquet(f"{store}/scaler")
        df = scale(df, fitted)
    df = encode(df, categories)
    if not do_impute:
        return df
    columns = [c for c in df.columns if c != key]
    if restored:
        medians = {r["column"]: r["median"] for r in spark.read.parquet(f"{store}/imputer").collect()}
    else:
        medians = {c: q[0] for c, q in stats.exact_quantiles(df, columns, [0.5]).items()}
        if store:
            spark.createDataFrame(list(medians.items()), "column string, median double").coalesce(1).write.mode("overwrite").parquet(f"{store}/imputer")
    return impute_median(df, columns, medians)


def split(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> DataFrame:
    """Adds is_test by the key alone: the same rows on every run, cluster and partitioning."""
    return df.withColumn("is_test", F.pmod(F.col(key) * 7919 + seed, F.lit(100)) < test_percent)


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str | None = None) -> DataFrame:
    """Exactly n rows (all, if there are fewer) in a seeded order of the key, or of the rows: the same whatever the partitioning."""
    if key is None:
        return df.orderBy(F.xxhash64(F.lit(seed), *df.columns), *df.columns).limit(n)
    mixed = F.pmod(F.pmod(F.col(key), F.lit(SAMPLE_PRIME)) * 48_271 + seed, F.lit(SAMPLE_PRIME))
    return df.orderBy(mixed, key).limit(n)
