"""Boosted stump scores (the MARKER-HF form) with the trees as data.

The coefficients of MARKER-HF carry no clear licence, so they are not part of this repository: pass
them as a table. A tree is (weight, left, right, value): `left` and `right` are conditions (input, 'lt'
or 'ge', threshold). A tree of depth one gives -1 if its first condition holds, else 1; with a second
condition in `both` the -1 needs both, in `either` one of the two is enough; a constant tree has none.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

INPUTS = ("bpdias", "creatn", "bun", "hgb", "wbc", "plt", "alb", "rdw")
# The range of each input, outside of which there is no score.
RANGES = {"bpdias": (20, 120), "creatn": (0, 25), "bun": (0, 160), "hgb": (2, 20), "wbc": (0, 40), "plt": (0, 1500), "alb": (0, 6), "rdw": (10, 30)}
OUT_OF_RANGE = -99.0
#: Most trees whose conditions are compiled one by one.
COMPILED_TREES = 25


def _compiled(inputs: list[Column], weight: float, kind: str, i: int, ge: bool, at: float, j: int, ge2: bool, at2: float) -> Column:
    first, second = (inputs[i] >= at if ge else inputs[i] < at), (inputs[j] >= at2 if ge2 else inputs[j] < at2)
    low = {"one": first, "both": first & second, "either": first | second}.get(kind, F.lit(False))
    return F.when(low, F.lit(-weight)).otherwise(F.lit(weight))


def _votes(inputs: list[Column], trees: list[tuple]) -> Column:
    """The same for any number of trees, in Arrow batches."""

    @F.pandas_udf(DoubleType())
    def votes(*x: pd.Series) -> pd.Series:
        x = [v.to_numpy(float) for v in x]
        total = np.zeros(len(x[0]))
        for weight, kind, i, ge, at, j, ge2, at2 in trees:
            first, second = (x[i] >= at if ge else x[i] < at), (x[j] >= at2 if ge2 else x[j] < at2)
            low = {"one": first, "both": first & second, "either": first | second}.get(kind, False)
            total += np.where(low, -weight, weight)
        return pd.Series(total)

    return votes(*inputs)


def stump_score(df: DataFrame, columns: dict[str, str], trees: list[tuple], scale: float, out: str = "marker_hf", check_ranges: bool = True) -> DataFrame:
    """Adds the weighted sum of trees over `scale`; -99 if an input is missing or out of range.

    Up to COMPILED_TREES trees are a sum of compiled conditions; as hundreds of conditions would pass the size that is compiled,
    more are summed over Arrow batches.
    """
    inputs = [F.when(~F.isnan(F.col(columns[i]).cast("double")), F.col(columns[i]).cast("double")) for i in INPUTS]
    if len(trees) <= COMPILED_TREES:
        total = sum((_compiled(inputs, *tree) for tree in trees), F.lit(0.0)) / F.lit(scale)
    else:
        total = _votes(inputs, trees) / F.lit(scale)
    good = reduce(lambda a, b: a & b, [v.isNotNull() for v in inputs])
    if check_ranges:
        for i, name in enumerate(INPUTS):
            good = good & inputs[i].between(*RANGES[name])
    return df.withColumn(out, F.when(F.coalesce(good, F.lit(False)), total).otherwise(F.lit(OUT_OF_RANGE)))
