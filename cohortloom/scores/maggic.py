"""The MAGGIC heart failure risk score as one column expression."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

INPUTS = ("sex", "smoking", "diabetes", "copd", "recent_hf", "betablocker", "ace_arb", "lvef", "nyha", "creatinine", "bmi", "sbp", "age")

# Risk of death for scores 0 to 50.
RISK_3_YEARS = [
    0.039, 0.043, 0.048, 0.052, 0.058, 0.063, 0.070, 0.077, 0.084, 0.092, 0.102, 0.111, 0.122, 0.134, 0.146, 0.160, 0.175,
    0.191, 0.209, 0.227, 0.247, 0.269, 0.292, 0.316, 0.342, 0.369, 0.397, 0.427, 0.458, 0.490, 0.523, 0.556, 0.590, 0.625,
    0.658, 0.692, 0.725, 0.756, 0.787, 0.815, 0.842, 0.866, 0.889, 0.908, 0.926, 0.941, 0.953, 0.964, 0.973, 0.980, 0.985,
]
RISK_1_YEAR = [
    0.015, 0.016, 0.018, 0.020, 0.022, 0.024, 0.027, 0.029, 0.032, 0.036, 0.039, 0.043, 0.048, 0.052, 0.058, 0.063, 0.070,
    0.077, 0.084, 0.093, 0.102, 0.111, 0.122, 0.134, 0.147, 0.160, 0.175, 0.186, 0.202, 0.219, 0.237, 0.256, 0.292, 0.316,
    0.342, 0.369, 0.398, 0.427, 0.458, 0.490, 0.523, 0.557, 0.591, 0.625, 0.659, 0.692, 0.725, 0.757, 0.787, 0.816, 0.842,
]
# Bands as (below, points), the last one open, and points by stratum of the ejection fraction.
LVEF = [(20, 7), (25, 6), (30, 5), (35, 3), (40, 2), (None, 0)]
CREATININE = [(90, 0), (110, 1), (130, 2), (150, 3), (170, 4), (210, 5), (250, 6), (None, 8)]
BMI = [(15, 6), (20, 5), (25, 3), (30, 2), (None, 0)]
STRATA = (30, 40)
SBP = {0: [(110, 5), (120, 4), (130, 3), (140, 2), (150, 1), (None, 0)], 1: [(110, 3), (120, 2), (130, 1), (None, 0)], 2: [(110, 2), (120, 1), (None, 0)]}
AGE_BELOW = [55, 60, 65, 70, 75, 80, None]
AGE = {0: [0, 1, 2, 4, 6, 8, 10], 1: [0, 2, 4, 6, 8, 10, 13], 2: [0, 3, 5, 7, 9, 12, 15]}
NYHA = {1: 0, 2: 2, 3: 6, 4: 8}
POINTS = {"smoking": 1, "diabetes": 3, "copd": 2, "recent_hf": 2, "betablocker": 3, "ace_arb": 1}


def band(value: Column, bands: list[tuple]) -> Column:
    out = F.lit(bands[-1][1])
    for below, points in reversed(bands[:-1]):
        out = F.when(value < below, points).otherwise(out)
    return out


def maggic(df: DataFrame, columns: dict[str, str], published: bool = False) -> DataFrame:
    """Adds maggic, maggic_risk_3y and maggic_risk_1y; any missing input makes all three missing.

    published=True gives the points for NOT taking a beta blocker or ACE inhibitor / ARB, and for heart
    failure that is not recent, as the published score does.
    """
    if missing := [i for i in INPUTS if i not in columns]:
        raise ValueError(f"no columns for {missing}")
    if missing := [c for c in columns.values() if c not in df.columns]:
        raise ValueError(f"no columns {missing}")
    v = {i: F.when(~F.isnan(F.col(columns[i]).cast("double")), F.col(columns[i]).cast("double")) for i in INPUTS}
    total = (v["sex"] == 0).cast("int")
    for name, points in POINTS.items():
        on = 0 if published and name in ("betablocker", "ace_arb", "recent_hf") else 1
        total += F.when(v[name] == on, points).otherwise(0)
    by_stratum = lambda f: F.when(v["lvef"] < STRATA[0], f(0)).when(v["lvef"] < STRATA[1], f(1)).otherwise(f(2))
    nyha = F.lit(0)
    for k, points in NYHA.items():
        nyha = F.when(v["nyha"] == k, points).otherwise(nyha)
    total += band(v["lvef"], LVEF) + nyha + band(v["creatinine"], CREATININE) + band(v["bmi"], BMI)
    total += by_stratum(lambda s: band(v["sbp"], SBP[s])) + by_stratum(lambda s: band(v["age"], list(zip(AGE_BELOW, AGE[s]))))
    known = ~sum((v[i].isNull().cast("int") for i in INPUTS), F.lit(0)).cast("boolean")
    df = df.withColumn("maggic", F.when(known, total.cast("long")))
    risk = lambda table: F.get(F.array(*[F.lit(x) for x in table]), F.col("maggic").cast("int"))
    return df.withColumns({"maggic_risk_3y": risk(RISK_3_YEARS), "maggic_risk_1y": risk(RISK_1_YEAR)})
