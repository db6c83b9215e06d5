"""Named sets of ATC and ICD-10 codes, and their match by equality or by prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def _range(stem: str, first: int, last: int, without: tuple[int, ...] = ()) -> list[str]:
    """Codes with two digits after the stem."""
    return [f"{stem}{n:02d}" for n in range(first, last + 1) if n not in without]


# Medication sets (ATC).
_MEDICATION: dict[str, list[str]] = {
    "ace": _range("C09AA", 1, 16) + _range("C09BA", 1, 15) + _range("C09BB", 2, 12) + _range("C09BX", 1, 5),
    "arb": _range("C09CA", 1, 10) + _range("C09DA", 1, 10) + _range("C09DB", 1, 9) + _range("C09DX", 1, 7, (4,)),
    "ras": ["C09AA", "C09B", "C09CA", "C09D", "C09X"],
    "arni": ["C09DX04"],
    "beta": ["C07AB03", "C07AB07", "C07AB02", "C07AA05", "C07AG02", "C07AB12"],
    "beta_all": ["C07AA", "C07AB", "C07AG", "C07BA", "C07BB", "C07BG", "C07CA", "C07CB", "C07CG", "C07DA", "C07DB", "C07DG", "C07FB", "C07FX"],
    "mra": _range("C03DA", 1, 5) + _range("C03EA", 1, 14) + ["C03EB01", "C03EB02"],
    "diuretics": ["C03A", "C03C", "C03D"],
    "loop_diuretics": _range("C03CA", 1, 4) + ["C03CB01", "C03CB02", "C03CC01", "C03CC02", "C03CX01"],
    "thiazide_diuretics": ["C03A"],
    "sglt2_hf": ["A10BX09", "A10BK01", "A10BX12", "A10BK03"],
    "sglt2_other": ["A10BX11", "A10BK02", "A10BK04", "A10BK05", "A10BK06"],
    "anticoagulant": ["B01AA", "B01AB", "B01AX05", "B01AX04", "B01AF", "B01AE", "B01AX01", "B01AD12", "B01AB02"],
    "antiplatelet": ["B01AC13", "B01AC17", "B01AC16", "B01AC04", "B01AC22", "B01AC05", "B01AC25", "B01AC24", "B01AC19", "B01AC11", "B01AC21", "B01AC06", "B01AC15", "B01AC08", "B01AC10", "B01AC18", "B01AC07", "B01AC03", "B01AC23", "B01AC01", "B01AC02", "B01AC26"],
    "statins": ["C10AA", "C10BA", "C10BX"],
    "digitalis": _range("C01AA", 1, 8),
    "ivabradine": ["C01EB17"],
    "ccb": ["C08C", "C08D", "C08E", "C08GA"],
}

# Conditions and outcomes (ICD-10). Entries without a full code are meant for match='prefix'.
_FAILURE = ["I50.1", "I50.20", "I50.21", "I50.22", "I50.23", "I50.30", "I50.31", "I50.32", "I50.33", "I50.40", "I50.41", "I50.42", "I50.43", "I50.9"]
_ANGINA = ["I20.0", "I20.1", "I20.2", "I20.8", "I20.9"]
_INFARCTION = ["I21.1", "I21.2", "I21.9", "I21.11", "I21.19", "I21.21", "I21.29", "I21.3", "I21.4", "I21.A1", "I22.0", "I22.1", "I22.2", "I22.8", "I22.9"]
_STROKE = ["I61", "I62", "I63", "I64", "I60"]
_FAILURE_STAY = [*_FAILURE, "I11.0", "I13.0", "I13.2", "I26.0", "I09.81", "I97.13"]
_CONDITIONS: dict[str, list[str]] = {
    "heart_failure": [*_FAILURE, "I11.0", "I13.0", "I13.2", "I26.0", "I25.5", "I09.81", "I97.13"],
    "af": ["I48.0", "I48.11", "I48.19", "I48.20", "I48.21", "I48.3", "I48.4", "I48.91", "I48.92"],
    "angina": _ANGINA,
    "acute_mi": _INFARCTION,
    "chronic_ischemic_hd": [
        *_ANGINA,
        *_INFARCTION,
        "I23.0", "I23.1", "I23.2", "I23.3", "I23.4", "I23.5", "I23.6", "I23.7", "I23.8", "I24.0", "I24.1", "I24.8", "I24.9",
        "I25.10", "I25.110", "I25.111", "I25.118", "I25.119", "I25.2", "I25.3", "I25.5", "I25.6", "I25.8", "I25.9",
    ],
    "hypertension": ["I10", "I11.0", "I11.9", "I12.0", "I12.9", "I13.0", "I13.10", "I13.11", "I13.2", "I15.0", "I15.1", "I15.2", "I15.8", "I15.9"],
    "stroke": _STROKE,
    "tia": ["G45.8", "G45.9", "I63.9"],
    "pad": ["I73", "I70", "I71", "I72", "I74", "I75", "I77", "I78", "I79"],
    "cardiomyopathy": ["I42", "I43"],
    "dilated_cm": ["I42.0"],
    "valvular": ["A520", "I05", "I06", "I07", "I08", "I09.1", "I09.8", "I34", "I35", "I36", "I37", "I38", "I39", "Q23.0", "Q23.1", "Q23.2", "Q23.3", "Z95.2", "Z95.3", "Z95.4"],
    "diabetes": [
        "E10.9", "E10.10", "E10.21", "E10.22", "E10.29", "E10.40", "E10.42", "E10.43", "E10.49", "E10.51", "E10.59", "E10.621", "E10.622", "E10.628", "E10.630", "E10.638", "E10.641", "E10.649", "E10.65", "E10.69", "E10.8",
        "E11.9", "E11.0", "E11.1", "E11.10", "E11.11", "E11.21", "E11.22", "E11.29", "E11.311", "E11.319", "E11.321", "E11.329", "E11.331", "E11.339", "E11.351", "E11.359",
        "E11.40", "E11.41", "E11.42", "E11.43", "E11.44", "E11.49", "E11.51", "E11.52", "E11.59", "E11.610", "E11.618", "E11.620", "E11.621", "E11.622", "E11.628", "E11.630", "E11.638", "E11.641", "E11.649", "E11.65", "E11.69", "E11.8",
        "E12.9", "E12.0", "E12.1", "E12.10", "E12.11", "E12.21", "E12.22", "E12.29", "E12.40", "E12.41", "E12.42", "E12.43", "E12.44", "E12.49", "E12.51", "E12.52", "E12.59", "E12.621", "E12.622", "E12.628", "E12.641", "E12.649", "E12.65", "E12.69", "E12.8",
        "E13.9", "E13.0", "E13.1", "E13.10", "E13.11", "E13.21", "E13.22", "E13.29", "E13.40", "E13.41", "E13.42", "E13.43", "E13.44", "E13.49", "E13.51", "E13.52", "E13.59", "E13.621", "E13.622", "E13.628", "E13.641", "E13.649", "E13.65", "E13.69", "E13.8",
        "E14.9", "E14.0", "E14.1", "E14.10", "E14.11", "E14.21", "E14.22", "E14.29", "E14.40", "E14.41", "E14.42", "E14.43", "E14.44", "E14.49", "E14.51", "E14.52", "E14.59", "E14.621", "E14.622", "E14.628", "E14.641", "E14.649", "E14.65", "E14.69", "E14.8",
    ],
    "t2dm": ["E11.9", "E11.21", "E11.22", "E11.29", "E11.31", "E11.32", "E11.33", "E11.34", "E11.35", "E11.36", "E11.39", "E11.40", "E11.41", "E11.42", "E11.43", "E11.44", "E11.49", "E11.51", "E11.52", "E11.59", "E11.65", "E11.69", "E11.8"],
    "ckd": ["N18.1", "N18.2", "N18.3", "N18.30", "N18.31", "N18.32", "N18.4", "N18.5", "N18.6", "N18.9", "N19"],
    "copd": ["J40", "J41", "J42", "J43", "J44"],
    "depression": ["F20.4", "F31.3", "F31.4", "F31.5", "F32", "F33", "F34.1", "F41.2", "F43.2"],
    "dementia": ["F00", "F01", "F02", "F03", "F05.1", "G30", "G31.1"],
    "liver_disease": ["B18", "I85", "I86.4", "I98.2", "K70", "K71.1", "K71.3", "K71.4", "K71.5", "K71.7", "K72", "K73", "K74", "K76.0", "K76.2", "K76.3", "K76.4", "K76.5", "K76.6", "K76.7", "K76.8", "K76.9", "Z94.4"],
    "hf_hosp": _FAILURE_STAY,
    "mace": [*_INFARCTION, *_STROKE, *_FAILURE_STAY],
}
CODE_SETS: dict[str, list[str]] = _MEDICATION | _CONDITIONS


def codes_of(names: list[str], more: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """The named sets, in order; unknown names are an error when the settings are read, not when rows are."""
    known = CODE_SETS | (more or {})
    if unknown := [n for n in names if n not in known]:
        raise ValueError(f"unknown code sets {unknown}; known: {sorted(known)}")
    return {n: known[n] for n in names}


def in_codes(code: Column, codes: list[str], match: str = "exact") -> Column:
    """Whether a code is in a set, or begins with one of its entries; a null code is in none."""
    text = code.cast("string")
    if match == "exact":
        return F.coalesce(text.isin(*codes), F.lit(False))
    if match != "prefix":
        raise ValueError("match is 'exact' or 'prefix'")
    return F.coalesce(reduce(lambda a, b: a | b, [text.startswith(c) for c in codes]), F.lit(False))
