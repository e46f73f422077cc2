"""Wetland class schemes as Column expressions. The code lists and thresholds are fixed values of the schemes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: code parts of open water, with and without deep lakes
WATER = ("L1", "L2", "PUB", "PUS", "PAB", "R2", "R3")
WATER_NO_LAKES = ("L2", "PUB", "PUS", "PAB", "R2", "R3")
# fixed values: class names and the codes they shorten to
SHORT = {"Emergent": "EMW", "Forested": "FSW", "ScrubShrub": "SSW", "OpenWater": "OWW", "UPL": "UPL"}
ADK_UPLAND = ("OW", "AB", "US", "UB", "SB", "RB")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def has(col: Column | str, *parts: str) -> Column:
    return reduce(lambda a, b: a | b, [_c(col).contains(p) for p in parts])


def first_match(rules: list[tuple[Column, Column | str]], default: Column | str | None) -> Column:
    """The value of the first rule whose condition holds; an unknown condition counts as false."""
    out = None
    for test, value in rules:
        value = F.lit(value) if isinstance(value, str) else value
        out = F.when(test, value) if out is None else out.when(test, value)
    return out if default is None else out.otherwise(F.lit(default) if isinstance(default, str) else default)


def drop_codes(df: DataFrame, col: str, pattern: str, and_where: Column | None = None) -> DataFrame:
    """Drop rows whose code matches (and that meet a further condition); rows without a code go too."""
    hit = F.col(col).rlike(pattern)
    return df.filter(F.col(col).isNotNull() & ~(hit if and_where is None else hit & and_where))


def classify_nwi(col: Column | str, variant: str = "standard") -> Column:
    """Inventory code to class name. Variants: ``no_lakes`` leaves deep lakes out of open water, ``ssw_mixed`` calls
    scrub with forest scrub, ``mixed`` keeps names for mixtures."""
    pfo, pss, pem = (has(col, p) for p in ("PFO", "PSS", "PEM"))
    fo, ss, em = (has(col, p) for p in ("FO", "SS", "EM"))
    water = has(col, *(WATER_NO_LAKES if variant == "no_lakes" else WATER)) & ~(pfo | pem | pss)
    if variant == "ssw_mixed":
        with_forest, with_emergent = pss & fo, "ScrubShrub"
        return first_match([(water, "OpenWater"), (pss & ~fo & ~em, "ScrubShrub"), (pem & ~fo & ~ss, "Emergent"), (pfo & ~ss & ~em, "Forested"), (with_forest, with_emergent), (pss & em, "Emergent")], _c(col))
    if variant == "mixed":
        return first_match([(water, "OpenWater"), (pss & ~fo & ~em, "ScrubShrub"), (pem & ~fo & ~ss, "Emergent"), (pfo & ~ss & ~em, "Forested"), (fo & ss, "ForestedScrub"), (em & ss, "EmergentScrub")], _c(col))
    return first_match([(water, "OpenWater"), (pss & ~pfo & ~pem, "ScrubShrub"), (pem & ~pfo & ~pss, "Emergent"), (pfo & ~pss & ~pem, "Forested"), (pss & pfo, "Forested"), (pss & pem, "Emergent")], _c(col))


def classify_cowardin(col: Column | str, default: str | None = "UPL") -> Column:
    """Community text to class code."""
    c = _c(col)
    water = c.rlike("Open water|Lacustrine|Riverine|Palustrine-AB")
    return first_match([(water, "OWW"), (c.contains("Palustrine-SS"), "SSW"), (c.contains("Palustrine-EM"), "EMW"), (c.contains("Palustrine-FO"), "FSW")], default)


def classify_adk(system: Column | str, class1: Column | str) -> Column:
    """Cover-type system and first class to class code."""
    return first_match([(_c(system) == "U", "UPL"), (has(class1, *ADK_UPLAND), "UPL"), (has(class1, "SS"), "SSW"), (has(class1, "EM"), "EMW"), (has(class1, "FO"), "FSW")], "REVIEW")


def classify_two(col: Column | str) -> Column:
    return F.when(_c(col).rlike("Forested|Shrub"), "FSW").otherwise("EMW")


def to_mod_class(col: Column | str) -> Column:
    return first_match([(_c(col) == name, code) for name, code in SHORT.items()], "Other")


def to_coarse(col: Column | str) -> Column:
    return F.when(_c(col) == "UPL", "UPL").otherwise("WET")


def classify_chm_adk(chm: Column | str) -> Column:
    """Mean canopy height to class: thresholds 1, 3.5 and 5 metres."""
    h = _c(chm)
    return first_match([(h <= 1, "OWW"), ((h > 1) & (h <= 3.5), "EMW"), ((h >= 1) & (h <= 5), "SSW"), (h > 5, "FSW")], "REVIEW")


def classify_chm_ndwi(chm: Column | str, ndwi: Column | str) -> Column:
    """Canopy height with a water index: thresholds 0.5, 3.5 and 5 metres, index 0.2."""
    h, w = _c(chm), _c(ndwi)
    return first_match(
        [((h <= 0.5) & (w > 0.2), "OWW"), ((h > 0.5) & (h <= 3.5) & (w > 0.2), "EMW"), ((h >= 0.5) & (h <= 5) & (w < 0.2), "SSW"), (h > 5, "FSW"), (h <= 3.5, "EMW"), ((h > 3.5) & (h <= 5), "SSW")], "REVIEW"
    )


def classify_code_chm(code: Column | str, chm: Column | str) -> Column:
    """Inventory code and mean canopy height to class, first match wins."""
    h = _c(chm)
    fo, ss, em = (has(code, p) for p in ("FO", "SS", "EM"))
    low, mid, upper, high = h <= 3.5, (h >= 1) & (h <= 5), (h > 3.5) & (h <= 5), h > 5
    groups = [
        (has(code, *WATER) & ~fo & ~ss & ~em, [(h <= 1, "OWW")]),
        (ss & ~fo & ~em, [(mid, "SSW"), (high, "FSW")]),
        (em & ~fo & ~ss, [(low, "EMW"), (mid, "SSW"), (high, "FSW")]),
        (fo & ~ss & ~em, [(mid, "SSW"), (high, "FSW")]),
        (has(code, "PFO") & (ss | em), [(low, "EMW"), (mid, "SSW"), (high, "FSW")]),
        (has(code, "PSS") & fo, [(mid, "SSW"), (high, "FSW")]),
        (has(code, "PSS") & em, [(low, "EMW"), (upper, "SSW")]),
        (has(code, "PEM") & ss, [(low, "EMW"), (upper, "SSW")]),
    ]
    return first_match([(test & band, to) for test, bands in groups for band, to in bands], "REVIEW")


def n_points(area: Column | str) -> Column:
    """Sampling size: the ceiling of log10 of the area, one at least."""
    return F.greatest(F.ceil(F.log10(_c(area))), F.lit(1)).cast("long")


def collapse_class(col: Column | str, old: str = "OWW", new: str = "UPL") -> Column:
    return F.when(_c(col) == old, new).otherwise(_c(col))
