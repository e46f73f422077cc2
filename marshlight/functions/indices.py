"""Spectral indices, masks and scaling as Column work. Division by zero gives null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

c = F.col


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def normalized(a: str, b: str) -> Column:
    return ratio(c(a) - c(b), c(a) + c(b))


def optical_indices(df: DataFrame) -> DataFrame:
    evi = ratio(2.5 * (c("b8") - c("b4")), c("b8") + 6 * c("b4") - 7.5 * c("b2") + 1)
    return df.withColumns({"NDVI": normalized("b8", "b4"), "MNDWI": normalized("b3", "b11"), "PSRI": ratio(c("b4") - c("b2"), c("b6")), "NDYI": normalized("b3", "b2"), "GDVI": normalized("b8", "b3"), "EVI": evi})


def sar_indices(df: DataFrame) -> DataFrame:
    return df.withColumns({"DPSVI": normalized("vv", "vh"), "RVI": ratio(4 * c("vh"), c("vv") + c("vh")), "VH_VV_ratio": ratio(c("vh"), c("vv"))})


def naip_indices(df: DataFrame, red: str = "red", green: str = "green", nir: str = "nir") -> DataFrame:
    return df.withColumns({"ndvi": normalized(nir, red), "ndwi": normalized(green, nir)})


def season(obs: DataFrame, first: str, last: str, doy0: int, doy1: int, max_cloud: float) -> DataFrame:
    """Scenes from ``first`` up to but not on ``last``, within days of the year, under a cloud share."""
    return obs.filter((c("ts") >= F.lit(first).cast("timestamp")) & (c("ts") < F.lit(last).cast("timestamp")) & F.dayofyear("ts").between(doy0, doy1) & (c("cloud_pct") < max_cloud))


def has_pols(obs: DataFrame, pols: list[str], mode: str) -> DataFrame:
    out = obs.filter(c("mode") == mode)
    for p in pols:
        out = out.filter(F.array_contains(F.split("pols", ","), p))
    return out


def mask_qa60(obs: DataFrame, bands: list[str], scale: float = 10000.0) -> DataFrame:
    """Bands scaled where the cloud (bit 10) and cirrus (bit 11) flags are clear, null elsewhere."""
    clear = c("qa60").bitwiseAND(F.lit(1 << 10 | 1 << 11)) == 0
    return obs.withColumns({b: F.when(clear, c(b) / scale) for b in bands})


def mask_scl(obs: DataFrame, drop: tuple[int, ...] = (3, 7, 8, 9, 10)) -> DataFrame:
    return obs.filter(~c("scl").isin(*drop))


def scale_bands(df: DataFrame, factors: dict[str, float]) -> DataFrame:
    return df.withColumns({b: c(b) * k for b, k in factors.items()})


def unmask(df: DataFrame, value: float, bands: list[str]) -> DataFrame:
    return df.withColumns({b: F.coalesce(c(b), F.lit(value)) for b in bands})


def log_band(df: DataFrame, band: str) -> DataFrame:
    return df.withColumn(band, F.when(c(band) > 0, F.log(c(band))))
