"""Terrain and hydrology on cell tables. Formulas are those of the published methods; cell size g."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cells import aggregate, resample, stack
from .focal import KEY, TILE, box_sums, gaussian, neighbours, on_tiles, whole, window_stats

# fixed values: codes of the eight directions and the neighbour each points to
D8 = [(1, "z6", 0, 1), (2, "z9", 1, 1), (4, "z8", 1, 0), (8, "z7", 1, -1), (16, "z4", 0, -1), (32, "z1", -1, -1), (64, "z2", -1, 0), (128, "z3", -1, 1)]
# fixed values: landform by number of lower (row) and higher (column) directions
FORMS = [
    "FL FL FL FS FS VL VL VL PT", "FL FL FS FS FS VL VL VL", "FL SH SL SL HL HL VL", "SH SH SL SL SL HL", "SH SH SP SL SL", "RI RI SP SP", "RI RI RI", "RI RI", "PK",
]
CODES = ["FL", "PK", "RI", "SH", "SP", "SL", "HL", "FS", "VL", "PT"]


def _z(p: int) -> Column:
    return F.col(f"z{p}")


def _gradient(g: float) -> tuple[Column, Column]:
    zx = ((_z(3) + 2 * _z(6) + _z(9)) - (_z(1) + 2 * _z(4) + _z(7))) / (8 * g)
    zy = ((_z(1) + 2 * _z(2) + _z(3)) - (_z(7) + 2 * _z(8) + _z(9))) / (8 * g)
    return zx, zy


def slope_aspect(cells: DataFrame, band: str = "dem", g: float = 1.0) -> DataFrame:
    """Slope in radians and degrees and aspect in degrees from eight neighbours; null where one is missing."""
    zx, zy = _gradient(g)
    rad = F.atan(F.sqrt(zx * zx + zy * zy))
    aspect = (F.degrees(F.atan2(-zx, -zy)) + 360) % 360
    n = neighbours(cells, band)
    return n.select(*KEY, F.when(whole(), rad).alias("slope_rad"), F.when(whole(), F.degrees(rad)).alias("slope"), F.when(whole(), aspect).alias("aspect"))


def relief(cells: DataFrame, band: str = "dem") -> DataFrame:
    """Position index, ruggedness index and roughness of the 3 x 3 window."""
    others = [_z(p) for p in range(1, 10) if p != 5]
    n = neighbours(cells, band)
    tpi = _z(5) - sum(others[1:], others[0]) / 8
    tri = sum([F.abs(_z(5) - o) for o in others[1:]], F.abs(_z(5) - others[0])) / 8
    rough = F.greatest(*[_z(p) for p in range(1, 10)]) - F.least(*[_z(p) for p in range(1, 10)])
    return n.select(*KEY, *[F.when(whole(), x).alias(k) for k, x in (("tpi", tpi), ("tri", tri), ("roughness", rough))])


def flowdir(cells: DataFrame, band: str = "dem", g: float = 1.0) -> DataFrame:
    """Direction code of the steepest descent to a present neighbour, 0 in a sink; ties go to the smaller code."""
    n = neighbours(cells, band)
    drops = F.array(*[F.struct((-(_z(5) - F.col(z)) / (g * (math.sqrt(2) if i and j else 1))).alias("d"), F.lit(code).alias("code")) for code, z, i, j in D8])
    best = F.array_min(F.filter(drops, lambda s: s["d"].isNotNull() & (s["d"] < 0)))
    return n.select(*KEY, F.coalesce(best["code"], F.lit(0)).alias("dir"))


def slope_w(cells: DataFrame, w: int, band: str = "dem", g: float = 1.0) -> DataFrame:
    """Slope in degrees of the plane fitted to a full w x w window; null where a value is missing. The fit's moments
    come from summed-area tables, so its cost does not depend on the window."""
    k = (w - 1) // 2
    m = float(w * sum(i * i for i in range(-k, k + 1)))

    def fit(grid: np.ndarray) -> dict[str, np.ndarray]:
        there = ~np.isnan(grid)
        v = np.where(there, grid - (np.round(grid[there].mean()) if there.any() else 0.0), 0.0)
        n = grid.shape[0] - 2 * k
        at, mid = np.arange(grid.shape[0], dtype=float), k + np.arange(n, dtype=float)
        s = box_sums(v, w)
        a = (box_sums(v * at[None, :], w) - mid[None, :] * s) / (m * g)
        b = (box_sums(v * at[:, None], w) - mid[:, None] * s) / (m * g)
        return {"slope": np.where(box_sums(there.astype(float), w) == w * w, np.degrees(np.arctan(np.hypot(a, b))), np.nan)}

    return on_tiles(cells, band, k, fit, {"slope": "double"})


def dmv(cells: DataFrame, w: int, band: str = "dem", stand: str = "none") -> DataFrame:
    """Deviation from the window's mean, or that over the window's range."""
    s = window_stats(cells, w, band)
    dev = F.col("v") - F.col("s") / F.col("n")
    return s.select(*KEY, (dev if stand == "none" else F.try_divide(dev, F.col("hi") - F.col("lo"))).alias("dmv"))


def curvature(cells: DataFrame, band: str = "dem", g: float = 1.0) -> DataFrame:
    """Mean, plan and profile curvature of the quadratic surface through the 3 x 3 window."""
    n = neighbours(cells, band)
    zxx = (_z(1) + _z(3) + _z(4) + _z(6) + _z(7) + _z(9) - 2 * (_z(2) + _z(5) + _z(8))) / (3 * g * g)
    zyy = (_z(1) + _z(2) + _z(3) + _z(7) + _z(8) + _z(9) - 2 * (_z(4) + _z(5) + _z(6))) / (3 * g * g)
    zxy = (_z(3) + _z(7) - _z(1) - _z(9)) / (4 * g * g)
    zx = (_z(3) + _z(6) + _z(9) - _z(1) - _z(4) - _z(7)) / (6 * g)
    zy = (_z(1) + _z(2) + _z(3) - _z(7) - _z(8) - _z(9)) / (6 * g)
    n = n.select(*KEY, whole().alias("ok"), zxx.alias("zxx"), zyy.alias("zyy"), zxy.alias("zxy"), zx.alias("zx"), zy.alias("zy"), (zx * zx + zy * zy).alias("p"))
    c = F.col
    profile = -F.try_divide(c("zxx") * c("zx") ** 2 + 2 * c("zxy") * c("zx") * c("zy") + c("zyy") * c("zy") ** 2, c("p") * (1 + c("p")) ** 1.5)
    plan = -F.try_divide(c("zxx") * c("zy") ** 2 - 2 * c("zxy") * c("zx") * c("zy") + c("zyy") * c("zx") ** 2, c("p") * (1 + c("p")) ** 0.5)
    mean = F.when(c("p") == 0, -(c("zxx") + c("zyy")) / 2).otherwise((profile + plan) / 2)
    return n.select(*KEY, *[F.when(c("ok"), x).alias(k) for k, x in (("meanc", mean), ("planc", plan), ("profc", profile))])


def geomorphons(cells: DataFrame, band: str = "dem", search: int = 10, skip: int = 1, flat: float = 1.5, g: float = 1.0) -> DataFrame:
    """Landform code: in each of eight directions the largest and least elevation angle between ``skip`` and
    ``search`` cells away say whether it rises or falls by more than ``flat`` degrees. Cells without another in reach have
    none. The horizons of all cells of a tile move outwards together, so a cell is sent to a few tiles only."""
    table = np.array([[CODES.index(x) + 1 for x in row.split()] + [0] * (9 - len(row.split())) for row in FORMS])

    def forms(grid: np.ndarray) -> dict[str, np.ndarray]:
        n = grid.shape[0] - 2 * search
        z = grid[search : search + n, search : search + n]
        up, down, any_ = np.zeros(z.shape, int), np.zeros(z.shape, int), np.zeros(z.shape, bool)
        for _, _, i, j in D8:
            high, low = np.full(z.shape, np.nan), np.full(z.shape, np.nan)
            for d in range(skip, search + 1):
                far = grid[search + i * d : search + i * d + n, search + j * d : search + j * d + n]
                t = (far - z) / (d * g * (math.sqrt(2) if i and j else 1))
                high, low = np.fmax(high, t), np.fmin(low, t)
            a = np.round(np.degrees(np.arctan(high)) + np.degrees(np.arctan(low)), 9)
            up, down, any_ = up + (a > flat), down + (a < -flat), any_ | ~np.isnan(a)
        return {"form": np.where(any_, table[down, up], np.nan)}

    return on_tiles(cells, band, search, forms, {"form": "int"}, tile=max(TILE, 2 * search)).filter("form IS NOT NULL")


def terrain_at_scale(cells: DataFrame, factor: int, metric: str, band: str = "dem") -> DataFrame:
    """Smooth by averaging ``factor`` cells and resampling back with cubic splines, then a metric; the column is
    named ``<metric>_<factor>``."""
    smooth = cells if factor == 1 else resample(aggregate(cells, factor, band), 1 / factor, band, "cubicspline")
    made = {"slope": lambda: slope_aspect(smooth, band).select(*KEY, "slope"), "tpi": lambda: relief(smooth, band).select(*KEY, "tpi"), "meanc": lambda: curvature(smooth, band).select(*KEY, "meanc"), "dmv": lambda: dmv(smooth, 3, band)}[metric]()
    return made.withColumnRenamed(metric, f"{metric}_{factor}")


def twi(acc: DataFrame, slope_rad: DataFrame) -> DataFrame:
    """Topographic wetness index ln(accumulation / tan slope); infinite becomes null."""
    met = acc.join(slope_rad.select(*KEY, "slope_rad"), KEY)
    return met.select(*KEY, F.when((F.col("acc") > 0) & (F.tan("slope_rad") > 0), F.log(F.col("acc") / F.tan("slope_rad"))).alias("twi"))


def hillshade(sa: DataFrame, alt: float = 45.0, az: float = 0.0) -> DataFrame:
    zen = math.radians(90 - alt)
    shade = math.cos(zen) * F.cos("slope_rad") + math.sin(zen) * F.sin("slope_rad") * F.cos(math.radians(az) - F.radians("aspect"))
    return sa.select(*KEY, shade.alias("shade"))


def scale_space(cells: DataFrame, sigmas: list[float], band: str = "dem") -> DataFrame:
    """Per smoothing scale: spread and range of the surface, mean, spread and largest slope."""
    out = None
    for s in sigmas:
        smooth = gaussian(cells, s, band) if s > 0 else cells.select(*KEY, band)
        met = stack([smooth, slope_aspect(smooth, band).select(*KEY, "slope")])
        one = met.agg(F.lit(float(s)).alias("scale"), F.stddev_samp(band).alias("sd"), (F.max(band) - F.min(band)).alias("range"), F.avg("slope").alias("slope_mean"), F.stddev_samp("slope").alias("slope_sd"), F.max("slope").alias("slope_max"))
        out = one if out is None else out.unionByName(one)
    return out


def pick_scales(cells: DataFrame, n: int, res: float = 1.0) -> DataFrame:
    """Zero and ``n`` log-spaced sigmas per watershed, from one cell to a thirtieth of the smaller extent."""
    ext = cells.groupBy("h").agg(F.least(F.max("r") - F.min("r") + 1, F.max("c") - F.min("c") + 1).alias("side"))
    hi = F.col("side") * res / 10 / 3
    k = F.explode(F.sequence(F.lit(0), F.lit(n))).alias("k")
    sig = F.when(F.col("k") == 0, 0.0).otherwise(F.exp(math.log(res) + (F.col("k") - 1) / (n - 1) * (F.log(hi) - math.log(res))))
    return ext.select("h", "side", k).select("h", "k", sig.alias("sigma"))


def method_compare(cells: DataFrame, n: int, band: str = "dem") -> DataFrame:
    """Agreement of the two slope methods at sampled cells."""
    from .cells import sample_cells

    a, b = slope_aspect(cells, band).select(*KEY, F.col("slope").alias("a")), slope_w(cells, 3, band).withColumnRenamed("slope", "b")
    met = sample_cells(cells.select(*KEY), n).join(a, KEY).join(b, KEY).filter("a IS NOT NULL AND b IS NOT NULL")
    return met.agg(F.count("*").alias("n"), F.corr("a", "b").alias("corr"))


