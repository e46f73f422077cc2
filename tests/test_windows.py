"""Windows across tiles against one numpy grid."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marshlight.operators import focal as W
from marshlight.operators import terrain as E


def raster(n, seed, holes=0.1):
    rng = np.random.default_rng(seed)
    z = np.round(rng.random((n, n)) * 30 * 16) / 16
    z[rng.random((n, n)) < holes] = np.nan
    return z


def table(spark, z, off=0):
    i, j = np.nonzero(~np.isnan(z))
    return spark.createDataFrame(pd.DataFrame({"h": 0, "r": i + off, "c": j - off, "dem": z[i, j]}))


def windows(z, w):
    k = w // 2
    p = np.pad(z, k, constant_values=np.nan)
    return {(i, j): p[i : i + w, j : j + w][~np.isnan(p[i : i + w, j : j + w])] for i, j in zip(*np.nonzero(~np.isnan(z)), strict=True)}


@pytest.fixture(autouse=True)
def small_tiles(monkeypatch):
    monkeypatch.setattr(W.on_tiles, "__defaults__", (8, False))


def test_statistics_median_and_mode(spark):
    z = raster(21, 1)
    df = table(spark, z, -7)
    got = {(x.r + 7, x.c - 7): x for x in W.focal_many(df, 7, {"lo": "min", "hi": "max", "mean": "mean", "sd": "sd"}, "dem").collect()}
    want = windows(z, 7)
    assert set(got) == set(want)
    for at, v in want.items():
        assert (got[at].lo, got[at].hi) == (v.min(), v.max())
        assert got[at].mean == pytest.approx(v.mean()) and got[at].sd == pytest.approx(v.std(ddof=1))
    for fun, value in (("median", np.median), ("modal", lambda v: np.unique(v)[np.unique(v, return_counts=True)[1].argmax()])):
        coarse = df.withColumn("dem", F.floor(F.col("dem") / 6).cast("double")) if fun == "modal" else df
        same = windows(np.floor(z / 6) if fun == "modal" else z, 9)
        assert {(x.r + 7, x.c - 7): x.dem for x in W.focal_tile(coarse, 9, fun, "dem").collect()} == {at: value(v) for at, v in same.items()}


def test_fitted_slope_needs_a_full_window(spark):
    z = raster(19, 2, 0.01)
    got = {(x.r, x.c): x.slope for x in E.slope_w(table(spark, z), 5).collect()}
    for (i, j), v in windows(z, 5).items():
        if len(v) < 25:
            assert got[i, j] is None
            continue
        w = z[i - 2 : i + 3, j - 2 : j + 3]
        d = np.arange(-2, 3)
        a, b = (w * d[None, :]).sum() / 50, (w * d[:, None]).sum() / 50
        assert got[i, j] == pytest.approx(math.degrees(math.atan(math.hypot(a, b))))


@pytest.mark.parametrize("search, skip", [(3, 1), (12, 4)])
def test_landforms_look_as_far_as_asked(spark, search, skip):
    z = raster(23, 3)
    got = {(x.r, x.c): x.form for x in E.geomorphons(table(spark, z), search=search, skip=skip, flat=5.0).collect()}
    for i, j in zip(*np.nonzero(~np.isnan(z)), strict=True):
        up = down = seen = 0
        for _, _, a, b in E.D8:
            t = [math.degrees(math.atan((z[i + a * d, j + b * d] - z[i, j]) / (d * math.hypot(a, b)))) for d in range(skip, search + 1) if 0 <= i + a * d < 23 and 0 <= j + b * d < 23 and not np.isnan(z[i + a * d, j + b * d])]
            seen += bool(t)
            up += bool(t) and round(max(t) + min(t), 9) > 5
            down += bool(t) and round(max(t) + min(t), 9) < -5
        assert got.get((i, j)) == (E.CODES.index(E.FORMS[down].split()[up]) + 1 if seen else None)


def test_gaussian_in_one_pass_equals_box_after_box(spark):
    z = raster(20, 4)
    low, high, m = W.gaussian_plan(2.0, 1.0)
    want = z.copy()
    for k in [low] * m + [high] * (5 - m):
        p = np.pad(np.where(np.isnan(want), 0, want), k)
        want = np.where(np.isnan(z), np.nan, np.lib.stride_tricks.sliding_window_view(p, (2 * k + 1, 2 * k + 1)).sum((2, 3)) / (2 * k + 1) ** 2)
    got = {(x.r, x.c): x.dem for x in W.gaussian(table(spark, z), 2.0, "dem").collect()}
    assert got == {(i, j): pytest.approx(want[i, j]) for i, j in zip(*np.nonzero(~np.isnan(z)), strict=True)}
