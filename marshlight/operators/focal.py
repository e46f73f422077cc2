"""Moving windows on cell tables: tiles with a halo go through one shuffle, and a tile's windows are numpy's work."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["h", "r", "c"]
TILE = 128


def on_tiles(cells: DataFrame, band: str, k: int, fun, columns: dict[str, str], tile: int = TILE, every: bool = False) -> DataFrame:
    """``h, r, c`` and ``columns`` (name: type) for each cell, or for ``every`` place of a tile where a value is given.

    A cell is sent to the tiles of ``tile`` x ``tile`` cells whose halo of ``k`` holds it (beside its own, only near their
    borders). ``fun`` gets a tile's values with the halo, NaN where there is none, and gives arrays of the tile's shape.
    """
    near = lambda x: F.explode(F.sequence(F.floor((F.col(x) - k) / tile), F.floor((F.col(x) + k) / tile)))
    tiles = cells.select(*KEY, F.col(band).cast("double").alias("v"), near("r").alias("tr")).select("*", near("c").alias("tc"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf.tr.iloc[0]) * tile, int(pdf.tc.iloc[0]) * tile
        i, j = (pdf.r - r0).to_numpy(), (pdf.c - c0).to_numpy()
        grid = np.full((tile + 2 * k, tile + 2 * k), np.nan)
        grid[i + k, j + k] = pdf.v
        own = (i >= 0) & (i < tile) & (j >= 0) & (j < tile)
        if not every and not own.any():
            return pd.DataFrame(columns=[*KEY, *columns])
        got = fun(grid)
        i, j = np.nonzero(np.any([~np.isnan(x) for x in got.values()], axis=0)) if every else (i[own], j[own])
        out = pd.DataFrame({"h": pdf.h.iloc[0], "r": i + r0, "c": j + c0})
        for name, kind in columns.items():
            v = got[name][i, j]
            out[name] = v if kind == "double" else pd.array(np.where(np.isnan(v), 0, v).astype("int64"), dtype="Int64")
            if kind != "double":
                out.loc[np.isnan(v), name] = pd.NA
        return out

    kinds = {f.name: f.dataType.simpleString() for f in cells.select(*KEY).schema}
    return tiles.groupBy("h", "tr", "tc").applyInPandas(run, ", ".join(f"{n} {t}" for n, t in [*kinds.items(), *columns.items()]))


def box_sums(v: np.ndarray, w: int) -> np.ndarray:
    """Sums over all w x w windows from a summed-area table: four look-ups, whatever the window."""
    a = np.zeros((v.shape[0] + 1, v.shape[1] + 1))
    a[1:, 1:] = v.cumsum(0).cumsum(1)
    return a[w:, w:] - a[:-w, w:] - a[w:, :-w] + a[:-w, :-w]


def _extremes(v: np.ndarray, w: int, fun) -> np.ndarray:
    return fun(sliding_window_view(fun(sliding_window_view(v, w, axis=0), axis=-1), w, axis=1), axis=-1)


def window_stats(cells: DataFrame, w: int, band: str, full: bool = False) -> DataFrame:
    """n, sum, sum of squares, min and max over the w x w window of each cell, present values only. With ``full`` also
    where the cell itself is missing, without its own value ``v``."""
    k = (w - 1) // 2

    def stats(grid: np.ndarray) -> dict[str, np.ndarray]:
        there = ~np.isnan(grid)
        # a whole number near the values is taken off before squares are added up
        near = np.round(grid[there].mean()) if there.any() else 0.0
        v = np.where(there, grid - near, 0.0)
        n, s, q = (box_sums(x, w) for x in (there.astype(float), v, v * v))
        some = n > 0
        lo, hi = (_extremes(np.where(there, grid, x), w, f) for x, f in ((np.inf, np.min), (-np.inf, np.max)))
        got = {"n": n, "s": s + n * near, "q": q + 2 * near * s + n * near * near, "lo": lo, "hi": hi}
        return {x: np.where(some, y, np.nan) for x, y in got.items()} | ({} if full else {"v": grid[k : grid.shape[0] - k, k : grid.shape[1] - k]})

    columns = {"n": "bigint", "s": "double", "q": "double", "lo": "double", "hi": "double"}
    out = on_tiles(cells, band, k, stats, columns if full else {"v": "double"} | columns, every=full)
    return out if full else out.withColumn("n", F.coalesce("n", F.lit(0)))


def focal(cells: DataFrame, w: int, fun: str, band: str) -> DataFrame:
    """min, max, mean, sum or sample sd over the w x w window of present values."""
    if w % 2 == 0:
        raise ValueError("the window must be odd")
    s = window_stats(cells, w, band)
    return s.select(*KEY, _statistic(fun).alias(band))


def _statistic(fun: str) -> Column:
    var = (F.col("q") - F.col("s") * F.col("s") / F.col("n")) / (F.col("n") - 1)
    return {"min": F.col("lo"), "max": F.col("hi"), "mean": F.try_divide("s", "n"), "sum": F.col("s"), "sd": F.when(F.col("n") > 1, F.sqrt(F.greatest(F.lit(0.0), var)))}[fun]


def focal_many(cells: DataFrame, w: int, funs: dict[str, str], band: str) -> DataFrame:
    """Several statistics (name: function) of one window in one pass."""
    return window_stats(cells, w, band).select(*KEY, *[_statistic(f).alias(n) for n, f in funs.items()])


def fill_gaps(cells: DataFrame, template: DataFrame, band: str) -> DataFrame:
    """On the template's cells: the band, or the mean of the 3 x 3 neighbours where it is missing."""
    around = window_stats(cells.filter(F.col(band).isNotNull()), 3, band, full=True).select(*KEY, F.try_divide("s", "n").alias("_m"))
    own = template.select(*KEY).join(cells.select(*KEY, band), KEY, "left")
    return own.join(around, KEY, "left").select(*KEY, F.coalesce(band, "_m").alias(band))


def fill_holes(cells: DataFrame, template: DataFrame, band: str, least: int = 5) -> DataFrame:
    """Gaps filled only where at least ``least`` of the nine cells around are present."""
    around = window_stats(cells.filter(F.col(band).isNotNull()), 3, band, full=True).select(*KEY, "n")
    return fill_gaps(cells, template, band).join(around.filter(F.col("n") >= least).select(*KEY), KEY, "left_semi")


def gaussian_plan(sigma: float, res: float, n: int = 5) -> tuple[int, int, int]:
    """Radii of the narrow and the wide box and how many of the n passes are narrow."""
    s = sigma / res
    w = math.sqrt(12 * s * s / n + 1)
    wl = int(math.floor(w))
    wl -= wl % 2 == 0
    m = round((12 * s * s - n * wl * wl - 4 * n * wl - 3 * n) / (-4 * wl - 4))
    return (wl - 1) // 2, (wl + 1) // 2, min(n, max(0, m))


def gaussian(cells: DataFrame, sigma: float, band: str, res: float = 1.0, n: int = 5) -> DataFrame:
    """Iterated box filter; a box sums present values over the whole window's size, gaps are not made up for."""
    low, high, m = gaussian_plan(sigma, res, n)
    passes = [k for k in [low] * m + [high] * (n - m) if k]
    halo = sum(passes)

    def smooth(grid: np.ndarray) -> dict[str, np.ndarray]:
        gone = np.isnan(grid)
        for k in passes:  # each pass narrows what is right by its radius, which the halo makes up for
            w = 2 * k + 1
            grid = np.where(gone, np.nan, box_sums(np.pad(np.where(gone, 0.0, grid), k), w) / float(w * w))
        return {band: grid[halo : grid.shape[0] - halo, halo : grid.shape[1] - halo]}

    return on_tiles(cells, band, halo, smooth, {band: "double"})


def focal_tile(cells: DataFrame, w: int, fun: str, band: str) -> DataFrame:
    """Median or mode (smallest on ties) of the present values of the window: a row of a tile's windows is sorted at once."""
    k = (w - 1) // 2

    def ranked(grid: np.ndarray) -> dict[str, np.ndarray]:
        size = grid.shape[0] - 2 * k
        out = np.full((size, size), np.nan)
        windows = sliding_window_view(grid, (w, w))
        for i in range(size):
            if np.isnan(grid[i : i + w]).all():
                continue
            v = np.sort(windows[i].reshape(size, w * w), axis=1)  # missing values come last
            n = (~np.isnan(v)).sum(1)
            if fun == "median":
                low, high = (np.take_along_axis(v, np.maximum(0, x)[:, None], 1)[:, 0] for x in ((n - 1) // 2, n // 2))
                out[i] = (low + high) / 2
            else:
                at = np.arange(w * w)
                new = np.ones(v.shape, bool)
                new[:, 1:] = v[:, 1:] != v[:, :-1]
                run = np.where(np.isnan(v), 0, at - np.maximum.accumulate(np.where(new, at, 0), axis=1) + 1)
                out[i] = np.take_along_axis(v, run.argmax(1)[:, None], 1)[:, 0]
        return {band: out}

    return on_tiles(cells, band, k, ranked, {band: "double"}, tile=64)


def neighbours(cells: DataFrame, band: str, reach: int = 1) -> DataFrame:
    """The eight neighbours of each cell as z1..z9, row by row from the north-west (north is smaller r; z5 is the
    cell), null where missing."""
    offs = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]

    def around(grid: np.ndarray) -> dict[str, np.ndarray]:
        n = grid.shape[0] - 2 * reach
        return {f"z{p}": grid[reach * (1 + i) : reach * (1 + i) + n, reach * (1 + j) : reach * (1 + j) + n] for p, (i, j) in enumerate(offs, 1)}

    return on_tiles(cells, band, reach, around, {f"z{p}": "double" for p in range(1, 10)})


def whole() -> Column:
    """All nine values are present."""
    out = F.col("z1").isNotNull()
    for p in range(2, 10):
        out = out & F.col(f"z{p}").isNotNull()
    return out
