"""Filling and accumulation against brute force on terrain that crosses many tiles."""

import heapq

import numpy as np
import pandas as pd
import pytest

from marshlight.operators import hydrology as H
from marshlight.operators import terrain as E

AROUND = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]


def table(spark, z, h=0, r0=0, c0=0):
    i, j = np.nonzero(~np.isnan(z))
    return spark.createDataFrame(pd.DataFrame({"h": h, "r": i + r0, "c": j + c0, "dem": z[i, j]}))


def filled(z):
    """Flood of the whole raster from its edge with one heap."""
    n, m = z.shape
    there = lambda i, j: 0 <= i < n and 0 <= j < m and not np.isnan(z[i, j])
    w = np.full(z.shape, np.nan)
    heap = []
    for i in range(n):
        for j in range(m):
            if there(i, j) and not all(there(i + a, j + b) for a, b in AROUND):
                w[i, j] = z[i, j]
                heap.append((z[i, j], i, j))
    heapq.heapify(heap)
    while heap:
        v, i, j = heapq.heappop(heap)
        for a, b in AROUND:
            if there(i + a, j + b) and np.isnan(w[i + a, j + b]):
                w[i + a, j + b] = max(v, z[i + a, j + b])
                heapq.heappush(heap, (w[i + a, j + b], i + a, j + b))
    return w


def as_array(df, shape, col, r0=0, c0=0):
    out = np.full(shape, np.nan)
    pdf = df.toPandas()
    out[pdf.r - r0, pdf.c - c0] = pdf[col]
    return out


def terrain(n, seed, holes=0.02, step=1.0):
    rng = np.random.default_rng(seed)
    z = np.round(rng.random((n, n)) * 40 / step) * step
    z[rng.random((n, n)) < holes] = np.nan
    return z


@pytest.mark.parametrize("n, tile, holes", [(200, 32, 0.0005), (200, 128, 0.0), (70, 4, 0.0), (70, 5, 0.02), (30, 64, 0.0)])
def test_filling_equals_one_flood(spark, n, tile, holes):
    z = terrain(n, n + tile, holes)
    got = as_array(H.fill_depressions(table(spark, z, r0=-17, c0=900), tile=tile), z.shape, "dem", -17, 900)
    assert np.array_equal(got, filled(z), equal_nan=True)


def test_a_spiral_across_tiles_is_filled_in_two_passes(spark):
    n = 64
    z = np.full((n, n), 50.0)
    i, j, d = 1, 0, 0
    path = []
    lo, hi = [1, 1], [n - 2, n - 2]
    for k in range(0, n // 2 - 2, 2):
        path += [(1 + k, c) for c in range(k, n - 1 - k)] + [(r, n - 2 - k) for r in range(1 + k, n - 1 - k)] + [(n - 2 - k, c) for c in range(n - 2 - k, k + 1, -1)] + [(r, k + 2) for r in range(n - 2 - k, k + 2, -1)]
    for at in path:
        z[at] = 10.0
    assert np.array_equal(as_array(H.fill_depressions(table(spark, z), tile=8), z.shape, "dem"), filled(z))


def test_watersheds_do_not_mix(spark):
    a, b = terrain(40, 1, 0), terrain(25, 2, 0)
    both = H.fill_depressions(table(spark, a).unionByName(table(spark, b, h=3)), tile=8)
    assert np.array_equal(as_array(both.filter("h = 0"), a.shape, "dem"), filled(a))
    assert np.array_equal(as_array(both.filter("h = 3"), b.shape, "dem"), filled(b))
    assert H.fill_depressions(both.limit(0)).count() == 0


def accumulated(d):
    n, m = d.shape
    acc = np.where(np.isnan(d), np.nan, 0)
    for i in range(n):
        for j in range(m):
            x, y = i, j
            while 0 <= x < n and 0 <= y < m and not np.isnan(d[x, y]):
                acc[x, y] += 1
                step = H.STEPS.get(int(d[x, y]))
                if not step:
                    break
                x, y = x + step[0], y + step[1]
    return acc


@pytest.mark.parametrize("tile", [4, 7, 128])
def test_accumulation_equals_following_every_drop(spark, tile):
    z = terrain(60, 9, 0.03, step=1e-9) + np.add.outer(np.arange(60), np.arange(60)) * 3
    dirs = E.flowdir(table(spark, z, r0=-5))
    d = as_array(dirs, z.shape, "dir", -5)
    assert np.array_equal(as_array(H.flow_acc(dirs, tile=tile), z.shape, "acc", -5), accumulated(d), equal_nan=True)


def test_directions_to_no_cell_end_and_circles_are_refused(spark):
    make = lambda rows: spark.createDataFrame(rows, "h long, r long, c long, dir int")
    assert {(r.c, r.acc) for r in H.flow_acc(make([(0, 0, 0, 1), (0, 0, 1, 1), (0, 0, 2, 1), (0, 0, 4, 16)]), tile=2).collect()} == {(0, 1), (1, 2), (2, 3), (4, 1)}
    for rows in ([(0, 0, 0, 1), (0, 0, 1, 16)], [(0, 0, 1, 1), (0, 0, 2, 16)]):
        with pytest.raises(Exception, match="circle"):
            H.flow_acc(make(rows), tile=2).count()
    assert H.flow_acc(make([]), tile=2).count() == 0
