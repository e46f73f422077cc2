"""Pairs of small rings that intersect, decided on whole rings that meet in squares of the grid of levels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .grid import SQUARE, base_of, level, levels_of, squares
from .iterate import settle

VERTICES = 64  # of a small ring, at most
KEY = ["h", *SQUARE, "_cell"]


def small_rings(vertices: DataFrame) -> DataFrame:
    """``poly_id, small`` for each ring: whether it has few vertices, all present, of one watershed and in a clear order."""
    there = lambda k: F.col(k).isNotNull() & ~F.isnan(k) & (F.abs(k) < float("inf"))
    n = F.count("*")
    one = (n <= VERTICES) & (F.count_if(there("x") & there("y")) == n) & (F.count("h") == n) & (F.min("h") == F.max("h")) & (F.count("seq") == n)
    return vertices.groupBy("poly_id").agg(one.alias("small"))


def packed(vertices: DataFrame) -> DataFrame:
    """A row for each ring: ``poly_id, h``, its vertices' ``xs`` and ``ys`` in order, and its box."""
    ring = F.sort_array(F.collect_list(F.struct("seq", "x", "y")))
    rows = vertices.groupBy("poly_id").agg(F.first("h").alias("h"), ring.alias("_ring")).select("poly_id", "h", *[F.col(f"_ring.{k}").cast("array<double>").alias(f"{k}s") for k in ("x", "y")])
    return rows.withColumns({f"{k}{m}": f(f"{k}s") for k in ("x", "y") for m, f in (("min", F.array_min), ("max", F.array_max))})


def meet_rings(xa: np.ndarray, ya: np.ndarray, xb: np.ndarray, yb: np.ndarray) -> np.ndarray:
    """For each pair of rings (rows; a ring may end with its last vertex repeated): do their edges cross inside both, or does
    one hold a vertex of the other, by the half-open rule?"""

    def against(x, y, px, py):
        x1, y1, dx, dy = x[:, :-1, None], y[:, :-1, None], np.diff(x)[:, :, None], np.diff(y)[:, :, None]
        up = dx * (py[:, None] - y1)
        side = np.sign(up - dy * (px[:, None] - x1))
        ray = ((y1 > py[:, None]) != (y[:, 1:, None] > py[:, None])) & (px[:, None] < up / dy + x1)
        low, high = (lambda v: v.min(1)[:, None]), (lambda v: v.max(1)[:, None])
        boxed = (px >= low(x)) & (px <= high(x)) & (py >= low(y)) & (py <= high(y))
        return side[:, :, :-1] * side[:, :, 1:] < 0, (boxed & (ray.sum(1) % 2 == 1)).any(1)

    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        (one, held), (two, held2) = against(xa, ya, xb, yb), against(xb, yb, xa, ya)
    return held | held2 | (one & two.transpose(0, 2, 1)).any((1, 2))


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins the groups of a and b in ``label`` (the least position of each group, changed in place) and tells which pairs
    were needed for that."""
    used, pair = [], np.arange(len(a))
    while len(pair):
        ra, rb = label[a[pair]], label[b[pair]]
        pair, low, high = pair[ra != rb], np.minimum(ra, rb)[ra != rb], np.maximum(ra, rb)[ra != rb]
        o = np.lexsort((low, high))
        first = o[np.flatnonzero(np.diff(high[o], prepend=-1))]  # each group takes one pair that leads to the least other one
        label[high[first]] = low[first]
        used.append(pair[first])
        while (label[label] != label).any():
            label[:] = label[label]
    return np.concatenate(used) if used else pair


def _pairs(joining: bool, at_once: int = 1 << 18):
    """The pairs of each cell that intersect, or, with ``joining``, only such as connect what was not connected yet."""

    def work(t: pa.Table):
        col = lambda k: t.column(k).to_numpy()
        key = [col(k) for k in KEY]
        new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
        begin, end = np.concatenate([[0], new]), np.concatenate([new, [t.num_rows]])
        group = np.repeat(np.arange(len(begin)), end - begin)
        other = np.add.reduceat((col("_side") == 0).astype(np.int64), begin) + begin  # where the second side begins
        row = np.arange(t.num_rows)
        start = np.where(col("_diag"), row + 1, other[group])
        count = np.where(col("_side") == 0, np.maximum(end[group] - start, 0), 0)
        ids, own, native = col("poly_id"), 2.0 ** col("_l"), col("_native")
        box = {k: col(k) for k in ("xmin", "ymin", "xmax", "ymax")}
        points = {k: t.column(k).combine_chunks() for k in ("xs", "ys")}
        length = np.diff(points["xs"].offsets.to_numpy())
        first = points["xs"].offsets.to_numpy()[:-1]
        flat = {k: p.values.to_numpy() for k, p in points.items()}
        label = row.copy()
        total = np.cumsum(count)
        for rows in np.split(row, np.flatnonzero(np.diff(total // at_once)) + 1):
            n = count[rows]
            a = np.repeat(rows, n)
            b = start[a] + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
            ok = (native[a] | native[b]) & (label[a] != label[b])
            for lo, hi, at in (("xmin", "xmax", "_bx"), ("ymin", "ymax", "_by")):
                ok &= (box[lo][a] <= box[hi][b]) & (box[lo][b] <= box[hi][a])
                ok &= np.floor(np.maximum(box[lo][a], box[lo][b]) / own[a]) == col(at)[a]
            a, b = a[ok], b[ok]
            most = np.maximum(length[a], length[b])
            o = np.argsort(most, kind="stable")
            a, b, most = a[o], b[o], most[o]
            while len(a):
                many = max(1, int(np.searchsorted(most[: 1 << 15].astype(np.int64) ** 2 * np.arange(1, len(most[: 1 << 15]) + 1), 1 << 20, "right")))
                i, j, wide = a[:many], b[:many], int(most[:many].max())
                a, b, most = a[many:], b[many:], most[many:]
                if joining:
                    apart = label[i] != label[j]
                    i, j = i[apart], j[apart]
                if not len(i):
                    continue
                place = lambda r, wide=wide: first[r][:, None] + np.minimum(np.arange(wide), length[r][:, None] - 1)
                pi, pj = place(i), place(j)
                hit = meet_rings(flat["xs"][pi], flat["ys"][pi], flat["xs"][pj], flat["ys"][pj])
                i, j = i[hit], j[hit]
                if joining:
                    needed = connect(label, i, j)
                    i, j = i[needed], j[needed]
                if len(i):
                    less = ids[i] < ids[j]
                    yield pa.RecordBatch.from_arrays([pa.array(ids[np.where(less, i, j)]), pa.array(ids[np.where(less, j, i)])], names=["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            # a cell that the batch may not end is kept for the next one
            same = np.all([(k := t.column(c).to_numpy()) == k[-1] for c in KEY], axis=0)
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
            if cut:
                yield from work(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield from work(held.combine_chunks())

    return run


def pairs_of_rings(vertices: DataFrame, joining: bool = False, block: int = 2048) -> DataFrame:
    """Pairs ``a < b`` of small rings of one watershed that intersect, each once; with ``joining`` only such pairs as
    connect all that these connect. A ring is sent whole to the squares its box touches; two meet where the lower left
    corner of what their boxes share lies. Squares of more than ``block`` rings are cut into pairs of blocks."""
    rings = settle(packed(vertices), "rings")
    base = base_of(rings)
    ups = F.array(*[F.lit(v) for v in sorted({max(v, base) for v in levels_of(rings)})]).cast("array<int>")
    own = rings.withColumn("_own", F.greatest(level(), F.lit(base)))
    at = squares(own.withColumn("_l", F.explode(F.filter(ups, lambda v: v >= F.col("_own"))))).withColumn("_native", F.col("_own") == F.col("_l")).drop("_own")
    crowd = at.groupBy("h", *SQUARE).agg(F.count("*").alias("_n")).filter(F.col("_n") > block).withColumn("_parts", F.ceil(F.col("_n") / block).cast("int")).drop("_n")
    parts = F.coalesce("_parts", F.lit(1))
    # crowded squares are fewer than the rows sent by the block's size
    cells = at.join(F.broadcast(crowd), ["h", *SQUARE], "left").withColumns({"_parts": parts, "_i": F.pmod(F.xxhash64("poly_id"), parts).cast("int")})
    cells = cells.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    here: Column = F.least("_i", "_j") * F.col("_parts") + F.greatest("_i", "_j")
    cells = cells.select("h", *SQUARE, here.alias("_cell"), F.when(F.col("_i") <= F.col("_j"), 0).otherwise(1).alias("_side"), (F.col("_i") == F.col("_j")).alias("_diag"), "_native", "poly_id", "xs", "ys", "xmin", "ymin", "xmax", "ymax")
    kind = vertices.schema["poly_id"].dataType.simpleString()
    return cells.repartition(*KEY).sortWithinPartitions(*KEY, "_side").mapInArrow(_pairs(joining), f"a {kind}, b {kind}")
