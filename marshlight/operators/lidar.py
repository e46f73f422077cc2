"""Point-cloud returns: noise, height above ground, cover shares, thinning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .geometry import hash_order
from .iterate import discard, settle
from .stats import quantile


def clean_returns(df: DataFrame) -> DataFrame:
    """Without withheld returns and the noise classes 7 and 18."""
    return df.filter(~F.col("withheld") & ~F.col("cls").isin(7, 18))


def normalize_height(df: DataFrame, k: int = 3, reach: float = 2.0, most: int = 50_000) -> DataFrame:
    """Height above the ground: the mean of the k nearest ground returns' heights, weighted by inverse squared distance
    (ties by place; all there are where a watershed has fewer than k; null where it has none).

    Ground returns are first reduced to one per position (the lowest). A place is met with the ground of its square and
    the eight around it; its k nearest are certain if the k-th lies within the square's side. Places that are not
    certain yet go on with squares of twice the side, so each round holds fewer places. Squares meet in tiles: a place
    goes to its own, ground to those it borders on, and pairs of the two exist only inside a task; a tile with more than
    ``most`` places is cut into parts, the ground being repeated for each."""
    there = lambda *cols: " AND ".join(f"{c} IS NOT NULL" for c in cols)
    ground = df.filter("cls = 2").groupBy("h", F.col("x").alias("gx"), F.col("y").alias("gy")).agg(F.min("z").cast("double").alias("gz"))
    ground = settle(ground.filter(there("h", "gx", "gy")), "ground")
    left = settle(df.select("h", "x", "y").filter(there("h", "x", "y")).distinct(), "places")
    ext = left.agg(*[(F.max(c) - F.min(c)).alias(c) for c in ("x", "y")]).first()
    ext2 = ground.agg(*[F.max(F.abs(c)).alias(c) for c in ("gx", "gy")]).first()
    widest = 2 * max([abs(float(v)) for v in (*ext, *ext2) if v is not None] or [0.0]) + reach
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in left.schema)
    tile = ["h", "ty", "tx"]
    found, size, side, old = None, float(reach), 16, []
    while True:
        square = lambda y, x: {"by": F.floor(F.col(y) / size), "bx": F.floor(F.col(x) / size)}  # noqa: B023, E731
        asked = left.withColumns(square("y", "x")).withColumns({"ty": F.floor(F.col("by") / side), "tx": F.floor(F.col("bx") / side)})
        parts = asked.groupBy(*tile).agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
        asked = asked.join(parts.filter("parts > 1"), tile, "left").withColumn("part", F.pmod(F.xxhash64("x", "y"), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
        near = lambda b: F.explode(F.sequence(F.floor((F.col(b) - 1) / side), F.floor((F.col(b) + 1) / side)))  # noqa: B023, E731
        sent = ground.withColumns(square("gy", "gx")).withColumn("ty", near("by")).withColumn("tx", near("bx"))
        sent = sent.join(parts, tile).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts").withColumn("void", F.col("gz").isNull())
        met = asked.groupBy(*tile, "part").cogroup(sent.groupBy(*tile, "part"))
        told = settle(met.applyInPandas(_nearest_ground(k), f"{kinds}, ground double, n long, far double"), "heights")
        sure = (F.col("n") == k) & (F.col("far") <= size * size)
        last = size > widest
        done = (told if last else told.filter(sure)).select("h", "x", "y", "ground")
        found = done if found is None else found.unionByName(done)
        rest = told.filter(~F.coalesce(sure, F.lit(False))).select("h", "x", "y")
        old += [left, told]
        if last or not rest.limit(1).count():
            break
        left, size, side = settle(rest, "places"), size * 2, max(1, side // 2)
    out = settle(found, "ground-levels", cells=True)
    discard(ground, *old)
    return df.join(out, ["h", "x", "y"], "left").withColumn("hag", F.col("z") - F.col("ground"))


def _nearest_ground(k: int, pairs: int = 2_000_000):
    """Of a tile's places: the weighted height of the k nearest ground returns in the nine squares around, how many there
    are, and the squared distance of the last."""

    def run(asked: pd.DataFrame, ground: pd.DataFrame) -> pd.DataFrame:
        n = len(asked)
        level, count, far = np.full(n, np.nan), np.zeros(n, np.int64), np.full(n, np.nan)
        out = asked[["h", "x", "y"]].copy() if n else pd.DataFrame(columns=["h", "x", "y"])
        if n and len(ground):
            # by square, inside a square in the order of ties
            g = ground.sort_values(["by", "bx", "gx", "gy"], kind="stable")
            gx, gy, gz = (g[c].to_numpy(np.float64) for c in ("gx", "gy", "gz"))
            void, rank = g["void"].to_numpy(bool), np.lexsort((gy, gx)).argsort()
            low, wide = int(g.bx.min()) - 2, int(max(g.bx.max(), asked.bx.max()) - min(g.bx.min(), asked.bx.min())) + 6
            at = g.by.to_numpy(np.int64) * wide + (g.bx.to_numpy(np.int64) - low)
            by, bx = asked.by.to_numpy(np.int64), asked.bx.to_numpy(np.int64)
            x, y = asked.x.to_numpy(np.float64), asked.y.to_numpy(np.float64)
            order = np.lexsort((bx, by))
            cut = np.flatnonzero((np.diff(by[order]) != 0) | (np.diff(bx[order]) != 0)) + 1
            starts, ends = np.append(0, cut), np.append(cut, n)
            mid = by[order[starts]] * wide + (bx[order[starts]] - low)
            first = [np.searchsorted(at, mid + d * wide - 1).tolist() for d in (-1, 0, 1)]
            behind = [np.searchsorted(at, mid + d * wide + 1, "right").tolist() for d in (-1, 0, 1)]
            for s, (a, b) in enumerate(zip(starts.tolist(), ends.tolist(), strict=True)):
                c = np.concatenate([np.arange(first[d][s], behind[d][s]) for d in range(3)])
                if not len(c):
                    continue
                c = c[np.argsort(rank[c])]
                for lo in range(a, b, max(1, pairs // len(c))):
                    p = order[lo : min(b, lo + max(1, pairs // len(c)))]
                    d2 = (x[p, None] - gx[c]) ** 2 + (y[p, None] - gy[c]) ** 2
                    best = np.argsort(d2, axis=1, kind="stable")[:, :k]
                    d2 = np.take_along_axis(d2, best, 1)
                    w, own = 1 / (d2 + 1e-6), c[best]
                    some = np.where(void[own], 0.0, w * gz[own]).sum(1) / w.sum(1)
                    level[p], count[p], far[p] = np.where(void[own].all(1), np.nan, some), best.shape[1], d2[:, -1]
        return out.assign(ground=level, n=count, far=far)

    return run


def clip_height(df: DataFrame, z: str, q: float) -> DataFrame:
    """Returns at or above the ground and below a quantile of all such heights."""
    up = df.filter(F.col(z) >= 0)
    cut = quantile(up, z, q).first()
    return up.filter(F.col(z) < F.lit(cut["q"])) if cut else up


def veg_metrics(df: DataFrame, z: str, res: float = 1.0) -> DataFrame:
    """Share of returns below 1 m, from 1 to 5 m and above 5 m, per cell."""
    share = lambda cond: F.avg(F.when(cond, 1.0).otherwise(0.0))
    v = F.col(z)
    return df.groupBy("h", F.floor(F.col("y") / res).alias("r"), F.floor(F.col("x") / res).alias("c")).agg(
        share(v < 1).alias("pct_below_1m"), share((v >= 1) & (v <= 5)).alias("pct_1m_to_5m"), share(v > 5).alias("pct_above_5m")
    )


def thin_returns(df: DataFrame, per_cell: int, key: str, seed: int = 0) -> DataFrame:
    """First returns only, at most ``per_cell`` a cell in hash order."""
    w = Window.partitionBy("h", F.floor("y"), F.floor("x")).orderBy(hash_order(F.col(key), seed), key)
    return df.filter("ret_no = 1").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_cell).drop("_n")
