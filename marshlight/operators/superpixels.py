"""Superpixels over class-probability bands."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .iterate import discard, settle

KEY = ["h", "r", "c"]
TILE = 8  # buckets on the side of a tile


def superpixels(cells: DataFrame, bands: list[str], step: int = 8, compactness: float = 0.2, rounds: int = 10, min_area: int = 16) -> DataFrame:
    """``h, r, c, sp``: cells grouped about moving centres by Jensen-Shannon distance of their probabilities and
    distance in space.

    Centres start on a grid of ``step``; a cell meets only centres of its own and the eight buckets around (side
    ``step``). After a fixed number of rounds, connected pieces are told apart and pieces under ``min_area`` cells
    join the touching piece with the smallest id, if there is one. Watersheds, rows and columns are numbers below 2^21;
    a missing band or NaN is left out of means and distances.

    Cells are packed once, one row for each tile of 8 x 8 buckets. A round sends a tile the centres that its cells may
    meet, and from it come only its sums for each centre, so pairs of cells and centres exist only inside a task. All
    cells of a centre lie within a few buckets, so its pieces are told apart where its cells meet.
    """
    n, side = len(bands), step * TILE
    held = [np.dtype("int32"), np.dtype("int32"), np.dtype("float64")]

    def pack(t: pd.DataFrame) -> pd.DataFrame:
        t = t.drop_duplicates(["r", "c"]).sort_values(["r", "c"])
        parts = (t[["r", "c"]].sub([t.tr[0] * side, t.tc[0] * side]).to_numpy(held[0]).T.tobytes(), t[bands].to_numpy(held[2]).T.tobytes())
        return pd.DataFrame({"h": t.h[:1], "tr": t.tr[:1], "tc": t.tc[:1], "at": parts[0], "p": parts[1]})

    def unpack(t: pd.Series) -> tuple:
        at, p = np.frombuffer(t["at"], held[0]).reshape(2, -1).astype("int64"), np.frombuffer(t["p"], held[2]).reshape(n, -1)
        return at[0] + t["tr"] * side, at[1] + t["tc"] * side, p

    def chosen(tiles: pd.DataFrame, centres: pd.DataFrame) -> tuple:
        """A tile's cells that meet a centre, with their bands and the number of that centre."""
        r, c, p = unpack(tiles.iloc[0])
        centres = centres.sort_values(["id_r", "id_c"], ignore_index=True)
        best = _nearest(r, c, p, centres.cr.to_numpy(), centres.cc.to_numpy(), centres[[f"p{i}" for i in range(n)]].to_numpy(held[2]).T, step, compactness)
        met = best >= 0
        return r[met], c[met], p[:, met], best[met], centres

    def sums(tiles: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(tiles) or not len(centres):
            return pd.DataFrame({k: [] for k in names})
        r, c, p, best, centres = chosen(tiles, centres)
        of = lambda w: np.bincount(best, w, len(centres))
        out = {"h": tiles.h[0], "id_r": centres.id_r, "id_c": centres.id_c, "n": np.bincount(best, minlength=len(centres)), "sr": of(r), "sc": of(c)}
        for i in range(n):
            out |= {f"s{i}": of(np.nan_to_num(p[i], nan=0.0)), f"n{i}": of(~np.isnan(p[i])).astype("int64")}
        out = pd.DataFrame(out)
        return out[out.n > 0]

    def assigned(tiles: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        if not len(tiles) or not len(centres):
            return pd.DataFrame({k: [] for k in (*KEY, "id_r", "id_c")})
        r, c, _, best, centres = chosen(tiles, centres)
        return pd.DataFrame({"h": tiles.h[0], "r": r, "c": c, "id_r": centres.id_r.to_numpy()[best], "id_c": centres.id_c.to_numpy()[best]})

    kinds = "h long, id_r long, id_c long, n long, sr double, sc double, " + ", ".join(f"s{i} double, n{i} long" for i in range(n))
    names = [k.split()[0] for k in kinds.split(", ")]
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])

    def meeting(tiles: DataFrame, centres: DataFrame):
        """Tiles with the centres in their own buckets and those around."""
        to = lambda k: F.explode(F.array_distinct(F.transform(near, lambda i: F.floor((F.floor(F.col(k) / step) + i) / TILE))))
        sent = centres.withColumn("tr", to("cr")).withColumn("tc", to("cc"))
        return tiles.groupBy("h", "tr", "tc").cogroup(sent.groupBy("h", "tr", "tc"))

    def means(parts: DataFrame) -> DataFrame:
        one = parts.groupBy("h", "id_r", "id_c").agg(*[F.sum(k).alias(k) for k in names[3:]])
        return one.select("h", "id_r", "id_c", (F.col("sr") / F.col("n")).alias("cr"), (F.col("sc") / F.col("n")).alias("cc"), *[F.try_divide(f"s{i}", f"n{i}").alias(f"p{i}") for i in range(n)])

    p = cells.filter("h IS NOT NULL AND r IS NOT NULL AND c IS NOT NULL").select(*[F.col(k).cast("long").alias(k) for k in KEY], *[F.col(b).cast("double").alias(b) for b in bands])
    tiled = p.withColumns({"tr": F.floor(F.col("r") / side), "tc": F.floor(F.col("c") / side)})
    tiles = settle(tiled.groupBy("h", "tr", "tc").applyInPandas(pack, "h long, tr long, tc long, at binary, p binary"), "tiles")

    def begun(batches):
        for batch in batches:
            for _, t in batch.iterrows():
                r, c, v = unpack(t)
                one = pd.DataFrame({"h": t["h"], "id_r": r // step, "id_c": c // step, "n": 1, "sr": r.astype("float64"), "sc": c.astype("float64")})
                for i in range(n):
                    one[f"s{i}"], one[f"n{i}"] = np.nan_to_num(v[i], nan=0.0), (~np.isnan(v[i])).astype("int64")
                yield one.groupby(["h", "id_r", "id_c"], as_index=False).sum()

    centres = settle(means(tiles.mapInPandas(begun, kinds)), "centres")
    for _ in range(rounds - 1):
        new = settle(means(meeting(tiles, centres).applyInPandas(sums, kinds)), "centres")
        discard(centres)
        centres = new
    best = meeting(tiles, centres).applyInPandas(assigned, "h long, r long, c long, id_r long, id_c long")

    def told_apart(t: pd.DataFrame) -> pd.DataFrame:
        root = _pieces(t.r.to_numpy(), t.c.to_numpy(), t.id_r.to_numpy(), t.id_c.to_numpy())
        node = (t.h.to_numpy() * (1 << 21) + t.r.to_numpy()) * (1 << 21) + t.c.to_numpy()
        return pd.DataFrame({"h": t.h, "r": t.r, "c": t.c, "sp": node[root], "small": np.bincount(root, minlength=len(t))[root] < min_area})

    group = [F.floor(F.col(k) / TILE).alias(f"g_{k}") for k in ("id_r", "id_c")]
    piece = settle(best.groupBy("h", *group).applyInPandas(told_apart, "h long, r long, c long, sp long, small boolean"), "pieces")
    discard(centres, tiles)
    small = piece.filter("small").select(*KEY, "sp")
    around = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((-1, 0), (1, 0), (0, -1), (0, 1))])
    asked = small.withColumn("d", F.explode(around)).select("sp", "h", (F.col("r") + F.col("d.i")).alias("r"), (F.col("c") + F.col("d.j")).alias("c"))
    move = asked.join(piece.filter("NOT small").select(*KEY, F.col("sp").alias("to")), KEY).groupBy("sp").agg(F.min("to").alias("to"))
    return piece.filter("NOT small").select(*KEY, "sp").union(small.join(move, "sp", "left").select(*KEY, F.coalesce("to", "sp").alias("sp")))


def _nearest(r, c, p, cr, cc, q, step: int, compactness: float) -> np.ndarray:
    """The number of each cell's nearest centre (the first, of equals) among those of its own bucket and the eight
    around, or -1. Rows of ``p`` and ``q`` are bands."""
    br, bc = np.floor_divide(r, step), np.floor_divide(c, step)
    kr, kc = np.floor(cr / step).astype("int64"), np.floor(cc / step).astype("int64")
    low = (min(br.min(), kr.min()) - 1, min(bc.min(), kc.min()) - 1)
    wide = max(bc.max(), kc.max()) - low[1] + 2
    bucket = (br - low[0]) * wide + bc - low[1]
    order = np.argsort((kr - low[0]) * wide + kc - low[1], kind="stable")
    held = ((kr - low[0]) * wide + kc - low[1])[order]
    best, far = np.full(len(r), -1), np.full(len(r), np.inf)
    for d in [i * wide + j for i in (-1, 0, 1) for j in (-1, 0, 1)]:
        first, last = np.searchsorted(held, bucket + d), np.searchsorted(held, bucket + d, "right")
        for k in range(int((last - first).max(initial=0))):  # the k-th centre of that bucket
            of = np.flatnonzero(first + k < last)
            m = order[first[of] + k]
            div = np.zeros(len(of))
            for a, b in zip(p[:, of], q[:, m], strict=True):
                mid = (a + b) / 2
                div += (_entropy(a, mid) + _entropy(b, mid)) / 2
            div = np.nan_to_num(np.maximum(div, 0.0), nan=0.0)  # a missing band: by distance in space alone
            at = np.round(np.sqrt(div) + compactness * np.sqrt((r[of] - cr[m]) ** 2 + (c[of] - cc[m]) ** 2) / step, 9)
            won = (at < far[of]) | ((at == far[of]) & (m < best[of]))
            best[of[won]], far[of[won]] = m[won], at[won]
    return best


def _entropy(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(a > 0, a * (np.log(a / b) / np.log(2.0)), np.where(np.isnan(b), np.nan, 0.0))


def _pieces(r, c, id_r, id_c) -> np.ndarray:
    """For each cell, the number of the first cell (by row, then column) of its piece: cells with the same centre,
    joined over their sides."""
    order = np.lexsort((c, r))
    place = np.empty(len(r), dtype="int64")
    place[order] = np.arange(len(r))
    cell, links = pd.DataFrame({"r": r, "c": c, "id_r": id_r, "id_c": id_c, "k": place}), []
    for i, j in ((0, 1), (1, 0)):
        met = cell.assign(r=r + i, c=c + j).merge(cell, on=["r", "c", "id_r", "id_c"])
        links.append((met.k_x.to_numpy(), met.k_y.to_numpy()))
    a, b = (np.concatenate(x) for x in zip(*links, strict=True))
    low = np.arange(len(r))
    while True:  # labels fall to the least neighbour's, then to their label's label
        was = low.copy()
        np.minimum.at(low, a, low[b])
        np.minimum.at(low, b, low[a])
        low = low[low]
        if (low == was).all():
            break
    return order[low[place]]
