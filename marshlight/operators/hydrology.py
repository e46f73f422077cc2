"""Depression filling and flow accumulation: tiles solve themselves, small graphs of their borders tie them together.

Cell tables are read twice, whatever way water takes: once for what each tile's border knows, once for the result. Rows and
columns stay below 2^30.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .focal import KEY
from .iterate import discard, settle

# fixed values: codes of the eight directions and the neighbour each points to (row, column)
STEPS = {1: (0, 1), 2: (1, 1), 4: (1, 0), 8: (1, -1), 16: (0, -1), 32: (-1, -1), 64: (-1, 0), 128: (-1, 1)}
SEA = -(1 << 62)  # row and column of what lies outside all cells
FAN = 4  # groups of tiles along each side of the next larger group
_GRAPH = "h long, r1 long, c1 long, r2 long, c2 long, w double"
_LEVELS = "h long, r long, c long, w double"


def _load(pdf: pd.DataFrame, tile: int):
    """A tile's own cells in a grid with a rim of one: rows, columns, heights, and which cells lack a neighbour."""
    tr, tc = int(pdf.tr.iloc[0]), int(pdf.tc.iloc[0])
    i, j = (pdf.r - tr * tile + 1).to_numpy(), (pdf.c - tc * tile + 1).to_numpy()
    z = np.full((tile + 4, tile + 4), np.nan)
    z[i + 1, j + 1] = pdf.z
    there = ~np.isnan(z)
    full = np.ones((tile + 2, tile + 2), bool)
    for a in range(3):
        for b in range(3):
            full &= there[a : a + tile + 2, b : b + tile + 2]
    z = z[1:-1, 1:-1]
    own = ~np.isnan(z)
    own[[0, -1]] = own[:, [0, -1]] = False
    return tr * tile - 1, tc * tile - 1, np.where(own, z, np.nan), own & ~full


def flood(z: np.ndarray, seeds: np.ndarray, levels: np.ndarray, labels: np.ndarray):
    """Least level at or above ``z`` at which each cell is reached from a seed, and that seed's label. ``z`` has a rim of
    missing cells; a seed keeps its own level and label."""
    width = z.shape[1]
    offs = (-width - 1, -width, -width + 1, -1, 1, width - 1, width, width + 1)
    ground, w, label = z.ravel().tolist(), [None] * z.size, [-2] * z.size
    heap = []
    for s, v, b in zip(seeds.tolist(), levels.tolist(), labels.tolist(), strict=True):
        w[s], label[s] = v, b
        heap.append((v, s))
    heapq.heapify(heap)
    while heap:
        v, s = heapq.heappop(heap)
        b = label[s]
        for o in offs:
            t = s + o
            if w[t] is None and ground[t] == ground[t]:
                up = ground[t] if ground[t] > v else v
                w[t], label[t] = up, b
                heapq.heappush(heap, (up, t))
    return np.array([np.nan if x is None else x for x in w]).reshape(z.shape), np.array(label).reshape(z.shape)


def _find(parent: list, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def spanning(n: int, a: np.ndarray, b: np.ndarray, w: np.ndarray, kept: np.ndarray):
    """Edges over ``kept`` nodes between which the least highest edge of a path is that of the whole graph. Edges are
    taken from the lowest; when two groups meet, one kept node of each stands for it."""
    parent, stands = list(range(n)), np.where(kept, np.arange(n), -1).tolist()
    out = []
    o = np.argsort(w, kind="stable")
    for x, y, v in zip(a[o].tolist(), b[o].tolist(), w[o].tolist(), strict=True):
        x, y = _find(parent, x), _find(parent, y)
        if x == y:
            continue
        parent[y] = x
        if stands[x] >= 0 and stands[y] >= 0:
            out.append((stands[x], stands[y], v))
        stands[x] = max(stands[x], stands[y]) if min(stands[x], stands[y]) < 0 else stands[x]
    return out


def _border(tile: int):
    """Of each tile: the spill graph of its border cells and of the sea."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0, z, out = _load(pdf, tile)
        rim = np.zeros(z.shape, bool)
        rim[[1, -2]] = rim[:, [1, -2]] = True
        rim &= ~np.isnan(z)
        flat = np.flatnonzero(rim | out)
        if not len(flat):
            return pd.DataFrame(columns=["h", "r1", "c1", "r2", "c2", "w"])
        sea = z.size
        w, label = flood(z, flat, z.ravel()[flat], np.where(rim.ravel()[flat], flat, sea))
        a, b, v = [], [], []
        for i, j in ((0, 1), (1, 0), (1, 1), (1, -1)):
            here = (slice(0, z.shape[0] - i), slice(max(0, -j), z.shape[1] - max(0, j)))
            there = (slice(i, None), slice(max(0, j), z.shape[1] + min(0, j)))
            p, q, high = label[here], label[there], np.maximum(w[here], w[there])
            met = (p != q) & (p >= 0) & (q >= 0)
            a.append(p[met]), b.append(q[met]), v.append(high[met])
        both = np.flatnonzero(rim & out)
        a, b, v = (np.concatenate(x) for x in ([*a, both], [*b, np.full(len(both), sea)], [*v, z.ravel()[both]]))
        edges = spanning(sea + 1, a, b, v, np.ones(sea + 1, bool))
        nodes = np.flatnonzero(rim)
        x = np.array([e[0] for e in edges] + nodes.tolist(), np.int64)
        y = np.array([e[1] for e in edges] + nodes.tolist(), np.int64)
        v = np.array([e[2] for e in edges] + z.ravel()[nodes].tolist())
        x, y = np.where(x == sea, y, x), np.where(x == sea, x, y)
        place = lambda k, first, step: np.where(k == sea, SEA, first + (k // z.shape[1] if step else k % z.shape[1]))
        return pd.DataFrame({"h": int(pdf.h.iloc[0]), "r1": place(x, r0, 1), "c1": place(x, c0, 0), "r2": place(y, r0, 1), "c2": place(y, c0, 0), "w": v})

    return run


def _graph(pdf: pd.DataFrame):
    """Nodes (ids, rows, columns; the sea comes last) and edges of a group: its members' edges, and those between
    neighbouring nodes."""
    own = (pdf.r1 == pdf.r2) & (pdf.c1 == pdf.c2)
    r, c, z = (pdf.loc[own, k].to_numpy() for k in ("r1", "c1", "w"))
    at = (r << 32) + c
    o = np.argsort(at)
    at, r, c, z = at[o], r[o], c[o], z[o]
    n = len(at)
    rest = pdf[~own]
    a = np.searchsorted(at, (rest.r1.to_numpy() << 32) + rest.c1.to_numpy())
    b = np.where(rest.r2 == SEA, n, np.searchsorted(at, (rest.r2.to_numpy() << 32) + rest.c2.to_numpy()))
    ends, w = [(a, b)], [rest.w.to_numpy()]
    for i, j in ((0, 1), (1, 0), (1, 1), (1, -1)):
        near = at + (i << 32) + j
        k = np.minimum(np.searchsorted(at, near), max(0, n - 1))
        hit = np.flatnonzero(at[k] == near) if n else np.empty(0, np.int64)
        ends.append((hit, k[hit]))
        w.append(np.maximum(z[hit], z[k[hit]]))
    return r, c, z, *(np.concatenate([e[k] for e in ends]) for k in (0, 1)), np.concatenate(w)


def _contract(size: int):
    """The spill graph of a group of tiles, of its border cells only."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c, z, a, b, w = _graph(pdf)
        n = len(r)
        rim = np.isin(r % size, (0, size - 1)) | np.isin(c % size, (0, size - 1))
        edges = spanning(n + 1, a, b, w, np.append(rim, True))
        nodes = np.flatnonzero(rim)
        x = np.array([min(e[:2]) for e in edges] + nodes.tolist(), np.int64)
        y = np.array([max(e[:2]) for e in edges] + nodes.tolist(), np.int64)
        v = np.array([e[2] for e in edges] + z[nodes].tolist())
        r, c = np.append(r, SEA), np.append(c, SEA)
        return pd.DataFrame({"h": int(pdf.h.iloc[0]), "r1": r[x], "c1": c[x], "r2": r[y], "c2": c[y], "w": v})

    return run


def _spread(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """Levels of all nodes of a group, from the sea and the levels of its border."""
    if not len(pdf):
        return pd.DataFrame(columns=["h", "r", "c", "w"])
    r, c, _, a, b, w = _graph(pdf)
    n = len(r)
    first, second, high = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([w, w])
    o = np.argsort(first, kind="stable")
    start = np.searchsorted(first[o], np.arange(n + 2)).tolist()
    to, high = second[o].tolist(), high[o].tolist()
    level = [np.inf] * n + [-np.inf]
    heap = [(-np.inf, n)]
    at = (r << 32) + c
    if len(known):
        for k, v in zip(np.searchsorted(at, (known.r.to_numpy() << 32) + known.c.to_numpy()).tolist(), known.w.tolist(), strict=True):
            level[k] = min(level[k], v)
            heap.append((v, k))
    heapq.heapify(heap)
    while heap:
        v, x = heapq.heappop(heap)
        if v > level[x]:
            continue
        for k in range(start[x], start[x + 1]):
            up = max(v, high[k])
            if up < level[to[k]]:
                level[to[k]] = up
                heapq.heappush(heap, (up, to[k]))
    return pd.DataFrame({"h": int(pdf.h.iloc[0]), "r": r, "c": c, "w": np.array(level[:n])})


def _surface(tile: int):
    """A tile's cells, flooded from the levels of its border and from cells at the edge of all."""

    def run(pdf: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["h", "r", "c", "w"])
        r0, c0, z, out = _load(pdf, tile)
        level = np.full(z.shape, np.nan)
        if len(known):
            level[known.r.to_numpy() - r0, known.c.to_numpy() - c0] = known.w
        seeds = np.flatnonzero(~np.isnan(level) | out)
        level = np.where(out, z, level)
        w, _ = flood(z, seeds, level.ravel()[seeds], seeds)
        i, j = np.nonzero(~np.isnan(z))
        return pd.DataFrame({"h": int(pdf.h.iloc[0]), "r": i + r0, "c": j + c0, "w": w[i, j]})

    return run


def _from_zero(cells: DataFrame) -> tuple[DataFrame, int]:
    """Each watershed's first row and column, and the longest side of any."""
    ext = settle(cells.groupBy("h").agg(F.min("r").alias("r0"), F.min("c").alias("c0"), F.max("r").alias("r1"), F.max("c").alias("c1")), "extent")
    side = ext.agg(F.max(F.greatest(F.col("r1") - F.col("r0"), F.col("c1") - F.col("c0"))).alias("m")).first()["m"]
    return ext, 1 + (side or 0)


def fill_depressions(cells: DataFrame, band: str = "dem", tile: int = 128) -> DataFrame:
    """Least surface at or above the terrain from which every cell drains to the edge (a cell with a missing neighbour).

    Each tile is flooded once from its border with a heap; where two border cells' floods meet is an edge of its spill
    graph. Graphs of ``FAN`` x ``FAN`` neighbours are joined and cut down to the border of the larger square, level by level,
    until one is left for a watershed; then levels come down the same way, and each tile is flooded once more from
    the known levels of its border. A group holds the borders of ``FAN`` x ``FAN`` squares. Missing heights are no cells;
    an empty table gives none.
    """
    there = cells.filter(F.col(band).isNotNull())
    ext, side = _from_zero(there)
    own = there.join(ext, "h").select("h", (F.col("r") - F.col("r0")).alias("r"), (F.col("c") - F.col("c0")).alias("c"), F.col(band).cast("double").alias("z"))
    near = lambda x: F.explode(F.sequence(F.floor((F.col(x) - 1) / tile), F.floor((F.col(x) + 1) / tile)))
    tiles = own.select("*", near("r").alias("tr")).select("*", near("c").alias("tc"))
    graphs, size = [settle(tiles.groupBy("h", "tr", "tc").applyInPandas(_border(tile), _GRAPH), "spill")], tile * FAN
    group = lambda r, c, s: ["h", F.floor(F.col(r) / s).alias("tr"), F.floor(F.col(c) / s).alias("tc")]
    while size < side:
        graphs.append(settle(graphs[-1].groupBy(*group("r1", "c1", size)).applyInPandas(_contract(size), _GRAPH), "spill"))
        size *= FAN
    levels = settle(cells.sparkSession.createDataFrame([], _LEVELS), "levels")
    for graph in reversed(graphs):
        met = graph.groupBy(*group("r1", "c1", size)).cogroup(levels.groupBy(*group("r", "c", size)))
        lower = settle(met.applyInPandas(_spread, _LEVELS), "levels")
        discard(levels, graph)
        levels, size = lower, size // FAN
    done = settle(tiles.groupBy("h", "tr", "tc").cogroup(levels.groupBy(*group("r", "c", tile))).applyInPandas(_surface(tile), _LEVELS), "filled")
    out = settle(done.join(ext, "h").select("h", (F.col("r") + F.col("r0")).alias("r"), (F.col("c") + F.col("c0")).alias("c"), F.col("w").alias(band)), "surface", cells=True)
    discard(levels, done, ext)
    return out


def _paths(pdf: pd.DataFrame, tile: int, weight: np.ndarray):
    """Accumulated weights of a tile's cells and the cell by which each one's water leaves the tile (-1: it stays)."""
    r, c, d = (pdf[k].to_numpy() for k in ("r", "c", "dir"))
    r0, c0 = int(pdf.tr.iloc[0]) * tile, int(pdf.tc.iloc[0]) * tile
    at = np.full((tile, tile), -1)
    at[r - r0, c - c0] = np.arange(len(r))
    step = np.array([STEPS.get(int(x), (0, 0)) for x in d]).reshape(-1, 2)
    tr, tc = r + step[:, 0], c + step[:, 1]
    moves = (step != 0).any(axis=1)
    inside = moves & (tr >= r0) & (tr < r0 + tile) & (tc >= c0) & (tc < c0 + tile)
    nxt = np.where(inside, at[np.clip(tr - r0, 0, tile - 1), np.clip(tc - c0, 0, tile - 1)], -1)
    waiting = np.bincount(nxt[nxt >= 0], minlength=len(r)).tolist()
    order = [i for i, n in enumerate(waiting) if not n]
    acc, to = weight.tolist(), nxt.tolist()
    for i in order:  # grows while it is read: a cell follows when all that drain into it are done
        t = to[i]
        if t >= 0:
            acc[t] += acc[i]
            waiting[t] -= 1
            if not waiting[t]:
                order.append(t)
    if len(order) < len(r):
        raise ValueError("flow directions run in a circle")
    leaves = np.where(moves & ~inside, np.arange(len(r)), -1).tolist()
    for i in reversed(order):
        if to[i] >= 0:
            leaves[i] = leaves[to[i]]
    return np.array(acc, np.int64), np.array(leaves), tr, tc


_EXITS = "h long, r long, c long, kind int, acc long, tr long, tc long"


def _exits(tile: int):
    """Of each tile: what flows out of it, from and to which cell (kind 0), and for its border cells the cell by which
    water that comes in there leaves again (kind 1)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        acc, leaves, tr, tc = _paths(pdf, tile, np.ones(len(pdf), np.int64))
        r, c = pdf.r.to_numpy(), pdf.c.to_numpy()
        out = np.flatnonzero(leaves == np.arange(len(r)))
        rim = np.flatnonzero(np.isin(r % tile, (0, tile - 1)) | np.isin(c % tile, (0, tile - 1)))
        rim = rim[leaves[rim] >= 0]
        one = pd.DataFrame({"r": r[out], "c": c[out], "kind": 0, "acc": acc[out], "tr": tr[out], "tc": tc[out]})
        two = pd.DataFrame({"r": r[rim], "c": c[rim], "kind": 1, "acc": 0, "tr": r[leaves[rim]], "tc": c[leaves[rim]]})
        return pd.concat([one, two]).assign(h=int(pdf.h.iloc[0]))[["h", "r", "c", "kind", "acc", "tr", "tc"]]

    return run


def _accumulate(tile: int):
    def run(pdf: pd.DataFrame, inflow: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return pd.DataFrame(columns=["h", "r", "c", "acc"])
        more = pdf[["r", "c"]].merge(inflow[["r", "c", "more"]], on=["r", "c"], how="left")["more"].fillna(0).to_numpy().astype(np.int64) if len(inflow) else 0
        acc, *_ = _paths(pdf, tile, np.full(len(pdf), 1, np.int64) + more)
        return pd.DataFrame({"h": pdf.h, "r": pdf.r, "c": pdf.c, "acc": acc})

    return run


def flow_acc(dirs: DataFrame, tile: int = 128) -> DataFrame:
    """Cells that drain through each cell, itself included; a code of no direction ends a path, as does a step to no cell.

    Tiles add up their own cells; the cells by which water leaves a tile form a forest, in which sums run down by
    doubling (after t rounds over 2^t tiles); each tile then adds up once more with what flows in. Only border cells
    take part in the rounds. Directions that run in a circle raise an error; an empty table gives none.
    """
    own = dirs.select(*KEY, "dir", F.floor(F.col("r") / tile).alias("tr"), F.floor(F.col("c") / tile).alias("tc"))
    both = settle(own.groupBy("h", "tr", "tc").applyInPandas(_exits(tile), _EXITS), "exits")
    ways = both.filter("kind = 1").select("h", F.col("r").alias("tr"), F.col("c").alias("tc"), F.col("tr").alias("nr"), F.col("tc").alias("nc"))
    out = both.filter("kind = 0").drop("kind")
    state = settle(out.join(ways, ["h", "tr", "tc"], "left"), "flow")
    for _ in range(state.count().bit_length() + 1):  # a way that does not end by then passes a cell twice
        moving = state.filter("nr IS NOT NULL")
        if not moving.limit(1).count():
            break
        more = moving.groupBy("h", F.col("nr").alias("r"), F.col("nc").alias("c")).agg(F.sum("acc").alias("more"))
        ahead = state.select("h", F.col("r").alias("nr"), F.col("c").alias("nc"), F.col("nr").alias("n2r"), F.col("nc").alias("n2c"))
        new = state.join(more, KEY, "left").join(ahead, ["h", "nr", "nc"], "left")
        new = settle(new.select(*KEY, (F.col("acc") + F.coalesce("more", F.lit(0))).alias("acc"), "tr", "tc", F.col("n2r").alias("nr"), F.col("n2c").alias("nc")), "flow")
        discard(state)
        state = new
    else:
        raise ValueError("flow directions run in a circle")
    inflow = state.groupBy("h", F.col("tr").alias("r"), F.col("tc").alias("c")).agg(F.sum("acc").alias("more"))
    met = own.groupBy("h", "tr", "tc").cogroup(inflow.groupBy("h", F.floor(F.col("r") / tile).alias("tr"), F.floor(F.col("c") / tile).alias("tc")))
    total = settle(met.applyInPandas(_accumulate(tile), "h long, r long, c long, acc long"), "acc", cells=True)
    discard(both, state)
    return total
