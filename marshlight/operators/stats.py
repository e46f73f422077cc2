"""Aggregates, windows, order and set operations of the data-frame side."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .iterate import settle


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def mean_by(df: DataFrame, key: str, val: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(val).alias("mean"), F.count("*").alias("n"))


def null_counts(df: DataFrame, key: str) -> DataFrame:
    """Missing values of every other column, per key."""
    return df.groupBy(key).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns if c != key])


def flag_low(df: DataFrame, group: list[str], val: str) -> DataFrame:
    """Group mean and sample deviation on each row, and a flag where the value is under |mean - sd|. Groups are summed
    before the shuffle and their one row each met with the rows, so no group is held in one task."""
    of = df.groupBy(*[F.col(k).alias(f"_{k}") for k in group]).agg(F.avg(val).alias("mean"), F.stddev_samp(val).alias("sd"))
    out = df.join(of, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in group]).drop(*[f"_{k}" for k in group])
    return out.withColumn("flag", F.when(F.col(val) < F.abs(F.col("mean") - F.col("sd")), "YesBad").otherwise("No"))


def distinct_on(df: DataFrame, key: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each key in a stated order."""
    n = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return df.withColumn("_n", n).filter("_n = 1").drop("_n")


def list_by(df: DataFrame, key: str, val: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_sort(F.collect_set(val)).alias("values"))


def to_long(df: DataFrame, ids: list[str], cols: list[str]) -> DataFrame:
    return df.unpivot(ids, cols, "band", "value")


def _per_band(cells: DataFrame, bands: list[str], stats: dict[str, Column]) -> DataFrame:
    """One row per band from one aggregation of the cells: ``stats`` are aggregates of the column ``value``."""
    one = lambda b: F.struct(F.lit(b).alias("band"), *[F.col(f"{b}.{n}").alias(n) for n in stats])
    parts = [cells.select(F.col(b).alias("value")).agg(F.struct(*[f.alias(n) for n, f in stats.items()]).alias(b)) for b in bands]
    out = parts[0].select(one(bands[0]).alias("s"))
    for b, p in zip(bands[1:], parts[1:], strict=True):
        out = out.union(p.select(one(b).alias("s")))
    return out.select("s.*")


def global_stats(cells: DataFrame, bands: list[str], fns: dict[str, Column] | None = None) -> DataFrame:
    """Per band: mean, max, sd, count, and user aggregates over the column ``value``. Each band is a scan of its own
    column with sums in the tasks; cells are not turned into rows of bands."""
    return _per_band(cells, bands, {"mean": F.avg("value"), "max": F.max("value"), "sd": F.stddev_samp("value"), "n": F.count("value"), **(fns or {})})


def band_minmax(cells: DataFrame, bands: list[str], skip: tuple[str, ...] = ()) -> DataFrame:
    """Smallest and largest value of each band that is not on the skip list, from one aggregation."""
    kept = [b for b in bands if b not in skip]
    ends = cells.agg(*[f(b).alias(f"{b}_{n}") for b in kept for n, f in (("min", F.min), ("max", F.max))])
    rows = F.array(*[F.struct(F.lit(b).alias("band"), F.col(f"{b}_min").alias("min"), F.col(f"{b}_max").alias("max")) for b in kept])
    return ends.select(F.explode(rows).alias("s")).select("s.*")


def minmax_scale(cells: DataFrame, stats: DataFrame, bands: list[str]) -> DataFrame:
    """Bands scaled to 0..1 by their global statistics: one row of numbers, broadcast."""
    one = stats.groupBy().pivot("band", bands).agg(F.first("min").alias("lo"), F.first("max").alias("hi"))
    met = cells.crossJoin(F.broadcast(one))
    return met.select(*[c for c in cells.columns if c not in bands], *[F.try_divide(F.col(b) - F.col(f"{b}_lo"), F.col(f"{b}_hi") - F.col(f"{b}_lo")).alias(b) for b in bands])


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.corr(a, b).alias("corr"))


def histogram(df: DataFrame, col: str, n: int) -> DataFrame:
    """Counts in n equal bins between the extremes; the last bin holds the maximum."""
    ends = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    pos = F.floor(F.try_divide((F.col(col) - F.col("lo")) * n, F.col("hi") - F.col("lo")))
    met = df.filter(F.col(col).isNotNull()).crossJoin(F.broadcast(ends))
    return met.groupBy(F.least(F.coalesce(pos, F.lit(0)), F.lit(n - 1)).cast("long").alias("bin")).agg(F.count("*").alias("n"))


def zscore(df: DataFrame, ids: list[str], cols: list[str]) -> DataFrame:
    """Standardised columns in long form."""
    stats = df.agg(*[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    out = df.crossJoin(F.broadcast(stats)).select(*ids, *[F.try_divide(F.col(c) - F.col(f"{c}_m"), F.col(f"{c}_s")).alias(c) for c in cols])
    return to_long(out, ids, cols)


def running(df: DataFrame, order: list[str | Column], weight: str | None = None, name: str = "end") -> DataFrame:
    """Rows with the sum of ``weight`` (else their number) up to and including each, over all rows in a total ``order``.

    Ranges of the order are sorted in tasks of their own and written; what lies before a range is the sum of the ranges
    before it, one number each. Ties in the order are taken in any order."""
    w = F.col(weight) if weight else F.lit(1).cast("long")
    cut = settle(df.withColumn("_w", w).repartitionByRange(*order).withColumn("_p", F.spark_partition_id()), "ranges")
    sums = {r["_p"]: r["s"] for r in cut.groupBy("_p").agg(F.sum("_w").alias("s")).collect()}  # one row a task
    before, at = [], 0
    for p in range(max(sums, default=-1) + 1):
        before.append(at)
        at += sums.get(p) or 0
    table = F.array(*[F.lit(v) for v in before]) if before else F.array(F.lit(0))
    inside = Window.partitionBy("_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.withColumn(name, F.sum("_w").over(inside) + F.get(table, F.col("_p"))).drop("_p", "_w")


def quantiles_by(df: DataFrame, key: str, val: str, qs: list[float]) -> DataFrame:
    """Exact quantiles per key, interpolated between neighbours: values are counted, the counts summed in order, and the
    two values about each position picked. No key is collected into one task."""
    counts = df.filter(F.col(val).isNotNull()).groupBy(key, val).agg(F.count("*").alias("_n"))
    ends = running(counts, [key, val], "_n", "_end")
    of = ends.groupBy(F.col(key).alias("_key")).agg(F.min(F.col("_end") - F.col("_n")).alias("_from"), F.sum("_n").alias("_all"))
    met = ends.join(of, F.col(key).eqNullSafe(F.col("_key")))
    end, first = F.col("_end") - F.col("_from"), F.col("_end") - F.col("_from") - F.col("_n")
    out = []
    for i, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("_all") - 1)
        pick = lambda r: F.max(F.when((first <= r) & (r < end), F.col(val)))
        out += [pick(F.floor(at)).alias(f"_l{i}"), pick(F.ceil(at)).alias(f"_h{i}"), F.first(at - F.floor(at)).alias(f"_t{i}")]
    got = met.groupBy(key).agg(*out)
    there = got.select(key, *[(F.col(f"_l{i}") + (F.col(f"_h{i}") - F.col(f"_l{i}")) * F.col(f"_t{i}")).alias(f"q{int(q * 100)}") for i, q in enumerate(qs)])
    keys = df.select(F.col(key).alias("_key")).distinct()
    return keys.join(there, F.col("_key").eqNullSafe(F.col(key)), "left").select(F.col("_key").alias(key), *[f"q{int(q * 100)}" for q in qs])


def quantile(df: DataFrame, val: str, q: float) -> DataFrame:
    """The exact quantile of a column, as one row ``q``."""
    one = quantiles_by(df.select(F.lit(0).alias("_all_rows"), val), "_all_rows", val, [q])
    return one.select(F.col(one.columns[1]).alias("q"))


def row_number(df: DataFrame, order: list[str | Column], by: list[str] | None = None, name: str = "n") -> DataFrame:
    """Rows numbered from 1 in a total order, within ``by`` where given, without one task for a group."""
    ends = running(df, [*(by or []), *order], None, "_end")
    if not by:
        return ends.withColumn(name, F.col("_end").cast("int")).drop("_end")
    first = ends.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(F.min("_end").alias("_from"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in by]
    return ends.join(first, same).withColumn(name, (F.col("_end") - F.col("_from") + 1).cast("int")).drop("_end", "_from", *[f"_{k}" for k in by])


def first_by(df: DataFrame, key: str, val: str, order: str) -> DataFrame:
    return df.groupBy(key).agg(F.min_by(val, order).alias(val))


def which_max(df: DataFrame, key: str, val: str) -> DataFrame:
    return df.agg(F.max_by(key, val).alias("largest"), F.min_by(key, val).alias("smallest"))


def semi(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_semi")


def anti(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return df.join(other.select(key).distinct(), key, "left_anti")


def bind_cols(a: DataFrame, b: DataFrame, order_a: list[str], order_b: list[str]) -> DataFrame:
    """Columns side by side by position in stated orders."""
    return row_number(a, order_a, name="_at").join(row_number(b, order_b, name="_at"), "_at").drop("_at")


def union_basins(dfs: list[DataFrame], suffixes: tuple[str, ...], key: list[str]) -> DataFrame:
    """Rows of several basins without their suffixed columns, one per key."""
    out = None
    for df in dfs:
        part = df.drop(*[c for c in df.columns if c.endswith(suffixes)])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out.dropDuplicates(key)


def fuzzy_best(left: DataFrame, right: DataFrame, lcol: str, rcol: str, block: int = 20_000) -> DataFrame:
    """For each distinct name its nearest reference name by Jaro distance (ties: first by name), and whether it is exact.

    Names are asked, reference names answer, in cells of about ``block`` x 3 ``block`` names. The characters two names can
    share at most bound their similarity from above; names of the same characters have the same bounds, so these are
    computed once for each pair of sets of characters. A name is compared with the references in falling order of the
    bound until none can be nearer, and within a bound in order of name until one reaches it; a cell returns one row per
    name. Null names take no part; without references there are no rows."""
    asked = left.select(F.col(lcol).alias("candidate")).filter("candidate IS NOT NULL").distinct()
    names = right.select(F.col(rcol).alias("reference")).filter("reference IS NOT NULL").distinct()
    rows, cols = (max(1, -(-x.count() // n)) for x, n in ((asked, block), (names, 3 * block)))
    here = asked.withColumn("g", F.pmod(F.xxhash64("candidate"), F.lit(rows))).withColumn("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cols - 1).cast("long"))))
    there = names.withColumn("s", F.pmod(F.xxhash64("reference"), F.lit(cols))).withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rows - 1).cast("long"))))
    # a cell is much work on few bytes: a partition for each, which adaptive execution leaves as they are
    here, there = (x.repartition(rows * cols, "g", "s") for x in (here, there))
    met = here.groupBy("g", "s").cogroup(there.groupBy("g", "s")).applyInPandas(lambda a, b: _nearest(a, b), "candidate string, reference string, dist double")
    best = met.groupBy("candidate").agg(F.min(F.struct("dist", "reference")).alias("m"))
    return best.select("candidate", F.col("m.reference").alias("reference"), F.col("m.dist").alias("dist"), (F.col("candidate") == F.col("m.reference")).alias("exact"))


def _letters(texts: list[str], places: dict[tuple[str, int], int] | None = None) -> tuple[np.ndarray, dict]:
    """Counts of characters: a column for each character's first, second, ... occurrence, so products of two rows count
    what two texts share. Columns are those of ``places``, or the texts' own."""
    own = places is None
    places = {} if own else places
    at = []
    for i, text in enumerate(texts):
        for ch, n in Counter(text).items():
            for k in range(n):
                j = places.setdefault((ch, k), len(places)) if own else places.get((ch, k))
                if j is not None:
                    at.append((i, j))
    out = np.zeros((len(texts), max(1, len(places))), np.float32)
    if at:
        out[tuple(np.array(at).T)] = 1
    return out, places


def _coded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in columns, a text each, -1 behind its end; and the texts' lengths."""
    size = np.array(list(map(len, texts)), np.int64)
    out = np.full((max(1, size.max(initial=0)), len(texts)), -1, np.int32)
    for i, text in enumerate(texts):
        out[: len(text), i] = list(map(ord, text))
    return out, size


def _alike(texts: list[str]) -> tuple[list[str], list[np.ndarray]]:
    """Sets of characters (sorted, repeats kept) and the texts of each, ascending."""
    sets: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        sets.setdefault("".join(sorted(text)), []).append(i)
    return list(sets), [np.array(x) for x in sets.values()]


def _nearest(asked: pd.DataFrame, names: pd.DataFrame, pairs: int = 1 << 18, cells: int = 1 << 22) -> pd.DataFrame:
    if not len(names) or not len(asked):
        return pd.DataFrame(columns=["candidate", "reference", "dist"])
    refs, cand = sorted(names.reference), sorted(asked.candidate)
    (kinds, members), (own, askers) = _alike(refs), _alike(cand)
    right, places = _letters(kinds)
    size = np.array(list(map(len, kinds)))
    (left, n_left), (letters, n_refs) = _coded(cand), _coded(refs)
    best, name = np.full(len(cand), -1.0), np.zeros(len(cand), np.int64)
    step = max(1, cells // len(kinds))
    for s in range(0, len(own), step):
        shared = _letters(own[s : s + step], places)[0].astype(np.float32) @ right.T
        work = []  # of each asked name: its bounds, the level it is on, the references of that level and how many are done
        for text, common, who in zip(own[s : s + step], shared.astype(np.float64), askers[s : s + step], strict=True):
            with np.errstate(divide="ignore", invalid="ignore"):
                bound = np.where(common > 0, (common / len(text) + common / size + 1) / 3, 0.0)
            bound = np.where(size + len(text) == 0, 1.0, bound)
            levels = np.unique(bound)[::-1].tolist()
            of: dict[int, np.ndarray] = {}
            work += [[i, bound, levels, of, 0, 0, 64] for i in who.tolist()]
        while work:
            turn, later, taken = [], [], 0
            for at, w in enumerate(work):
                if taken >= pairs:
                    later = work[at:]
                    break
                i, bound, levels, of, level, done, many = w
                if level not in of:
                    of[level] = np.sort(np.concatenate([members[k] for k in np.flatnonzero(bound == levels[level])]))
                part = of[level][done : done + many]
                turn.append((w, part))
                taken += len(part)
            a = np.repeat([w[0] for w, _ in turn], [len(x) for _, x in turn])
            got = jaro_pairs(left, n_left, letters, n_refs, a, np.concatenate([x for _, x in turn]))
            work, at = later, 0
            for w, part in turn:
                i, bound, levels, of, level, done, many = w
                mine = got[at : at + len(part)]
                at += len(part)
                k = int(mine.argmax())
                top, first = float(mine[k]), int(part[k])
                if top > best[i] or top == best[i] and first < name[i]:
                    best[i], name[i] = top, first
                w[5], w[6] = done + len(part), many * 2
                if best[i] >= levels[level]:  # what follows on this level is no nearer and later by name
                    ended = best[i] > levels[level] or w[5] >= len(of[level]) or of[level][w[5]] > name[i]
                else:
                    ended = w[5] >= len(of[level])
                if ended:
                    w[4], w[5], w[6] = level + 1, 0, 64
                if w[4] < len(levels) and levels[w[4]] >= best[i]:
                    work.append(w)
    return pd.DataFrame({"candidate": cand, "reference": [refs[k] for k in name], "dist": 1.0 - best})


def jaro_pairs(left: np.ndarray, n_left: np.ndarray, right: np.ndarray, n_right: np.ndarray, a: np.ndarray, b: np.ndarray, step: int = 8192) -> np.ndarray:
    """Jaro similarity of pairs of texts, ``a`` of ``left`` with ``b`` of ``right`` (columns of code points, -1 behind
    each one's length)."""
    out = np.zeros(len(a))
    for s in range(0, len(a), step):
        i, j = a[s : s + step], b[s : s + step]
        n, m = n_left[i], n_right[j]
        x, y = left[: max(1, n.max()), i], right[: max(1, m.max()), j]
        reach = np.maximum(n, m) // 2 - 1
        wide, even = int(reach.max()), bool(reach.min() == reach.max())
        free, hit = y >= 0, np.zeros(x.shape, bool)
        for p in range(x.shape[0]):
            open_ = x[p] >= 0
            for q in range(max(0, p - wide), min(y.shape[0], p + wide + 1)):
                take = (y[q] == x[p]) & free[q] & open_
                if not even:
                    take &= abs(p - q) <= reach
                free[q] ^= take
                hit[p] |= take
                open_ ^= take
        used = (y >= 0) & ~free
        both = hit.sum(0)
        own, other = np.zeros((int(both.max(initial=0)) + 1, len(i)), np.int32), np.zeros((int(both.max(initial=0)) + 1, len(i)), np.int32)
        for at, mask, text in ((own, hit, x), (other, used, y)):
            p, q = np.nonzero(mask)
            at[(mask.cumsum(0) - 1)[p, q], q] = text[p, q]
        swaps = (own != other).sum(0) // 2
        with np.errstate(divide="ignore", invalid="ignore"):
            got = np.where(both > 0, (both / n + both / m + (both - swaps) / both) / 3, 0.0)
        w = min(x.shape[0], y.shape[0])
        out[s : s + step] = np.where((n == m) & (n <= w) & (x[:w] == y[:w]).all(0), 1.0, got)
    return out


def jaro_many(a: str, letters: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Jaro similarity of one text to many (rows of code points, -1 behind each one's ``size``)."""
    n, width = letters.shape
    reach = np.maximum(len(a), size) // 2 - 1
    free, hit = letters >= 0, np.zeros((n, len(a)), bool)
    place = np.arange(width)
    for i, ch in enumerate(a):
        near = free & (letters == ord(ch)) & (np.abs(place[None, :] - i) <= reach[:, None])
        j = near.argmax(1)
        hit[:, i] = near[np.arange(n), j]
        free[np.flatnonzero(hit[:, i]), j[hit[:, i]]] = False
    used = (letters >= 0) & ~free
    m = hit.sum(1)
    own, other = np.zeros((n, len(a) + 1), np.int64), np.zeros((n, len(a) + 1), np.int64)
    r, i = np.nonzero(hit)
    own[r, (hit.cumsum(1) - 1)[r, i]] = np.array(list(map(ord, a)), np.int64)[i]
    r, j = np.nonzero(used)
    other[r, (used.cumsum(1) - 1)[r, j]] = letters[r, j]
    swaps = (own != other).sum(1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.where(m > 0, (m / max(1, len(a)) + m / size + (m - swaps) / m) / 3, 0.0)
    whole = (size == len(a)) & (letters[:, : len(a)] == np.array(list(map(ord, a)), np.int64)).all(1) if len(a) <= width else np.zeros(n, bool)
    return np.where(whole, 1.0, out)


def jaro(a: str, b: str) -> float:
    """Jaro similarity: matches within half the longer length, less half (rounded down) of the matched pairs out of order."""
    if a == b:
        return 1.0
    reach = max(len(a), len(b)) // 2 - 1
    free, hits = [True] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == ch:
                free[j] = False
                hits.append(ch)
                break
    if not hits:
        return 0.0
    other = [ch for ch, f in zip(b, free, strict=True) if not f]
    swaps = sum(x != y for x, y in zip(hits, other, strict=True)) // 2
    m = len(hits)
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3
