"""Steps that failed or grew too fast on larger tables."""

import math
import random

import pandas as pd
from pyspark.sql import functions as F

from marshlight.operators import cells as R
from marshlight.operators import geometry as G
from marshlight.operators import lidar as P
from marshlight.operators import spatial as S
from marshlight.operators import stats as T
from marshlight.operators import superpixels as X
from marshlight.operators.grid import base_of, levels_of
from marshlight.operators.iterate import both_ways, settle


def rest(key, k):
    return int(math.fmod(key * 2654435761 + k * 40503, 1000003)) if abs(key) < 1 << 20 else (key * 2654435761 + k * 40503) % 1000003


def test_hash_order_of_keys_beyond_a_long(spark):
    keys = [0, 1, -1, 17, -17, 1000003, -1000003, (1 << 33) + 5, (1 << 60) + 123, (1 << 63) - 1]
    df = spark.createDataFrame([(k,) for k in keys], "key long")
    for k in (0, 1, 7):
        got = {r.key: r.o for r in df.select("key", G.hash_order(F.col("key"), k).alias("o")).collect()}
        assert got == {key: rest(key, k) for key in keys}


def test_cells_of_many_watersheds_are_sampled(spark):
    cells = spark.range(300).select(F.col("id").alias("h"), F.lit(63).cast("long").alias("r"), F.lit(63).cast("long").alias("c"))
    got = [r.h for r in R.sample_cells(cells, 10, seed=1).collect()]
    key = lambda h: (rest(((h * 4096 + 63) * 4096 + 63), 1), h)
    assert sorted(got) == sorted(sorted(range(300), key=key)[:10])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_packed_cells_are_not_broadcast(spark):
    n = 400_000
    cells = settle(spark.range(n).select(F.lit(0).cast("long").alias("h"), F.floor(F.col("id") / 1000).alias("r"), (F.col("id") % 1000).alias("c"), F.lit(1.0).alias("v")), "cells", cells=True)
    few = settle(cells.filter("r < 2"), "few", cells=True)
    other = spark.range(4 * n).select(F.lit(0).cast("long").alias("h"), F.floor(F.col("id") / 1000).alias("r"), (F.col("id") % 1000).alias("c"), F.rand(1).alias("w"))
    assert "BroadcastHashJoin" not in plan_of(other.join(cells.select("h", "r", "c", (F.col("v") + 1).alias("v")), ["h", "r", "c"]))
    assert "BroadcastHashJoin" in plan_of(other.join(few, ["h", "r", "c"]))


def test_ground_is_sought_without_a_row_for_each_pair(spark):
    rows = [(h, (i * 37 % 101) / 4.0, (i * 53 % 97) / 4.0, float(i % 13), 2 if i % 3 else 5) for h in (0, 1) for i in range(500)]
    rows += [(2, 900.0, -900.0, 3.0, 5), (2, 0.0, 0.0, 1.0, 2), (2, 1.0, 0.0, 2.0, 2), (3, 1.0, 1.0, 9.0, 5), (4, 5.0, 5.0, None, 2), (4, 6.0, 5.0, 7.0, 2), (None, 1.0, 1.0, 1.0, 2)]
    df = spark.createDataFrame(rows, "h long, x double, y double, z double, cls int")
    want = {}
    for h, x, y, *_ in rows:
        low = {}
        for h2, gx, gy, z, cls in rows:
            if cls == 2 and h2 == h and h is not None:
                low[gx, gy] = min([v for v in (low.get((gx, gy)), z) if v is not None], default=None)
        near = sorted(((x - gx) ** 2 + (y - gy) ** 2, gx, gy, z) for (gx, gy), z in low.items())[:3]
        known = [(1 / (d + 1e-6), z) for d, _, _, z in near]
        there = [w * z for w, z in known if z is not None]
        want[h, x, y] = sum(there) / sum(w for w, _ in known) if there else None
    for most in (50_000, 7):
        got = P.normalize_height(df, 3, 2.0, most).select("h", "x", "y", "ground").distinct().collect()
        assert len(got) == len(want)
        for r in got:
            assert r.ground == want[r.h, r.x, r.y] or abs(r.ground - want[r.h, r.x, r.y]) < 1e-9


def test_pairs_of_places_and_ground_stay_in_a_task(spark, monkeypatch):
    df = spark.range(600).select(F.lit(0).cast("long").alias("h"), (F.col("id") % 64 / 32).alias("x"), (F.col("id") / 300).alias("y"), F.lit(1.0).alias("z"), F.when(F.col("id") % 2 == 0, 2).otherwise(5).alias("cls"))
    plans = []
    monkeypatch.setattr(P, "settle", lambda x, tag, **more: plans.append((tag, plan_of(x))) or settle(x, tag, **more))
    P.normalize_height(df, 3, 2.0).count()
    heights = [x for tag, x in plans if tag == "heights"]
    assert heights and not any("Window" in x for x in heights)


def test_nearest_names_equal_all_pairs():
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abc1é") for _ in range(n))
    asked = sorted({word(rng.randrange(9)) for _ in range(300)} | {"", "zz", "a"})
    refs = sorted({word(rng.randrange(9)) for _ in range(400)} | {"", "b"})
    got = T._nearest(pd.DataFrame({"candidate": asked}), pd.DataFrame({"reference": refs}), pairs=500, cells=2000)
    want = {a: min((1.0 - T.jaro(a, b), b) for b in refs) for a in asked}
    assert {r.candidate: (r.dist, r.reference) for r in got.itertuples()} == want


def test_names_of_equal_characters_are_bounded_once(monkeypatch):
    """Bounds are computed for sets of characters, comparisons end at the first name that reaches its bound."""
    seen = []
    jaro_pairs = T.jaro_pairs
    monkeypatch.setattr(T, "jaro_pairs", lambda *x: seen.append(len(x[-1])) or jaro_pairs(*x))
    refs = [f"Supplier#{i:09d}" for i in range(3000)]
    asked = [f"Customer#{i:09d}" for i in range(3000)]
    got = T._nearest(pd.DataFrame({"candidate": asked}), pd.DataFrame({"reference": refs}))
    assert len(got) == 3000 and sum(seen) < 300 * 3000


def test_edges_keep_to_small_partitions(spark):
    v = spark.range(4000).select(F.floor(F.col("id") / 5).alias("poly_id"), F.lit(0).cast("long").alias("h"), (F.col("id") % 5).alias("seq"), (F.col("id") % 7 * 1.0).alias("x"), (F.col("id") % 11 * 1.0).alias("y"))
    sizes = [n for n in G.edges(v, most=400).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()]
    assert len(sizes) == 10 and max(sizes) < 3 * 400


def plain_superpixels(cells, step, compactness, rounds, min_area):
    """Superpixels by plain loops over ``{(r, c): bands}`` of one watershed; ids are (r, c)."""
    n = len(next(iter(cells.values())))
    bucket = lambda r, c: (math.floor(r / step), math.floor(c / step))
    mean = lambda v: sum(v) / len(v) if v else None
    grown = lambda at: (mean([r for r, _ in at]), mean([c for _, c in at]), [mean([cells[x][i] for x in at if cells[x][i] is not None]) for i in range(n)])
    own = {x: bucket(*x) for x in cells}
    for turn in range(rounds + 1):
        centres = {k: grown([x for x in cells if own.get(x) == k]) for k in set(own.values())}
        if turn == rounds:
            break
        own = {}
        for (r, c), p in cells.items():
            found = []
            for k, (cr, cc, q) in centres.items():
                near = [abs(a - b) <= 1 for a, b in zip(bucket(r, c), bucket(cr, cc), strict=True)]
                if all(near):
                    part = lambda a, m: a * math.log2(a / m) if a > 0 else 0.0
                    div = 0.0 if None in [*p, *q] else sum((part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2 for a, b in zip(p, q, strict=True))
                    found.append((round(math.sqrt(max(div, 0.0)) + compactness * math.hypot(r - cr, c - cc) / step, 9), k))
            own[r, c] = min(found)[1]
    sp = {}
    for x in sorted(own):
        todo = [] if x in sp else [x]
        while todo:
            r, c = todo.pop()
            if (r, c) not in sp:
                sp[r, c] = x
                todo += [y for y in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)) if own.get(y) == own[x]]
    size = {k: list(sp.values()).count(k) for k in set(sp.values())}
    touch = {}
    for (r, c), k in sp.items():
        touch.setdefault(k, set()).update(sp[y] for y in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)) if y in sp and size[sp[y]] >= min_area)
    return {x: min(touch[k], default=k) if size[k] < min_area else k for x, k in sp.items()}


def test_superpixels_meet_centres_inside_tasks(spark, monkeypatch):
    rng = random.Random(5)
    plans = []
    monkeypatch.setattr(X, "settle", lambda x, tag, **more: plans.append((tag, plan_of(x))) or settle(x, tag, **more))
    cells = {(r, c): [rng.random() if rng.random() < 0.98 else None for _ in range(2)] for r in range(40) for c in range(20, 40) if (r * c) % 17}
    rows = [(h, r + off, c, a, b) for h, off in ((0, 0), (3, 5)) for (r, c), (a, b) in cells.items()]
    df = spark.createDataFrame(rows, "h long, r long, c long, a double, b double")
    got = X.superpixels(df, ["a", "b"], step=4, rounds=3, min_area=6).collect()
    assert len(got) == len(rows)
    for h, off in ((0, 0), (3, 5)):
        want = plain_superpixels({(r + off, c): v for (r, c), v in cells.items()}, 4, 0.2, 3, 6)
        assert {(x.r, x.c): x.sp for x in got if x.h == h} == {x: (h * (1 << 21) + r) * (1 << 21) + c for x, (r, c) in want.items()}
    assert [tag for tag, _ in plans].count("centres") == 3
    assert not any("Join" in plan or "SortAggregate" in plan for _, plan in plans)


def test_points_near_outlines_are_not_paired_with_edges(spark, monkeypatch):
    """A point goes to one square and each edge to few of them; rows for pairs of both are never made."""
    rng = random.Random(11)
    rings, pts = {}, []
    for k in range(60):
        cx, cy, w, t = rng.uniform(-30, 30), rng.uniform(-30, 30), rng.choice([0.01, 1, 5, 40]), rng.uniform(0, 6)
        ring = [(cx + w * math.cos(t + a) * (1 if i else 0.2), cy + w * math.sin(t + a)) for i, a in enumerate((0, 1.3, 2.9, 4.4))]
        rings[k] = (k % 3, [*ring, ring[0]])
    pts = [(i, rng.randrange(4), rng.uniform(-80, 80), rng.uniform(-80, 80)) for i in range(1500)] + [(9000, 0, None, 1.0), (9001, None, 1.0, 1.0)]
    v = spark.createDataFrame([(k, h, i, x, y) for k, (h, ring) in rings.items() for i, (x, y) in enumerate(ring)], "poly_id long, h long, seq int, x double, y double")
    p = spark.createDataFrame(pts, "pt_id long, h long, x double, y double")

    def hit(h, x, y, d):
        if h is None or x is None:
            return False
        for g, ring in rings.values():
            inside = False
            for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False) if g == h else ():
                dx, dy = x2 - x1, y2 - y1
                t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
                if math.hypot(x - x1 - t * dx, y - y1 - t * dy) <= d:
                    return True
                inside ^= (y1 > y) != (y2 > y) and x < dx * (y - y1) / dy + x1
            if inside:
                return True
        return False

    plans = []
    monkeypatch.setattr(S, "settle", lambda x, tag, **more: plans.append((tag, plan_of(x))) or settle(x, tag, **more))
    for d in (0.25, 3.0):
        want = {i for i, h, x, y in pts if hit(h, x, y, d)}
        assert {r.pt_id for r in S.points_near(p, v, d).collect()} == want
        assert {r.pt_id for r in S.points_near(p, v, d, inverse=True).collect()} == {i for i, *_ in pts} - want
    assert {tag for tag, _ in plans} == {"near"} and all("LeftSemi" in x and "Inner" not in x for _, x in plans)


def test_intersecting_polygons_are_sought_once(spark):
    """Edges are settled once, lie on one level, and pairs taken both ways are not computed twice."""
    rng = random.Random(2)
    rings = [(k, k % 2, [(cx + w * x, cy + w * y) for x, y in ((1, 0), (0.5, 1), (-1, 0.25), (-0.5, -1), (1, 0))]) for k in range(80) for cx, cy, w in [(rng.uniform(0, 40), rng.uniform(0, 40), rng.choice([0.3, 1, 2, 3, 12]))]]
    v = spark.createDataFrame([(k, h, i, x, y) for k, h, ring in rings for i, (x, y) in enumerate(ring)], "poly_id long, h long, seq int, x double, y double")
    turn = lambda e, p: (lambda z: (z > 0) - (z < 0))((e[2] - e[0]) * (p[1] - e[1]) - (e[3] - e[1]) * (p[0] - e[0]))
    sides = {k: [(*a, *b) for a, b in zip(ring, ring[1:], strict=False)] for k, _, ring in rings}
    cross = lambda e, f: turn(e, f[:2]) * turn(e, f[2:]) < 0 and turn(f, e[:2]) * turn(f, e[2:]) < 0
    holds = lambda k, p: sum((e[1] > p[1]) != (e[3] > p[1]) and p[0] < (e[2] - e[0]) * (p[1] - e[1]) / (e[3] - e[1]) + e[0] for e in sides[k]) % 2 == 1
    want = set()
    for a, h, ra in rings:
        for b, g, rb in rings:
            if a < b and h == g and (any(cross(e, f) for e in sides[a] for f in sides[b]) or any(holds(a, p) for p in rb) or any(holds(b, p) for p in ra)):
                want.add((a, b))
    pairs = G.intersecting(v)
    assert {(r.a, r.b) for r in pairs.collect()} == want
    assert {(r.a, r.b) for r in both_ways(pairs).collect()} == want | {(b, a) for a, b in want}
    assert plan_of(both_ways(pairs)).count("Window") == 0
    e = G._boxed(G.edges(v))
    assert base_of(e) >= 1 and len({max(x, base_of(e)) for x in levels_of(e)}) < len(levels_of(e))


def test_finer_cells_need_no_row_for_each_neighbour(spark):
    rows = [(h, r, c, None if (r * c) % 7 == 3 else float((r * 31 + c * 17) % 23)) for h in (0, 4) for r in range(9) for c in range(130) if (r + c) % 5 or c > 60]
    cells = spark.createDataFrame(rows, "h long, r long, c long, v double")
    for f in (2, 3):
        got = R._finer(cells, f, "v")
        assert "FlatMapGroupsInPandas" in plan_of(R.resample(cells, 1 / 2, "v", "cubicspline"))
        at = got.select("h", "r", "c", ((F.col("r") + 0.5) / f).alias("sy"), ((F.col("c") + 0.5) / f).alias("sx"))
        want = {(x.h, x.r, x.c): x.v for x in R.sample(at, cells, "v", "cubicspline", ["h", "r", "c"]).collect()}
        found = {(x.h, x.r, x.c): x.v for x in got.collect()}
        assert len(found) == 2 * 9 * 130 * f * f == len(want)
        assert all((v is None) == (want[k] is None) and (v is None or abs(v - want[k]) < 1e-9) for k, v in found.items())


def test_composite_is_resampled_once_for_all_watersheds(spark):
    from marshlight.functions import indices as I
    from marshlight.plans import jobs as J
    from marshlight.plans.fixtures import Fixtures

    obs = Fixtures(spark, "/root/testdata/sf0.001").obs
    rows = [(h, r, k) for h in (0, 1, 7) for r in range(0, 24, 3) for k in range(h, 70)] + [(1, 2, 5), (1, 2, 5), (None, 3, 3), (1, None, 3), (1, 900, 2)]
    grid = spark.createDataFrame(rows, "h long, r long, c long")
    got = J.satellite_composite(obs, grid, 0.25)
    assert "Generate" not in plan_of(got)  # no row for a cell and one of its four neighbours in each watershed
    clear = I.mask_qa60(I.mask_scl(obs.filter("cloud_pct < 20")), ["b2", "b3", "b4", "b6", "b8", "b11"])
    comp = R.median_composite(I.optical_indices(clear), ["NDVI"]).crossJoin(grid.select("h").distinct())
    want = R.warp(comp, grid, lambda x, y: (x * 0.25, y * 0.25), "NDVI")
    table = lambda df: sorted(((r.h, r.r, r.c), None if r.NDVI is None else round(r.NDVI, 9)) for r in df.collect() if None not in (r.h, r.r, r.c))
    assert table(got) == table(want) and any(v is not None for _, v in table(got))
    odd = lambda df: sorted((str(r.h), str(r.r), r.c, r.NDVI) for r in df.filter("h IS NULL OR r IS NULL").collect())
    assert odd(got) == odd(want) == [("1", "None", 3, None), ("None", "3", 3, None)]


def counted(df):
    """The rows of ``df``, and an accumulator of how many were worked out."""
    seen = df.sparkSession.sparkContext.accumulator(0)

    def through(parts):
        for p in parts:
            seen.add(len(p))
            yield p

    return df.mapInPandas(through, df.schema), seen


def marks(spark, n=600):
    got = spark.range(n).select(F.col("id").alias("pt_id"), F.when(F.col("id") % 5 < 2, "UPL").otherwise("WET").alias("k"), (F.col("id") % 5 + F.col("id") % 3).cast("double").alias("a"), (F.col("id") * 37 % 101).cast("double").alias("b"))
    return got.withColumn("a", F.when(F.col("pt_id") != 7, F.col("a")))


def test_forest_report_works_its_rows_out_once(spark):
    from marshlight.operators import learn as M
    from marshlight.plans import jobs as J

    df, seen = counted(marks(spark))
    got = J.forest_report(df, ["a", "b"], "k", trees=3).collect()
    assert len(got) == 1 and 0.5 < got[0].accuracy <= 1 and seen.value == 600
    whole = marks(spark).dropna("any", subset=["a", "b"])
    _, scored = M.last_fit(whole, "k", ["a", "b"], "pt_id", trees=3)
    want = M.split(whole, 0.8, "pt_id", "k").filter("NOT train")
    assert scored.columns[:4] == whole.columns and sorted(r[:4] for r in scored.select(*whole.columns).collect()) == sorted(r[:4] for r in want.select(*whole.columns).collect())
    df, seen = counted(whole)
    M.fit_rf(df, "k", ["a", "b"], trees=3)
    assert seen.value == 599


def test_importance_works_its_rows_out_once(spark):
    from marshlight.operators import learn as M

    whole = marks(spark, 200).dropna("any", subset=["a", "b"])
    model = M.fit_rf(whole, "k", ["a", "b"], trees=3)
    df, seen = counted(whole)
    got = {r.feature: r.importance for r in M.perm_importance(model, df, "k", ["a", "b"], "pt_id").collect()}
    assert seen.value == 199
    rows = whole.toPandas().sort_values("pt_id").reset_index(drop=True)
    right = lambda p: M.accuracy(M.augment(model, spark.createDataFrame(p)), "k").first()[0]
    for i, name in enumerate(["a", "b"]):
        deck = sorted(rows.index, key=lambda j: (rest(int(rows.pt_id[j]), i + 1), rows.pt_id[j]))
        assert abs(got[name] - (right(rows) - right(rows.assign(**{name: rows[name][deck].to_numpy()})))) < 1e-9


def test_importance_of_every_feature_of_the_model(spark):
    from marshlight.operators import learn as M
    from marshlight.plans import queries_learning as Q
    from marshlight.plans import registry

    rows = registry.QUERIES["m06_perm_importance"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.feature for r in rows) == sorted(Q.BANDS) and len(Q.BANDS) == 5
    # a model's other columns stay as they are, whole numbers may be dealt, rows may be in any partitions
    whole = marks(spark, 300).dropna("any", subset=["a", "b"]).withColumn("b", F.col("b").cast("long"))
    model = M.fit_rf(whole, "k", ["a", "b"], trees=3)
    both = {r.feature: r.importance for r in M.perm_importance(model, whole.repartition(7), "k", ["a", "b"], "pt_id").collect()}
    one = M.perm_importance(model, whole, "k", ["a"], "pt_id").collect()
    assert [r.feature for r in one] == ["a"] and abs(one[0].importance - both["a"]) < 1e-12


def test_intersecting_polygons_meet_as_whole_rings(spark):
    """No row stands for an edge and another one; crowded squares are cut; long rings and odd ones go the general way."""
    from marshlight.operators.iterate import connected
    from marshlight.operators.rings import VERTICES, pairs_of_rings, small_rings

    rng = random.Random(4)
    star = lambda n: [(math.cos(2 * math.pi * k / n) * (1 if k % 2 else 0.6), math.sin(2 * math.pi * k / n) * (1 if k % 2 else 0.6)) for k in range(n)]
    rings = {}
    for k in range(150):
        cx, cy, w = (rng.choice([5, 9, 13.5]), rng.choice([5, 8, 30]), rng.choice([1, 2, 3])) if k < 60 else (rng.uniform(-40, 40), rng.uniform(-40, 40), rng.choice([0.4, 1, 3, 9]))
        shape = star(rng.choice([4, 6, 10] if k % 10 else [VERTICES + 6, 4]))
        rings[k] = (k % 2, [(cx + w * x, cy + w * y) for x, y in [*shape, shape[0]]])
    table = lambda r: spark.createDataFrame([(k, h, i, x, y) for k, (h, ring) in r.items() for i, (x, y) in enumerate(ring)], "poly_id long, h long, seq int, x double, y double").repartition(3)
    v = table(rings)

    def within(ring, p):
        xs, ys = zip(*ring, strict=True)
        n = sum((a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(ring, ring[1:], strict=False))
        return n % 2 == 1 and min(xs) <= p[0] <= max(xs) and min(ys) <= p[1] <= max(ys)

    turn = lambda a, b, p: (lambda z: (z > 0) - (z < 0))((b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]))
    sides = {k: list(zip(ring, ring[1:], strict=False)) for k, (_, ring) in rings.items()}
    cross = lambda e, f: turn(*e, f[0]) * turn(*e, f[1]) < 0 and turn(*f, e[0]) * turn(*f, e[1]) < 0
    want = {(a, b) for a in rings for b in rings if a < b and rings[a][0] == rings[b][0] and (any(cross(e, f) for e in sides[a] for f in sides[b]) or any(within(rings[a][1], p) for p in rings[b][1]) or any(within(rings[b][1], p) for p in rings[a][1]))}
    large = {k for k in rings if len(rings[k][1]) > VERTICES}
    assert large and {(r.a, r.b) for r in G.intersecting(v).collect()} == want
    small = v.filter(~F.col("poly_id").isin(*large))
    short = {(a, b) for a, b in want if not {a, b} & large}
    for block in (7, 2048):
        got = [(r.a, r.b) for r in pairs_of_rings(small, block=block).collect()]
        assert set(got) == short and len(got) == len(short)
    assert "SortMergeJoin" not in plan_of(G.intersecting(small)) and "x1" not in plan_of(G.intersecting(small))
    # pairs that connect are few, and connect the same
    few = [(r.a, r.b) for r in G.intersecting(small, joining=True).collect()]
    assert set(few) <= short and len(few) < len(short)
    nodes = v.select(F.col("poly_id").alias("node")).distinct()
    groups = lambda pairs: {(r.node, r.root) for r in connected(pairs, nodes).collect()}
    assert groups(G.intersecting(v, joining=True)) == groups(G.intersecting(v))
    odd = {1: (0, [(0.0, 0.0), (4.0, 0.0), (None, 4.0), (0.0, 0.0)]), 2: (0, rings[1][1]), 3: (0, [(math.nan, 0.0), (1.0, 1.0)])}
    assert {r.poly_id: r.small for r in small_rings(table(odd)).collect()} == {1: False, 2: True, 3: False}
    assert G.intersecting(v.limit(0)).count() == 0
