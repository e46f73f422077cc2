"""Operators on small hand-made inputs and their invariants."""

import math

import pytest
from pyspark.sql import functions as F

from marshlight.operators import cells as R
from marshlight.operators import focal as W
from marshlight.operators import geometry as G
from marshlight.operators import hydrology as H
from marshlight.operators import spatial as S
from marshlight.operators import stats as T
from marshlight.operators import terrain as E


def grid(spark, n, z):
    return spark.createDataFrame([(0, r, c, float(z(r, c))) for r in range(n) for c in range(n)], "h long, r long, c long, dem double")


def square(spark, i, x, y, s):
    ring = [(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]
    return spark.createDataFrame([(i, 0, k, float(a), float(b)) for k, (a, b) in enumerate(ring)], "poly_id long, h long, seq int, x double, y double")


def test_plane_has_constant_slope(spark):
    got = E.slope_aspect(grid(spark, 6, lambda r, c: 2 * c)).filter("slope IS NOT NULL").toPandas()
    assert len(got) == 16
    assert all(abs(s - math.degrees(math.atan(2))) < 1e-9 for s in got.slope)
    assert all(abs(a - 270) < 1e-9 for a in got.aspect)


def test_window_of_one_is_identity(spark):
    g = grid(spark, 4, lambda r, c: r * 10 + c)
    assert sorted(W.focal(g, 1, "mean", "dem").collect()) == sorted(g.collect())


def test_even_window_is_refused(spark):
    with pytest.raises(ValueError):
        W.focal(grid(spark, 3, lambda r, c: 0), 4, "mean", "dem")


def test_single_pit_is_filled(spark):
    z = lambda r, c: -5 if (r, c) == (3, 3) else 10 + abs(r - 3) + abs(c - 3)
    got = {(x.r, x.c): x.dem for x in H.fill_depressions(grid(spark, 7, z), tile=4).collect()}
    assert got[3, 3] > -5
    for r in range(1, 6):
        for c in range(1, 6):
            assert min(got[r + i, c + j] for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j) <= got[r, c]


def test_accumulation_at_outlets_is_the_number_of_cells(spark):
    d = E.flowdir(grid(spark, 9, lambda r, c: r * 3 + c))
    out = H.flow_acc(d).join(d, ["h", "r", "c"]).filter("dir = 0").agg(F.sum("acc")).first()[0]
    assert out == 81


def test_mosaic_does_not_depend_on_order(spark):
    rows = [(0, 0, 0, i, float(i % 3)) for i in range(5)]
    make = lambda x: spark.createDataFrame(x, "h long, r long, c long, tile_ord int, v double")
    for fun in ("first", "max", "mean"):
        assert R.mosaic(make(rows), fun).collect() == R.mosaic(make(rows[::-1]).repartition(3), fun).collect()


def test_areas_add_up(spark):
    a, b = square(spark, 1, 0.1, 0.1, 6), square(spark, 2, 3.1, 2.1, 6)
    ca, cb = G.cell_set(a), G.cell_set(b)
    both = G.overlay(ca.withColumnRenamed("poly_id", "a"), cb.withColumnRenamed("poly_id", "b"), "a", "b").first()["area"]
    assert both + G.difference(ca, cb).count() == ca.count() == 36


def test_thinning_is_separated_and_maximal(spark):
    pts = [(i, 0, (i * 37 % 50) / 2, (i * 91 % 47) / 2) for i in range(60)]
    df = spark.createDataFrame(pts, "pt_id long, h long, x double, y double")
    kept = {r.pt_id for r in S.thin(df, 3.0).collect()}
    at = {p[0]: p[2:] for p in pts}
    near = lambda a, b: math.dist(at[a], at[b]) <= 3.0
    want = set()
    for i in sorted(at):
        if not any(near(i, j) for j in want):
            want.add(i)
    assert kept == want


def test_thinning_decides_every_point_of_a_long_line(spark):
    df = spark.createDataFrame([(i, 0, float(i), 0.5) for i in range(430)], "pt_id long, h long, x double, y double")
    assert sorted(r.pt_id for r in S.thin(df, 1.5).collect()) == list(range(0, 430, 2))


def test_points_of_one_place_are_one_node(spark):
    pts = [(i, 0, 5.0, 5.0) for i in range(3000)] + [(3000, 0, 6.0, 5.0), (3001, 0, 20.0, 5.0), (3002, 1, 5.0, 5.0), (3003, 0, None, 5.0)]
    df = spark.createDataFrame(pts, "pt_id long, h long, x double, y double")
    assert sorted(r.pt_id for r in S.thin(df, 2.0).collect()) == [0, 3001, 3002, 3003]
    assert sorted(r.pt_id for r in S.isolated(df, 2.0).collect()) == [3001, 3002, 3003]


def test_results_do_not_depend_on_partitions(spark):
    g = grid(spark, 8, lambda r, c: (r * 7 + c * 5) % 11)
    assert sorted(E.curvature(g.repartition(1)).collect()) == sorted(E.curvature(g.repartition(16)).collect())


def test_jaro():
    assert T.jaro("MARTHA", "MARHTA") == pytest.approx(0.944444, abs=1e-6)
    assert T.jaro("abc", "xyz") == 0 and T.jaro("", "") == 1


@pytest.mark.parametrize("block", [7, 20_000])
def test_nearest_names_equal_all_pairs(spark, block):
    import random

    rng = random.Random(block)
    word = lambda: "".join(rng.choice("abcde ") for _ in range(rng.randint(0, 9)))
    left, right = [word() for _ in range(60)] + ["é", None, "same"], [word() for _ in range(40)] + ["same", None]
    got = T.fuzzy_best(spark.createDataFrame([(x,) for x in left], "n string"), spark.createDataFrame([(x,) for x in right], "n string"), "n", "n", block)
    want = {}
    for a in {x for x in left if x is not None}:
        d, name = min((round(1 - T.jaro(a, b), 12), b) for b in right if b is not None)
        want[a] = (name, d, a == name)
    assert {r.candidate: (r.reference, round(r.dist, 12), r.exact) for r in got.collect()} == want


def test_rows_are_numbered_across_tasks(spark):
    rows = [(i, (i * 7919) % 1000, None if i % 3 == 2 else i % 3) for i in range(900)]
    df = spark.createDataFrame(rows, "id long, v long, g int").repartition(5)
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    assert {r.id: r.n for r in T.row_number(df, ["v", "id"]).collect()} == {r[0]: i + 1 for i, r in enumerate(order)}
    by = {}
    want = {r[0]: by.setdefault(r[2], []).append(0) or len(by[r[2]]) for r in order}
    assert {r.id: r.n for r in T.row_number(df, ["v", "id"], ["g"]).collect()} == want
    assert T.row_number(df.limit(0), ["v"]).count() == 0


def test_quantiles_equal_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 500), np.round(rng.normal(size=500), 1), strict=True)] + [(7, 2.5), (8, None)]
    got = {r.g: (r.q25, r.q98) for r in T.quantiles_by(spark.createDataFrame(rows, "g int, v double"), "g", "v", [0.25, 0.98]).collect()}
    for g in (0, 1, 2, 7):
        assert got[g] == pytest.approx(tuple(np.quantile([v for k, v in rows if k == g], [0.25, 0.98])))
    assert got[8] == (None, None)


@pytest.mark.parametrize("seed, ground", [(0, 40), (1, 3), (2, 2), (3, 0)])
def test_nearest_ground_is_found_however_far(spark, seed, ground):
    """Ground in two crowds far from most returns."""
    import random

    from marshlight.operators import lidar as P

    rng = random.Random(seed)
    g = [(0, (0 if i % 2 else 300) + round(rng.random(), 2), round(rng.random(), 2), float(i), 2) for i in range(ground)]
    p = [(0, round(rng.random() * 400 - 50, 1), round(rng.random() * 90, 1), 9.0, 5) for _ in range(40)]
    got = P.normalize_height(spark.createDataFrame(g + p, "h long, x double, y double, z double, cls int"), 3, 1.0).collect()
    assert len(got) == len(g + p)
    low = {}
    for _, x, y, z, _ in g:
        low[x, y] = min(z, low.get((x, y), z))
    for r in got:
        near = sorted(((r.x - x) ** 2 + (r.y - y) ** 2, x, y, z) for (x, y), z in low.items())[:3]
        w = [1 / (n[0] + 1e-6) for n in near]
        assert r.hag == (pytest.approx(r.z - sum(a * n[3] for a, n in zip(w, near, strict=True)) / sum(w)) if near else None)


def test_isolation_in_a_crowd_equals_all_pairs(spark):
    import random

    rng = random.Random(4)
    pts = [(i, i % 2, rng.random() * 30, rng.random() * 30) for i in range(150)] + [(200 + i, 0, 5 + rng.random() / 9, 5 + rng.random() / 9) for i in range(300)]
    want = {p[0] for p in pts if not any(q[0] != p[0] and q[1] == p[1] and math.dist(p[2:], q[2:]) <= 1.5 for q in pts)}
    assert {r.pt_id for r in S.isolated(spark.createDataFrame(pts, "pt_id long, h long, x double, y double"), 1.5).collect()} == want


def star(spark, i, cx, cy, r, n):
    """A closed ring of n vertices whose radius swings."""
    ring = [(cx + r * (0.6 + 0.4 * math.sin(7 * a)) * math.cos(a), cy + r * (0.6 + 0.4 * math.sin(7 * a)) * math.sin(a)) for a in (2 * math.pi * k / n for k in range(n))]
    return spark.createDataFrame([(i, 0, k, x, y) for k, (x, y) in enumerate([*ring, ring[0]])], "poly_id long, h long, seq int, x double, y double"), ring


def test_spans_of_a_large_outline(spark):
    """A lake of 100,000 edges over a million cells: its cells are as many as its area, and the plan joins no cells with edges."""
    lake, ring = star(spark, 1, 600.0, 600.0, 580.0, 100_000)
    cells = G.cell_set(lake)
    area = abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2
    assert abs(cells.count() - area) < 3000
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_points_in_and_near_polygons_equal_brute_force(spark):
    import random

    rng = random.Random(9)
    shapes = [star(spark, i, rng.random() * 40, rng.random() * 40, 2 + 9 * rng.random(), 20) for i in range(6)]
    vertices = shapes[0][0]
    for s, _ in shapes[1:]:
        vertices = vertices.unionByName(s)
    pts = [(i, 0, rng.random() * 50 - 5, rng.random() * 50 - 5) for i in range(200)]

    def inside(x, y, ring):
        edges = list(zip(ring, ring[1:] + ring[:1], strict=True))
        return sum(((a[1] > y) != (b[1] > y)) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in edges) % 2 == 1

    def away(x, y, ring):
        best = math.inf
        for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
            d = (b[0] - a[0], b[1] - a[1])
            t = max(0.0, min(1.0, ((x - a[0]) * d[0] + (y - a[1]) * d[1]) / (d[0] ** 2 + d[1] ** 2)))
            best = min(best, math.hypot(x - a[0] - t * d[0], y - a[1] - t * d[1]))
        return best

    df = spark.createDataFrame(pts, "pt_id long, h long, x double, y double")
    at = df.select("pt_id", "h", F.col("x").alias("px"), F.col("y").alias("py"))
    assert {(r.pt_id, r.poly_id) for r in G.points_in(at, vertices, ["pt_id"]).collect()} == {(p[0], i) for p in pts for i, (_, ring) in enumerate(shapes) if inside(*p[2:], ring)}
    for d in (0.3, 2.5):
        got = {(r.pt_id, r.poly_id): r.dist for r in G.points_close(at, vertices, d, ["pt_id"]).collect()}
        want = {(p[0], i): away(*p[2:], ring) for p in pts for i, (_, ring) in enumerate(shapes) if away(*p[2:], ring) <= d}
        assert got == {k: pytest.approx(v) for k, v in want.items()}
    near = {(r.poly_id, r.r, r.c): r.dist for r in G.outline_cells(vertices, 1.7).collect()}
    want = {(i, r, c): away(c + 0.5, r + 0.5, ring) for i, (_, ring) in enumerate(shapes) for r in range(-20, 60) for c in range(-20, 60) if away(c + 0.5, r + 0.5, ring) <= 1.7}
    assert near == {k: pytest.approx(v) for k, v in want.items()}


def test_points_are_drawn_in_slivers_too(spark):
    thin = spark.createDataFrame([(1, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (100.0, 100.0), (100.0, 100.001), (0.0, 0.0)])], "poly_id long, h long, seq int, x double, y double")
    flat = spark.createDataFrame([(2, 0, k, x, y) for k, (x, y) in enumerate([(0.0, 0.0), (50.0, 0.0), (50.0, 1e-6), (0.0, 0.0)])], thin.schema)
    pts = G.random_points(thin.unionByName(flat).unionByName(square(spark, 3, 1, 1, 2)), 40)
    assert {r.poly_id: r["count"] for r in pts.groupBy("poly_id").count().collect()} == {1: 40, 2: 40, 3: 40}
    for r in pts.filter("poly_id = 1").collect():
        assert 0 <= r.y - r.x <= 0.0011 or abs(r.y - r.x) < 1e-9


def test_boxes_of_all_sizes_meet_once(spark):
    import random

    from marshlight.operators import grid as Q

    rng = random.Random(2)
    box = lambda i: (i, *(lambda x, y, s, t: (x, y, x + s, y + t))(rng.random() * 100 - 50, rng.random() * 100 - 50, 10 ** rng.uniform(-2, 2), 10 ** rng.uniform(-2, 2)))
    a, b = [box(i) for i in range(80)], [box(i) for i in range(90)]
    schema = "id long, xmin double, ymin double, xmax double, ymax double"
    left, right = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
    got = sorted((r.a, r.b) for r in S.box_pairs(left.withColumnRenamed("id", "a"), right.withColumnRenamed("id", "b"), "a", "b", []).collect())
    assert got == sorted((p[0], q[0]) for p in a for q in b if p[1] < q[3] and q[1] < p[3] and p[2] < q[4] and q[2] < p[4])
    assert Q.squares(left.withColumn("_l", Q.level())).groupBy("id").count().agg(F.max("count")).first()[0] <= 4


def test_a_crowded_square_is_split(spark):
    """A third of all points in one place: no part of its square has more than four times the median part."""
    from marshlight.operators import grid as Q

    many = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40 + 10).alias("k"))
    few = spark.createDataFrame([(k, f"b{j}") for k in range(50) for j in range(3)], "k long, b string")
    met = Q.meet(many, few, ["k"], most=100)
    assert met.count() == 9000 * 3 and met.select("id", "b").distinct().count() == 9000 * 3
    crowd = many.groupBy("k").count().filter("count > 100").select("k", F.ceil(F.col("count") / 100).alias("parts"))
    parts = many.join(crowd, "k", "left").groupBy("k", F.pmod(F.xxhash64("id"), F.coalesce("parts", F.lit(1))).alias("p")).count().toPandas()["count"]
    assert parts.max() <= 4 * parts.median()


@pytest.mark.parametrize("name", ["e40_superpixels", "p04_satellite", "p06_hydrology"])
def test_query_covers_all_watersheds(spark, name):
    from marshlight.plans import registry

    got = registry.QUERIES[name](spark, "/root/testdata/sf0.001")
    if name == "p04_satellite":
        got = got.filter("NDVI IS NOT NULL")
    assert sorted(r.h for r in got.select("h").distinct().collect()) == [0, 1, 2, 3]


def test_delineation_covers_all_zones(spark):
    from marshlight.plans import registry
    from marshlight.plans.fixtures import Fixtures

    fx = Fixtures(spark, "/root/testdata/sf0.001")
    got = registry.QUERIES["p17_delineated"](spark, "/root/testdata/sf0.001")
    zones = S.polys_meet_zones(fx.vertices, fx.zones).select("poly_id").distinct()
    one = S.polys_meet_zones(fx.vertices, fx.zones.filter("cluster = 1")).select("poly_id").distinct()
    assert one.count() < zones.count() and got.join(one, "poly_id", "left_anti").count() > 0
