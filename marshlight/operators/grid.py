"""A grid of levels for spatial joins: the squares of level l have side 2^l.

A box lies on the level of its longer side, where it has four squares at most, however large it is. A point has one square
on each level that boxes lie on. Squares with very many rows of one side are split by hash, the other side's few rows
being repeated for each part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOW, HIGH = -20, 40  # levels below and above which boxes share one
SQUARE = ["_l", "_by", "_bx"]
BOX = ["xmin", "ymin", "xmax", "ymax"]


def level() -> Column:
    """Level of a box with the columns of ``BOX``."""
    side = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"), F.lit(2.0**LOW))
    return F.least(F.ceil(F.log2(side)), F.lit(HIGH)).cast("int")


def levels_of(boxes: DataFrame) -> list[int]:
    """The levels in use, ``HIGH - LOW + 1`` at most."""
    return sorted(r[0] for r in boxes.select(level().alias("l")).distinct().collect() if r[0] is not None)


def base_of(boxes: DataFrame, more: int = 2) -> int:
    """The level up to which small boxes are lifted: ``more`` levels above the median's at most, and none that all lie
    below. Boxes of about one size then share one level instead of being sent to several."""
    found = sorted((r.l, r.n) for r in boxes.groupBy(level().alias("l")).agg(F.count("*").alias("n")).collect() if r.l is not None)
    half, seen = sum(n for _, n in found) / 2, 0
    for at, n in found:
        seen += n
        if seen >= half:
            return min(at + more, found[-1][0])
    return LOW


def _side() -> Column:
    return F.pow(F.lit(2.0), F.col("_l"))


def squares(boxes: DataFrame) -> DataFrame:
    """Boxes with ``_l`` once for each square of that level they touch."""
    span = lambda lo, hi: F.explode(F.sequence(F.floor(F.col(lo) / _side()), F.floor(F.col(hi) / _side())))
    return boxes.withColumn("_by", span("ymin", "ymax")).withColumn("_bx", span("xmin", "xmax"))


def points_on(pts: DataFrame, x: Column, y: Column, levels: list[int]) -> DataFrame:
    """Points once for each level, with their square there."""
    on = pts.withColumn("_l", F.explode(F.array(*[F.lit(v) for v in levels]).cast("array<int>")))
    return on.withColumns({"_by": F.floor(y / _side()), "_bx": F.floor(x / _side())})


def meet(many: DataFrame, few: DataFrame, keys: list[str], most: int = 50_000) -> DataFrame:
    """Equi-join on ``keys``. A key with more than ``most`` rows of ``many`` is cut into parts of about as many, and the
    rows of ``few`` are repeated for each part."""
    crowd = many.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_parts"))
    parts = F.coalesce("_parts", F.lit(1))
    left = many.withColumn("_own", F.xxhash64(*[c for c in many.columns if c not in keys])).join(crowd, keys, "left").withColumn("_part", F.pmod("_own", parts).cast("int")).drop("_own", "_parts")
    right = few.join(crowd, keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left.join(right, [*keys, "_part"]).drop("_part")


def points_in_boxes(pts: DataFrame, x: str, y: str, boxes: DataFrame, on: list[str], most: int = 50_000) -> DataFrame:
    """Every point with every box (closed) that holds it; each pair meets in one square."""
    native = squares(boxes.withColumn("_l", level()))
    met = meet(points_on(pts, F.col(x), F.col(y), levels_of(boxes)), native, [*on, *SQUARE], most)
    held = F.col(x).between(F.col("xmin"), F.col("xmax")) & F.col(y).between(F.col("ymin"), F.col("ymax"))
    return met.filter(held).drop(*SQUARE)


def boxes_with_boxes(a: DataFrame, b: DataFrame, on: list[str], closed: bool = False, most: int = 50_000, base: int = LOW) -> DataFrame:
    """Pairs of boxes that overlap in more than an edge (or touch, with ``closed``). ``b``'s own columns, the box too,
    must be named otherwise: its box columns are ``b_xmin`` and so on.

    Two boxes meet on the level of the larger one. A box is sent to the squares of its own level and, on the coarser
    levels that the other side uses, to those it touches; the pair is kept in the square that holds the lower left
    corner of what they share."""
    renamed = b.select(*[F.col(f"b_{k}").alias(k) for k in BOX])
    lifted = lambda boxes: sorted({max(v, base) for v in levels_of(boxes)})

    def sent(df: DataFrame, box: dict, others: list[int]) -> DataFrame:
        own = df.withColumns({k: F.col(v) for k, v in box.items()}).withColumn("_own", F.greatest(level(), F.lit(base)))
        ups = F.array(*[F.lit(v) for v in others]).cast("array<int>")
        upper = F.array_distinct(F.concat(F.array("_own"), F.filter(ups, lambda v: v > F.col("_own"))))
        return squares(own.withColumn("_l", F.explode(upper)))

    left = sent(a, {k: k for k in BOX}, lifted(renamed)).withColumnRenamed("_own", "_la")
    right = sent(b, {k: f"b_{k}" for k in BOX}, lifted(a)).withColumnRenamed("_own", "_lb").drop(*BOX)
    met = meet(left, right, [*on, *SQUARE], most).filter((F.col("_la") == F.col("_l")) | (F.col("_lb") == F.col("_l")))
    below = (lambda p, q: F.col(p) <= F.col(q)) if closed else (lambda p, q: F.col(p) < F.col(q))
    hit = below("xmin", "b_xmax") & below("b_xmin", "xmax") & below("ymin", "b_ymax") & below("b_ymin", "ymax")
    corner = lambda k, at: F.floor(F.greatest(k, f"b_{k}") / _side()) == F.col(at)
    return met.filter(hit & corner("xmin", "_bx") & corner("ymin", "_by")).drop(*SQUARE, "_la", "_lb")
