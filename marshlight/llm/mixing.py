"""Mixing sources to target weights by entropy balancing. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, materialize, remove

BUCKETS = 4096
BROADCAST_ROWS = 50_000


def _key(source: Column) -> Column:
    """Grouping key of a source; a null source is one of its own."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def document_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"), _key(F.col(source_col)).alias("key"), F.regexp_count(F.coalesce(text_col, F.lit("")), F.lit(WORD)).cast("long").alias("size")
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...], most: float) -> DataFrame:
    """``key, source_size, target, scale`` per source.

    Sources in code-point order (null last) weigh ``weights`` in turn and share all sizes by weight; a target
    stops at ``most`` times its source's size and the excess goes to the others by weight. In the order of
    cap over weight, the sources before some point are at their caps and one level serves all behind it. One
    row per source is ordered in one task, after aggregation.
    """
    per = sizes.groupBy("key").agg(F.sum("size").alias("source_size"), F.sum(F.col("size").cast("double") * F.col("size")).alias("squares"))
    rank = F.row_number().over(Window.orderBy(F.col("key") == "n", "key"))
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", cycle).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "key")
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    behind = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.sum("source_size").over(everything) - before) / behind)
    per = per.withColumn("capped", F.col("level") * F.col("weight") > F.col("cap"))
    level = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    target = F.when(F.col("capped") | level.isNull(), F.col("cap")).otherwise(level * F.col("weight"))
    scale = F.when(F.col("source_size") > 0, F.col("squares") / F.col("source_size")).otherwise(1.0)
    return per.withColumn("target", target).select("key", "source_size", "target", scale.alias("scale"))


def _rate(size: Column, most: float) -> Column:
    """Tilted rate of a document: an exponential tilt in its size, kept between 0 and ``most``, 1 at multiplier 0."""
    tilt = F.exp(-F.col("mult") * size / F.col("scale"))
    return F.when(F.col("full"), F.lit(float(most))).otherwise(F.lit(float(most)) / (1 + (most - 1) * tilt))


def _meet(rows: DataFrame, small: DataFrame, n: int) -> DataFrame:
    """Join with one row per source: broadcast when there are few sources, else with a salt against hot ones."""
    if n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(small), "key")
    salts = 32
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64("size", *[c for c in rows.columns if c == "doc_id"]), F.lit(salts)).cast("int")).join(salted, ["key", "_salt"]).drop("_salt")


def solve_dual(counts: DataFrame, targets: DataFrame, n: int, most: float, rounds: int = 40, near: float = 1e-5) -> tuple[DataFrame, list[str]]:
    """Newton's method on each source's convex dual, all sources at once, over ``key, size, docs``.

    The dual's slope at multiplier m is the sum of size * rate(m) less the target; a step that leaves the
    bracket of slopes with both signs is replaced by the bracket's middle (or a doubled step while one side is
    open). Each round is one aggregation over the size counts, its state written to the shared folder.
    """
    spark = counts.sparkSession
    share = F.try_divide("target", "source_size")
    free = F.coalesce((share < most * (1 - 1e-12)) & (share > 0), F.lit(False))
    start = F.when(free, F.log((most - 1) * share / (most - share))).otherwise(0.0)
    state = targets.select("*", start.alias("mult"), (~free).alias("full"), F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"))
    state, path = materialize(state, "dual")
    for _ in range(rounds):
        met = _meet(counts, state.filter("NOT full"), n)
        rate, x = _rate(F.col("size"), most), F.col("size") / F.col("scale")
        tokens = F.col("docs") * F.col("size")
        slope = met.groupBy("key").agg(F.sum(tokens * rate).alias("got"), F.sum(tokens * x * rate * (1 - rate / most)).alias("curve"))
        s = state.join(slope, "key", "left").withColumn("gap", F.coalesce(F.col("got") - F.col("target"), F.lit(0.0)))
        s = s.withColumn("lo", F.when(F.col("gap") < 0, F.col("mult")).otherwise(F.col("lo"))).withColumn("hi", F.when(F.col("gap") > 0, F.col("mult")).otherwise(F.col("hi")))
        newton = F.col("mult") - F.col("gap") / F.when(F.col("curve") > 1e-300, F.col("curve"))
        wide = F.col("mult") - F.signum("gap") * (2 + F.abs("mult"))
        fits = (newton > F.coalesce("lo", wide - 1e-9)) & (newton < F.coalesce("hi", wide + 1e-9)) & (F.abs(newton - F.col("mult")) <= 2 + F.abs("mult"))
        middle = F.when(F.col("lo").isNotNull() & F.col("hi").isNotNull(), (F.col("lo") + F.col("hi")) / 2).otherwise(wide)
        done = F.abs("gap") <= near * F.col("target")
        s = s.withColumn("error", F.when(done, 0.0).otherwise(1.0)).withColumn("mult", F.when(done, F.col("mult")).when(fits, newton).otherwise(middle))
        new, new_path = materialize(s.select(*state.columns, "error"), "dual")
        remove(spark, path)
        state, path = new.drop("error"), new_path
        if not new.filter("error > 0").limit(1).count():
            break
    return state, [path]


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), most: float = 3.0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken, copies int, rate double`` for every document.

    Rates solve the entropy-balancing dual for each source's token target; a document takes the whole part of
    its rate, and one copy more if the hash of its id falls under its fraction. Per source the cut on that
    hash is then moved to where the copies' tokens come nearest the target (a histogram of at most 8192
    buckets a source) and the one document whose change comes nearest is changed, which leaves a few words. Reruns agree: nothing is random.

    Null texts have size 0 and take nothing; a null source is a source, last in order; repeated rows share
    their decision; when all sizes are 0 all targets are 0; an empty table gives no rows; other columns are not
    carried. No document takes more than ``most`` times its size.
    """
    sizes, _ = materialize(document_sizes(docs, id_col, text_col, source_col), "sizes")
    targets, targets_path = materialize(source_targets(sizes, weights, most), "targets")
    n = targets.count()
    counts, counts_path = materialize(sizes.filter("size > 0").groupBy("key", "size").agg(F.count("*").alias("docs")), "counts")
    state, state_paths = solve_dual(counts, targets, n, most)
    remove(docs.sparkSession, counts_path, targets_path)
    u = F.pmod(F.xxhash64("doc_id", "size"), F.lit(1 << 40)) / float(1 << 40)
    rated = _meet(sizes, state, n).withColumn("rate", _rate(F.col("size"), most))
    rated = rated.withColumn("floor", F.floor("rate").cast("int")).withColumn("bucket", F.floor((u - (F.col("rate") - F.col("floor")) + 1) * BUCKETS).cast("int"))
    sums = rated.groupBy("key", "bucket").agg(F.sum("size").alias("more"), F.sum(F.col("floor") * F.col("size")).alias("base"))
    line = Window.partitionBy("key").orderBy("bucket")
    whole = Window.partitionBy("key")
    walk = sums.withColumn("less", F.sum("more").over(line) - F.col("more")).withColumn("all", F.sum("base").over(whole))
    # total before this bucket's documents get their extra copy, and after
    met = _meet(walk.withColumn("size", F.col("bucket").cast("long")), state.select("key", "target"), n)
    off = lambda extra, cut: F.struct(F.abs(F.col("all") + extra - F.col("target")).alias("far"), cut.alias("cut"), (F.col("target") - F.col("all") - extra).alias("gap"))
    best = met.groupBy("key").agg(F.min(F.least(off(F.col("less"), F.col("bucket") - 1), off(F.col("less") + F.col("more"), F.col("bucket")))).alias("at"))
    cut, _ = materialize(best.select("key", "at.cut", "at.gap"), "cuts")
    cutting = _meet(rated, cut, n).withColumn("extra", (F.col("bucket") <= F.col("cut")).cast("int"))
    # one document more or less where that comes nearer still
    change = F.when(F.col("extra") == 1, -F.col("size")).when(F.col("floor") < int(most), F.col("size"))
    left = F.abs(F.col("gap") - change)
    swap = cutting.filter(F.col("doc_id").isNotNull() & (F.col("size") > 0) & (left < F.abs("gap"))).groupBy("key").agg(F.min(F.struct(left.alias("far"), "doc_id", "size")).alias("at"))
    swap, _ = materialize(swap.select("key", F.col("at.doc_id").alias("swap_id"), F.col("at.size").alias("swap_size")), "swaps")
    out = _meet(cutting, cut.select("key").join(swap, "key", "left"), n)
    flip = F.coalesce((F.col("doc_id") == F.col("swap_id")) & (F.col("size") == F.col("swap_size")), F.lit(False))
    extra = F.when(flip, 1 - F.col("extra")).otherwise(F.col("extra"))
    copies = F.when(F.col("size") > 0, F.least(F.lit(int(most)), F.col("floor") + extra)).otherwise(F.least(F.lit(1), F.col("floor")))
    out = out.withColumn("copies", copies.cast("int"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate")
