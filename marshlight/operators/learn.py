"""Splits, recipes, forests, metrics and clusters."""

from __future__ import annotations

from itertools import combinations
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, OneHotEncoder, StandardScaler, StringIndexer, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .geometry import hash_order
from .iterate import discard, settle
from .stats import row_number, running


def split(df: DataFrame, frac: float, key: str, strata: str | None = None, seed: int = 0) -> DataFrame:
    """Rows tagged ``train`` by hash order: the first share of each class."""
    at = row_number(df, [hash_order(F.col(key), seed), key], [strata] if strata else None, "_at")
    if strata:
        n = df.groupBy(F.col(strata).alias("_s")).agg(F.count("*").alias("_n"))
        at = at.join(n, F.col(strata).eqNullSafe(F.col("_s"))).drop("_s")
    else:
        at = at.withColumn("_n", F.lit(df.count()))
    return at.withColumn("train", F.coalesce(F.try_divide(F.col("_at") - 1, F.col("_n") - 1), F.lit(0.0)) < frac).drop("_at", "_n")


def dummies(df: DataFrame, col: str, levels: list[str]) -> DataFrame:
    """0/1 columns of all levels but the first."""
    return df.withColumns({f"{col}_{v}": (F.col(col) == v).cast("int") for v in levels[1:]}).drop(col)


def normalize(df: DataFrame, cols: list[str]) -> DataFrame:
    """Columns less their mean over their sample deviation; columns without variance are dropped."""
    stats = df.agg(*[F.stddev_samp(c).alias(c) for c in cols]).collect()[0]
    keep = [c for c in cols if stats[c]]
    means = df.agg(*[f(c).alias(f"{c}__{n}") for c in keep for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    return df.drop(*[c for c in cols if c not in keep]).crossJoin(F.broadcast(means)).select(
        *[c for c in df.columns if c not in cols], *[((F.col(c) - F.col(f"{c}__m")) / F.col(f"{c}__s")).alias(c) for c in keep]
    )


def recipe(target: str, numeric: list[str], nominal: list[str] = ()) -> Pipeline:
    """Index the target, dummy-code nominals, drop constant numerics, centre and scale."""
    stages = [StringIndexer(inputCol=target, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep")]
    for c in nominal:
        stages += [StringIndexer(inputCol=c, outputCol=f"{c}__i", handleInvalid="keep"), OneHotEncoder(inputCol=f"{c}__i", outputCol=f"{c}__v", dropLast=True)]
    stages += [
        VectorAssembler(inputCols=list(numeric), outputCol="__num"), VarianceThresholdSelector(featuresCol="__num", outputCol="__var", varianceThreshold=0.0),
        StandardScaler(inputCol="__var", outputCol="__std", withMean=True, withStd=True), VectorAssembler(inputCols=["__std", *[f"{c}__v" for c in nominal]], outputCol="features"),
    ]
    return Pipeline(stages=stages)


def fit_rf(df: DataFrame, target: str, numeric: list[str], trees: int = 10, mtry: int = 2, min_n: int = 2, seed: int = 1, nominal: list[str] = (), written: bool = False) -> PipelineModel:
    """A forest on the recipe. Each stage of it reads all rows, so their columns are written first, unless the rows are
    ``written`` already; else each stage would work them out anew."""
    rows = df if written else settle(df.select(*dict.fromkeys([target, *numeric, *nominal])), "fit")
    rf = RandomForestClassifier(numTrees=trees, featureSubsetStrategy=str(min(mtry, len(numeric))), minInstancesPerNode=min_n, seed=seed)
    model = Pipeline(stages=[*recipe(target, numeric, nominal).getStages(), rf]).fit(rows)
    if not written:
        discard(rows)
    return model


def levels(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labels)


def augment(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Original columns, predicted class and one probability per class."""
    names = levels(model)
    table = F.array(*[F.lit(x) for x in names])
    p = vector_to_array("probability")
    out = model.transform(df)
    return out.select(*df.columns, F.get(table, F.col("prediction").cast("int")).alias("pred_class"), *[p[i].alias(f"pred_{x}") for i, x in enumerate(names)])


def auc_hand_till(scored: DataFrame, truth: str, classes: list[str]) -> DataFrame:
    """Mean over class pairs of the two rank-sum areas (Hand and Till 2001). Scores are counted per pair and value, and the
    counts summed in order for all pairs at once."""
    sides = [side for a, b in combinations(classes, 2) for side in ((a, b), (b, a))]
    t = F.col(truth)
    each = F.array(*[F.when(t.isin(pos, neg), F.struct(F.lit(i).alias("side"), F.col(f"pred_{pos}").alias("p"), (t == pos).alias("y"))) for i, (pos, neg) in enumerate(sides)])
    rows = scored.select(F.explode(F.array_compact(each)).alias("s")).select("s.*")
    at = rows.groupBy("side", "p").agg(F.count("*").alias("n"), F.count_if("y").alias("k"))
    ends = running(at, ["side", "p"], "n", "end")
    first = ends.groupBy(F.col("side").alias("_side")).agg(F.min(F.col("end") - F.col("n")).alias("from"))
    ranked = ends.join(F.broadcast(first), F.col("side") == F.col("_side")).withColumn("mid", F.col("end") - F.col("from") - (F.col("n") - 1) / 2.0)  # one row a side
    per = ranked.groupBy("side").agg(F.sum(F.col("mid") * F.col("k")).alias("r"), F.sum("k").alias("np"), F.sum(F.col("n") - F.col("k")).alias("nn"))
    area = F.try_divide(F.col("r") - F.col("np") * (F.col("np") + 1) / 2, F.col("np") * F.col("nn"))
    return per.agg(F.avg(area).alias("roc_auc"))


def tune_rf(df: DataFrame, target: str, numeric: list[str], grid: list[tuple[int, int]], folds: int, key: str, trees: int = 10, at_once: int = 4) -> DataFrame:
    """Mean area over hash-made folds for each (mtry, min_n), best first. ``at_once`` models are fitted side by side, as
    jobs of one session; the loop is over models, not rows."""
    fold = F.pmod(hash_order(F.col(key), 7), F.lit(folds))
    df = settle(df.withColumn("__fold", fold), "folds")

    def one(at: tuple[int, int, int]) -> tuple[int, int, float | None]:
        mtry, min_n, k = at
        model = fit_rf(df.filter(F.col("__fold") != k), target, numeric, trees, mtry, min_n, written=True)
        scored = augment(model, df.filter(F.col("__fold") == k))
        known = [c for c in levels(model) if f"pred_{c}" in scored.columns]
        return mtry, min_n, auc_hand_till(scored, target, known).first()["roc_auc"]

    with ThreadPool(at_once) as pool:
        rows = pool.map(one, [(m, n, k) for m, n in grid for k in range(folds)])
    discard(df)
    out = df.sparkSession.createDataFrame(rows, "mtry int, min_n int, roc_auc double")
    return out.groupBy("mtry", "min_n").agg(F.avg("roc_auc").alias("roc_auc")).orderBy(F.desc("roc_auc"), "mtry", "min_n")


def accuracy(scored: DataFrame, truth: str, pred: str = "pred_class") -> DataFrame:
    return scored.agg(F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"))


def conf_mat(scored: DataFrame, truth: str, pred: str, classes: list[str]) -> DataFrame:
    """Counts of every pair of classes, zeros included."""
    all_ = scored.sparkSession.createDataFrame([(a, b) for a in classes for b in classes], "truth string, pred string")
    n = scored.groupBy(F.col(truth).alias("truth"), F.col(pred).alias("pred")).agg(F.count("*").alias("n"))
    return F.broadcast(all_).join(n, ["truth", "pred"], "left").fillna(0, ["n"])  # classes squared rows


def cm_summary(cm: DataFrame) -> DataFrame:
    """Accuracy, kappa, and macro means of sensitivity, specificity, predictive values, J, balanced accuracy and F."""
    t = cm.agg(F.sum("n").cast("double").alias("total"))
    side = lambda k, name: cm.groupBy(F.col(k).alias("cls")).agg(F.sum("n").cast("double").alias(name))
    hit = cm.filter("truth = pred").select(F.col("truth").alias("cls"), F.col("n").cast("double").alias("tp"))
    per = hit.join(side("truth", "pos"), "cls").join(side("pred", "called"), "cls").crossJoin(F.broadcast(t))
    tp, pos, called, total = (F.col(x) for x in ("tp", "pos", "called", "total"))
    tn = total - pos - called + tp
    sens, spec, ppv, npv = F.try_divide(tp, pos), F.try_divide(tn, total - pos), F.try_divide(tp, called), F.try_divide(tn, total - called)
    per = per.withColumns({"sens": sens, "spec": spec, "ppv": ppv, "npv": npv, "f": F.try_divide(2 * tp, pos + called)})
    chance = F.sum(pos * called) / F.first(total) ** 2
    acc = F.sum(tp) / F.first(total)
    return per.agg(acc.alias("accuracy"), ((acc - chance) / (1 - chance)).alias("kappa"), *[F.avg(x).alias(x) for x in ("sens", "spec", "ppv", "npv", "f")], F.avg(F.col("sens") + F.col("spec") - 1).alias("j"), F.avg((F.col("sens") + F.col("spec")) / 2).alias("bal"))


def agreement(scored: DataFrame, truth: str, pred: str) -> DataFrame:
    """Disagreements per class."""
    return scored.withColumn("agree", F.col(truth) == F.col(pred)).groupBy(truth).agg(F.count_if(~F.col("agree")).alias("disagree"), F.count("*").alias("n"))


def last_fit(df: DataFrame, target: str, numeric: list[str], key: str, frac: float = 0.8, **kw) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training share, score the rest. Rows are worked out once and written, and so are their parts."""
    rows = settle(df, "rows")
    parts = settle(split(rows, frac, key, target), "parts")
    discard(rows)
    model = fit_rf(parts.filter("train"), target, numeric, written=True, **kw)
    return model, augment(model, parts.filter("NOT train").drop("train"))


def perm_importance(model: PipelineModel, df: DataFrame, target: str, numeric: list[str], key: str, seed: int = 0, written: bool = False) -> DataFrame:
    """Loss of accuracy when one column is dealt out anew, by pairing two stated orders of the rows. The orders of all
    columns are sorted at once and meet the rows in one join, and all deals are scored in one pass. Rows are read several
    times, so they are written first, unless they are ``written`` already."""
    df = df if written else settle(df, "rows")
    deals = F.array(*[F.struct(F.lit(i).alias("_deal"), hash_order(F.col(key), seed + i + 1).alias("_o"), F.col(c).cast("double").alias("_v")) for i, c in enumerate(numeric)])
    decks = running(df.select(F.col(key).alias("_key"), F.explode(deals).alias("_d")).select("_key", "_d.*"), ["_deal", "_o", "_key"], None, "_end")
    # each deck has all rows, so a place in the order of decks is one in its own deck
    dealt = decks.groupBy(((F.col("_end") - 1) % max(df.count(), 1) + 1).alias("_at")).agg(*[F.max(F.when(F.col("_deal") == i, F.col("_v"))).alias(f"_v{i}") for i in range(len(numeric))])
    met = running(df, [key], None, "_at").join(dealt, "_at")
    mixed = [F.struct(F.lit(i).alias("_deal"), *[F.col(f"_v{j}" if i == j else c).cast("double").alias(c) for j, c in enumerate(numeric)]) for i in range(-1, len(numeric))]
    rows = met.select(*[c for c in df.columns if c not in numeric], F.explode(F.array(*mixed)).alias("_d")).select("*", "_d.*").drop("_d")
    found = augment(model, rows).groupBy("_deal").agg(F.avg((F.col(target) == F.col("pred_class")).cast("double")).alias("accuracy"))
    found = found.agg(F.max(F.when(F.col("_deal") < 0, F.col("accuracy"))).alias("base"), *[F.max(F.when(F.col("_deal") == i, F.col("accuracy"))).alias(f"_a{i}") for i in range(len(numeric))])
    each = F.array(*[F.struct(F.lit(c).alias("feature"), (F.col("base") - F.col(f"_a{i}")).alias("importance")) for i, c in enumerate(numeric)])
    return found.select(F.explode(each).alias("_d")).select("_d.*").orderBy(F.desc("importance"), "feature")


def pca(df: DataFrame, cols: list[str], k: int, key: str) -> DataFrame:
    """Scores on the first k components of the standardised columns; each component's largest loading is positive."""
    prep = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="v"), StandardScaler(inputCol="v", outputCol="s", withMean=True)]).fit(df)
    s = prep.transform(df)
    m = PCA(k=k, inputCol="s", outputCol="p").fit(s)
    load = m.pc.toArray()
    sign = [1.0 if load[abs(load[:, j]).argmax(), j] >= 0 else -1.0 for j in range(k)]
    p = vector_to_array("p")
    return m.transform(s).select(key, *[(p[j] * sign[j]).alias(f"pc{j + 1}") for j in range(k)])


def kmeans(df: DataFrame, cols: list[str], k: int, seed: int = 1, scale: bool = False) -> DataFrame:
    stages = [VectorAssembler(inputCols=cols, outputCol="__v")]
    if scale:
        stages.append(StandardScaler(inputCol="__v", outputCol="__s", withMean=True))
    stages.append(KMeans(k=k, seed=seed, featuresCol=stages[-1].getOutputCol(), predictionCol="cluster_id"))
    return Pipeline(stages=stages).fit(df).transform(df).select(*df.columns, "cluster_id")


def predict_map(model: PipelineModel, stacked: DataFrame, bands: list[str]) -> DataFrame:
    """Class and probabilities of every cell whose bands are all present."""
    return augment(model, stacked.dropna("any", subset=bands))


def supplement_sizes(pts: DataFrame, cls: str) -> DataFrame:
    """How many more points of each class are wanted: emergent and scrub by half each if both are under half of
    forest; half of water from the other classes if they are together under half of water."""
    n = lambda *x: F.count_if(F.col(cls).isin(*x))
    c = pts.agg(n("EMW").alias("e"), n("SSW").alias("s"), n("FSW").alias("f"), n("OWW").alias("o"))
    low = (F.col("e") < 0.5 * F.col("f")) & (F.col("s") < 0.5 * F.col("f"))
    dry = (F.col("f") + F.col("e") + F.col("s")) < 0.5 * F.col("o")
    zero = F.lit(0)
    return c.select(
        F.when(low, F.bround(F.col("e") / 2)).otherwise(zero).cast("int").alias("EMW"), F.when(low, F.bround(F.col("s") / 2)).otherwise(zero).cast("int").alias("SSW"), F.when(dry, F.ceil(F.col("o") / 2)).otherwise(zero).cast("int").alias("other")
    )


def share_where(cond: Column) -> Column:
    """User statistic: the share of present values that meet a condition."""
    return F.avg(cond.cast("double"))
