"""Iteration with state in the shared folder, and connected components on it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_local: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir). Where it is unset a local session, as in tests, gets a
    temporary folder; a cluster is told to set it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="marshlight-")
    return _local[app]


BROADCAST = 10 << 20  # bytes in memory up to which a settled table may be sent to all


def settle(df: DataFrame, tag: str = "state", cells: bool = False) -> DataFrame:
    """Write the state of a round to the cluster's shared folder and read it back, which ends its lineage.

    Spark takes the files' size for the table's, and files of cells are packed to a twentieth of what a broadcast of
    them takes in the driver. Joins of a table of ``cells``, which is met on its cells and not on a few hot keys, are
    therefore told to sort if its rows take more than ``BROADCAST``."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    if cells and out.count() * 8 * (len(df.columns) + 3) > BROADCAST:  # the files' footers tell
        out = out.hint("merge")
    out._settled = path
    return out


def discard(*states: DataFrame) -> None:
    """Delete settled tables that no later result reads."""
    for df in states:
        at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._settled)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def both_ways(pairs: DataFrame) -> DataFrame:
    """``a, b`` and ``b, a``; a union would compute the pairs twice."""
    return pairs.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")).select("p.a", "p.b")


def connected(pairs: DataFrame, nodes: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root``: the smallest node each of ``nodes(node)`` reaches over ``pairs(a, b)``. Labels fall to the
    least neighbour's and then jump to their label's label."""
    both = settle(both_ways(pairs), "pairs")
    labels = held = settle(nodes.select("node", F.col("node").alias("root")), "labels")
    for _ in range(rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("root").alias("m"))
        low = labels.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("root").alias("old"), F.least("root", F.coalesce("m", "root")).alias("root"))
        low = settle(low, "labels")
        up = low.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = settle(low.join(up, "root", "left").select("node", "old", F.least("root", F.coalesce("up", "root")).alias("root")), "labels")
        discard(held, low)
        held, labels = new, new.select("node", "root")
        if not new.filter("root <> old").limit(1).count():
            discard(both)
            return labels
    raise RuntimeError("labels did not settle")
