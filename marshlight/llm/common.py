"""Scratch tables in the shared folder and small helpers that the operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


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


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: the lineage ends and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that no later result reads."""
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def arrow_batches(spark: SparkSession, size: int):
    """Plans run inside send Python at most ``size`` bytes at once; the session's own limit is put back after."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def tidy(run):
    """``run`` over batches, giving the memory that it freed back to the system at its end: a worker stays for later
    tasks, beside the executor's heap."""

    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(mod)


def text_bytes(text: Column) -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(text, F.lit("")).cast("binary")


def join_counted(rows: DataFrame, facts: DataFrame, key: str, count: str, hot: int = 5000) -> DataFrame:
    """``rows`` with the columns of ``facts``, which has one row per value of ``key`` (null included) and how many rows
    have it. A value of more than one in ``hot`` rows is met by broadcast, and there are fewer than ``hot`` of them; the
    others are met by a shuffle, in which no value is large."""
    facts, _ = materialize(facts.withColumnRenamed(key, "_key"), "facts")
    n = facts.agg(F.sum(count)).first()[0] or 0
    common = F.col(count) > F.lit(n / hot)
    same = F.col(key).eqNullSafe(F.col("_key"))
    many, few = facts.filter(common), facts.filter(~common)
    found = rows.join(F.broadcast(many), same).unionByName(rows.join(F.broadcast(many.select("_key")), same, "left_anti").join(few, same))
    return found.drop("_key")
