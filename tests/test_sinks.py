"""Tables on disk: windows skip files, failed rewrites change nothing."""

import pytest
from pyspark.sql import functions as F

from marshlight.sources import sinks as S


def cells(spark, n=64):
    r = spark.range(-n // 2, n // 2).withColumnRenamed("id", "r")
    return r.select("r", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias("c")).select(F.explode(F.array(F.lit(0), F.lit(1))).alias("h"), "r", "c", (F.col("r") * 100 + F.col("c")).cast("double").alias("dem"))


def test_morton_numbers_are_distinct_and_local(spark):
    got = {(x.r, x.c): x.m for x in cells(spark, 16).filter("h = 0").select("r", "c", S.morton(F.col("r"), F.col("c")).alias("m")).collect()}
    assert len(set(got.values())) == len(got) == 256
    assert max(got[r, c] for r in range(0, 4) for c in range(0, 4)) - min(got[r, c] for r in range(0, 4) for c in range(0, 4)) == 15


def test_a_window_meets_few_files(spark, tmp_path):
    root = str(tmp_path / "cells")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # a table this small would be one file
    try:
        S.write_cells(cells(spark), root, ("h",))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(root)
    files = back.filter("h = 1").groupBy(F.input_file_name().alias("f")).agg(F.min("r").alias("r0"), F.max("r").alias("r1"), F.min("c").alias("c0"), F.max("c").alias("c1")).collect()
    met = [f for f in files if f.r0 <= 7 and f.r1 >= 0 and f.c0 <= 7 and f.c1 >= 0]
    assert len(files) >= 12 and len(met) <= 3
    assert back.count() == 2 * 64 * 64 and back.filter("h = 1 AND r BETWEEN 0 AND 7 AND c BETWEEN 0 AND 7").count() == 64


def test_a_rewrite_that_fails_leaves_the_table(spark, tmp_path):
    root, aside = str(tmp_path / "cells"), str(tmp_path / "aside")
    S.write_cells(cells(spark), root, ("h",))
    before = sorted(map(tuple, spark.read.parquet(root).collect()))
    bad = spark.read.parquet(root).filter("h = 1").withColumn("dem", F.when(F.col("r") == 20, F.raise_error(F.lit("stopped half-way"))).otherwise(F.col("dem") + 1).cast("double"))
    with pytest.raises(Exception, match="half-way"):
        S.replace_partition(spark, bad, root, ("h",), aside)
    with pytest.raises(Exception, match="half-way"):
        S.write_cells(spark.read.parquet(root).filter("h = 1").select("h", "r", "c", F.when(F.col("r") == 20, F.raise_error(F.lit("half-way"))).otherwise(F.col("dem")).cast("double").alias("dem")), root, ("h",))
    assert sorted(map(tuple, spark.read.parquet(root).collect())) == before
    S.replace_partition(spark, spark.read.parquet(root).filter("h = 1").withColumn("dem", F.col("dem") + 1), root, ("h",), aside)
    got = spark.read.parquet(root)
    assert got.filter("h = 0").count() == 4096 and got.filter("h = 1").agg(F.sum("dem") - F.sum(F.col("r") * 100 + F.col("c"))).first()[0] == 4096
    assert not (tmp_path / "aside").exists()
