"""Shared pieces of the training-data operators: the shared work folder, written tables, folds and global ranks."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share. Where none is set, a local session takes a folder of its own;
    on a cluster that is an error, since executors would write to disks that nobody else reads."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        sc = spark.sparkContext
        if sc._jsc.sc().getCheckpointDir().isEmpty():
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="cutweave-"))
        base = sc._jsc.sc().getCheckpointDir().get()
    path = spark._jvm.org.apache.hadoop.fs.Path(base)  # qualified, so that readers other than Spark's look into the same store
    return f"{path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends here, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key's text modulo folds; NULL for a NULL key."""
    return F.crc32(key.cast("string")) % F.lit(folds)


def learnable(fold: Column, held: int) -> Column:
    """Rows to learn from: a fold that is known and not held out."""
    return F.coalesce(fold != F.lit(held), F.lit(False))


def global_rank(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Adds rank (from 0) in the order of unique keys without ever putting all rows into one task.

    Rows are ranged over partitions and written; each range is ranked alone and shifted by the rows of the ranges before
    it, of which there is one total per partition.
    """
    ranged = written(df.repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, *order).withColumn("__range", F.spark_partition_id()), "ranked")
    totals = ranged.groupBy("__range").agg(F.count("*").alias("__rows"))
    before = totals.select("__range", (F.sum("__rows").over(Window.orderBy("__range")) - F.col("__rows")).alias("__before"))
    local = ranged.withColumn("__local", F.row_number().over(Window.partitionBy("__range").orderBy(*order)) - F.lit(1))
    return local.join(before, "__range").withColumn(rank, F.col("__local") + F.col("__before")).drop("__range", "__local", "__before")


def range_edges(df: DataFrame, key: str, ranges: int) -> list:
    """Keys that cut df into about equal ranges, at most ranges - 1 of them; only the key is read."""
    return sorted(set(df.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or [])) if ranges > 1 else []


def range_of(key: Column, edges: list) -> Column:
    """How many edges are below key, found by halving; 0 for NULL."""
    if not edges:
        return F.lit(0)
    all_edges, n = F.array(*[F.lit(e) for e in edges]), len(edges)
    steps = F.array(*[F.lit(1 << b) for b in range(n.bit_length() - 1, -1, -1)])
    found = F.aggregate(steps, F.lit(0), lambda t, s: F.when((t + s <= n) & (key > F.get(all_edges, F.least(t + s, F.lit(n)) - 1)), t + s).otherwise(t))
    return F.when(key.isNull(), F.lit(0)).otherwise(found)
