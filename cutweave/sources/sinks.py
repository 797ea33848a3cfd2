"""Tables as results: appended logs and overwritten payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import settled

KINDS = ["segment_label", "boundary_refinement"]


def append_results(results: DataFrame, path: str) -> None:
    """Appends result records as JSON lines, in a folder for each kind of job; unknown kinds are windows."""
    kind = F.when(F.col("job_type").isin(*KINDS), F.col("job_type")).otherwise("window")
    results.withColumn("job_type", kind).write.mode("append").partitionBy("job_type").json(path)


def stream_results(results: DataFrame, path: str, checkpoint: str):
    """The same for a stream; each batch is appended once, however often it is tried."""
    return results.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint).partitionBy("job_type").outputMode("append").trigger(availableNow=True).start()


def overwrite_payloads(segments: DataFrame, path: str, buckets: int = 256) -> None:
    """Replaces the segments of the samples at hand and of no others, in folders by a hash of the sample; diagnostics are not kept.

    The folders of these samples are written anew with what the others in them have, so the number of files follows the buckets.
    """
    spark, kept = segments.sparkSession, segments.drop("diagnostics").withColumn("bucket", F.pmod(F.xxhash64("sample_id"), F.lit(buckets)).cast("int"))
    if _exists(spark, path):
        old = spark.read.parquet(path)
        touched = kept.select("bucket").distinct()
        others = old.join(F.broadcast(touched), "bucket", "left_semi").join(kept.select("sample_id").distinct(), "sample_id", "left_anti")
        kept = settled(kept.unionByName(others.select(*kept.columns)))  # read whole before its folders are replaced
    kept.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def _exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
