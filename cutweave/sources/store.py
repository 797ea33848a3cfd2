"""The store of finished samples: commits in batches that are tried again without harm, and event logs written to two places.

A batch writes its payloads, then runtime records and failure reports, then markers, each under batch=<id>, and last its own id. What a
sample holds is told by its last marker alone: a payload counts if its batch's marker says done, a report if it says failed. So a batch
that dies between two steps shows nothing, a second try overwrites the same places, one that ended is not done again, and a failure
hides what was there before; vacuum() removes what is hidden. Batch ids ascend over the life of a store.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lifecycle import KEY, finished
from ..operators.metrics import contract_violations

#: Folders of the current rows after a vacuum; samples are dealt to them by a hash of their key.
BUCKETS = 256
MARKER = "subset string, sample_id long, marker string, batch long"
REPORT = "subset string, sample_id long, reason string, details string, batch long"
RUNTIME = "subset string, sample_id long, runtime string, batch long"


def bucket(buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int").alias("bucket")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def put(df: DataFrame, path: str, batch: int) -> None:
    """Writes the rows of one batch in place of what an earlier try left there."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches of a table; none before the first."""
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def ended(spark: SparkSession, base: str, batch: int) -> bool:
    return exists(spark, f"{base}/batches/batch={batch}/_SUCCESS")


def next_batch(spark: SparkSession, base: str) -> int:
    """An id above all of the store."""
    if not exists(spark, f"{base}/batches"):
        return 0
    return (table(spark, f"{base}/batches", "done boolean, batch long").agg(F.max("batch")).first()[0] or 0) + 1


def markers(spark: SparkSession, base: str, before: int | None = None) -> DataFrame:
    """subset, sample_id, marker, batch: each sample's last marker, of the batches before one if that is given."""
    rows = table(spark, f"{base}/markers", MARKER)
    rows = rows if before is None else rows.filter(F.col("batch") < before)
    return rows.groupBy(*KEY).agg(F.max(F.struct("batch", "marker")).alias("m")).select(*KEY, "m.marker", "m.batch")


def payloads(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """Segments of the samples that are done; schema gives their columns besides subset, sample_id."""
    rows = table(spark, f"{base}/segments", f"subset string, sample_id long, {schema}, batch long")
    return rows.join(markers(spark, base).filter("marker = 'done'"), [*KEY, "batch"], "left_semi").drop("batch")


def reports(spark: SparkSession, base: str) -> DataFrame:
    """Failure reports of the samples that failed last."""
    rows = table(spark, f"{base}/failures", REPORT)
    return rows.join(markers(spark, base).filter("marker = 'failed'"), [*KEY, "batch"], "left_semi").drop("batch")


def runtimes(spark: SparkSession, base: str) -> DataFrame:
    """The runtime record of each sample's last marker."""
    return table(spark, f"{base}/runtimes", RUNTIME).join(markers(spark, base), [*KEY, "batch"], "left_semi").drop("batch")


def commit(samples: DataFrame, base: str, batch: int) -> DataFrame:
    """samples(subset, sample_id, seq, required, completed, failure_reason, details, runtime, segments array of structs) -> subset,
    sample_id, outcome, missing, already_done, after the batch is in the store.

    Of rows of one sample the last by seq counts. Outcomes are those of lifecycle.finished: a sample that lacks a required stage is
    refused and changes nothing; one that failed loses what it had; one that is done loses its report. Segments lose their
    diagnostics. already_done is about the batches before this one, so a second try tells the same; a batch that ended is only
    told again. An empty batch leaves its id.
    """
    spark = samples.sparkSession
    rest = [c for c in samples.columns if c not in KEY]
    last = samples.groupBy(*KEY).agg(F.max_by(F.struct(*rest), "seq").alias("s")).select(*KEY, "s.*")
    had = markers(spark, base, batch).select(*KEY, (F.col("marker") == "done").alias("was_done"))
    told = last.join(had, KEY, "left")
    outcomes = finished(told)
    if ended(spark, base, batch):
        return outcomes
    rows = told.join(outcomes.select(*KEY, "outcome"), KEY).filter("outcome <> 'refused'")
    done, failed = rows.filter("outcome = 'done'"), rows.filter("outcome = 'failed'")
    segment = done.select(*KEY, F.explode("segments").alias("g")).select(*KEY, "g.*").drop("diagnostics")
    put(segment, f"{base}/segments", batch)
    put(rows.select(*KEY, "runtime"), f"{base}/runtimes", batch)
    put(failed.select(*KEY, F.trim("failure_reason").alias("reason"), F.coalesce("details", F.lit("{}")).alias("details")), f"{base}/failures", batch)
    put(rows.select(*KEY, F.col("outcome").alias("marker")), f"{base}/markers", batch)
    put(spark.range(1).select(F.lit(True).alias("done")), f"{base}/batches", batch)
    return outcomes


def commit_stream(samples: DataFrame, base: str, checkpoint: str, first: int = 0):
    """commit() for each batch of a stream. A stream with a new checkpoint begins at next_batch()."""
    each = lambda df, k: commit(df, base, first + k).write.format("noop").mode("overwrite").save()
    return samples.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(spark: SparkSession, base: str) -> DataFrame:
    """subset, done, failed: samples by their last marker."""
    return markers(spark, base).groupBy("subset").agg(F.count_if(F.col("marker") == "done").alias("done"), F.count_if(F.col("marker") == "failed").alias("failed"))


def vacuum(spark: SparkSession, base: str, to: str, schema: str, buckets: int = BUCKETS) -> None:
    """Writes what counts into a new store at to, as its batch 0, with files by buckets of samples, however many these are."""
    kept = {"segments": payloads(spark, base, schema), "runtimes": runtimes(spark, base), "failures": reports(spark, base), "markers": markers(spark, base).drop("batch")}
    for name, df in kept.items():
        put(df.repartition(buckets, bucket(buckets)), f"{to}/{name}", 0)
    put(spark.range(1).select(F.lit(True).alias("done")), f"{to}/batches", 0)


# events


def lines(events: DataFrame) -> DataFrame:
    """events(event_id, event, ...) -> event_id, line: single JSON objects with sorted keys, fields without a value left out."""
    names = sorted(c for c in events.columns if c != "event_id")
    return events.select("event_id", F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "true"}).alias("line"))


def checked_lines(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines of the events that keep their contract, event_id and missing fields of those that don't). event_id tells events apart."""
    bad = contract_violations(events)
    return lines(events.join(bad.select("event_id"), "event_id", "left_anti")), bad


def append_events(events: DataFrame, base: str, batch: int) -> None:
    """Appends the same events to the logs of their samples (by buckets) and to the log of their run (by subset); events that break
    their contract go to a third place, with what they lack. A second try of a batch writes the same rows in the same places, one that
    ended writes nothing."""
    spark = events.sparkSession
    if ended(spark, base, batch):
        return
    good, bad = checked_lines(events)
    keyed = good.join(events.select("event_id", *KEY), "event_id")
    keyed.withColumn("bucket", bucket()).write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/sample_events/batch={batch}")
    keyed.write.mode("overwrite").partitionBy("subset").parquet(f"{base}/run_events/batch={batch}")
    put(bad, f"{base}/rejected", batch)
    put(spark.range(1).select(F.lit(True).alias("done")), f"{base}/batches", batch)


def event_stream(events: DataFrame, base: str, checkpoint: str):
    """append_events() for each batch of a stream."""
    return events.writeStream.foreachBatch(lambda df, k: append_events(df, base, k)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def of_ended(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows of a log, of the batches that ended."""
    return spark.read.parquet(f"{base}/{name}").join(F.broadcast(spark.read.parquet(f"{base}/batches").select("batch").distinct()), "batch", "left_semi")


# documents


def write_documents(documents: DataFrame, path: str, key: str = "subset") -> None:
    """documents(key, ...) -> one indented JSON text for each key (a run's manifest or its summary), in a folder of that key; what other
    keys have stays."""
    fields = [c for c in documents.columns if c != key]
    text = F.to_json(F.struct(key, *fields), {"pretty": "true"})
    documents.select(F.col(key).alias("__key"), text.alias("value")).repartition(key if key == "__key" else "__key").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__key").text(path)
