"""Token-ID output: documents in ascending id order, encoded and written as wavelet shards, and read back."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens, wavelet
from .common import range_edges, range_of, shared_dir, table, written


def to_batch(df: pd.DataFrame):
    import pyarrow as pa

    return pa.RecordBatch.from_pandas(df.astype({"part": "int32", "shard": "int32"}), preserve_index=False)


def put(uri: str, name: str, data: bytes) -> None:
    """Writes a file under a name of this attempt, then moves it: a repeated task leaves the same whole file."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))
    store.create_dir(root, recursive=True)
    own = f"{root}/_{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{root}/{name}")


def write_shards(docs: DataFrame, directory: str, tokenizer: str | None = None, end_id: int = 0, shard_tokens: int = wavelet.SHARD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the shards into directory (a URI that all executors reach) and returns one row for each: part, shard, start
    (ids of all documents before it), n_docs, n_tokens.

    Documents stand in ascending id, NULL ids first, equal ids in the order of their texts' hashes. A NULL text is empty, so
    each document has its end id at least. An empty table writes no file. Ids must be integers, and the tokenizer's at most 65,535.
    """
    path = tokenizer or tokens.tokenizer_path()
    ranged = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ranged.repartitionById(ranges, range_of(F.col("doc_id"), range_edges(ranged, "doc_id", ranges))).sortWithinPartitions(*order)

    def write(batches):
        encoder, part, shard = tokens.encoder(path), TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, bytes]] = []
        total, end = 0, np.array([end_id], "<u2").tobytes()

        def flush() -> pd.DataFrame:
            lengths = [len(b) // 2 for _, b in held]
            ids = np.frombuffer(b"".join(b for _, b in held), "<u2")
            put(directory, f"part-{part:06d}-{shard:06d}.wvm", wavelet.build(ids, [d for d, _ in held], lengths, part, shard))
            return pd.DataFrame({"part": [part], "shard": [shard], "n_docs": [len(held)], "n_tokens": [len(ids)]})

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for some in tokens.in_pieces(texts, [len(t) for t in texts], 1 << 20):
                for doc, encoded in zip(ids[some], encoder.encode(texts[some]), strict=True):
                    held.append((doc, encoded + end))
                    total += len(encoded) // 2 + 1
                    if total >= shard_tokens:
                        yield to_batch(flush())
                        held, total, shard = [], 0, shard + 1
        if held:
            yield to_batch(flush())

    shards = written(ranged.mapInArrow(write, "part int, shard int, n_docs long, n_tokens long"), "shards")
    return with_starts(shards).select("part", "shard", "start", "n_docs", "n_tokens")


def with_starts(shards: DataFrame) -> DataFrame:
    """shards(part, shard, n_tokens) with start, the ids of all shards before."""
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("n_tokens")
    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("of_part"))  # a row for each partition
    before = parts.select("part", (F.sum("of_part").over(Window.orderBy("part")) - F.col("of_part")).alias("before"))
    return shards.join(before, "part").withColumn("start", F.col("before") + inside).drop("before")


def read_heads(spark: SparkSession, directory: str) -> DataFrame:
    """part, shard, n_tokens as the headers of the files have them."""

    def read(batches):
        for batch in batches:
            heads = [wavelet.head_of(data) for data in batch["content"]]
            yield pd.DataFrame({"part": [h["part"] for h in heads], "shard": [h["shard"] for h in heads], "n_tokens": [h["n"] for h in heads]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(directory).select("content")
    return files.mapInPandas(read, "part int, shard int, n_tokens long")


def read_shards(spark: SparkSession, directory: str) -> DataFrame:
    """What the files hold: part, shard, doc_id, inside (ids before it in the shard), n_tokens, ids_crc32."""

    def read(batches):
        tokens.release()
        for batch in batches:
            for data in batch["content"]:
                rows = [(doc, at, len(ids), wavelet.ids_crc32(ids), shard) for shard in [wavelet.Shard(data)] for doc, at, ids in shard.documents()]
                yield pd.DataFrame({"part": [s.head["part"] for *_, s in rows], "shard": [s.head["shard"] for *_, s in rows], "doc_id": pd.array([r[0] for r in rows], "Int64"), "inside": [r[1] for r in rows], "n_tokens": [r[2] for r in rows], "ids_crc32": [r[3] for r in rows]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.wvm").load(directory).select("content")
    return files.mapInPandas(read, "part int, shard int, doc_id long, inside long, n_tokens long, ids_crc32 long")


def documents_of(spark: SparkSession, directory: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files alone: a shard that is missing moves all starts after it."""
    starts = with_starts(written(read_heads(spark, directory), "heads")).select("part", "shard", "start")
    return read_shards(spark, directory).join(starts, ["part", "shard"]).select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def op10_tokenfiles(spark, sf_dir: str) -> DataFrame:
    directory = shared_dir(spark, "token-files")
    shards = write_shards(table(spark, sf_dir, "documents"), directory)
    if shards.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return documents_of(spark, directory)
