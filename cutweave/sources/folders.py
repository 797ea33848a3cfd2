"""Scans of folders: the samples of data sets, runs that hold something already, and boundary files of both shapes."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Folder(InputPartition):
    def __init__(self, root: str, subset: str, path: str):
        self.root, self.subset, self.path = root, subset, path


class Listing(DataSource):
    """Names in folders, one partition for each folder, so folders are listed in parallel and nothing of files is read. Options:
    folders, JSON of [root, subset, path]; a folder that is not there gives one row without a name."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return "root string, subset string, name string, is_folder boolean"

    def reader(self, schema) -> DataSourceReader:
        return Lister(json.loads(self.options["folders"]))


class Lister(DataSourceReader):
    def __init__(self, folders: list[list[str]]):
        self.folders = folders

    def partitions(self) -> list[InputPartition]:
        return [Folder(*f) for f in self.folders]

    def read(self, partition: Folder) -> Iterator[tuple]:
        from pyarrow import fs

        uri = partition.path.replace("s3a://", "s3://", 1)
        store, path = fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True))
        yield partition.root, partition.subset, None, None
        for f in found:
            yield partition.root, partition.subset, f.base_name, f.type == fs.FileType.Directory


def listed(spark: SparkSession, folders: list[list[str]]) -> DataFrame:
    """root, subset, name, is_folder of what lies in each [root, subset, path]; each has a row without a name besides."""
    if not folders:
        return spark.createDataFrame([], "root string, subset string, name string, is_folder boolean")
    spark.dataSource.register(Listing)
    return spark.read.format("folder_listing").option("folders", json.dumps(folders)).load()


def data_sets(spark: SparkSession, sets: list[tuple[str, str]], runs: str, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(data_root, subset, sample_id; data_root, subset, run_dir, nonempty) of data sets (root, subset): a sample is a folder in
    root/subset, none where that is missing; nonempty tells whether runs/subset/run_id held anything."""
    data = listed(spark, [[r, s, f"{r.rstrip('/')}/{s}"] for r, s in sets]).filter("is_folder")
    run = listed(spark, [[r, s, f"{runs.rstrip('/')}/{s}/{run_id}"] for r, s in sets]).groupBy("root", "subset").agg((F.count("name") > 0).alias("nonempty"))
    at = F.concat_ws("/", F.lit(runs.rstrip("/")), "subset", F.lit(run_id))
    return data.select(F.col("root").alias("data_root"), "subset", F.col("name").alias("sample_id")), run.select(F.col("root").alias("data_root"), "subset", at.alias("run_dir"), "nonempty")


def boundary_files(spark: SparkSession, path: str, official: bool = False) -> DataFrame:
    """sample_id (the file's folder), idx, frame: ends of all segments but the last of each JSON file. Predictions are objects with
    segments, official files the segments themselves. A file that is no such JSON, or has one segment, gives no rows; an end that
    is no number is NULL; broken numbers are cut."""
    files = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=True).select("value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("sample_id"))
    segments = F.try_variant_get(F.try_parse_json("value"), "$" if official else "$.segments", "array<variant>")
    rows = files.select("sample_id", segments.alias("s")).select("sample_id", F.size("s").alias("n"), F.posexplode("s").alias("idx", "segment")).filter("idx < n - 1")
    end = F.coalesce(F.try_variant_get("segment", "$.end_frame", "long"), F.try_variant_get("segment", "$.end_frame", "double").cast("long"))
    return rows.select("sample_id", F.col("idx").cast("long").alias("idx"), end.alias("frame"))
