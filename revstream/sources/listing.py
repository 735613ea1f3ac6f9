"""Files as rows: where they are, how large and how old. Contents are not read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``file_name, bytes, modified_at`` of every file below ``path``; ``pattern`` is a glob on the file's own name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    meta = F.col("_metadata")
    return reader.load(path).select(
        meta["file_path"].alias("file_name"),
        meta["file_size"].alias("bytes"),
        meta["file_modification_time"].cast("timestamp_ntz").alias("modified_at"),
    )


def folder_below(root: str, file_name: str = "file_name") -> Column:
    """The first folder of a file's path below ``root``."""
    name = root.rstrip("/").rsplit("/", 1)[-1]
    return F.substring_index(F.element_at(F.split(F.col(file_name), f"/\\Q{name}\\E/"), -1), "/", 1)
