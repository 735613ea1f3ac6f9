"""Per-object watermarks in a small keyed table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstream.catalog import OBJECTS
from revstream.operators.incremental import DEFAULT_WATERMARK, as_utc
from revstream.sources.tables import Table


class WatermarkStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, Table(spark, path)

    def get(self, obj: str) -> datetime:
        stored = self.table.read()
        row = None if stored is None else stored.filter(F.col("object") == obj).first()
        return as_utc(row["watermark"]) if row else DEFAULT_WATERMARK

    def set(self, obj: str, ts: datetime | str) -> None:
        """Last write wins; writing the same instant again changes nothing."""
        self.set_all({obj: ts})

    def set_all(self, marks: dict[str, datetime | str]) -> None:
        rows = [(o, as_utc(t).isoformat()) for o, t in marks.items()]
        self.table.upsert(self.spark.createDataFrame(rows, "object string, watermark string"), "object", buckets=1)

    def get_all(self, objects: list[str] | None = None) -> DataFrame:
        """Every object with its watermark; objects never written show the default."""
        names = self.spark.createDataFrame([(o,) for o in objects or OBJECTS], "object string")
        stored = self.table.read()
        if stored is None:
            return names.withColumn("watermark", F.lit(DEFAULT_WATERMARK.isoformat()))
        default = F.lit(DEFAULT_WATERMARK.isoformat())
        return names.join(stored, "object", "left").withColumn("watermark", F.coalesce("watermark", default))
