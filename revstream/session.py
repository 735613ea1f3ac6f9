"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs rely on. Everything here may be overridden by the cluster's own settings.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Joins on a hot account, owner or campaign: AQE splits the oversized partition.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... also where an aggregate on the same key follows and the split costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    # Recording the Python line of every expression doubles the time to build wide plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "revstream", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the session names in ``spark.checkpoint.dir``.

    Every executor must reach it, so a machine-local folder is only accepted on a local master.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="run-")
    return f"{base.rstrip('/')}/revstream/{purpose}-{uuid.uuid4().hex}"


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


# Shredding takes a variant apart into columns: three times the time to write it, and to read it whole.
SHREDDING = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")


@contextmanager
def _set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def shuffles_released(spark: SparkSession):
    """Executors remove the shuffle files of an action when it has ended, not when the driver collects garbage."""
    return _set_for(spark, {RELEASE: "true"})


def variants_whole(spark: SparkSession):
    """Variants are written as they are, for tables that keep a record and seldom read its fields."""
    return _set_for(spark, dict.fromkeys(SHREDDING, "false"))


def checkpointed(df):
    """Cut lineage through the shared checkpoint folder, so that a lost executor costs no replay."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
    return df.checkpoint()


def _written_to(path: str, df):
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df, purpose: str):
    """``df`` written to the shared scratch folder and read back: lineage ends there, readers scan only what they use."""
    return _written_to(scratch_dir(df.sparkSession, purpose), df)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Scratch:
    """Writes frames as ``written`` does and knows where they are."""

    def __init__(self, spark: SparkSession):
        self.spark, self.held = spark, []

    def __call__(self, df, purpose: str, *done):
        """``df`` written and read back; then the frames ``done`` go, which only ``df`` was made of."""
        path = scratch_dir(self.spark, purpose)
        self.held.append((None, path))
        frame = _written_to(path, df)
        self.held[self.held.index((None, path))] = frame, path
        self.drop(*done)
        return frame

    def drop(self, *frames) -> None:
        for held in [x for x in self.held if any(x[0] is f for f in frames)]:
            removed(self.spark, held[1])
            self.held.remove(held)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A writer of frames that are read inside this block only: their folders go when it ends."""
    store = Scratch(spark)
    try:
        yield store
    finally:
        for _, path in store.held:
            removed(spark, path)
