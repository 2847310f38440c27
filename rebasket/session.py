"""Session settings and the shared folder used to hand tables over."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from rebasket.sources.files import remove

# Joins here follow business keys (customer, product, order).  One key may own a
# large share of the rows, so skewed join partitions are always split, also
# where that costs one more exchange further up.
_RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Bytes of compressed rows; sorted, they take five times as much and up to four
    # tasks share an executor, so that larger partitions would spill.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the joins rely on to a session."""
    for key, value in _RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cores: int | str = "*", **settings: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rebasket-"))
    return context.getCheckpointDir().rstrip("/")


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    run = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/{run}/{name}-{uuid.uuid4().hex[:12]}"
    made = _scratch.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables handed over inside the block when it ends, also after an error.

    What the block returns must not read them any more.
    """
    token = _scratch.set([])
    try:
        yield
    finally:
        made = _scratch.get() or []
        _scratch.reset(token)
        for path in made:
            remove(spark, path)


def spread_rows(df: DataFrame) -> DataFrame:
    """Enough partitions for every core; a table that has them is left alone.

    For work that is heavy per row, so that a small table in one file does not
    keep a single core busy.  ``df`` should read a stored table: its partitions
    are counted, which would run the shuffles of a longer plan.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


@dataclass(frozen=True)
class Handover:
    """A Parquet table between two stages: it cuts lineage and survives executors."""

    path: str
    schema: StructType

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(self.schema).parquet(self.path)


def hand_over(df: DataFrame, name: str, partition_by: str | None = None) -> Handover:
    """Write ``df`` once to the shared folder and describe how to read it back."""
    path = new_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return Handover(path, df.schema)
