"""Session helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python stages find it anywhere."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="dealspark-")) / "dealspark.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, str(Path(root.name) / path.relative_to(root)))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only where none is set and all runs on this machine (tests)."""
    context = spark.sparkContext
    current = context.getCheckpointDir() or context.getConf().get("spark.checkpoint.dir")
    if not current:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = os.path.join(tempfile.gettempdir(), "dealspark-checkpoints")
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def durable(df: DataFrame) -> DataFrame:
    """Cut lineage through the shared checkpoint folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Parquet tables in the shared checkpoint folder that cut lineage: compact, read by column, and dropped when no longer needed."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
        self.tables: list[tuple[DataFrame, str]] = []

    def stored(self, df: DataFrame) -> DataFrame:
        path = f"{self.base}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.tables.append((out, path))
        return out

    def drop(self, *kept: DataFrame) -> None:
        """Delete all tables but those that a lazy result still reads."""
        for df, name in self.tables:
            if not any(df is k for k in kept):
                path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
                path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self.tables = [t for t in self.tables if any(t[0] is k for k in kept)]


def stored(df: DataFrame) -> DataFrame:
    """One such table for a result that is read later."""
    return Scratch(df.sparkSession).stored(df)


#: Rows of an Arrow batch of whole texts.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """At most so many rows an Arrow batch in this session, since a batch of 10,000 long texts is held several times over; it stays so, as results are lazy."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


#: Rows of a task for costly work on narrow rows; fewer rows than the lower figure make no task of their own.
TASK_ROWS, LEAST_ROWS = 50_000, 500


def task_count(df: DataFrame) -> int:
    """Tasks for costly work on the rows of a table: three a core at least, more for many rows, fewer for very few."""
    rows = df.count()
    return min(max(3 * df.sparkSession.sparkContext.defaultParallelism, rows // TASK_ROWS), rows // LEAST_ROWS + 1)


def spread(df: DataFrame, key: str) -> DataFrame:
    """The narrow rows of a table dealt by a key to as many tasks as costly work on them needs.

    Spark sizes its tasks by bytes, and a row group is never divided: a million orders in one row group are one task, whatever is made of them.
    """
    return df.repartition(task_count(df), key)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
