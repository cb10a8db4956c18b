"""Event-time form of the weekly windows: deduplicated, counted, written once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealspark.functions import dates
from dealspark.session import ensure_checkpoint_dir


def weekly_counts(events: DataFrame, lateness: str = "10 days") -> DataFrame:
    """Counts of distinct events by weekly window and type; later events than ``lateness`` are dropped by the watermark."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", lateness)
    unique = timed.dropDuplicatesWithinWatermark(["event_id"])
    start = dates.window_start(F.col("at").cast("timestamp_ntz"))
    return unique.groupBy(start.alias("start"), "event_type").agg(F.count("*").alias("n"))


def counted_once(spark: SparkSession, path: str) -> DataFrame:
    """Run the stream over all files that are there and return its table."""
    found = spark.read.parquet(path)
    folder, _, name = path.rpartition("/")
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    single = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).isFile()  # a stream reads folders only
    reader = spark.readStream.schema(found.schema)
    events = reader.option("pathGlobFilter", name).parquet(folder) if single else reader.parquet(path)
    run = uuid.uuid4().hex
    base = f"{ensure_checkpoint_dir(spark)}/streams/{run}"

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/out/{number:08d}")

    stream = weekly_counts(events).writeStream.outputMode("complete").foreachBatch(save).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start()
    stream.awaitTermination()
    if stream.lastProgress is None:  # no file had rows
        return weekly_counts(found)
    last = stream.lastProgress["batchId"]
    return spark.read.parquet(f"{base}/out/{last:08d}")


#: Weekly windows begin on Fridays at 05:00, counted from the epoch's Thursday.
WEEK, OFFSET = "7 days", "29 hours"


def closed_counts(events: DataFrame, lateness: str = "10 days") -> DataFrame:
    """Counts of distinct events by weekly window and type, for append mode: a window comes once, when the watermark has passed its end.

    State holds the windows and event ids that the watermark hasn't passed, so its size is bounded by the lateness.
    """
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", lateness)
    counted = timed.dropDuplicatesWithinWatermark(["event_id"]).groupBy(F.window("at", WEEK, WEEK, OFFSET).alias("w"), "event_type").agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n")


class Weeks:
    """A folder of event files as weekly counts, with the rows that come too late in a table of their own.

    A first stream deals the rows of each micro-batch: those older than the latest time of all batches before, less the lateness, are late. A second one
    counts the rest; nothing it reads is behind its watermark, so it leaves no row out. A batch that is written again replaces itself.
    Late rows say which windows to count again from the files.
    """

    def __init__(self, spark: SparkSession, path: str, base: str | None = None, lateness: str = "10 days", files: int = 1000):
        self.spark, self.lateness = spark, lateness
        self.base = base or f"{ensure_checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}"
        self.schema = spark.read.parquet(path).schema
        folder, _, name = path.rpartition("/")
        file = spark._jvm.org.apache.hadoop.fs.Path(path)
        single = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).isFile()
        self._reader = lambda: (lambda r: r.option("pathGlobFilter", name).parquet(folder) if single else r.parquet(path))(spark.readStream.schema(self.schema).option("maxFilesPerTrigger", files))

    def run(self) -> Weeks:
        """Read what is there and stop; a later call goes on from there."""
        rows = self._reader().writeStream.foreachBatch(self._sort_out).option("checkpointLocation", f"{self.base}/state/rows").trigger(availableNow=True).start()
        rows.awaitTermination()
        timely = self.spark.readStream.schema(self.schema).parquet(f"{self.base}/timely/*")
        counts = closed_counts(timely, self.lateness).writeStream.outputMode("append").format("parquet").option("path", f"{self.base}/closed").option("checkpointLocation", f"{self.base}/state/closed").trigger(availableNow=True).start()
        counts.awaitTermination()
        return self

    def _sort_out(self, batch: DataFrame, number: int) -> None:
        """The batch's timely and late rows, and the latest time up to and with it."""
        spark = batch.sparkSession
        known = spark.read.schema("high timestamp_ntz").parquet(f"{self.base}/marks/{number - 1:09d}").first()[0] if number else None
        at = F.col("ts").cast("timestamp_ntz")
        is_late = F.coalesce(at < F.lit(known) - F.expr(f"interval {self.lateness}"), F.lit(False)) if known is not None else F.lit(False)
        batch.where(is_late).write.mode("overwrite").parquet(f"{self.base}/late/{number:09d}")
        batch.where(~is_late).write.mode("overwrite").parquet(f"{self.base}/timely/{number:09d}")
        high = batch.agg(F.greatest(F.max(at), F.lit(known).cast("timestamp_ntz")).alias("high"))
        high.coalesce(1).write.mode("overwrite").parquet(f"{self.base}/marks/{number:09d}")

    def closed(self) -> DataFrame:
        return self.spark.read.schema("start timestamp_ntz, event_type string, n long").parquet(f"{self.base}/closed")

    def late(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.base}/late/*")

    def recount(self, events: DataFrame) -> DataFrame:
        """The windows that late rows belong to, counted again from all events."""
        start = dates.window_start(F.col("ts").cast("timestamp_ntz"))
        touched = self.late().select(start.alias("start")).distinct()
        unique = events.withColumn("start", start).join(touched, "start", "left_semi").dropDuplicates(["event_id"])
        return unique.groupBy("start", "event_type").agg(F.count("*").alias("n"))
