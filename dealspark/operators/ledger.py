"""Resumable work: an append-only ledger of attempts and outputs, so that only open work is done again.

A run deals the open candidates to batches by a hash of their key. Each batch's results are one folder, written under a name that
the batch alone decides, so that a batch that is written again replaces itself; a folder without its success mark doesn't
count. The ledger is the table of those folders. A run that stops anywhere is continued by calling it again.

Defined cases: candidates with a null key are refused; repeated candidates are one; a key that was accepted is never tried again, one that
failed is until it has had ``most_attempts``; of several accepted rows of a key the first by run and batch counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealspark.session import ensure_checkpoint_dir

ACCEPTED, FAILED = "accepted", "failed"


class Ledger:
    """Attempts of one piece of work in a shared folder; ``schema`` has the key, status and any outputs."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "key"):
        self.spark, self.path, self.key = spark, path, key
        self.schema = T.StructType.fromDDL(schema)
        if key not in self.schema.fieldNames() or "status" not in self.schema.fieldNames():
            raise ValueError(f"a ledger needs the columns {key} and status")
        self._fs_path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _runs(self) -> list[str]:
        """Folders of finished batches, in order: a few for each run."""
        found = self._fs.globStatus(self._fs_path(f"{self.path}/run=*/batch=*/_SUCCESS")) or []
        return sorted(str(x.getPath().getParent().toString()) for x in found)

    def attempts(self) -> DataFrame:
        """Every recorded attempt, with its run and batch."""
        paths = self._runs()
        own = T.StructType(list(self.schema.fields))
        if not paths:
            return self.spark.createDataFrame([], own).withColumns({"run": F.lit(0), "batch": F.lit(0)})
        read = self.spark.read.schema(own).parquet(*paths).withColumn("file", F.input_file_name())
        number = lambda name: F.regexp_extract("file", rf"/{name}=([0-9]+)/", 1).cast("int")
        return read.withColumns({"run": number("run"), "batch": number("batch")}).drop("file")

    def outputs(self) -> DataFrame:
        """The first accepted attempt of each key."""
        first = Window.partitionBy(self.key).orderBy("run", "batch")
        return self.attempts().where(F.col("status") == ACCEPTED).withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")

    def open_work(self, candidates: DataFrame, most_attempts: int = 3) -> DataFrame:
        """The candidates that were neither accepted nor tried too often."""
        seen = self.attempts().groupBy(self.key).agg(F.count("*").alias("tries"), F.max((F.col("status") == ACCEPTED).cast("int")).alias("done"))
        settled = seen.where((F.col("done") == 1) | (F.col("tries") >= most_attempts)).select(self.key)
        return candidates.join(settled, self.key, "left_anti")

    def run(self, candidates: DataFrame, work: Callable[[DataFrame], DataFrame], batch_rows: int = 5_000_000, most_attempts: int = 3) -> DataFrame:
        """Do all open work, batch by batch, and return the outputs. ``work`` maps a batch to rows of the ledger's schema, one for each candidate."""
        if not candidates.where(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"a candidate without {self.key}")
        unique = candidates.dropDuplicates([self.key])
        number = max((int(p.split("/run=")[1].split("/")[0]) for p in self._runs()), default=0) + 1
        todo = self.open_work(unique, most_attempts)
        batches = -(-todo.count() // batch_rows)
        if batches:
            # fixed while the run goes on, so that its own batches don't change what is open
            mark = f"{self.path}/open/run={number}"
            todo.withColumn("batch_of", F.pmod(F.xxhash64(self.key), F.lit(batches))).write.mode("overwrite").partitionBy("batch_of").parquet(mark)
            fixed = self.spark.read.parquet(mark)
            for batch in range(batches):
                done = work(fixed.where(F.col("batch_of") == batch).drop("batch_of")).select(*self.schema.fieldNames())
                done.write.mode("overwrite").parquet(f"{self.path}/run={number:06d}/batch={batch:06d}")
            self._fs.delete(self._fs_path(mark), True)
        return self.outputs()


def restored(rows: DataFrame, identity: Column, output: Column, gates: Sequence[tuple[str, Column]], requested: int, scope: str) -> DataFrame:
    """Earlier outputs, all or none: the rows if every condition holds, else ValueError with the conditions that don't.

    Conditions: at least one and at most ``requested`` rows, distinct identities, distinct outputs that lie inside ``scope``, and every gate true in every row.
    One pass of counts decides.
    """
    shown = rows.select(identity.alias("identity"), output.alias("output"), *[F.coalesce(passes, F.lit(False)).alias(f"gate_{i}") for i, (_, passes) in enumerate(gates)])
    inside = F.coalesce(F.startswith("output", F.lit(scope.rstrip("/") + "/")) & ~F.rlike("output", F.lit(r"(^|/)\.\.(/|$)")), F.lit(False))
    counts = [F.count("*").alias("n"), F.count_distinct("identity").alias("identities"), F.count_distinct("output").alias("outputs"), F.count_if(~inside).alias("outside")]
    seen = shown.agg(*counts, *[F.count_if(~F.col(f"gate_{i}")).alias(f"gate_{i}") for i in range(len(gates))]).first()
    broken = [name for name, holds in (("no rows", seen["n"] > 0), ("more rows than requested", seen["n"] <= requested), ("repeated or missing identity", seen["identities"] == seen["n"]), ("repeated or missing output", seen["outputs"] == seen["n"]), ("output out of scope", seen["outside"] == 0)) if not holds]
    broken += [name for i, (name, _) in enumerate(gates) if seen[f"gate_{i}"]]
    if broken:
        raise ValueError("earlier outputs cannot be restored: " + ", ".join(broken))
    return rows


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A fresh folder in the shared checkpoint folder."""
    import uuid

    return f"{ensure_checkpoint_dir(spark)}/{kind}/{uuid.uuid4().hex}"
