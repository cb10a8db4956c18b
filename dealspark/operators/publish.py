"""All-or-nothing publishing of windows: staged, measured while written, checked, then committed by one file.

A publication is written to a folder of its own. Metrics are observed in the same pass. If a condition on them fails, nothing
that readers see has changed. The commit is one small file, renamed into place under the next number; a rename onto a number that
is taken fails, so of two writers one has to start again. Readers take, for each window, the folder that the last commit names, so a
window is replaced as a whole and the others stay.

Defined cases: a publication without rows fails unless ``allow_empty``; a null window is refused; publishing under the name of a run
that was committed before does nothing; a writer that is lost before its commit leaves a folder that nobody reads.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class PublishError(ValueError):
    """A condition that failed; readers still see what was published before."""


class WindowTable:
    """Windows of one table in a shared folder."""

    def __init__(self, spark: SparkSession, base: str, window: str = "window"):
        self.spark, self.base, self.window = spark, base, window
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def _commits(self) -> list[dict]:
        """What each commit says, oldest first: one line for each publication."""
        found = self._fs.globStatus(self._path(f"{self.base}/commits/*.json")) or []
        paths = sorted(x.getPath().toString() for x in found)
        if not paths:
            return []
        lines = self.spark.read.text(paths, wholetext=True).select(F.input_file_name().alias("file"), "value").orderBy("file").collect()
        return [json.loads(r["value"]) for r in lines]

    def _commit(self, number: int, entry: dict) -> None:
        draft, place = self._path(f"{self.base}/drafts/{entry['run']}.json"), self._path(f"{self.base}/commits/{number:09d}.json")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(json.dumps(entry).encode()))
        finally:
            out.close()
        self._fs.mkdirs(place.getParent())
        if self._fs.exists(place) or not self._fs.rename(draft, place):
            raise PublishError(f"another writer has committed number {number}")

    def publish(self, run: str, rows: DataFrame, metrics: Mapping[str, Column], conditions: Mapping[str, Callable[[dict], bool]], unique: list[str] | None = None, allow_empty: bool = False) -> dict:
        """Publish the windows that ``rows`` holds and return the metrics; raises PublishError if a condition isn't met.

        ``metrics`` are aggregates over the rows, ``conditions`` are named tests of them. ``unique`` names columns that together
        may occur once in a window.
        """
        before = self._commits()
        for entry in before:
            if entry["run"] == run:
                return entry["metrics"]
        folder = f"{self.base}/data/{run}"
        seen = Observation(f"publish-{run}")
        own = {"rows": F.count("*"), "without_window": F.count_if(F.col(self.window).isNull()), **metrics}
        rows.observe(seen, *[c.alias(k) for k, c in own.items()]).write.mode("overwrite").parquet(folder)
        values = {k: v if isinstance(v, (int, float, str, bool, type(None))) else str(v) for k, v in seen.get.items()}
        broken = [name for name, holds in conditions.items() if not holds(values)]
        if values["without_window"]:
            broken.append("a row without a window")
        if not values["rows"] and not allow_empty:
            broken.append("no rows")
        staged = self.spark.read.schema(rows.schema).parquet(folder)
        if unique and not staged.groupBy(self.window, *unique).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            broken.append("repeated rows")
        if broken:
            self._fs.delete(self._path(folder), True)
            raise PublishError("not published: " + ", ".join(broken))
        windows = [str(r[0]) for r in staged.select(F.col(self.window).cast("string")).distinct().orderBy(self.window).collect()]  # windows of one publication
        self._commit(len(before) + 1, {"run": run, "windows": windows, "metrics": values, "schema": rows.schema.json()})
        return values

    def read(self) -> DataFrame:
        """All windows as last published."""
        from pyspark.sql.types import StructType

        commits = self._commits()
        if not commits:
            raise PublishError("nothing is published")
        last = {w: entry["run"] for entry in commits for w in entry["windows"]}
        schema = StructType.fromJson(json.loads(commits[-1]["schema"]))
        runs: dict[str, list[str]] = {}
        for w, run in last.items():
            runs.setdefault(run, []).append(w)
        out = self.spark.createDataFrame([], schema)
        for run, windows in runs.items():  # one for each publication that is still in force
            out = out.unionByName(self.spark.read.schema(schema).parquet(f"{self.base}/data/{run}").where(F.col(self.window).cast("string").isin(windows)))
        return out

    def history(self) -> DataFrame:
        """run, window and number of every publication."""
        rows = [(entry["run"], w, k) for k, entry in enumerate(self._commits(), 1) for w in entry["windows"]]
        return self.spark.createDataFrame(rows, "run string, window string, number int")
