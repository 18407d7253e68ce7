"""A log of scores that readers see as each person's newest row.

Every batch is a run of its own. When a level has ``FAN`` runs they are merged into one run of the next level, which
keeps each person's newest row, so a reader meets at most a few runs a level and not every batch there
ever was. Which runs count is said by a manifest: a small file with a number, written under another name and then renamed,
so a reader sees the runs before a change or those after it. Whatever a crash leaves behind is in no manifest, and is
written over when the batch is tried again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.sources.schemas import KEY

# Runs of a level that are merged.
FAN = 8


@dataclass(frozen=True)
class Run:
    """Rows of the epochs up to ``epoch``, in a folder of its own."""

    folder: str
    level: int
    epoch: int


class ScoreLog:
    """Runs and manifests below one folder. One writer at a time; readers need no lock."""

    def __init__(self, spark: SparkSession, path: str, fan: int = FAN):
        self._spark, self._path, self._fan = spark, path.rstrip("/"), fan
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _versions(self) -> list[int]:
        place = self._hadoop.Path(f"{self._path}/manifests")
        if not self._files.exists(place):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(place)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def runs(self) -> list[Run]:
        """The runs that count now."""
        versions = self._versions()
        if not versions:
            return []
        # A manifest names a few runs per level.
        text = self._spark.read.text(f"{self._path}/manifests/{versions[-1]}.json", wholetext=True).first()[0]
        return [Run(**r) for r in json.loads(text)]

    def _switch(self, runs: list[Run]) -> None:
        """Make ``runs`` those that count."""
        version = (self._versions() or [0])[-1] + 1
        hidden = self._hadoop.Path(f"{self._path}/manifests/.{uuid.uuid4().hex}")
        out = self._files.create(hidden, False)
        out.write(json.dumps([vars(r) for r in runs]).encode())
        out.close()
        if not self._files.rename(hidden, self._hadoop.Path(f"{self._path}/manifests/{version}.json")):
            raise RuntimeError(f"manifest {version} is there already: the log has another writer")

    def _rows(self, runs: list[Run]) -> DataFrame:
        return self._spark.read.parquet(*[f"{self._path}/runs/{r.folder}" for r in runs])

    @staticmethod
    def _newest(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c != KEY]
        return rows.groupBy(KEY).agg(F.max_by(F.struct(*others), "epoch").alias("row")).select(KEY, "row.*")

    def append(self, rows: DataFrame, epoch: int) -> None:
        """Log one batch, one row per person. An epoch that counts already isn't logged again."""
        runs = self.runs()
        if any(r.epoch >= epoch for r in runs):
            return
        run = Run(f"epoch-{epoch}", 0, epoch)
        rows.withColumn("epoch", F.lit(epoch).cast("long")).write.mode("overwrite").parquet(f"{self._path}/runs/{run.folder}")
        self._switch([*runs, run])
        self._compact()

    def _compact(self) -> None:
        runs = self.runs()
        level = 0
        while len(own := [r for r in runs if r.level == level]) >= self._fan:
            merged = Run(f"level-{level + 1}-to-{own[-1].epoch}", level + 1, own[-1].epoch)
            self._newest(self._rows(own)).write.mode("overwrite").parquet(f"{self._path}/runs/{merged.folder}")
            runs = sorted([*(r for r in runs if r not in own), merged], key=lambda r: r.epoch)
            self._switch(runs)
            level += 1

    def entries(self) -> DataFrame | None:
        """The rows of all runs that count; None before the first batch."""
        runs = self.runs()
        return self._rows(runs) if runs else None

    def latest(self) -> DataFrame:
        """Each person's newest row."""
        rows = self.entries()
        if rows is None:
            raise FileNotFoundError(f"nothing is logged below {self._path}")
        return self._newest(rows).drop("epoch")

    def forget(self) -> None:
        """Delete runs and manifests that no longer count; readers that opened them before can't go on."""
        runs, versions = {r.folder for r in self.runs()}, self._versions()
        place = self._hadoop.Path(f"{self._path}/runs")
        for status in self._files.listStatus(place) if self._files.exists(place) else []:
            if status.getPath().getName() not in runs:
                self._files.delete(status.getPath(), True)
        for version in versions[:-1]:
            self._files.delete(self._hadoop.Path(f"{self._path}/manifests/{version}.json"), False)
