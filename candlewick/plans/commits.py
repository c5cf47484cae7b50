"""The live files of a layer table: numbered commits, one small file each.

A table is a folder with ``data/commit=<id>/...`` (Parquet files, a folder for
each write) and ``log/<number>.json``.  A commit adds files, removes files, or
both, and exists as soon as its log file does: that file is written aside and
renamed to the next free number, which fails if another writer has taken it.  So
batch writers, streams, compaction and retention share one history, readers see
the files of whole commits only, and a write that stops early leaves files that
nobody reads.

Each added file carries its layout values, row count, time range and key range.
Watermarks, pruning and the choice of files that need de-duplication come from
these; no data file is opened for them.  After every ``SNAPSHOT_EVERY`` commits the
live entries are written as one Parquet table, and reads start from the newest one.

The shared file system must rename atomically and refuse an existing target
(HDFS and local disks do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT_EVERY = 50
ENTRIES = (
    "seq long, action string, path string, parts map<string,string>, n_rows long, "
    "first_time timestamp, last_time timestamp, low string, high string, commit string, rewrite boolean"
)


class CommitConflict(RuntimeError):
    """Another commit has removed files that this one wanted to replace."""


class Log:
    """The commits of one table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    # ---------------------------------------------------------------- files

    def path(self, *parts: str) -> str:
        return "/".join([self.table, *parts])

    def _hadoop(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self):
        return self._hadoop(self.table).getFileSystem(self._conf)

    def exists(self) -> bool:
        return self._fs().exists(self._hadoop(self.path("log")))

    def create(self) -> None:
        self._fs().mkdirs(self._hadoop(self.path("log")))
        self._fs().mkdirs(self._hadoop(self.path("data")))

    def _numbers(self, folder: str) -> list[int]:
        place = self._hadoop(self.path(folder))
        if not self._fs().exists(place):
            return []
        names = [s.getPath().getName().removesuffix(".json") for s in self._fs().listStatus(place)]
        return sorted(int(n) for n in names if n.isdigit())

    def newest(self) -> int:
        """The number of the newest commit, 0 without any."""
        return max(self._numbers("log"), default=0)

    def _put(self, number: int, text: str) -> bool:
        """Write a log file aside and rename it to its number; False if the number is taken."""
        aside, target = self._hadoop(self.path("log", f".{uuid.uuid4().hex}")), self._hadoop(self.path("log", f"{number:020d}.json"))
        out = self._fs().create(aside, False)
        out.write(text.encode())
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(aside.getFileSystem(self._conf).getUri(), self._conf)
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(aside, target, options)
        except Exception:
            self._fs().delete(aside, False)
            if self._fs().exists(target):
                return False
            raise
        return True

    # ---------------------------------------------------------------- reading

    def entries(self, after: int | None = None) -> DataFrame:
        """All entries of the commits after a number; without it, of the newest snapshot and the commits after it."""
        read, frames = self.spark.read.schema(ENTRIES), []
        if after is None:
            whole = [n for n in self._numbers("snapshots") if self._fs().exists(self._hadoop(self.path("snapshots", f"{n:020d}", "_SUCCESS")))]
            after = max(whole, default=0)
            if after:
                frames.append(read.parquet(self.path("snapshots", f"{after:020d}")))
        tail = [self.path("log", f"{n:020d}.json") for n in self._numbers("log") if n > after]
        if tail:
            frames.append(read.json(tail))
        return reduce(DataFrame.unionByName, frames) if frames else self.spark.createDataFrame([], ENTRIES)

    def live(self) -> DataFrame:
        """The entries of the files that the newest state of the table holds, and those of tags."""
        entries = self.entries()
        gone = entries.where(F.col("action") == "remove").select(F.col("path").alias("__gone"))
        return entries.where(F.col("action") != "remove").join(gone, F.col("path") == F.col("__gone"), "left_anti")

    def files(self) -> DataFrame:
        return self.live().where(F.col("action") == "add")

    def tagged(self, tag: str) -> bool:
        return not self.entries().where((F.col("action") == "tag") & (F.col("path") == tag)).isEmpty()

    # ---------------------------------------------------------------- writing

    def commit(self, added: Iterable[dict] = (), removed: Iterable[str] = (), tag: str | None = None, seen: int | None = None) -> int | None:
        """Add and remove files at once; returns the commit's number, or None if ``tag`` was committed before.

        ``seen`` is the newest commit that the choice of ``removed`` rests on: if a
        later one removed any of them too, nothing is committed.
        """
        added, removed = list(added), list(removed)
        name = uuid.uuid4().hex
        while True:
            newest = self.newest()
            if tag is not None and self.tagged(tag):
                return None
            if removed and seen is not None and newest > seen:
                taken = self.entries(after=seen).where((F.col("action") == "remove") & F.col("path").isin(removed))
                if not taken.isEmpty():
                    raise CommitConflict(f"files of {self.table} were replaced by another commit after number {seen}")
            number = newest + 1
            lines = [{"seq": number, "action": "add", "commit": name, **e} for e in added]
            lines += [{"seq": number, "action": "remove", "path": p, "commit": name} for p in removed]
            lines += [{"seq": number, "action": "tag", "path": tag, "commit": name}] if tag is not None else []
            if self._put(number, "".join(json.dumps(x) + "\n" for x in lines)):
                break
        if number % SNAPSHOT_EVERY == 0:
            self.live().where(F.col("seq") <= number).coalesce(1).write.mode("overwrite").parquet(self.path("snapshots", f"{number:020d}"))
        return number


def stamp(value) -> str | None:
    return None if value is None else value.strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def overlapping(files: DataFrame) -> DataFrame:
    """``files`` with ``mixed``: whether a key of the file may also be in a file of another commit.

    Files of one commit hold different keys; files of two commits can share one only in
    the same partition, where both their time ranges and their key ranges meet.
    """
    rows = files.withColumn("__parts", F.to_json("parts"))
    other = rows.select(
        F.col("__parts").alias("__p"), F.col("commit").alias("__c"), F.col("first_time").alias("__f"), F.col("last_time").alias("__l"), F.col("low").alias("__low"), F.col("high").alias("__high")
    ).distinct()
    meets = (
        (F.col("__parts").eqNullSafe(F.col("__p")))
        & (F.col("commit") != F.col("__c"))
        & (F.col("first_time") <= F.col("__l"))
        & (F.col("__f") <= F.col("last_time"))
        & (F.col("low") <= F.col("__high"))
        & (F.col("__low") <= F.col("high"))
    )
    mixed = rows.join(other, meets, "left_semi").select(F.col("path").alias("__mixed"))
    return rows.join(mixed, F.col("path") == F.col("__mixed"), "left").withColumn("mixed", F.col("__mixed").isNotNull()).drop("__parts", "__mixed")
