"""Tables in versions: each version is a list of parts, and readers see one version whatever is written.

A part is a folder of files that never change. A version is a small file that names the folder of every part;
it comes into being by one rename, which fails if another writer has made that version meanwhile. So a
refresh that touches a few parts writes those alone, all others keep their files, and a reader that has begun
with a version goes on with its files until ``vacuum`` lets go of it. The lists of parts pass through the
driver; tables are cut into days or hash buckets, so that these are some thousands at most.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"


class Conflict(RuntimeError):
    """Another writer has committed on top of the same version."""


@dataclass(frozen=True)
class Version:
    number: int
    parts: dict[str, str]
    batch: int | None  # the last change batch that went in

    def named(self, prefix: str) -> list[str]:
        return [p for p in self.parts if p.startswith(prefix)]


EMPTY = Version(0, {}, None)


@dataclass(frozen=True)
class VersionedTable:
    root: str

    def _fs(self, spark: SparkSession):
        hadoop = spark._jvm.org.apache.hadoop.fs
        path = hadoop.Path(f"{self.root}/versions")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path

    def _numbers(self, spark: SparkSession) -> list[int]:
        fs, path = self._fs(spark)
        folder = path(f"{self.root}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def version(self, spark: SparkSession, number: int | None = None) -> Version:
        """The latest version, or the one with that number."""
        if number is None:
            numbers = self._numbers(spark)
            if not numbers:
                return EMPTY
            number = numbers[-1]
        text = spark.read.text(f"{self.root}/versions/{number:010d}.json", wholetext=True).first()[0]
        held = json.loads(text)
        return Version(number, held["parts"], held["batch"])

    def read(self, spark: SparkSession, schema: str, parts: list[str], at: Version) -> DataFrame:
        """The rows of these parts; a part that the version does not have is empty."""
        folders = [at.parts[p] for p in parts if p in at.parts]
        return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)

    def stage(self, rows: DataFrame, part) -> dict[str, str]:
        """Write rows to fresh folders by the text column expression ``part``; which parts got rows, and where."""
        spark = rows.sparkSession
        folder = f"{self.root}/files/{uuid.uuid4().hex}"
        marked = rows.withColumn(PART, part)
        marked.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)
        fs, path = self._fs(spark)
        found = [s.getPath().getName() for s in fs.listStatus(path(folder)) if s.isDirectory()]
        return {n.removeprefix(f"{PART}="): f"{folder}/{n}" for n in found if n.startswith(f"{PART}=")}

    def commit(self, spark: SparkSession, base: Version, changed: dict[str, str | None], batch: int | None = None) -> Version:
        """The version after ``base``: parts changed to new folders, or gone where the folder is None."""
        parts = {p: f for p, f in {**base.parts, **changed}.items() if f is not None}
        made = Version(base.number + 1, parts, base.batch if batch is None else batch)
        fs, path = self._fs(spark)
        target = path(f"{self.root}/versions/{made.number:010d}.json")
        draft = path(f"{self.root}/versions/.{uuid.uuid4().hex}")
        out = fs.create(draft)
        out.write(bytearray(json.dumps({"parts": parts, "batch": made.batch}).encode()))
        out.close()
        if fs.exists(target) or not fs.rename(draft, target):
            fs.delete(draft, False)
            raise Conflict(f"version {made.number} of {self.root} exists already")
        return made

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Forget all but the last ``keep`` versions and delete folders that none of those names; how many."""
        numbers = self._numbers(spark)
        fs, path = self._fs(spark)
        live = {f for n in numbers[-keep:] for f in self.version(spark, n).parts.values()}
        for n in numbers[:-keep]:
            fs.delete(path(f"{self.root}/versions/{n:010d}.json"), False)
        gone = 0
        root = path(f"{self.root}/files")
        for lot in fs.listStatus(root) if fs.exists(root) else []:
            name = f"{self.root}/files/{lot.getPath().getName()}"
            for part in fs.listStatus(lot.getPath()):
                folder = f"{name}/{part.getPath().getName()}"
                if part.isDirectory() and folder not in live:
                    fs.delete(part.getPath(), True)
                    gone += 1
        return gone


def touched(rows: DataFrame, part) -> list[str]:
    """The parts that rows belong to: a few thousand at most."""
    return [r[0] for r in rows.select(part.alias(PART)).distinct().collect()]


def bucket(key: str, n: int, prefix: str = ""):
    """A hash bucket of the key, as the name of a part."""
    return F.concat(F.lit(prefix), F.pmod(F.xxhash64(key), F.lit(n)).cast("string"))
