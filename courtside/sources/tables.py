"""Parquet tables of a data folder, and versioned table writes."""

from __future__ import annotations

import time
import uuid

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.operators.incremental import upsert
from courtside.session import materialize, shuffles_dropped, small_tasks

FILE_BYTES = 64 << 20  # of shuffled rows for one task of a bucketed table, whose files are a share of it


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``{root}/{name}.parquet``; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


class VersionedTable:
    """A table stored as immutable version folders plus numbered marker files.

    ``write`` puts a complete new version next to the old ones, then creates the
    marker ``_versions/{number}.{version}`` with the next number; the highest
    number is current. A marker is an empty file made by create-if-absent: nothing
    is ever deleted or renamed, so a stop at any moment leaves the previous
    version current and readers undisturbed, and of two writers that take the
    same number the higher name wins for every reader alike.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.base = f"{root.rstrip('/')}/{name}"

    def _markers(self) -> list[tuple[int, str]]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/_versions")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
        return sorted((int(n), v) for n, _, v in (x.partition(".") for x in names) if n.isdigit() and v)

    def current_path(self) -> str | None:
        markers = self._markers()
        return f"{self.base}/{markers[-1][1]}" if markers else None

    def exists(self) -> bool:
        return self.current_path() is not None

    def number(self) -> int:
        """The number of the current version, 0 before the first."""
        markers = self._markers()
        return markers[-1][0] if markers else 0

    def read(self) -> DataFrame | None:
        path = self.current_path()
        return self.spark.read.parquet(path) if path else None

    def write(self, df: DataFrame, partition_by: list[str] | None = None) -> str:
        version = f"v={int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
        path = f"{self.base}/{version}"
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        self._publish(self.number() + 1, version)
        return path

    def _publish(self, number: int, version: str) -> None:
        marker = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/_versions/{number:09d}.{version}")
        marker.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(marker, False).close()


class BucketedTable:
    """One row per key, in folders by a hash of the key (I3): an upsert reads and rewrites the folders of its batch only.

    The bucket numbers of a batch (at most ``buckets``) become a partition filter on the table, and those folders are
    replaced. The new content of the folders is first written aside as a whole:
    a run that stops while folders are replaced is finished by the next one, so no row is lost and the watermark of
    the table never runs ahead of its rows. Choose ``buckets`` so that one fits a task; ``bucket_by`` (part of the key) keeps
    rows that change together in one folder.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, keys: Sequence[str], buckets: int = 64,
                 bucket_by: Sequence[str] | None = None):
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.bucket_by = list(bucket_by or keys)
        self.path, self.aside = (f"{root.rstrip('/')}/{name}/{part}" for part in ("data", "aside"))

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _has(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def exists(self) -> bool:
        return self._has(self.path)

    def read(self) -> DataFrame | None:
        self._replace()
        return self.spark.read.parquet(self.path).drop("key_bucket") if self.exists() else None

    def upsert(self, batch: DataFrame) -> list[int]:
        """Rows of ``batch`` (one per key) replace those with the same key or are added; returns the buckets written."""
        self._replace()
        bucket = F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")
        merged = batch.withColumn("key_bucket", bucket)  # the first rows are written where they lie, each task to all folders
        if self.exists():
            batch = materialize(merged)
            touched = [r[0] for r in batch.select("key_bucket").distinct().collect()]
            if not touched:
                return []
            target = self.spark.read.parquet(self.path).where(F.col("key_bucket").isin(touched))
            # Rebalanced: a bucket is written by as many tasks as its bytes ask for.
            merged = upsert(target, batch, [*self.keys, "key_bucket"]).hint("rebalance", "key_bucket")
        with shuffles_dropped(self.spark), small_tasks(merged, FILE_BYTES):
            merged.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("key_bucket").parquet(self.aside)
        written = sorted(int(p.getName().removeprefix("key_bucket=")) for p in self._folders(self.aside))
        self._replace()
        return written

    def _folders(self, path: str) -> list:
        fs, p = self._fs(path)
        return [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and s.getPath().getName().startswith("key_bucket=")]

    def _replace(self) -> None:
        """Move the folders written aside to their place; a no-op unless they are complete.

        A folder leaves the place aside only as it arrives, so that what a stop leaves undone is done by the next call.
        """
        if self._has(f"{self.aside}/_SUCCESS"):
            fs, aside = self._fs(self.aside)
            for folder in self._folders(self.aside):
                _, place = self._fs(f"{self.path}/{folder.getName()}")
                fs.mkdirs(place.getParent())
                fs.delete(place, True)
                if not fs.rename(folder, place):
                    raise OSError(f"{folder} could not be moved to {place}")
            fs.delete(aside, True)


class HistoryTable(VersionedTable):
    """Versions in two parts (D2-D4): the open ones, rewritten by each step, and the closed ones, only ever added to.

    Step n writes, in one job, all open versions and those it closes to ``rows/step=n``, and is then made current.
    Readers take the open versions of the current step and the closed ones of all steps up to it, so a
    stop in between changes nothing, and a repeated step replaces what the stopped one had written.
    """

    def _rows(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.base}/rows").parquet(f"{self.base}/rows")

    def read_open(self) -> DataFrame | None:
        n = self.number()
        return self._rows().where((F.col("step") == n) & F.col("is_open")).drop("step", "is_open") if n else None

    def read(self) -> DataFrame | None:
        n = self.number()
        if not n:
            return None
        return self._rows().where((F.col("step") == n) | ((F.col("step") < n) & ~F.col("is_open"))).drop("step", "is_open")

    def write_step(self, rows: DataFrame) -> None:
        """``rows``: a check step's result over the open versions, open and newly closed ones."""
        n = self.number() + 1
        path = f"{self.base}/rows/step={n}"
        out = rows.withColumn("is_open", F.col("valid_to").isNull()).write.mode("overwrite")
        out.option("partitionOverwriteMode", "static").partitionBy("is_open").parquet(path)
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        parts = p.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(p)
        if any(s.isDirectory() for s in parts):  # without any version there is no step
            self._publish(n, f"step={n}")
