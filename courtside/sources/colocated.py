"""Tables stored side by side on a common key, joined and windowed without a shuffle.

Each table is written once as a bucketed, sorted table of Spark's catalog. A bucket is one task's work and adaptive
execution does not split it, so keys that would overfill one are kept apart, in a plain table that is joined the
ordinary way, where adaptive execution splits skewed keys. A key lies wholly in one of the two parts in every table.
"""

from __future__ import annotations

import uuid

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def heavy_keys(df: DataFrame, keys: Sequence[str], parts: int) -> DataFrame:
    """Keys with over 1/``parts`` of all rows (under ``parts`` of them), NULL being a key like any other."""
    total = df.select((F.count(F.lit(1)) / F.lit(parts)).alias("share")).scalar()
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > total).select(*keys)


class CoLocated:
    """Tables bucketed alike by ``keys``; read back by any number of joins and windows on these keys.

    Choose ``buckets`` so that one fits a task at the size of the largest table. ``folder`` is a shared folder.
    Empty tables and tables without heavy keys give an empty heavy part. A light key holds at most 1/``buckets`` of a
    table's rows, so a bucket stays within a few even shares.
    """

    def __init__(self, spark: SparkSession, folder: str, tables: dict[str, DataFrame], keys: Sequence[str], buckets: int):
        self.spark, self.keys, self.buckets = spark, list(keys), buckets
        self.folder, self.tag = folder.rstrip("/"), uuid.uuid4().hex
        path = f"{self.folder}/heavy-keys"
        heavy = reduce(DataFrame.unionByName, [heavy_keys(t, self.keys, buckets) for t in tables.values()]).distinct()
        heavy.write.mode("errorifexists").parquet(path)
        # at most tables * buckets rows, as heavy_keys says
        self.heavy = F.broadcast(spark.read.schema(heavy.schema).parquet(path))
        for name, df in tables.items():
            self._write(name, df)

    def _name(self, table: str) -> str:
        return f"colocated_{table}_{self.tag}"

    def _write(self, table: str, df: DataFrame) -> None:
        on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(self.heavy[k]) for k in self.keys])
        light, heavy = (df.join(self.heavy, on, how) for how in ("left_anti", "left_semi"))
        (light.repartition(self.buckets, *self.keys)  # Spark's bucket of a key is its partition: one file a bucket
              .write.mode("errorifexists").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
              .option("path", f"{self.folder}/{table}/light").format("parquet").saveAsTable(self._name(table)))
        heavy.write.mode("errorifexists").parquet(f"{self.folder}/{table}/heavy")

    def light(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def heavy_part(self, table: str) -> DataFrame:
        return self.spark.read.schema(self.light(table).schema).parquet(f"{self.folder}/{table}/heavy")

    def per_key(self, fn: Callable[..., DataFrame], *tables: str) -> DataFrame:
        """``fn`` of the tables' light parts and of their heavy parts, for any work that stays within a key."""
        return fn(*map(self.light, tables)).unionByName(fn(*map(self.heavy_part, tables)))

    def join(self, left: str, right: str, how: str = "left") -> DataFrame:
        return self.per_key(lambda a, b: a.join(b, on=self.keys, how=how), left, right)
