"""Incremental loading (I1-I5): high-watermark selection and upsert by key.

These are pure DataFrame operators; ``courtside.sources.tables`` persists the
result as a new table version (no MERGE exists for plain parquet).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.operators.dedup import latest_per_key

WATERMARK_FLOOR = "1900-01-01"


def watermark(target: DataFrame, loaded_col: str, floor: str = WATERMARK_FLOOR) -> Column:
    """COALESCE(MAX(loaded_col), floor) as a scalar subquery column."""
    return target.select(F.coalesce(F.max(F.col(loaded_col)), F.lit(floor).cast("timestamp_ntz"))).scalar()


def watermark_value(target: DataFrame, loaded_col: str, floor: str = WATERMARK_FLOOR) -> Column:
    """The watermark read now, as a literal: a filter on it skips files, and loads that it rules out are not planned."""
    mark = target.agg(F.coalesce(F.max(F.col(loaded_col)), F.lit(floor).cast("timestamp_ntz")).alias("w"))
    return F.lit(mark.select(F.col("w").cast("string")).first()[0]).cast(mark.schema["w"].dataType)


def new_rows(raw: DataFrame, target: DataFrame | None, inserted_col: str = "inserted_at",
             loaded_col: str = "loaded_at_utc", floor: str = WATERMARK_FLOOR) -> DataFrame:
    """Everything on the first run, later only rows strictly newer
    than the target's newest load time (a row with an equal or older load time
    arriving later is not picked up, as in the reference)."""
    if target is None:
        return raw
    return raw.filter(F.col(inserted_col) > watermark_value(target, loaded_col, floor))


def dedup_batch(batch: DataFrame, key_cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """I4: one row per key inside a batch (newest first under ``order``)."""
    return latest_per_key(batch, key_cols, order)


def upsert(target: DataFrame | None, batch: DataFrame, key_cols: Sequence[str],
           order: Sequence[Column] | None = None, deal: Sequence[str] = ()) -> DataFrame:
    """Rows of ``batch`` replace target rows with the same key; new keys are
    inserted; other target rows stay. NULL keys never match (as in MERGE).

    Re-applying the same batch gives the same table (idempotent), so a replayed
    micro-batch is harmless. A small batch is broadcast. For a batch that is large or costly to derive give an
    ``order``: both frames are then derived and shuffled once, by key, and sorted by key and ``order``, so
    that a ``latest_per_key`` under the same order needs neither again. ``deal`` names columns, made from the key
    alone, to shuffle by instead of the whole key: rows that a later join brings together then lie together already.
    """
    if target is None:
        return batch
    keys = list(key_cols)
    if order is not None:
        both = target.withColumn("__new", F.lit(False)).unionByName(batch.select(*target.columns).withColumn("__new", F.lit(True)))
        both = both.repartition(*deal) if deal else both
        whole_key = Window.partitionBy(*deal, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        keyless = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        both = both.withColumn("__replaced", F.max("__new").over(whole_key))
        return both.where(F.col("__new") | ~F.col("__replaced") | keyless).drop("__new", "__replaced")
    kept = target.join(batch.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(batch.select(*target.columns))


KEY_BITS = 27  # 16 MB of bits at most
PAGE_BITS = 15  # fixed value: a bitmap of Spark has 4 KB


def upsert_stored(target: DataFrame, batch: DataFrame, key_cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """I3 for stored frames that are too large to shuffle whole: ``upsert``, but target rows that no key of the batch can have stay where they lie.

    The keys of the batch set bits of a table of fixed size, which is broadcast; a row whose bit is not set is not replaced, the
    others (and few more, as keys share bits) are settled by ``upsert``. Both frames are read twice.
    """
    place = F.pmod(F.xxhash64(*key_cols), F.lit(1 << KEY_BITS))
    page, bit = F.shiftright(place, PAGE_BITS), place.bitwiseAND(F.lit((1 << PAGE_BITS) - 1))
    pages = batch.groupBy(page.alias("__page")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    seen = F.coalesce(F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1, F.lit(False))
    marked = target.join(F.broadcast(pages), page == F.col("__page"), "left").select(*target.columns, seen.alias("__seen"))
    return marked.where(~F.col("__seen")).drop("__seen").unionByName(
        upsert(marked.where("__seen").drop("__seen"), batch, key_cols, order))
