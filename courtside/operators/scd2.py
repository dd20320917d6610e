"""Attribute history as type-2 versions, check strategy.

Version columns: ``valid_from``, ``valid_to`` (NULL = open), ``version_id`` =
surrogate_key(key, updated_at) and ``version_updated_at``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.keys import surrogate_key
from courtside.operators.dedup import latest_per_key
from courtside.session import materialize

VERSION_COLS = ("valid_from", "valid_to", "version_id", "version_updated_at")


def _any_differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """True when any pair differs, NULL-safely."""
    out = F.lit(False)
    for left, right in pairs:
        out = out | ~left.eqNullSafe(right)
    return out


def _updated_at(updated_at_col: str | None, now: Column | None) -> Column:
    if updated_at_col:
        return F.col(updated_at_col)
    if now is None:
        raise ValueError("a snapshot without updated_at needs the run time `now`")
    return now


def initial_snapshot(batch: DataFrame, key: str, updated_at_col: str | None = None,
                     now: Column | None = None) -> DataFrame:
    """Every row becomes an open version."""
    ts = _updated_at(updated_at_col, now).cast("timestamp_ntz")
    return (batch.withColumn("version_updated_at", ts)
                 .withColumn("valid_from", ts)
                 .withColumn("valid_to", F.lit(None).cast("timestamp_ntz"))
                 .withColumn("version_id", surrogate_key(F.col(key), ts)))


def snapshot_check(snapshot: DataFrame | None, batch: DataFrame, key: str, check_cols: Sequence[str],
                   updated_at_col: str | None = None, now: Column | None = None,
                   close_missing: bool = False) -> DataFrame:
    """Apply one batch (one row per key, see ``latest_per_key``).

    New key -> open version. Changed check column (NULL-safe) -> the open
    version is closed at the new time and a new one opened. Unchanged -> the
    open version stays untouched (other columns may go stale, by design).
    Missing key -> stays open unless ``close_missing`` (which needs ``now``).
    A row older than the open version is passed over: an interval never ends
    before it begins. NULL is a key like any other.

    One full outer join of the open versions with the batch; each joined pair
    gives its zero to two rows in place, and the closed history is passed
    through without a shuffle.
    """
    if close_missing and now is None:
        raise ValueError("close_missing needs the run time `now`")
    fresh = initial_snapshot(batch, key, updated_at_col, now)
    if snapshot is None:
        return fresh
    cols = snapshot.columns
    history = snapshot.filter(F.col("valid_to").isNotNull())
    o = snapshot.filter(F.col("valid_to").isNull()).select(F.struct(*cols).alias("o"))
    b = fresh.select(F.struct(*[F.col(c).cast(snapshot.schema[c].dataType).alias(c) for c in cols]).alias("b"))
    j = o.join(b, F.col(f"o.{key}").eqNullSafe(F.col(f"b.{key}")), "full")
    has_o, has_b = F.col("o").isNotNull(), F.col("b").isNotNull()
    differs = _any_differs([(F.col(f"o.{c}"), F.col(f"b.{c}")) for c in check_cols])
    changed = has_o & has_b & differs & (F.col("b.valid_from") >= F.col("o.valid_from"))
    close_at = F.when(changed, F.col("b.valid_from"))
    if close_missing:
        close_at = close_at.when(~has_b, now.cast("timestamp_ntz"))
    old = F.when(has_o, F.col("o").withField("valid_to", close_at))
    new = F.when(has_b & (~has_o | changed), F.col("b"))
    return history.unionByName(j.select(F.inline(F.array_compact(F.array(old, new)))))


#: A key is heavy if it holds more than one in HEAVY_PART of all rows and LIGHT_ROWS at least, or over HEAVY_ROWS anyway.
HEAVY_PART, LIGHT_ROWS, HEAVY_ROWS = 64, 1_000, 5_000_000
SLICES, SLICE_ROWS = 256, 100_000


def _heavy_keys(keys: DataFrame) -> list[tuple[object, int]]:
    """(key, rows) of the heavy keys of a one-column frame: HEAVY_PART of them, and one per HEAVY_ROWS rows, at most."""
    counts = keys.toDF("k").groupBy("k").agg(F.count("*").alias("n"))
    most, total = counts.agg(F.max("n"), F.sum("n")).first()
    least = max(LIGHT_ROWS, min(HEAVY_ROWS, (total or 0) // HEAVY_PART))
    return [tuple(r) for r in counts.where(F.col("n") > least).collect()] if (most or 0) > least else []


def _split(df: DataFrame, key: str, heavy: list[tuple[object, int]]) -> tuple[DataFrame, DataFrame]:
    """Rows of light and of heavy keys; NULL is a key like any other."""
    kind = df.schema[key].dataType.simpleString()
    listed = F.broadcast(df.sparkSession.createDataFrame([(k,) for k, _ in heavy], f"__heavy {kind}"))
    same = F.col(key).eqNullSafe(F.col("__heavy"))
    return df.join(listed, same, "left_anti"), df.join(listed, same, "left_semi")


def _sliced(df: DataFrame, key: str, time: str, heavy: list[tuple[object, int]]) -> DataFrame:
    """Rows of heavy keys with ``__s``, the number of their slice, stored.

    Slices follow the order of (key, time) and hold about equally many rows: Spark's range
    partitioning takes its split points from a sample of the rows, so a key gets slices by its
    weight wherever its times lie. Rows of one key and time share a slice.
    """
    slices = max(SLICES, -(-sum(n for _, n in heavy) // SLICE_ROWS))
    return materialize(df.repartitionByRange(slices, key, time).withColumn("__s", F.spark_partition_id()))


def history_bulk(rows: DataFrame, key: str, check_cols: Sequence[str], updated_at_col: str,
                 tie_breakers: Sequence[Column] = ()) -> DataFrame:
    """All versions from the full history of rows in one pass.

    Same result as applying the batches one by one in ``updated_at`` order,
    with one row per key and time: a row opens a version when it is the
    first of its key or any check column differs from the previous row.
    Rows are first reduced to one per (key, time) with a map-side top-1. A light key is
    ordered as one window. A heavy one is ordered in slices of about equally many
    rows, and only the last row (then the first version) of each slice is passed to
    its neighbour, so it spreads over many tasks. ``rows`` is read for the key counts and
    for the result: store it first if it is costly to derive.
    """
    heavy = _heavy_keys(rows.select(key))
    per_time = latest_per_key(rows, [key, updated_at_col], list(tie_breakers) or [F.lit(1)])
    if not heavy:
        return _versions(per_time, key, check_cols, updated_at_col, None)
    light, split = _split(per_time, key, heavy)
    split = _versions(_sliced(split, key, updated_at_col, heavy), key, check_cols, updated_at_col, "__s")
    return _versions(light, key, check_cols, updated_at_col, None).unionByName(split)


def _versions(per_time: DataFrame, key: str, check_cols: Sequence[str], updated_at_col: str,
              slice_col: str | None) -> DataFrame:
    """Versions of rows that are one per (key, time); with ``slice_col`` a key's order is carried from slice to slice."""
    t, k = F.col(updated_at_col), F.col(key)
    here = Window.partitionBy(key, *([slice_col] if slice_col else [])).orderBy(t)

    def carried(df: DataFrame, value: Column, step) -> DataFrame:
        """``step`` over the values of a key's slices, joined back to its rows."""
        if not slice_col:
            return df.withColumn("__carry", F.lit(None))
        per = df.groupBy(k.alias("__k"), F.col(slice_col).alias("__p")).agg(value.alias("__x"))
        per = per.select("__k", "__p", step("__x").over(Window.partitionBy("__k").orderBy("__p")).alias("__carry"))
        return df.join(per, k.eqNullSafe(per["__k"]) & (df[slice_col] == per["__p"]), "left").drop("__k", "__p")

    checks = F.struct(*check_cols)
    j = carried(per_time, F.max_by(checks, t), F.lag)
    prev = F.coalesce(F.lag(checks).over(here), F.col("__carry")) if slice_col else F.lag(checks).over(here)
    j = j.withColumn("__prev", prev)
    changed = F.col("__prev").isNull() | _any_differs([(F.col(c), F.col("__prev")[c]) for c in check_cols])
    j = carried(j.where(changed).drop("__prev", "__carry"), F.min(t), F.lead)
    ts, end = t.cast("timestamp_ntz"), F.coalesce(F.lead(t).over(here), F.col("__carry")).cast("timestamp_ntz")
    j = j.withColumn("valid_to", end).withColumn("version_updated_at", ts).withColumn("valid_from", ts)
    return j.withColumn("version_id", surrogate_key(k, ts)).drop("__carry", *([slice_col] if slice_col else []))


def current_versions(snapshot: DataFrame, loaded_col: str | None = "loaded_at_utc") -> DataFrame:
    """Open versions with the silver flags."""
    out = (snapshot.filter(F.col("valid_to").isNull())
                   .withColumn("record_effective_date", F.col("valid_from"))
                   .withColumn("is_current_record", F.lit(True)))
    if loaded_col:
        out = out.withColumn("last_updated_at", F.col(loaded_col))
    return out


def asof_lookup(facts: DataFrame, snapshot: DataFrame, fact_key: str, ts_col: str,
                snap_key: str | None = None, cols: Sequence[str] = ("version_id",)) -> DataFrame:
    """The version valid at each fact's time: valid_from <= ts < valid_to (open end when NULL).

    Facts and versions are ordered together by time and each fact takes the last
    version before it, so no fact meets more than one version. A light key is ordered as
    one window; a heavy one in slices of about equally many rows, with the version open
    at the start of each slice carried in, so it spreads over many tasks. Versions of a
    key must not overlap. A fact without key, time or version gets NULLs. Both
    frames are read for the key counts and for the result: store a derived snapshot first.
    """
    snap_key = snap_key or fact_key
    v = snapshot.select(F.col(snap_key).alias("__k"), F.col("valid_from").alias("__t"),
                        F.struct(F.col("valid_to").alias("__end"), *cols).alias("__v")).where("__k IS NOT NULL")
    f = facts.select(F.col(fact_key).alias("__k"), F.col(ts_col).alias("__t"), F.struct(*facts.columns).alias("__f"))
    heavy = _heavy_keys(v.select("__k").union(f.select("__k").where("__k IS NOT NULL")))
    events = v.unionByName(f.where("__k IS NOT NULL"), allowMissingColumns=True)
    first = F.col("__f").isNotNull()  # at one time the version comes before the facts

    def latest(*slice_col: str) -> Column:
        here = Window.partitionBy("__k", *slice_col).orderBy("__t", first)
        return F.last("__v", ignorenulls=True).over(here.rowsBetween(Window.unboundedPreceding, 0))

    light, split = _split(events, "__k", heavy) if heavy else (events, None)
    out = light.withColumn("__hit", latest()).where(first).select("__k", "__t", "__f", "__hit")
    if split is not None:
        split = _sliced(split, "__k", "__t", heavy)
        last = split.groupBy("__k", "__s").agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col("__t"))).alias("__last"))
        before = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
        carry = last.select("__k", "__s", F.last("__last", ignorenulls=True).over(before).alias("__carry"))
        hit = F.coalesce(latest("__s"), F.col("__carry"))
        out = out.unionByName(split.join(carry, ["__k", "__s"], "left").withColumn("__hit", hit).where(first)
                              .select("__k", "__t", "__f", "__hit"))
    keyless = f.where("__k IS NULL").withColumn("__hit", F.lit(None).cast(v.schema["__v"].dataType))
    valid = F.col("__t").isNotNull() & F.col("__k").isNotNull() & (
        F.col("__hit.__end").isNull() | (F.col("__t") < F.col("__hit.__end")))
    return out.unionByName(keyless).select("__f.*", *[F.when(valid, F.col("__hit")[c]).alias(c) for c in cols])
