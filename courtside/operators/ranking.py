"""Ranks within a partition (W3) and over a whole table.

``RANK() OVER (ORDER BY x)`` without a partition runs in one task. The
scalable form here never sorts the rows themselves:

1. histogram ``(partition, x) -> count``: a map-side partial aggregate, so a
   value held by a third of the rows is one row per map task;
2. approximate quantiles of ``x`` (one scalar subquery, ``buckets`` values)
   cut the value range into order-preserving buckets;
3. per-bucket totals (at most ``buckets`` rows per partition) give bucket
   offsets; a running sum inside each bucket gives the rows strictly before
   each distinct value;
4. rank = 1 + offset + before, joined back to the rows on (partition, x).

Equal values always fall in one bucket, so ties share a rank and gaps follow
as with ``rank()``. NULLs form their own group, first or last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def value_rank_table(df: DataFrame, value_col: str, partition_cols: Sequence[str] = (),
                     descending: bool = True, nulls_first: bool = True, out: str = "rank",
                     buckets: int = 256, accuracy: int = 10000, own_splits: bool = False) -> DataFrame:
    """One row per distinct (partition, value): ``__v`` and its rank ``out``.

    ``own_splits`` takes split points per value of the one partition column, which must have few values.
    """
    parts = list(partition_cols)
    v = F.col(value_col)
    hist = df.groupBy(*parts, value_col).agg(F.count(F.lit(1)).alias("__n"))

    probs = [i / buckets for i in range(1, buckets)]
    quantiles = F.percentile_approx(v, probs, accuracy)
    if own_splits:
        each = hist.groupBy(*parts).agg(quantiles.alias("__q"))
        splits = each.select(F.map_from_entries(F.collect_list(F.struct(*parts, "__q")))).scalar()[F.col(parts[0])]
    else:
        splits = hist.select(quantiles).scalar()
    hist = hist.withColumn("__splits", splits)
    if descending:
        in_order = F.size(F.filter(F.col("__splits"), lambda s: s >= v))
    else:
        in_order = F.size(F.filter(F.col("__splits"), lambda s: s <= v))
    null_bucket = F.lit(-1 if nulls_first else buckets + 1)
    hist = hist.withColumn("__b", F.when(v.isNull(), null_bucket).otherwise(in_order)).drop("__splits")

    totals = hist.groupBy(*parts, "__b").agg(F.sum("__n").alias("__bn"))
    w_off = Window.partitionBy(*parts).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("__off", F.coalesce(F.sum("__bn").over(w_off), F.lit(0))).drop("__bn")

    order = v.desc() if descending else v.asc()
    w_in = Window.partitionBy(*parts, "__b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.withColumn("__before", F.coalesce(F.sum("__n").over(w_in), F.lit(0)))

    t = totals.select(*[F.col(p).alias(f"__t_{p}") for p in parts], F.col("__b").alias("__t_b"), "__off")
    on = [hist["__b"] == t["__t_b"]] + [hist[p].eqNullSafe(t[f"__t_{p}"]) for p in parts]
    return (hist.join(t, on=on, how="inner")
                .select(*[hist[p] for p in parts], v.alias("__v"),
                        (F.lit(1) + F.col("__off") + F.col("__before")).cast("bigint").alias(out)))


def scalable_rank(df: DataFrame, value_col: str, partition_cols: Sequence[str] = (),
                  descending: bool = True, nulls_first: bool = True, out: str = "rank",
                  buckets: int = 256, accuracy: int = 10000, source: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = rank() over (partition by partition_cols order by value_col).

    ``source`` (default ``df``) is where the value histogram is computed; pass a
    materialised frame when several ranks are added one after another, so each
    rank does not re-derive the previous ones.
    """
    parts = list(partition_cols)
    src = source if source is not None else df
    ranked = value_rank_table(src, value_col, parts, descending, nulls_first, out, buckets, accuracy)
    if parts:
        cond = [df[value_col].eqNullSafe(ranked["__v"])] + [df[p].eqNullSafe(ranked[p]) for p in parts]
        return df.join(ranked, on=cond, how="inner").select(df["*"], ranked[out])
    # NULL measures share one rank, a scalar: they need no partner in the join.
    nulls = F.lit(1).cast("bigint") if nulls_first else src.select(F.count(value_col) + 1).scalar()
    known = ranked.where("__v IS NOT NULL")
    return df.join(known, on=df[value_col] == known["__v"], how="left").select(
        df["*"], F.coalesce(known[out], nulls).alias(out))


def global_rank(df: DataFrame, value_col: str, descending: bool = True, nulls_first: bool = True,
                out: str = "rank", buckets: int = 256, source: DataFrame | None = None) -> DataFrame:
    """Rank over the whole table without a single-partition sort."""
    return scalable_rank(df, value_col, (), descending, nulls_first, out, buckets, source=source)


def rank_measures(df: DataFrame, measures: dict[str, str], row_col: str, descending: bool = True,
                  nulls_first: bool = True, buckets: int = 256) -> DataFrame:
    """W4 for several measures (value column -> rank column) of one type at once.

    One histogram over (measure, value), one join of its ranks to the cells and one join by row, however many
    measures. ``row_col`` is unique; pass a materialised frame, which is read three times. NULLs of a
    measure share one rank and meet no join.
    """
    cells = df.select(F.col(row_col).alias("__row_id"), F.posexplode(F.array(*measures)).alias("__m", "__x"))
    ranked = value_rank_table(cells, "__x", ["__m"], descending, nulls_first, "__r", buckets, own_splits=True)
    ranked = ranked.where("__v IS NOT NULL").withColumnRenamed("__m", "__rm")
    known = cells.where("__x IS NOT NULL")
    known = known.join(ranked, (known["__m"] == ranked["__rm"]) & (known["__x"] == ranked["__v"]))
    wide = known.groupBy("__row_id").agg(*[F.max(F.when(F.col("__m") == i, F.col("__r"))).alias(f"__r{i}")
                                           for i in range(len(measures))])
    out = []
    for i, (value, name) in enumerate(measures.items()):
        nulls = F.lit(1).cast("bigint") if nulls_first else df.select(F.count(value) + 1).scalar()
        out.append(F.coalesce(wide[f"__r{i}"], nulls).alias(name))
    return df.join(wide, df[row_col] == wide["__row_id"], "left").select(df["*"], *out)


def rank_within(df: DataFrame, partition_cols: Sequence[str], value_col: str, descending: bool = True,
                nulls_first: bool = True, out: str = "rank", buckets: int = 256) -> DataFrame:
    """Rank inside each partition, safe when one partition holds most rows."""
    return scalable_rank(df, value_col, partition_cols, descending, nulls_first, out, buckets)


def plain_rank(df: DataFrame, value_col: str, partition_cols: Sequence[str] = (), descending: bool = True,
               nulls_first: bool = True, out: str = "rank") -> DataFrame:
    """Reference form (one sort per partition); used to cross-check the scalable form."""
    v = F.col(value_col)
    if descending:
        order = v.desc_nulls_first() if nulls_first else v.desc_nulls_last()
    else:
        order = v.asc_nulls_first() if nulls_first else v.asc_nulls_last()
    w = Window.partitionBy(*partition_cols).orderBy(order) if partition_cols else Window.orderBy(order)
    return df.withColumn(out, F.rank().over(w))
