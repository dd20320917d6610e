"""Per-entity statistics over three periods (A1-A9): all rows, one season, last N.

The reference computes three grouped sub-queries over the same fact and left
joins them. Here the all-time and season figures come from **one** aggregate
(partial on the map side, so a hot entity is pre-aggregated before it is
shuffled) over rows marked for the distinct count, and the last-N figures from a
``WindowGroupLimit``-pruned top-N. NULL parity with the join form is kept: a
period without rows yields NULL, not 0.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtside.operators.dedup import recent_n
from courtside.session import materialize


@dataclass(frozen=True)
class StatSpec:
    """What to compute per entity and period.

    avg:     output name -> column averaged (NULLs skipped)
    ratios:  output name -> (numerator, denominator): SUM(n) / NULLIF(SUM(d), 0)
    flags:   output name -> boolean column counted as SUM(CASE WHEN c THEN 1 ELSE 0)
    maxes:   output name -> column (MAX)
    distinct: column whose distinct non-NULL values are counted (``games``)
    """

    avg: dict[str, str] = field(default_factory=dict)
    ratios: dict[str, tuple[str, str]] = field(default_factory=dict)
    flags: dict[str, Column] = field(default_factory=dict)
    maxes: dict[str, str] = field(default_factory=dict)
    distinct: str | None = None
    distinct_name: str = "total_games"


def _figures(spec: StatSpec, in_period: Column | None, prefix: str, counted: Column | None) -> list[Column]:
    """Aggregates of one period; ``counted`` marks the rows that stand for a distinct value."""
    def gate(c: Column) -> Column:
        return c if in_period is None else F.when(in_period, c)

    out = []
    if spec.distinct:
        games = F.count(gate(F.when(counted, F.lit(1))))
        out.append(F.when(F.count(gate(F.lit(1))) > 0, games).cast("bigint").alias(f"{prefix}{spec.distinct_name}"))
    for name, c in spec.avg.items():
        total, n = F.sum(gate(F.col(c))), F.count(gate(F.col(c)))
        out.append((total.cast("double") / F.nullif(n, F.lit(0)).cast("double")).alias(f"{prefix}{name}"))
    for name, (num, den) in spec.ratios.items():
        s_n, s_d = F.sum(gate(F.col(num))), F.sum(gate(F.col(den)))
        out.append((s_n.cast("double") / F.nullif(s_d, F.lit(0)).cast("double")).alias(f"{prefix}{name}"))
    for name, cond in spec.flags.items():
        out.append(F.sum(gate(F.when(cond, F.lit(1)).otherwise(F.lit(0)))).cast("bigint").alias(f"{prefix}{name}"))
    for name, c in spec.maxes.items():
        out.append(F.max(gate(F.col(c))).alias(f"{prefix}{name}"))
    return out


def all_and_season_stats(df: DataFrame, key: str, spec: StatSpec, season_col: str | None = None,
                         season: str | None = None, all_prefix: str = "all_",
                         season_prefix: str = "season_") -> DataFrame:
    """All-time and (optionally) current-season figures per ``key`` in one pass.

    COUNT(DISTINCT) becomes a count of marked rows: of each (key, distinct value) the first row, those
    of the season before the others. Rows are sorted for that, which spills, and need no shuffle where they
    lie by the distinct column already (after a join on it); the only hash table is that of the keys.
    """
    in_season = (F.col(season_col) == F.lit(season)) if season_col else None
    counted = None
    if spec.distinct:
        order = in_season if in_season is not None else F.lit(True)
        pair = Window.partitionBy(key, spec.distinct).orderBy(order.desc_nulls_last())
        df = df.withColumn("__nth", F.row_number().over(pair))
        counted = (F.col("__nth") == 1) & F.col(spec.distinct).isNotNull()
    aggs = _figures(spec, None, all_prefix, counted)
    if in_season is not None:
        aggs += _figures(spec, in_season, season_prefix, counted)
    return df.groupBy(key).agg(*aggs) if aggs else df.select(key).distinct()


def recent_stats(df: DataFrame, key: str, spec: StatSpec, order: Sequence[Column], n: int,
                 prefix: str = "recent_") -> DataFrame:
    """Figures over the first ``n`` rows per key under ``order`` (W2 + A*)."""
    top = recent_n(df, [key], order, n)
    aggs = []
    if spec.distinct:
        aggs.append(F.count_distinct(F.col(spec.distinct)).cast("bigint").alias(f"{prefix}{spec.distinct_name}"))
    for name, c in spec.avg.items():
        aggs.append(F.avg(F.col(c)).alias(f"{prefix}{name}"))
    for name, (num, den) in spec.ratios.items():
        aggs.append((F.sum(F.col(num)).cast("double")
                     / F.nullif(F.sum(F.col(den)), F.lit(0)).cast("double")).alias(f"{prefix}{name}"))
    for name, cond in spec.flags.items():
        aggs.append(F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint").alias(f"{prefix}{name}"))
    for name, c in spec.maxes.items():
        aggs.append(F.max(F.col(c)).alias(f"{prefix}{name}"))
    return top.groupBy(key).agg(*aggs)


def period_stats(df: DataFrame, key: str, spec: StatSpec, season_col: str, season: str,
                 order: Sequence[Column], n: int, recent_spec: StatSpec | None = None,
                 prefixes: tuple[str, str, str] = ("all_", "season_", "recent_")) -> DataFrame:
    """All-time, current-season and last-``n`` figures, one row per entity with rows.

    Stored, so that the rows of the facts are sorted in tasks of bounded size.
    """
    a = all_and_season_stats(df, key, spec, season_col, season, prefixes[0], prefixes[1])
    r = recent_stats(df, key, recent_spec or spec, order, n, prefixes[2])
    return materialize(a.join(r, on=key, how="full"))
