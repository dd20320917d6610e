"""Latest row per key (W1) and most recent N rows per entity.

Both are ``row_number()`` filters. Catalyst turns the filter into a
``WindowGroupLimit`` that keeps at most N rows per key inside every map task
*before* the shuffle, so a key that holds a third of all rows still sends at
most N rows per input partition across the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def desc_nulls_first(*cols: str) -> list[Column]:
    """The warehouse's ``ORDER BY c DESC`` (NULLs come first)."""
    return [F.col(c).desc_nulls_first() for c in cols]


def asc_nulls_last(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of each key under ``order``.

    ``order`` must be total within a key (end it with tie-breakers), otherwise
    the surviving row is not deterministic and a task retry could pick another.
    """
    return recent_n(df, keys, order, 1)


def recent_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
             rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows of each key under ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    tmp = rank_col or "__rn"
    out = df.withColumn(tmp, F.row_number().over(w)).filter(F.col(tmp) <= n)
    return out if rank_col else out.drop(tmp)
