"""Scalar expressions of the silver and gold models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_default(c, default: str = "00:00") -> Column:
    """NULL or empty text becomes ``default``."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(default)).otherwise(c)


def guarded_ratio(num, den) -> Column:
    """P5: num / den as double when den > 0, else 0 (also for a NULL den)."""
    num, den = _col(num), _col(den)
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def nullif_ratio(num, den) -> Column:
    """Num / NULLIF(den, 0) as double; NULL when den is 0 or NULL."""
    num, den = _col(num), _col(den)
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def status_bucket(year_text, threshold: int = 2024, below: str = "Retired",
                  otherwise: str = "Active", strict: bool = False) -> Column:
    """Year given as text; ``< threshold`` -> ``below``, else (NULL too) ``otherwise``.

    Tolerant by default: text that is not a number falls to ``otherwise``.
    ``strict=True`` keeps the warehouse behaviour of failing the query on it.
    """
    y = _col(year_text)
    year = y.cast("int") if strict else y.try_cast("int")
    return F.when(year < F.lit(threshold), F.lit(below)).otherwise(F.lit(otherwise))


def placeholder_label(prefix: str, key, suffix: str = ")") -> Column:
    """E.g. 'Unknown Player (' || key || ')' with the key cast to text."""
    return F.concat(F.lit(prefix), _col(key).cast("string"), F.lit(suffix))

