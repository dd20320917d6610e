"""Surrogate keys (P3): MD5 over the text form of the key parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the reference's key format exactly:
# the text that stands in for a NULL part, and the separator between parts.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_text(*parts) -> Column:
    """The text whose digest is the surrogate key: equal texts, equal keys, and fewer bytes to shuffle."""
    if not parts:
        raise ValueError("surrogate_key needs at least one part")
    return F.concat_ws(SEPARATOR, *[F.coalesce(_col(p).cast("string"), F.lit(NULL_PART)) for p in parts])


def surrogate_key(*parts) -> Column:
    """md5(part1 || '-' || part2 ...), each part cast to text, NULL -> NULL_PART.

    Two keys that differ only in which part is NULL stay different. Parts should
    be integers, strings or dates: the text form of doubles and timestamps is
    engine-specific.
    """
    return F.md5(key_text(*parts))
