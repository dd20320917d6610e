"""Column-level functions (JVM-side expressions only, no Python UDFs)."""

from courtside.functions.keys import surrogate_key
from courtside.functions.scalars import (
    blank_default,
    guarded_ratio,
    nullif_ratio,
    placeholder_label,
    status_bucket,
)
from courtside.functions.semistruct import extract, flatten, parse_raw

__all__ = [
    "surrogate_key", "blank_default", "guarded_ratio", "nullif_ratio", "placeholder_label",
    "status_bucket", "extract", "flatten", "parse_raw",
]
