"""Semi-structured feed handling (V1-V5): parse, flatten and typed extraction.

Landing files are JSON arrays of objects. They are parsed to VARIANT, exploded
with the ``variant_explode`` generator (0 rows for NULL, ``[]`` and malformed
text; one row per field for a single object), then typed with ``variant_get``
(strict) or ``try_variant_get`` (tolerant).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Spark type names accepted in a spec entry; "int" follows the warehouse's
# NUMBER(38,0) and is held as bigint, fractions are rounded, not truncated.
_INTEGRAL = {"int", "bigint", "long", "integer"}


def parse_raw(df: DataFrame, text_col: str, out: str = "raw_json", strict: bool = False) -> DataFrame:
    """Text -> VARIANT. Tolerant parsing gives NULL for malformed text."""
    fn = F.parse_json if strict else F.try_parse_json
    return df.withColumn(out, fn(F.col(text_col)))


def flatten(df: DataFrame, variant_col: str, keep: Sequence[str] = (), value: str = "value",
            with_position: bool = False) -> DataFrame:
    """V1/V5: one row per array element (or per object field), file columns kept.

    Rows whose value is NULL, an empty array or malformed produce no row, as an
    inner lateral flatten does.
    """
    spark = df.sparkSession
    exploded = df.lateralJoin(spark.tvf.variant_explode(F.col(variant_col).outer()))
    cols = [F.col(k) for k in keep] + [F.col("value").alias(value)]
    if with_position:
        cols.append(F.col("pos"))
    return exploded.select(*cols)


def typed_path(variant: Column, path: str, type_name: str, tolerant: bool = False) -> Column:
    """V2/V3: value at ``path`` as ``type_name``; a missing key or JSON null -> NULL."""
    get = F.try_variant_get if tolerant else F.variant_get
    t = type_name.lower()
    if t in _INTEGRAL:
        return whole_number(get(variant, path, "decimal(38,9)"), t)
    if t in ("float", "double"):
        return get(variant, path, "double")
    if t in ("string", "text", "varchar"):
        return get(variant, path, "string")
    if t in ("timestamp_ntz", "timestamp"):
        return get(variant, path, "timestamp_ntz")
    if t == "date":
        return F.to_date(get(variant, path, "timestamp_ntz"))
    return get(variant, path, type_name)


def whole_number(value: Column, type_name: str) -> Column:
    """A decimal rounded half away from zero (7.6 -> 8, as in the warehouse cast) if the type is integral; others as they are."""
    return F.round(value, 0).cast("bigint") if type_name.lower() in _INTEGRAL else value


def typed_fields(variant: Column, paths: dict[str, str], tolerant: bool = False) -> Column:
    """V2/V3 for many fields of an object in one pass: a struct of the values at ``paths`` ("$.name" -> type).

    Each field is what ``typed_path`` gives, but for integral types, which ``whole_number`` still has to round. NULL for
    anything that is no object.
    """
    get = F.try_variant_get if tolerant else F.variant_get
    kinds = {"float": "double", "text": "string", "varchar": "string", "timestamp": "timestamp_ntz"}
    kind = lambda t: "decimal(38,9)" if t in _INTEGRAL else kinds.get(t, t)
    fields = ", ".join(f"`{p.removeprefix('$.')}`: {kind(t.lower())}" for p, t in paths.items())
    is_object = F.try_variant_get(variant, "$", "struct<`$`: string>").isNotNull()
    return F.when(is_object, get(variant, "$", f"struct<{fields}>"))


def extract(df: DataFrame, variant_col: str, spec: Sequence[tuple[str, str, str]],
            keep: Sequence[str] = (), tolerant: bool = False) -> DataFrame:
    """Project ``(name, json_path, type)`` entries out of ``variant_col``."""
    v = F.col(variant_col)
    cols = [F.col(k) for k in keep]
    cols += [typed_path(v, path, t, tolerant).alias(name) for name, path, t in spec]
    return df.select(*cols)
