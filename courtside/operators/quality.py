"""Declarative data-quality checks (Q1-Q9) run as distributed queries.

Each check has a *failing rows* form (zero rows = pass) and a failure count
with the warehouse test's counting rule. ``run_checks`` folds every row-level
check on one table (not_null, accepted_values, not_accepted_values,
accepted_range) into a single aggregation pass; grouping checks (unique,
relationships) add one shuffle each. Nothing is collected to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ROW_LEVEL = {"not_null", "accepted_values", "not_accepted_values", "accepted_range"}


@dataclass(frozen=True)
class Check:
    name: str
    kind: str
    column: str
    values: tuple = ()
    min_value: Any = None
    max_value: Any = None
    inclusive: bool = True
    where: str | None = None
    parent: DataFrame | None = None
    field: str | None = None


# ---- failing-row forms -------------------------------------------------------

def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where the column is NULL."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str, where: str | Column | None = None) -> DataFrame:
    """Q2/Q3: values occurring more than once (NULLs ignored); ``where`` first."""
    src = df.filter(where) if where is not None else df
    return (src.filter(F.col(column).isNotNull()).groupBy(column)
               .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def _range_fail(c: Column, lo, hi, inclusive: bool) -> Column:
    conds = []
    if lo is not None:
        conds.append(c >= F.lit(lo) if inclusive else c > F.lit(lo))
    if hi is not None:
        conds.append(c <= F.lit(hi) if inclusive else c < F.lit(hi))
    ok = conds[0]
    for x in conds[1:]:
        ok = ok & x
    return ~ok  # NULL column -> NULL -> not a failure


def _values(values: Sequence) -> list[Column]:
    return [F.lit(v) for v in values]


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q4: distinct values outside the list (NULL passes)."""
    c = F.col(column)
    return df.filter(~c.cast("string").isin(*[str(v) if not isinstance(v, str) else v for v in values])) \
             .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q5: rows whose value is in the forbidden list."""
    return df.filter(F.col(column).isin(*_values(values)))


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    """Q6: rows outside [min, max] (either bound optional; NULL passes)."""
    return df.filter(_range_fail(F.col(column), min_value, max_value, inclusive))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Q7: child rows whose non-NULL key has no parent row."""
    p = parent.select(F.col(field).alias("__to")).filter(F.col("__to").isNotNull()).distinct()
    c = child.filter(F.col(column).isNotNull())
    return c.join(p, c[column] == p["__to"], "left_anti")


def freshness(df: DataFrame, loaded_col: str, now: Column, warn_hours: float = 25,
              error_hours: float = 49, source: str = "source") -> DataFrame:
    """Q9: newest load time against ``now``: pass / warn / error (error wins).

    A table without rows has no newest load time and is reported as error.
    """
    newest = F.max(F.col(loaded_col))
    age_s = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(newest.cast("timestamp"))
    status = (F.when(newest.isNull(), "error")
                .when(age_s > F.lit(error_hours * 3600), "error")
                .when(age_s > F.lit(warn_hours * 3600), "warn").otherwise("pass"))
    return df.agg(F.lit(source).alias("source"), newest.alias("max_loaded_at"),
                  age_s.cast("bigint").alias("age_seconds"), status.alias("status"))


# ---- folded runner -----------------------------------------------------------

def _row_fail(chk: Check) -> Column:
    c = F.col(chk.column)
    if chk.kind == "not_null":
        fail = c.isNull()
    elif chk.kind == "accepted_values":
        fail = ~c.cast("string").isin(*[v if isinstance(v, str) else str(v) for v in chk.values])
    elif chk.kind == "not_accepted_values":
        fail = c.isin(*_values(chk.values))
    else:
        fail = _range_fail(c, chk.min_value, chk.max_value, chk.inclusive)
    if chk.where:
        fail = fail & F.expr(chk.where)
    return F.coalesce(fail, F.lit(False))


def _row_count(chk: Check) -> Column:
    return F.sum(F.when(_row_fail(chk), F.lit(1)).otherwise(F.lit(0)))


def observed(df: DataFrame, checks: Sequence[Check]) -> tuple[DataFrame, Observation | None]:
    """``df`` with the failing rows of its row-level checks counted while it is written.

    Write the returned frame as it is: metrics taken right above the write count each partition once, also when
    a task is repeated. The observation's ``get`` then maps check names to failing rows.
    """
    row_checks = [c for c in checks if c.kind in ROW_LEVEL]
    if not row_checks:
        return df, None
    seen = Observation()
    return df.observe(seen, *[F.coalesce(_row_count(c), F.lit(0)).cast("bigint").alias(c.name) for c in row_checks]), seen


def run_checks(df: DataFrame, checks: Sequence[Check], seen: dict[str, int] | None = None) -> DataFrame:
    """One row per check: ``check_name``, ``failures`` (0 = pass).

    ``seen``: failing rows by check name, counted when ``df`` was written; such checks read nothing. Only accepted
    values, of which each counts once, are read again where some row failed.
    """
    parts: list[DataFrame] = []
    seen = seen or {}
    known = [c for c in checks if c.name in seen and c.kind in ROW_LEVEL and (c.kind != "accepted_values" or not seen[c.name])]
    if known:
        rows = [(c.name, int(seen[c.name])) for c in known]
        parts.append(df.sparkSession.createDataFrame(rows, "check_name string, failures bigint"))
    checks = [c for c in checks if c not in known]
    row_checks = [c for c in checks if c.kind in ROW_LEVEL and c.kind != "accepted_values"]
    if row_checks:
        agg = df.agg(*[F.coalesce(_row_count(c), F.lit(0)).cast("bigint").alias(f"__c{i}")
                       for i, c in enumerate(row_checks)])
        rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"__c{i}").alias("failures"))
                         for i, c in enumerate(row_checks)])
        parts.append(agg.select(F.inline(rows)))
    for c in checks:
        if c.kind == "unique":
            failing = unique(df, c.column, c.where)
        elif c.kind == "relationships":
            failing = relationships(df.filter(c.where) if c.where else df, c.column, c.parent, c.field)
        elif c.kind == "accepted_values":  # one failure per value, grouped once
            failing = accepted_values(df.filter(c.where) if c.where else df, c.column, c.values)
        elif c.kind in ROW_LEVEL:
            continue
        else:
            raise ValueError(f"unknown check kind {c.kind}")
        parts.append(failing.agg(F.lit(c.name).alias("check_name"),
                                 F.count(F.lit(1)).cast("bigint").alias("failures")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def count_failures(name: str, failing: DataFrame) -> DataFrame:
    """One-row summary of any failing-rows frame (used for singular tests)."""
    return failing.agg(F.lit(name).alias("check_name"), F.count(F.lit(1)).cast("bigint").alias("failures"))
