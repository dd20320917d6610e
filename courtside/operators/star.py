"""Star-schema joins: enrichment (J1-J4), counterpart resolution (J5),
orphan detection (J6) and placeholder members (U2)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtside.functions.scalars import placeholder_label
from courtside.session import input_bytes, materialize


LOOKUP_BYTES = 4 << 20  # of a stored lookup's files; codes of three digits compress to a sixteenth of their size in memory


def looked_up(dim: DataFrame) -> DataFrame:
    """``dim`` stored, and broadcast if its bytes, now counted, are few: facts many times larger are then not shuffled for it."""
    kept = materialize(dim)
    return F.broadcast(kept) if input_bytes(kept) <= LOOKUP_BYTES else kept


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left") -> DataFrame:
    """Left equi join to a dimension; the planner broadcasts it when its bytes allow."""
    return df.join(dim, on=on, how=how)


def resolve_counterpart(facts: DataFrame, dim: DataFrame, text_col: str, own_code_col: str,
                        dim_code_col: str, dim_cols: Mapping[str, str], n: int = 3) -> DataFrame:
    """Left join facts to the dimension rows whose code is the first or the
    last ``n`` characters of ``text_col`` and differs from the fact's own code.

    A NULL own code matches nothing; an own code in neither position matches both
    (fan-out); no match keeps the fact row with NULL dimension columns, and
    repeated facts stay apart. ``dim_cols`` maps output name -> dim column.

    One form for every size: the dimension rows of a code become one array, each
    fact looks up both candidate codes by equality (the lookup is stored, and
    broadcast when its bytes allow; adaptive execution splits a hot code when
    not) and explodes the matches. The facts are never joined back to themselves.
    """
    own = F.col(own_code_col)
    fields = [F.col(c).alias(o) for o, c in dim_cols.items()]
    payload = dim.filter(F.col(dim_code_col).isNotNull()).select(
        F.col(dim_code_col).alias("__key"), F.struct(*fields).alias("__m"))
    lookup = looked_up(payload.groupBy("__key").agg(F.collect_list("__m").alias("__ms")))
    l1 = lookup.withColumnsRenamed({"__key": "__k1", "__ms": "__ms1"})
    l2 = lookup.withColumnsRenamed({"__key": "__k2", "__ms": "__ms2"})
    f = facts.withColumns({"__c1": F.left(F.col(text_col), F.lit(n)), "__c2": F.right(F.col(text_col), F.lit(n))})
    f = f.withColumns({"__c1": F.when(F.col("__c1") != own, F.col("__c1")), "__c2": F.when(F.col("__c2") != own, F.col("__c2"))})
    j = (f.join(l1, f["__c1"] == l1["__k1"], "left")
          .join(l2, (f["__c2"] == l2["__k2"]) & ~f["__c2"].eqNullSafe(f["__c1"]), "left"))
    # All rows under a code have that code, so the own one is left out before the lookup, and a
    # list that is alone is exploded as it is: nothing is copied per fact, however many rows a code has.
    one, two = F.col("__ms1"), F.col("__ms2")
    matches = F.when(two.isNull(), one).when(one.isNull(), two).otherwise(F.concat(one, two))
    out = j.select(*[F.col(c) for c in facts.columns], F.explode_outer(matches).alias("__hit"))
    return out.select(*[F.col(c) for c in facts.columns], *[F.col("__hit")[o].alias(o) for o in dim_cols])


def orphan_keys(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str | None = None,
                out: str | None = None) -> DataFrame:
    """DISTINCT fact keys ``NOT IN`` the dimension's keys, with SQL's NULL rules.

    One NULL key in the dimension makes the result empty; an empty dimension gives
    every key, NULL too; otherwise a NULL fact key is no orphan. Written as
    distinct + left anti join (partial aggregation first) and one scalar probe of
    the dimension, instead of the broadcast-only null-aware anti join.
    """
    dim_key = dim_key or fact_key
    out = out or fact_key
    has_null = dim.select(F.bool_or(F.col(dim_key).isNull())).scalar()  # NULL for an empty dimension
    keys = fact.select(F.col(fact_key).alias(out)).distinct()
    anti = keys.join(dim.select(F.col(dim_key).alias(out)).filter(F.col(out).isNotNull()), on=out, how="left_anti")
    return anti.filter(F.when(has_null.isNull(), True).otherwise(~has_null & F.col(out).isNotNull()))


def fill_orphans(dim: DataFrame, orphans: DataFrame, key: str, defaults: Mapping[str, Column]) -> DataFrame:
    """Dimension UNION ALL one placeholder member per orphan key.

    ``defaults`` gives expressions (over the orphan frame) for dimension columns;
    columns not named become NULL of the dimension's type.
    """
    cols = []
    for f in dim.schema.fields:
        if f.name == key:
            cols.append(F.col(key).cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            cols.append(defaults[f.name].cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return dim.unionByName(orphans.select(*cols))


def placeholder_defaults(key: str, label_prefix: str, now: Column, label_col: str, na_cols: Sequence[str],
                         status_col: str | None = None, status: str = "Unknown",
                         freshness_col: str | None = None) -> dict[str, Column]:
    """The reference's placeholder member: label, 'N/A' texts, status, load time."""
    d: dict[str, Column] = {label_col: placeholder_label(label_prefix, key)}
    for c in na_cols:
        d[c] = F.lit("N/A")
    if status_col:
        d[status_col] = F.lit(status)
    if freshness_col:
        d[freshness_col] = now
    return d
