"""Dimension lookups with the reference's miss policies.

The reference's list / point reads of a dimension (S14) become these joins.

- skip on miss: inner join (or a left join split into resolved/unresolved);
- abort on miss: count unresolved rows before anything is published;
- all-or-nothing per parent: a parent survives only if all its children
  resolve.  The distinct set of parents with an unresolved child (usually
  small, so AQE can broadcast it) is anti-joined from the resolved children:
  no per-parent window or grouping of all children, so a parent holding a
  third of all rows is never gathered into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


class UnresolvedLookup(RuntimeError):
    pass


def require_resolved(df: DataFrame, key_col: str, what: str) -> None:
    """Raise if any row's lookup key is NULL (one count job)."""
    missing = df.filter(F.col(key_col).isNull()).limit(1).count()
    if missing:
        raise UnresolvedLookup(f"{what}: unresolved rows in lookup of {key_col}")


def all_or_nothing(children: DataFrame, parent_key: str, found: Column) -> DataFrame:
    """Keep the children of parents whose every child has ``found`` true."""
    flagged = children.withColumn("_mf_found", F.coalesce(found, F.lit(False)))
    bad = flagged.filter(~F.col("_mf_found")).select(parent_key).distinct()
    return flagged.filter(F.col("_mf_found")).join(bad, parent_key, "left_anti").drop("_mf_found")
