"""Latest / first value per key (W2-W5) as one partial aggregation.

``max_by(value, ordering_struct)`` needs no sort and combines map-side, so a
key holding a third of all rows is reduced before the shuffle.  NULL order
keys are mapped to an explicit flag so the PostgreSQL rule can be chosen:
``DESC`` puts NULLs first (a NULL stamp is "latest"), ``ASC`` puts them last.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def order_key(order: Sequence[Column], nulls_win: bool) -> Column:
    """Ordering struct for ``max_by``/``min_by``: with ``nulls_win`` a NULL in
    an order column beats every value in that position."""
    return _order_struct(order, nulls_win)


def _order_struct(order: Sequence[Column], nulls_win: bool) -> Column:
    fields = []
    for i, c in enumerate(order):
        # True sorts above False: with nulls_win a NULL key beats any value
        flag = c.isNull() if nulls_win else c.isNotNull()
        fields += [flag.alias(f"n{i}"), c.alias(f"v{i}")]
    return F.struct(*fields)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
              values: Mapping[str, Column], nulls_latest: bool = False) -> DataFrame:
    """One row per key with ``values`` taken from the row that is greatest by
    ``order`` (a lexicographic tuple; end it with a tiebreak for a total order).
    ``nulls_latest=True`` gives PostgreSQL ``ORDER BY .. DESC`` (NULLS FIRST)."""
    pick = F.max_by(F.struct(*[v.alias(k) for k, v in values.items()]), _order_struct(order, nulls_latest))
    return df.groupBy(*keys).agg(pick.alias("_mf_pick")).select(*keys, "_mf_pick.*")


def earliest_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                values: Mapping[str, Column], nulls_earliest: bool = False) -> DataFrame:
    """Mirror of :func:`latest_by`; ``nulls_earliest=False`` is PostgreSQL ASC
    (NULLS LAST): the first row is the smallest non-NULL key."""
    pick = F.min_by(F.struct(*[v.alias(k) for k, v in values.items()]),
                    _order_struct(order, not nulls_earliest))
    return df.groupBy(*keys).agg(pick.alias("_mf_pick")).select(*keys, "_mf_pick.*")
