"""Keys at given ranks without sorting the table.

The k-th key is found by histogram refinement: count rows per range of the
first key, keep the range that holds the rank, split it again.  Every pass is
a partial aggregation over one pruned column that returns a bounded number of
counts; no row is shuffled, written or gathered until a range holds at most
``BOUND`` rows, whose keys are then sorted.  A single value that more rows
share is settled by the next key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from martflow.operators.keys import assign_keys, ntile_distributed

BOUND = 20_000               # rows whose keys are sorted at once for a rank
SPLITS = 1_024               # ranges that an interval is split into per pass


@dataclass(frozen=True)
class Key:
    """One column of a sort order; NULLs come first in ascending and last in
    descending order unless stated."""
    name: str
    desc: bool = False
    nulls_first: bool | None = None

    @property
    def null_leads(self) -> bool:
        return (not self.desc) if self.nulls_first is None else self.nulls_first

    def order(self) -> Column:
        c = F.col(self.name)
        if self.desc:
            return c.desc_nulls_first() if self.null_leads else c.desc_nulls_last()
        return c.asc_nulls_first() if self.null_leads else c.asc_nulls_last()

    def after(self, value) -> Column:
        """Whether a row's value comes after ``value`` in this order."""
        c = F.col(self.name)
        if value is None:
            return c.isNotNull() if self.null_leads else F.lit(False)
        later = c < F.lit(value) if self.desc else c > F.lit(value)
        return F.coalesce(later, F.lit(not self.null_leads))

    def same(self, value) -> Column:
        return F.col(self.name).isNull() if value is None else F.coalesce(F.col(self.name) == F.lit(value), F.lit(False))


def after(order: Sequence[Key], values: Sequence) -> Column:
    """Whether a row comes after the key ``values``."""
    out = order[-1].after(values[-1])
    for key, value in zip(reversed(order[:-1]), reversed(values[:-1])):
        out = key.after(value) | (key.same(value) & out)
    return out


def _whole(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(38,0)")


def _number(df: DataFrame, key: Key) -> Column | None:
    """The key as an integer of the same order; None if its type has none."""
    c, kind = F.col(key.name), df.schema[key.name].dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        n = c.cast("decimal(38,0)")
    elif isinstance(kind, T.DecimalType):
        n = (c * _whole(10 ** kind.scale)).cast("decimal(38,0)") if kind.precision + kind.scale <= 37 else None
    elif isinstance(kind, T.DateType):
        n = F.unix_date(c).cast("decimal(38,0)")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        n = F.unix_micros(c.cast("timestamp")).cast("decimal(38,0)")
    else:
        return None
    return None if n is None else -n if key.desc else n


def keys_at(df: DataFrame, order: Sequence[Key], ranks: Sequence[int], bound: int = BOUND) -> dict[int, tuple]:
    """{rank: key values} of the rows at the given 1-based ranks under ``order``;
    ranks beyond the last row are left out.  ``df`` is read a few times."""
    return {r: v for r, (v, _) in _found(df.select(*[k.name for k in order]), list(order), sorted(set(r for r in ranks if r > 0)), bound).items()}


def _found(df: DataFrame, order: list[Key], ranks: list[int], bound: int) -> dict[int, tuple[tuple, bool]]:
    """Per rank the key, and whether the next row has the same one."""
    key, number = order[0], _number(df, order[0])
    if not ranks:
        return {}
    nulls, rows, lo, hi = df.agg(F.count_if(F.col(key.name).isNull()), F.count("*"), *([F.min(number), F.max(number)] if number is not None else [F.lit(None)] * 2)).first()
    ranks = [r for r in ranks if r <= rows]
    if rows <= bound:
        return _sorted(df, order, [(r, r, None) for r in ranks])
    if number is None:
        return _ranged(df, order, ranks)
    known = rows - nulls
    first = nulls if key.null_leads else 0            # rows before the first number
    out: dict[int, tuple[tuple, bool]] = {}
    of_nulls = [r for r in ranks if (r <= first if key.null_leads else r > known)]
    shift = 0 if key.null_leads else known
    out |= {r + shift: v for r, v in _of_value(df, order, None, [r - shift for r in of_nulls], nulls, bound).items()}
    # interval -> (rows before it, rows in it, its ranks)
    todo = {(int(lo), int(hi)): (first, known, [r for r in ranks if r not in out])} if known else {}
    few: list[tuple[int, int, tuple[int, int]]] = []
    while todo:
        todo = {i: x for i, x in todo.items() if x[2]}
        for (a, e), (before, n, wanted) in list(todo.items()):
            if n <= bound:
                few += [(r, r - before, (a, e)) for r in wanted]
                del todo[a, e]
            elif a == e:
                value = df.filter(number == _whole(a)).select(key.name).first()[0]
                out |= {r + before: v for r, v in _of_value(df, order, value, [r - before for r in wanted], n, bound).items()}
                del todo[a, e]
        if todo:
            todo = _split(df, number, todo)
    if few:
        # all small intervals in one sort of their keys
        some = F.lit(False)
        for a, e in {i for _, _, i in few}:
            some = some | number.between(_whole(a), _whole(e))
        out |= _sorted(df.filter(some), order, few, number)
    return out


def _of_value(df: DataFrame, order: list[Key], value, ranks: list[int], n: int, bound: int) -> dict[int, tuple[tuple, bool]]:
    """The ranks among the rows that share one value of the first key."""
    if not ranks:
        return {}
    if len(order) == 1:
        return {r: ((value,), r < n) for r in ranks}
    rest = _found(df.filter(order[0].same(value)).select(*[k.name for k in order[1:]]), order[1:], ranks, bound)
    return {r: ((value, *v), tie) for r, (v, tie) in rest.items()}


def _split(df: DataFrame, number: Column, todo: dict) -> dict:
    """Each interval cut into ``SPLITS`` ranges; those that hold a rank."""
    place, cuts = F.lit(None).cast("long"), {}
    for i, (a, e) in enumerate(todo):
        width = -(-(e - a + 1) // SPLITS)
        cuts[i] = (a, e, width)
        off = number - _whole(a)
        at = ((off - F.pmod(off, _whole(width))) / _whole(width)).cast("long") + F.lit(i * SPLITS)
        place = F.when(number.between(_whole(a), _whole(e)), at).otherwise(place)
    counts = {int(r[0]): r[1] for r in df.select(place.alias("place")).where("place is not null").groupBy("place").count().collect()}
    out = {}
    for i, (before, _, wanted) in enumerate(todo.values()):
        a, e, width = cuts[i]
        for j in range(SPLITS):
            n = counts.get(i * SPLITS + j, 0)
            mine = [r for r in wanted if before < r <= before + n]
            if mine:
                out[a + j * width, min(e, a + (j + 1) * width - 1)] = (before, n, mine)
            before += n
    return out


def _sorted(df: DataFrame, order: list[Key], wanted: list[tuple[int, int, tuple | None]], number: Column | None = None) -> dict[int, tuple[tuple, bool]]:
    """Ranks inside intervals of few rows: (rank, rank in its interval, interval)."""
    names = [F.col(k.name) for k in order]
    rows = df.select(*names, (number if number is not None else F.lit(0)).alias("_mf_n")).orderBy(*[k.order() for k in order]).collect()
    out = {}
    for rank, place, interval in wanted:
        mine = rows if interval is None else [r for r in rows if interval[0] <= int(r[-1]) <= interval[1]]
        key = tuple(mine[place - 1])[:-1]
        out[rank] = (key, place < len(mine) and tuple(mine[place])[:-1] == key)
    return out


def _ranged(df: DataFrame, order: list[Key], ranks: list[int]) -> dict[int, tuple[tuple, bool]]:
    """A key without numbers that many rows hold: its rows are ranged."""
    numbered = assign_keys(df, [k.order() for k in order], key="_mf_no")
    near = {r["_mf_no"]: tuple(r[k.name] for k in order) for r in numbered.filter(F.col("_mf_no").isin(ranks + [r + 1 for r in ranks])).collect()}
    return {r: (near[r], near.get(r + 1) == near[r]) for r in ranks}


def ntile(df: DataFrame, buckets: int, order: Sequence[Key], out: str, bound: int = BOUND, onto: DataFrame | None = None) -> DataFrame:
    """``ntile(buckets) OVER (ORDER BY order)``: the last key of each bucket
    is selected, and a row's bucket follows from comparing it with them.

    Where rows with equal keys would be dealt to two buckets, they are told
    apart by numbering the table instead.  The column goes onto ``onto``, the
    same rows with other columns, where one is given.
    """
    onto = df if onto is None else onto
    n = df.count()
    q, r = divmod(n, buckets)
    ends = [e for e in (q * i + min(i, r) for i in range(1, buckets)) if 0 < e < n]
    cuts = _found(df.select(*[k.name for k in order]), list(order), sorted(set(ends)), bound)
    if any(tie for _, tie in cuts.values()):
        return ntile_distributed(onto, buckets, [k.order() for k in order], out)
    bucket = F.lit(1)
    for e in sorted(set(ends)):
        bucket = bucket + after(order, cuts[e][0]).cast("int") * ends.count(e)
    return onto.withColumn(out, bucket.cast("int"))
