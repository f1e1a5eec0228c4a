"""Column expressions for the reference's scalar functions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from martflow.constants import DESCRIPTOR_SEPARATOR, DOC_TS_FORMAT, VALIDITY_SENTINEL


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def split_descriptor(c: str | Column, pattern: str = DESCRIPTOR_SEPARATOR) -> Column:
    """REGEXP_SPLIT_TO_ARRAY(s, ':+')."""
    return F.split(_c(c), pattern)


def part(arr: str | Column, i: int) -> Column:
    """1-based subscript, NULL when out of range (never raises under ANSI)."""
    return F.get(_c(arr), i - 1)


def time_of_day(ts: str | Column) -> Column:
    """Interval since midnight, exact to the microsecond."""
    ts = _c(ts)
    return ts - F.to_date(ts).cast("timestamp_ntz")


def age_day_part(a: str | Column, b: str | Column) -> Column:
    """DATE_PART('day', AGE(a, b)) -- the day *component* of the
    symbolic difference, not the number of days between.

    With lo/hi the smaller/larger stamp: d = day(hi) - day(lo), minus one
    when hi's time of day is before lo's; a negative d borrows the length
    of lo's month.  The sign is negative when a < b.
    """
    a, b = _c(a), _c(b)
    lo, hi = F.least(a, b), F.greatest(a, b)
    d = F.dayofmonth(hi) - F.dayofmonth(lo) - (time_of_day(hi) < time_of_day(lo)).cast("int")
    # d stands outside the conditionals, so that generated code computes it once;
    # least and greatest skip NULL, AGE doesn't: the sign of such a pair is NULL
    borrowed = F.when(d < 0, F.dayofmonth(F.last_day(lo))).otherwise(0)
    return ((d + borrowed) * F.when(a < b, -1).when(a >= b, 1)).cast("int")


def month_name_padded(d: str | Column) -> Column:
    """TO_CHAR(d, 'month') -- lower-case name blank-padded to 9."""
    return F.rpad(F.lower(F.date_format(_c(d), "MMMM")), 9, " ")


def parse_doc_ts(s: str | Column) -> Column:
    """strptime('%Y-%m-%d %H:%M:%S') -> timestamp without zone."""
    return F.to_timestamp_ntz(_c(s), F.lit(DOC_TS_FORMAT))


def format_doc_ts(ts: str | Column) -> Column:
    return F.date_format(_c(ts), DOC_TS_FORMAT)


def time_text(ts: str | Column) -> Column:
    """Time part as 'HH:mm:ss' (TIME type is off by default in 4.1)."""
    return F.date_format(_c(ts), "HH:mm:ss")


def sentinel() -> Column:
    return F.lit(VALIDITY_SENTINEL).cast("timestamp_ntz")


def to_json_keep_nulls(struct: Column) -> Column:
    """Document -> JSON text with ids as text, stamps as
    'yyyy-MM-dd HH:mm:ss' and NULL fields kept (the default drops them)."""
    return F.to_json(struct, {"timestampNTZFormat": DOC_TS_FORMAT,
                              "timestampFormat": DOC_TS_FORMAT,
                              "ignoreNullFields": "false"})
