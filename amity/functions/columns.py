"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts the reference prints.
DOB_PATTERN = "M/d/yyyy"          # birth dates in user profiles, e.g. 8/27/1970
LIST_SEP = ","                    # ids inside an adjacency line / mutual list
FIELD_SEP = "\t"                  # key / value separator of text outputs
PRINTED_LIST_SEP = ", "           # java List.toString separator, "[a, b]"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_id(c: Column | str) -> Column:
    """Text id -> bigint; NULL for anything that is not a whole number.
    Surrounding blanks are accepted and leading zeros ignored ("007" = 7)."""
    return col_of(c).try_cast("bigint")


def parse_dob(c: Column | str, pattern: str = DOB_PATTERN) -> Column:
    """Birth-date text -> date, NULL when it does not parse."""
    return F.try_to_date(col_of(c), pattern)


def as_date(value: Column | str | _dt.date | None) -> Column:
    """Date literal / column; ``None`` means today (``current_date()``)."""
    if value is None:
        return F.current_date()
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.date):
        return F.lit(value)
    return F.to_date(F.lit(value))


def age_years(dob: Column | str, as_of: Column | str | _dt.date | None = None) -> Column:
    """Calendar age in whole years on ``as_of``: year difference, minus one
    while the birthday of that year has not come yet. NULL birth date gives
    NULL. Feb 29 birthdays count from Mar 1 in common years."""
    d = col_of(dob)
    a = as_date(as_of)
    before_birthday = (F.month(a) < F.month(d)) | (
        (F.month(a) == F.month(d)) & (F.dayofmonth(a) < F.dayofmonth(d)))
    return (F.year(a) - F.year(d) - F.when(before_birthday, 1).otherwise(0)).cast("int")


def pair_lo(a: Column | str, b: Column | str) -> Column:
    return F.least(col_of(a), col_of(b))


def pair_hi(a: Column | str, b: Column | str) -> Column:
    return F.greatest(col_of(a), col_of(b))


def id_list_text(arr: Column | str, sep: str = LIST_SEP) -> Column:
    """array<bigint> -> "1,2,10" in numeric order (not text order)."""
    return F.array_join(F.array_sort(col_of(arr)), sep)


def printed_list(arr: Column | str) -> Column:
    """array<string> -> "[a, b]" the way a java list prints."""
    return F.concat(F.lit("["), F.array_join(col_of(arr), PRINTED_LIST_SEP), F.lit("]"))


def row_text(*cols: Column | str) -> Column:
    """Row -> "[a,b,c]" like a Spark Row prints; NULL shows as "null"."""
    parts = [F.coalesce(_as_text(col_of(c)), F.lit("null")) for c in cols]
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def tsv_text(*cols: Column | str, sep: str = FIELD_SEP, null: str = "") -> Column:
    """Fields joined by TAB; NULL shows as ``null`` text (default empty) so
    that field positions never shift. Callers turn arrays into text first."""
    parts = [F.coalesce(_as_text(col_of(c)), F.lit(null)) for c in cols]
    return F.concat_ws(sep, *parts)


def _as_text(c: Column) -> Column:
    return c.cast("string")
