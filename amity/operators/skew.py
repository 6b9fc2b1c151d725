"""Joins of a large, possibly skewed table to a lookup table.

In a friendship graph one user may hold a third of all edges; a plain
shuffle join would send all of that user's rows to one task.
``lookup_join`` spreads the rows of hot keys over several tasks:

* ``pieces`` (from ``hot_pieces``) names every key above a row threshold and
  the number of pieces for it. The threshold is at least the total number of
  rows / ``MAX_HOT``, so by arithmetic no more than ``MAX_HOT`` keys can
  exceed it: the table has a proven size bound and leaves no hot key out;
* it is broadcast; every row of the big side learns how many pieces its
  key is split into and takes a salt from a hash of its own columns
  (deterministic, so a re-run task after a lost executor routes every row
  the same way);
* the lookup rows of a hot key are repeated once per piece; cold keys have
  one piece, so they join exactly as in a plain shuffle join.

The join carries no hint: a sort-merge join, which can spill, unless adaptive
execution finds the partitions small enough for something faster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOOR_ROWS = 2_000_000  # below this a key is never worth splitting
MAX_HOT = 1_000_000     # keys a hot-key table can hold (about 20 MB)

_PIECES = "__pieces"
_SALT = "__salt"


def piece_rows(counts: DataFrame, count_col: str, floor_rows: int | None = None, max_hot: int = MAX_HOT) -> Column:
    """Rows of a key that one task takes: ``max(floor_rows, total rows /
    max_hot)``, the total being a scalar subquery of the same plan."""
    floor = FLOOR_ROWS if floor_rows is None else floor_rows
    total = counts.agg(F.sum(count_col)).scalar()
    return F.greatest(F.lit(floor).cast("bigint"), F.ceil(F.coalesce(total, F.lit(0)) / F.lit(max_hot)).cast("bigint"))


def hot_pieces(counts: DataFrame, key: str, count_col: str, floor_rows: int | None = None,
               max_hot: int = MAX_HOT, rows: Column | None = None) -> DataFrame:
    """``(key, __pieces)`` for every key with more than ``piece_rows`` rows."""
    rows = piece_rows(counts, count_col, floor_rows, max_hot) if rows is None else rows
    return (counts.where(F.col(count_col) > rows)
            .select(key, F.ceil(F.col(count_col) / rows).cast("int").alias(_PIECES)))


def lookup_join(big: DataFrame, lookup: DataFrame, key: str,
                pieces: DataFrame | None = None, how: str = "left", spread: Column | None = None) -> DataFrame:
    """``big`` join ``lookup`` on ``key``.

    ``pieces`` is a bounded ``(key, __pieces)`` table from ``hot_pieces``;
    ``None`` gives a plain join. ``how`` is ``left`` or ``inner``. ``spread``
    is the number of pieces where ``lookup`` itself knows it, which saves a
    join. Output: the columns of ``big`` then the value columns of ``lookup``.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    values = [c for c in lookup.columns if c != key]
    if pieces is None:
        return big.join(lookup, key, how).select(*big.columns, *values)
    p = F.broadcast(pieces.select(key, _PIECES))
    n = F.coalesce(F.col(_PIECES), F.lit(1))
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), n).cast("int")
    salted_big = big.join(p, key, "left").select(*big.columns, salt.alias(_SALT))
    known = lookup.join(p, key, "left") if spread is None else lookup
    spread_lookup = known.select(key, *values, F.explode(F.sequence(F.lit(0), (n if spread is None else spread) - 1)).alias(_SALT))
    return (salted_big.join(spread_lookup, [key, _SALT], how)
            .select(*big.columns, *values))
