"""The reference's text output layouts, one ``value`` line per result row.

Each function takes the DataFrame an operator returns and renders the line
the matching reference program prints; write them with
``write_text(df, path)`` or ``df.write.text(path)``. A NULL field prints
``null`` as the reference's string concatenation does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amity.functions.columns import FIELD_SEP, id_list_text, printed_list, row_text
from amity.operators.graph import mutual_friend_lists


def _txt(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("null"))


def mutual_friend_lines(mutual_long: DataFrame) -> DataFrame:
    """E1: ``u<TAB>v<TAB>f1,f2,...`` (ids ascending; empty list for none)."""
    lists = mutual_friend_lists(mutual_long)
    return lists.select(F.concat_ws(FIELD_SEP, _txt("u"), _txt("v"), id_list_text("mutual")).alias("value"))


def pair_count_lines(counts: DataFrame) -> DataFrame:
    """E2 / E2a: ``u,v<TAB>n``."""
    return counts.select(F.concat(_txt("u"), F.lit(","), _txt("v"), F.lit(FIELD_SEP), _txt("n_mutual"))
                         .alias("value"))


def named_pair_lines(named: DataFrame) -> DataFrame:
    """E3: ``n<TAB>first<TAB>last<TAB>address`` for u, then for v."""
    cols = ["n_mutual", "first_u", "last_u", "address_u", "first_v", "last_v", "address_v"]
    return named.select(F.concat_ws(FIELD_SEP, *[_txt(c) for c in cols]).alias("value"))


def profile_list_lines(profiles_of_pair: DataFrame) -> DataFrame:
    """E4: ``u,v<TAB>[name:dob, name:dob]`` -- one line per pair, entries in
    text order. The list is one pair's mutual friends (bounded by the
    smaller friend list of the two)."""
    entry = F.concat(_txt("first_name"), F.lit(":"), _txt("dob"))
    grouped = (profiles_of_pair.groupBy("u", "v")
               .agg(F.array_sort(F.collect_list(entry)).alias("entries")))
    return grouped.select(F.concat(_txt("u"), F.lit(","), _txt("v"), F.lit(FIELD_SEP),
                                   printed_list("entries")).alias("value"))


def oldest_friend_lines(top: DataFrame) -> DataFrame:
    """E5: ``user<TAB>address,city,state,age``."""
    rest = F.concat_ws(",", _txt("address"), _txt("city"), _txt("state"), _txt("max_friend_age"))
    return top.select(F.concat(_txt("user_id"), F.lit(FIELD_SEP), rest).alias("value"))


def row_lines(df: DataFrame) -> DataFrame:
    """E6 / E7: ``[a,b,...]`` as a Row prints; arrays as ``[x, y]``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.typeName() == "array":
            c = printed_list(c.cast("array<string>"))
        cols.append(c)
    return df.select(row_text(*cols).alias("value"))
