"""Ordered and distinct string lists per owner.

A list is built in two aggregations. The first groups on (owner, sort keys,
value) and counts: it runs partially on the map side, so an owner with
millions of equal entries ships one row per map task, not millions. The
second collects the (now distinct) entries of each owner, sorts them inside
the array and repeats each value by its count, which gives exactly the text of
``array_join(transform(array_sort(collect_list(struct(k, v))), x -> x.v))``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATOR = ", "


def ordered_list(df: DataFrame, group_cols, order_cols, value: str, out: str,
                 sep: str = SEPARATOR, distinct: bool = False, empty_as_null: bool = False) -> DataFrame:
    """One row per group: values joined by ``sep`` in (order_cols, value) order.

    Null sort keys come first (struct order); null values are skipped, so a
    group of only nulls gives ``''`` (R6). With ``distinct`` duplicates of the
    value appear once in a group, at their first place by ``order_cols``. With ``empty_as_null`` a group
    without any non-null value gives null, as SQL ``listagg`` does.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    keys = [F.col(c) for c in order_cols] + [F.col(value)]
    pre = df.groupBy(*group_cols, *keys).agg(F.count(F.lit(1)).alias("_n"))
    fields = [F.col(c).alias(f"k{i}") for i, c in enumerate(order_cols)]
    entry = F.struct(*fields, F.col(value).alias("v"), F.col("_n").alias("n"))
    # sort_array orders with the type's own ordering (no per-comparison lambda);
    # the entries are structs, never null, so it agrees with array_sort.
    agg = pre.groupBy(*group_cols).agg(F.sort_array(F.collect_list(entry)).alias("_entries"),
                                       F.count(F.col(value)).alias("_values"))
    if distinct:
        # field of an array of structs (compiled, no lambda); of equal values the first in order stays
        values = F.array_distinct(F.col("_entries.v"))
    else:
        values = F.flatten(F.transform("_entries", lambda x: F.array_repeat(x["v"], x["n"].cast("int"))))
    text = F.array_join(values, sep)
    if empty_as_null:
        text = F.when(F.col("_values") > 0, text)
    return agg.select(*group_cols, text.alias(out))


def distinct_list(df: DataFrame, group_cols, value: str, out: str, sep: str = SEPARATOR) -> DataFrame:
    """Sorted distinct values per group joined by ``sep``.

    ``collect_set`` deduplicates on the map side; nulls are skipped, so a group
    without values gives ``''``.
    """
    return (df.groupBy(*group_cols)
            .agg(F.array_join(F.sort_array(F.collect_set(F.col(value))), sep).alias(out)))
