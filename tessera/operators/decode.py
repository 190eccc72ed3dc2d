"""Code-list decoding.

A code list is one relation ``(list_type, name, val, high, desc_text,
active_flg)`` holding every list; a decode is a left join of the facts with
the active rows of one list. No broadcast is forced: lists are value domains, so
the planner sees their size and broadcasts them by the session's byte bound,
or joins by sort-merge past it.

Several lists are decoded from one read: ``labels`` turns the relation into
(list and code, label) rows, and every ``decode_by`` joins that same frame on one
key, so Spark builds its hash table (or its shuffle) once and uses it again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Renames applied when a list is read.
LIST_COLUMNS = {"name": "code_name", "val": "code_val", "high": "code_high", "desc_text": "code_desc"}


def active_lists(codes: DataFrame, types, type_col: str = "list_type",
                 active_col: str = "active_flg") -> DataFrame:
    """One read for several list types, active rows only, columns renamed."""
    return (codes.filter(F.col(type_col).isin(*types) & (F.col(active_col) == "Y"))
            .withColumnsRenamed(LIST_COLUMNS))


def one_list(lists: DataFrame, list_type: str, key: str, label: str,
             type_col: str = "list_type") -> DataFrame:
    """Split one type out of ``active_lists`` as ``(key, label)``."""
    return lists.filter(F.col(type_col) == list_type).select(
        F.col(key).alias("_code"), F.col(label).alias("_label"))


def decode(df: DataFrame, code_list: DataFrame, key: str, out: str, how: str = "left",
           label_expr=None) -> DataFrame:
    """Add ``out`` = label of ``df[key]`` in ``code_list`` (from ``one_list``).

    ``how='left'`` keeps facts without a label (J4); ``'inner'`` drops them.
    A code listed twice multiplies the fact row, as a join does (see
    ``duplicate_codes``). ``label_expr`` maps the label column (e.g. cleaning).
    """
    tag = f"_{out}"
    side = code_list.select(F.col("_code").alias(tag + "_code"), F.col("_label").alias(tag + "_label"))
    label = F.col(tag + "_label")
    joined = df.join(side, F.col(key) == F.col(tag + "_code"), how)
    return joined.withColumn(out, label_expr(label) if label_expr else label).drop(
        tag + "_code", tag + "_label")


# Between a list's type and a code in a joint key; no type holds it.
SEPARATOR = "|"


def by_type(shapes: dict[str, tuple[str, str]], which: int, type_col: str = "list_type") -> Column:
    """The key column (``which`` 0) or label column (1) of each list type; null for other types."""
    out = F
    for list_type, columns in shapes.items():
        out = out.when(F.col(type_col) == list_type, F.col(columns[which]))
    return out


def labels(codes: DataFrame, shapes: dict[str, tuple[str, str]], type_col: str = "list_type",
           active_col: str = "active_flg") -> DataFrame:
    """``(list_code, label)`` of the active rows of several lists, from one read.

    ``shapes`` gives each list type its key and label column; types differ in
    them, whatever the other columns hold.
    """
    code = F.concat(F.col(type_col), F.lit(SEPARATOR), by_type(shapes, 0, type_col))
    return (codes.filter(F.col(type_col).isin(*shapes) & (F.col(active_col) == "Y"))
            .select(code.alias("list_code"), by_type(shapes, 1, type_col).alias("label")))


def unique_labels(labelled: DataFrame) -> DataFrame:
    """``(list_code, label, n_dropped)``: one row per code, its least label, and how many others it had.

    A decode by it repeats no fact. Codes repeated with one label count as dropped, too.
    """
    of_code = Window.partitionBy("list_code")
    ranked = labelled.filter(F.col("list_code").isNotNull()).select(
        "list_code", "label", F.row_number().over(of_code.orderBy(F.col("label").asc_nulls_last())).alias("_rank"),
        (F.count(F.lit(1)).over(of_code) - 1).alias("n_dropped"))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def decode_by(df: DataFrame, labelled: DataFrame, list_type: str, key: str, out: str, how: str = "left",
              label_expr=None) -> DataFrame:
    """Add ``out`` = label of ``df[key]`` in one list of ``labels``.

    The list is chosen in the joint key of the facts, not by a filter on the
    labels, so all decodes have the same right side. A code listed twice
    repeats the fact, as a join does, unless the labels are ``unique_labels``.
    """
    tag = f"_{out}"
    side = labelled.select(F.col("list_code").alias(tag + "_code"), F.col("label").alias(tag + "_label"))
    label = F.col(tag + "_label")
    joined = df.join(side, F.concat(F.lit(list_type + SEPARATOR), F.col(key)) == F.col(tag + "_code"), how)
    return joined.withColumn(out, label_expr(label) if label_expr else label).drop(tag + "_code", tag + "_label")


def duplicate_codes(codes: DataFrame, shapes: dict[str, tuple[str, str]], type_col: str = "list_type",
                    active_col: str = "active_flg") -> DataFrame:
    """Codes listed more than once within a type (D17): they would multiply rows."""
    return (codes.groupBy(F.col(type_col).alias("list_type"), by_type(shapes, 0, type_col).alias("code"))
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.when(F.col(active_col) == "Y", 1).otherwise(0)).alias("n_active"))
            .filter(F.col("n_rows") > 1))
