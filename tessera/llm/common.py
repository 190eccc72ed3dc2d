"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder, its lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package's modules, once per application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="tessera-modules-"), "tessera-modules.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "tessera")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def mapped(df: DataFrame, function: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with this package at hand in the tasks, whatever the columns' names."""
    ship(df.sparkSession)
    names = df.columns
    if all(name.isidentifier() for name in names):
        return df.mapInArrow(function, schema)

    def renamed(batches):  # Spark takes names with dots and quotes apart
        return function(batch.rename_columns(names) for batch in batches)

    return df.toDF(*[f"c{i}" for i in range(len(names))]).mapInArrow(renamed, schema)


def held_out(doc_id: Column) -> Column:
    """True if crc32 of the id as text leaves no remainder by 5 (false for a null id)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def row_key(doc_id: Column, text: Column) -> Column:
    """128-bit key of a row's id and text; only rows equal in both share it. Never null."""
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")),
                          F.when(text.isNull(), F.lit("\x00null")).otherwise(F.concat(F.lit("\x00="), text))))


def named(column: str, parent: str | None = None) -> Column:
    """The column (or field of a struct column) of that very name, dots and quotes included."""
    quoted = "`" + column.replace("`", "``") + "`"
    return F.col(quoted if parent is None else f"{parent}.{quoted}")


def boxed(docs: DataFrame, box: str = "doc") -> Column:
    """All columns of ``docs`` in one struct, so that an operator's own columns can't clash with them."""
    return F.struct(*[named(c) for c in docs.columns]).alias(box)


def unboxed(docs: DataFrame, box: str = "doc") -> list[Column]:
    """The columns of ``docs`` out of that struct."""
    return [named(c, box).alias(c) for c in docs.columns]


def sampled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The small ``sample``'s columns (``doc_id`` among them) and ``text``: one row per id, its smallest text."""
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return found.groupBy(*sample.columns).agg(F.min("text").alias("text"))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts; null is the empty text."""
    return [t if t is not None else "" for t in batch.column(column).to_pylist()]


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> Iterator[bytes]:
    """The batch's texts as UTF-8 bytes, one after the other; null is empty."""
    col = batch.column(column).cast(pa.binary())
    for value in col:
        yield value.as_py() or b""


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns appended."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()],
                                      names=[*batch.schema.names, *columns])


def row_slices(batch: pa.RecordBatch, limit: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batch in slices of consecutive rows with ``limit`` bytes in the column at most (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and total + size > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield batch.slice(start)


# Keys given to every task by join_totals: at most so many have over one in so many of all rows.
HOT_KEYS = 1 << 10


def join_totals(rows: DataFrame, totals: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` joined with ``totals`` (one row per key, ``n`` of them in ``rows``) on ``key``, which is never null.

    Keys with over one in ``HOT_KEYS`` of all rows, fewer than ``HOT_KEYS`` of
    them, are broadcast; the others are joined by a shuffle that none of them
    makes uneven. ``rows`` is read twice, so it should be stored.
    """
    every = totals.agg(F.sum(n)).first()[0] or 0
    hot = totals.where(F.col(n) * HOT_KEYS > every)
    cold = totals.where(F.col(n) * HOT_KEYS <= every)
    near = rows.join(F.broadcast(hot), key)
    far = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key)
    return near.unionByName(far)
