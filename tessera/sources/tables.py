"""Scans and sinks.

The jobs read warehouse relations by SQL text and write one CSV export. Here a
relation is a parquet table; SQL text runs through ``spark.sql`` with the
frames passed as arguments (no global views, so two folders can be read in one
session), and parameters go in as named markers, never by string formatting.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

# Tables of the test folders (TESTDATA.md) and their columns. With the schema
# given, planning a query reads no footer and runs no job, and a changed table
# is read as these columns, never by a remembered inference.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}
TABLES = tuple(SCHEMAS)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table. Column pruning and filters reach the scan."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql(spark: SparkSession, text: str, args: dict | None = None, **frames: DataFrame) -> DataFrame:
    """Run SQL text over frames given as ``{name}`` references.

    ``args`` binds ``:name`` parameter markers (S2); values are never pasted
    into the text.
    """
    return spark.sql(text, args=args or {}, **frames)


def run_stamp(now: _dt.datetime | None = None) -> str:
    """Folder stamp ``yyyyMMddHHmmss`` (E12); pass ``now`` to make it fixed."""
    return (now or _dt.datetime.now()).strftime("%Y%m%d%H%M%S")


# A cell is text without line breaks: a backslash, a line feed and a carriage return are
# written as two characters, so a part file can be cut at any line. Null is a mark that
# no text gives, and an empty text is a quoted nothing; blanks stay at either end,
# quotes are doubled.
ESCAPES = (("\\", "\\b"), ("\n", "\\n"), ("\r", "\\r"))
NULL_MARK = "\\N"
EXACT = {"quote": '"', "escape": '"', "nullValue": NULL_MARK, "emptyValue": "",
         "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _text_columns(df: DataFrame, change) -> DataFrame:
    return df.select(*[change(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f"`{f.name}`") for f in df.schema])


def encode_cells(df: DataFrame) -> DataFrame:
    """Text columns as CSV cells without line breaks."""
    def encoded(c):
        for plain, code in ESCAPES:
            c = F.replace(c, F.lit(plain), F.lit(code))
        return c

    return _text_columns(df, encoded)


def decode_cells(df: DataFrame) -> DataFrame:
    """The text of ``encode_cells``: every backslash begins a code, so the codes are undone last to first."""
    def decoded(c):
        for plain, code in reversed(ESCAPES):
            c = F.replace(c, F.lit(code), F.lit(plain))
        return c

    return _text_columns(df, decoded)


def write_csv(df: DataFrame, path: str, single_file: bool = False, sep: str = ",",
              encoding: str = "UTF-8") -> str:
    """CSV export with a header, overwrite mode (S9, S10, H3). Null and empty text stay apart.

    ``single_file`` funnels the export through one task (``coalesce(1)``): only
    for exports known to be small. By default every partition writes its part.
    The target is a folder of ``part-*.csv`` files.
    """
    out = encode_cells(df.coalesce(1) if single_file else df)
    (out.write.mode("overwrite")
        .options(header="true", sep=sep, encoding=encoding, **{**EXACT, "emptyValue": '""'})
        .csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
             encoding: str = "UTF-8") -> DataFrame:
    """Read an export back with an explicit schema (no inference pass); every text is what was written.

    No cell holds a line break, so a large part file is split over many tasks
    (not in an encoding of two or four bytes, whose lines Spark doesn't find by themselves).
    """
    whole = str(encoding.upper().startswith(("UTF-16", "UTF-32"))).lower()
    return decode_cells(spark.read.schema(schema)
                        .options(header="true", sep=sep, encoding=encoding, multiLine=whole, **EXACT)
                        .csv(path))


def csv_lines(df: DataFrame, sep: str = ",") -> DataFrame:
    """``(line)``: each row as the line that ``write_csv`` writes for it."""
    cells = encode_cells(df)
    row = F.struct(*[F.col(f"`{c}`") for c in cells.columns])
    return cells.select(F.to_csv(row, {"sep": sep, **EXACT, "emptyValue": '""'}).alias("line"))


def parse_csv_lines(lines: DataFrame, schema: StructType, sep: str = ",") -> DataFrame:
    """The rows of ``csv_lines``."""
    text = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    parsed = lines.select(F.from_csv("line", text, {"sep": sep, **EXACT}).alias("row"))
    return decode_cells(parsed.select("row.*"))
