import datetime as dt

import pytest

from conftest import SF0001
from oracle_check import duck, rows_of
from tessera.sources import relations as R
from tessera.sources.tables import read_csv, run_stamp, write_csv


@pytest.mark.parametrize("name", sorted(R.RELATIONS))
def test_relation_same_rows_in_spark_and_duckdb(spark, name):
    df = R.frame(spark, SF0001, name)
    con = duck(SF0001)
    res = con.execute(f"{R.cte(name)} SELECT * FROM {name}")
    spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    duck_rows = rows_of([c[0] for c in res.description], res.fetchall())
    assert spark_rows == duck_rows


def test_snapshot_same_rows_in_spark_and_duckdb(spark):
    df = R.snapshot(spark, SF0001, "199807", current=True)
    res = duck(SF0001).execute(R.snapshot_sql("199807", True, "duckdb"))
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(
        [c[0] for c in res.description], res.fetchall())
    assert R.period_bounds("199812") == ("1998-12-01 00:00:00", "1999-01-01 00:00:00")


def test_csv_sink_options_and_stamp(spark, tmp_path):
    df = spark.createDataFrame([("a;b", "x"), ("", None)], "p string, q string")
    path = write_csv(df, str(tmp_path / "out.csv_tmp"), single_file=True, sep=";")
    parts = [p for p in (tmp_path / "out.csv_tmp").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    back = read_csv(spark, path, df.schema, sep=";")
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted([("a;b", "x"), ("", None)], key=str)
    assert run_stamp(dt.datetime(2024, 1, 2, 3, 4, 5)) == "20240102030405"


def test_csv_keeps_blanks_quotes_line_breaks_and_encoding(spark, tmp_path):
    rows = [(" 001 ", "a\nb"), ('say "x"', "tab\t"), ("ñandú", "c,d")]
    df = spark.createDataFrame(rows, "p string, q string")
    for encoding in ("UTF-8", "UTF-16LE"):
        path = write_csv(df, str(tmp_path / encoding), encoding=encoding)
        back = read_csv(spark, path, df.schema, encoding=encoding)
        assert sorted(tuple(r) for r in back.collect()) == sorted(rows)


def test_exports_keep_null_empty_and_line_breaks_and_split(spark, tmp_path):
    from tessera.sources.tables import csv_lines, parse_csv_lines
    texts = [None, "", " ", "\n", "a\r\nb", "\\", "\\n", "\\N", "\\b\\", '"', '""', ',', "\\\n\\", "N", "null", "#x"]
    df = spark.createDataFrame([(t, i, u) for i, t in enumerate(texts) for u in (None, "", "\\N", "x\ny")],
                               "`p q` string, i int, r string")
    path = write_csv(df, str(tmp_path / "out"))
    back = read_csv(spark, path, df.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    lines = csv_lines(df)
    assert not [r.line for r in lines.collect() if "\n" in r.line or "\r" in r.line]
    again = parse_csv_lines(lines, df.schema)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    written = {line for part in (tmp_path / "out").glob("part-*") for line in part.read_text().split("\n")[1:] if line}
    assert written == {r.line for r in lines.collect()}
    big = spark.range(2000).selectExpr("concat('x\\n', id) AS t").coalesce(1)
    one = read_csv(spark, write_csv(big, str(tmp_path / "big")), big.schema)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        split = read_csv(spark, str(tmp_path / "big"), big.schema)
        assert split.rdd.getNumPartitions() > 1 and split.exceptAll(one).count() == 0 and split.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_stored_snapshots_are_read_by_period_and_joined_without_a_shuffle(spark):
    from tessera.plans.catalog import QUERIES
    one = R.read_snapshot(spark, SF0001, "199807")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(STRANOMES" in plan and "= 199807" in plan
    direct = R.snapshot(spark, SF0001, "199807", True).select(one.columns)
    assert one.count() == direct.count() > 0
    assert one.exceptAll(direct).count() == direct.exceptAll(one).count() == 0
    assert R.snapshot_store(spark, SF0001).select("STRANOMES").distinct().count() > 12
    for name in ("period_full_outer", "period_compare", "period_compare_unique"):
        for threshold in ("-1", "10485760"):
            old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                df = QUERIES[name](spark, SF0001)
                plan = df._jdf.queryExecution().executedPlan().toString()
                assert "Exchange hashpartitioning" not in plan
                assert "Bucketed: true" in plan or threshold != "-1"  # a small side is broadcast instead
                assert plan.count("Scan parquet") == (1 if name == "period_compare_unique" else 2)
            finally:
                spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_added_columns_are_no_matter(spark, tmp_path):
    from tessera.sources.tables import table
    spark.createDataFrame([(1, "R", "x")], "r_regionkey int, r_name string, more string").write.parquet(
        str(tmp_path / "region.parquet"))
    assert table(spark, str(tmp_path), "region").collect() == [(1, "R")]


def lines(spark, folder, rows):
    """A folder with order lines of (part, supplier, price, ship date)."""
    spark.createDataFrame(
        [(i, part, supp, i % 7 + 1, 2.0, price, 0.05, 0.02, "AN"[i % 2], "F", day) for i, (part, supp, price, day) in enumerate(rows)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return str(folder)


def test_snapshot_of_null_negative_and_repeated_keys(spark, tmp_path):
    days = [None, dt.datetime(1998, 6, 30), dt.datetime(1998, 7, 1), dt.datetime(2000, 12, 31)]
    rows = [(p, s, x, d) for p in (None, -3, 7, 57, 85) for s in (None, -13, 0, 9, 13) for x in (None, -10.25, 99.5)
            for d in days for _ in range(2)]
    folder = lines(spark, tmp_path, rows)
    for period in (None, "199807"):
        for deal in (None, (5, ("STRCLINIT", "STROBLOBLIGSARC"))):
            df = R.snapshot(spark, folder, period, True, deal)
            args = {} if period is None else dict(zip(("start", "end"), R.period_bounds(period)), period=period)
            told = R.sql(spark, R.snapshot_sql(period, True, "spark"), args, lineitem=R.table(spark, folder, "lineitem"))
            assert df.dtypes == told.dtypes and df.count() == told.count() > 0
            assert df.exceptAll(told).count() == told.exceptAll(df).count() == 0


@pytest.mark.parametrize("name", ["provision_sums", "period_measures", "period_suffix"])
def test_wide_period_projections_are_compiled_in_parts(spark, name, capsys):
    """The JIT leaves methods of more than 8000 bytes to the interpreter."""
    import re
    from tessera.plans.catalog import QUERIES
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        QUERIES[name](spark, SF0001).explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_store_has_buckets_by_its_lines_and_deals_short_rows(spark, tmp_path, monkeypatch):
    from tessera.plans.catalog import QUERIES
    assert R.snapshot_buckets(0) == R.snapshot_buckets(4_000_000) == 4 and R.snapshot_buckets(216_000_001) == 217
    monkeypatch.setattr(R, "LINES_PER_BUCKET", 20)
    days = [dt.datetime(1998, 6, 3), dt.datetime(1998, 7, 4), dt.datetime(1999, 1, 5)]
    folder = lines(spark, tmp_path, [(p, s, 10.0 * p + s, d) for p in range(5) for s in range(20) for d in days])
    store = R.snapshot_store(spark, folder)
    name = R._STORES[(spark.sparkContext.applicationId, folder)]
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    assert told["Num Buckets"] == "15"
    direct = R.snapshot(spark, folder, None, True).select(store.columns)
    assert store.exceptAll(direct).count() == direct.exceptAll(store).count() == 0
    plan = QUERIES["period_full_outer"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan
    dealt = R.snapshot(spark, folder, None, True, (15, ("STRCLINIT", "STROBLOBLIGSARC")))
    plan = dealt.repartition(15, "STRCLINIT", "STROBLOBLIGSARC")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 1 and plan.index("Generate explode") < plan.index("REPARTITION_BY_NUM")


def test_duplicate_keys_are_counted_where_their_groups_are_dealt(spark):
    from tessera.plans.catalog import QUERIES
    df = QUERIES["duplicate_keys"](spark, SF0001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    counted = plan[:plan.index("Generate explode")]
    assert "Exchange" not in counted and "REPARTITION_BY_NUM" in plan
    assert df.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions"))  # not joined to a few
