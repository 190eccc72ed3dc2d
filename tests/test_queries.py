"""Every registered query against its DuckDB oracle at sf0.01, plus schema and determinism."""

import pytest

from conftest import SF001, SF0001
from oracle_check import check, duck, rows_of
from tessera.plans.catalog import ORACLE, QUERIES
from tessera.plans.profile import REPORT_COLUMNS


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert name in ORACLE, f"{name} has no oracle SQL"
    r = check(spark, con, name, SF001)
    assert r["status"] == "ok", r
    assert "type_diffs" not in r, r["type_diffs"]


def test_report_schemas(spark):
    final = QUERIES["profile_final"](spark, SF0001)
    assert tuple(final.columns) == REPORT_COLUMNS
    assert all(t == "string" for _, t in final.dtypes)
    gated = QUERIES["profile_gated"](spark, SF0001)
    assert tuple(gated.columns) == REPORT_COLUMNS + ("CANAL_CONTACTO_FINAL",)
    excluded = QUERIES["profile_excluded"](spark, SF0001)
    assert tuple(excluded.columns) == REPORT_COLUMNS + ("CANAL_DE_CONTACTO",)


def test_period_schema(spark):
    out = QUERIES["period_compare"](spark, SF0001)
    assert len(out.columns) == 98
    assert out.columns[:2] == ["STRCLINIT", "STROBLOBLIGSARC"] and out.columns[-1] == "DIFERENCIAL_ACUM"
    assert sum(c.endswith("_ANT") for c in out.columns) == 47
    assert sum(c.endswith("_ACT") for c in out.columns) == 48


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_for_any_partitioning(spark, name):
    results = []
    for n in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        df = QUERIES[name](spark, SF0001)
        results.append(rows_of(df.columns, [tuple(r) for r in df.collect()]))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_exclusion_properties(spark):
    """L3 output keys are disjoint from refused keys; gate output is a subset of the report."""
    from tessera.operators import consent as C
    from tessera.plans import profile as PR
    from tessera.functions.text import doc_key
    f = PR.load(spark, SF001)
    newest = C.newest_consent(C.tagged(f, (C.LAW_A, C.FORM)))
    refused = {r[0] for r in C.refused(newest).collect()}
    out = PR.profile_excluded(f, sort=False).select(doc_key("IDENT").alias("d"))
    assert refused and not ({r[0] for r in out.collect()} & refused)
    report = {r[0] for r in PR.profile_final(f, sort=False).select("IDENT").collect()}
    gated = {r[0] for r in PR.profile_gated(f, sort=False).select("IDENT").collect()}
    assert gated and gated <= report


def test_export_job_checkpoints_and_writes(spark, tmp_path):
    from tessera.plans.jobs import run_export
    out = run_export(spark, SF0001, "gated", out_dir=str(tmp_path))
    assert out["counts"]["report"] == spark.read.option("header", "true").csv(out["path"]).count()
    assert len(out["preview"]) == min(10, out["counts"]["report"]) and out["counts"]["report"] > 0
    names = [p["CLIENTE"] for p in out["preview"]]
    assert names == sorted(names)


SLOW_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
              "SortAggregate", "FlatMapGroupsInPandas")


def slow_nodes(name):
    # The unique comparison takes the least of text columns, over buckets that hold whole keys.
    return [n for n in SLOW_NODES if not (name == "period_compare_unique" and n == "SortAggregate")]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_cross_join_python_or_sort_aggregate(spark, name):
    plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in slow_nodes(name) if n in plan]


@pytest.mark.parametrize("setting,value", [("spark.sql.session.timeZone", "America/New_York"),
                                           ("spark.sql.ansi.enabled", "false")])
@pytest.mark.parametrize("name", ["parse_timestamps", "latest_across_laws", "profile_gated", "consent_flags"])
def test_same_rows_under_other_session_settings(spark, setting, value, name):
    def run():
        df = QUERIES[name](spark, SF0001)
        return rows_of(df.columns, [tuple(r) for r in df.collect()])
    base = run()
    old = spark.conf.get(setting)
    spark.conf.set(setting, value)
    try:
        assert run() == base
    finally:
        spark.conf.set(setting, old)


def test_parameters_flow_through(spark):
    from tessera.plans import profile as PR
    from tessera.sources.relations import snapshot
    f = PR.load(spark, SF001)
    one_segment = PR.ProfileParams(segments=("Seg - Building",))
    segs = {r[0] for r in PR.profile_final(f, one_segment, sort=False).select("SEGMENTO").collect()}
    assert segs == {"Seg - Building"}
    assert PR.profile_final(f, one_segment).count() < PR.profile_final(f).count()
    periods = {r[0] for r in snapshot(spark, SF001, "200001", current=False).select("STRANOMES").collect()}
    assert periods == {"200001"}


def test_cli_lists_and_runs(spark, capsys, tmp_path):
    from tessera.__main__ import main
    main(["list"])
    listed = capsys.readouterr().out.split("\n")
    assert len([line for line in listed if line.strip()]) == len(QUERIES)
    main(["run", "dup_codes", "--sf-dir", SF0001, "--show", "0", "--csv", str(tmp_path / "out")])
    assert any(p.name.startswith("part-") for p in (tmp_path / "out").iterdir())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_building_a_query_runs_no_job(spark, name):
    from tessera.sources.relations import snapshot_store
    snapshot_store(spark, SF0001)  # the period queries read stored snapshots, which the first of them writes
    sc = spark.sparkContext
    group = f"build-{name}"
    sc.setJobGroup(group, "building only")
    try:
        QUERIES[name](spark, SF0001)
        assert not sc.statusTracker().getJobIdsForGroup(group)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_without_broadcasts_has_no_cross_join(spark, name):
    """The plan that large tables get: nothing is small enough to broadcast, and no hint forces it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not [n for n in (*slow_nodes(name), "BroadcastHashJoin") if n in plan]


def test_repeated_dimension_rows_repeat_no_report_row(spark):
    from tessera.plans import profile as PR
    f = PR.load(spark, SF001)
    assert f["attention"].count() > f["attention"].distinct().count()
    assert f["address"].count() > f["address"].distinct().count()
    report = PR.profile_final(f, sort=False)
    assert report.count() == report.distinct().count() > 0
    again = {**f, **{n: f[n].unionAll(f[n]) for n in ("attention", "address", "code_list", "segment_attr", "position_link")}}
    assert PR.profile_final(again, sort=False).exceptAll(report).count() == 0
    assert report.exceptAll(PR.profile_final(again, sort=False)).count() == 0


def test_period_measures_cover_every_month(spark):
    out = QUERIES["period_measures"](spark, SF0001).groupBy("STRANOMES").count().collect()
    assert len(out) > 12


def test_consent_facts_are_read_once(spark):
    """Gate and channel, both sources of the union, and the stage counts."""
    for name, most in (("profile_gated", 1), ("union_missing_columns", 1), ("stage_counts", 2)):
        plan = QUERIES[name](spark, SF0001)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("AS content#") <= most, name


def test_report_holds_no_primary_id(spark):
    """A contact listed twice with another primary point is one report row."""
    from tessera.plans import profile as PR
    f = PR.load(spark, SF001)
    listed = f["contact"].groupBy("row_id").agg({"primary_point_id": "count"}).where("`count(primary_point_id)` > 1")
    report = PR.profile_final(f, sort=False)
    assert listed.count() > 0 and report.count() == report.distinct().count() > 0


def test_sql_profile_takes_its_codes_from_parameters(spark):
    from tessera.plans import profile as PR
    from tessera.plans.catalog import profile_sql
    f = PR.load(spark, SF001)
    assert profile_sql(spark, f).count() > 0
    assert profile_sql(spark, f, PR.ProfileParams(active_status=("none",))).count() == 0
    assert profile_sql(spark, f, PR.ProfileParams(relation_types=())).count() == 0
    other = PR.ProfileParams(list_columns={**PR.DEFAULT.list_columns, "city": ("name", "desc_text")})
    assert profile_sql(spark, f, other).count() == 0  # cities are keyed by another column
