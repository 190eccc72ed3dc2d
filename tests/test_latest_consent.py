import datetime as dt

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import consent as C
from tessera.operators.latest import latest, newest_first, union_sources

T0 = dt.datetime(2024, 1, 1)


def ts(h):
    return None if h is None else T0 + dt.timedelta(hours=h)


def test_latest_newest_first_nulls_last_total_tiebreak(spark):
    df = spark.createDataFrame([("a", ts(1), "x"), ("a", ts(3), "y"), ("a", None, "z"), ("b", None, "q"),
                                ("b", None, "p"), (None, ts(5), "n")], "k string, t timestamp, v string")
    got = sorted(rows(latest(df, "k", [newest_first("t")]), "k", "v"))
    assert got == [("a", "y"), ("b", "p")]


def test_latest_keeps_one_row_per_key(spark):
    df = spark.range(5_000).selectExpr("CAST(id % 7 AS string) AS k", "CAST(id AS timestamp) AS t", "id")
    out = latest(df, "k", [newest_first("t")])
    assert out.count() == 7 and out.groupBy("k").count().filter("count > 1").count() == 0
    assert sorted(r[0] for r in out.select("id").collect()) == list(range(4993, 5000))


def test_latest_hot_key(spark):
    # one key holds a third of all rows; the partial window limit keeps the shuffle small
    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id AS string) END AS k",
                                        "id")
    out = latest(df, "k", [F.col("id").desc()])
    assert out.count() == 20_001
    assert rows(out.filter("k = 'hot'"), "id") == [(29_997,)]


def _laws(spark, a_rows, b_rows):
    schema = "ley string, doc_join string, agree int, ts timestamp, canal_contacto string"
    a = spark.createDataFrame(a_rows, schema).withColumn("consent_id", F.lit(1))
    b = spark.createDataFrame(b_rows, schema).withColumn("consent_id", F.lit(2))
    return a, b


def test_latest_of_laws_tie_goes_to_law_b_and_exclusion(spark):
    a, b = _laws(spark,
                 [("1581", "1", 1, ts(5), "a1"), ("1581", "2", 0, ts(9), "a2"), ("1581", "3", 1, ts(1), "a3"),
                  ("1581", "5", None, ts(1), "a5")],
                 [("2300", "1", 0, ts(5), "b1"), ("2300", "2", 1, ts(1), "b2"), ("2300", "3", 0, ts(2), "b3"),
                  ("2300", "4", 1, None, "b4")])
    newest = C.latest_of_laws(a, b)
    got = {r[0]: (r[1], r[2]) for r in rows(newest, "doc_join", "ley", "agree")}
    assert got == {"1": ("2300", 0), "2": ("1581", 0), "3": ("2300", 0), "4": ("2300", 1), "5": ("1581", None)}
    assert sorted(r[0] for r in rows(C.refused(newest))) == ["1", "2", "3"]
    # null flag: neither refused nor allowed
    assert sorted(r[0] for r in rows(C.allowed(newest), "doc_join")) == ["4"]
    people = spark.createDataFrame([(1, "1"), (2, "4"), (3, None), (4, "9")], "row_id int, doc_join string")
    kept = sorted(r[0] for r in rows(C.exclude(people, C.refused(newest)), "row_id"))
    assert kept == [2, 3, 4]  # no document and no consent are kept


ROW = "source string, consent_id long, ref_num string, agree_ind string, create_date string, content string"


def test_law_a_gate_reads_flag_after_latest(spark):
    df = spark.createDataFrame([
        ("A", 1, " 0001", "1", "2024-01-01 10:00:00", None),   # doc 1: older accept ...
        ("A", 2, "001", "0", "2024-01-02 10:00:00", None),     # ... newer refusal -> out
        ("A", 3, "2", "0", "2024-01-01 10:00:00", None),       # doc 2: older refusal ...
        ("A", 4, "0002", "2", "02/01/24 10:00:00 AM", None),   # ... newer '2' (day-first) -> in
        ("A", 5, "3", "1.0", None, None),                      # doc 3: only a dateless '1.0' -> in
        ("A", 6, "000", "1", "2024-01-01 10:00:00", None),     # empty document -> never
        ("F", 7, "1", "1", "2025-01-01 10:00:00", None),       # another source doesn't count
    ], ROW)
    assert sorted(r[0] for r in rows(C.law_a_gate(df))) == ["2", "3"]
    people = spark.createDataFrame([(10, "1"), (20, "2"), (30, "3"), (40, None)], "row_id int, doc_join string")
    assert sorted(r[0] for r in rows(C.gate(people, C.law_a_gate(df)), "row_id")) == [20, 30]


def test_latest_channel_tie_goes_to_registry_and_union_fills_nulls(spark):
    df = spark.createDataFrame([("F", 1, "7", "1", "2024-01-01 10:00:00", None),
                                ("F", 2, "8", "1", "2024-01-03 10:00:00", "web"),
                                ("F", 5, "9", "1", "2024-01-03 10:00:00", None),
                                ("R", 3, "7", "1", "2024-01-01 10:00:00", "rne-7"),
                                ("R", 4, "8", "1", "2024-01-02 10:00:00", "rne-8")], ROW)
    got = {r[0]: r[1:] for r in rows(C.latest_channel(df), "doc_join", "origin", "channel")}
    assert got == {"7": ("2300_RNE", "rne-7"), "8": ("2300_FORM", "web"), "9": ("2300_FORM", "-")}
    both = {(r[0], r[1]): r[2:] for r in rows(C.channel_rows(df), "origin", "doc_join", "form_channel", "registry_channel")}
    assert both[("2300_FORM", "7")] == ("-", None) and both[("2300_RNE", "8")] == (None, "rne-8")


def test_every_edge_of_the_consent_store_matters(spark):
    """Emptying a condition of the star, one at a time, changes the consents that come out."""
    from conftest import SF001
    from tessera.plans import profile as PR
    f = PR.load(spark, SF001)
    base = C.tagged(f).count()
    opened = {
        "consent": ("end_dt", "string"), "owner": ("inactivated_dt", "string"), "identifier": ("end_dt", "string")}
    for name, (column, kind) in opened.items():
        assert C.tagged({**f, name: f[name].withColumn(column, F.lit(None).cast(kind))}).count() > base, name
    consents = f["consent"].select("consent_id")
    every = consents.withColumn("content", F.lit("x"))
    assert C.tagged({**f, "provision": every}).count() > base
    assert C.tagged({**f, "entity": consents.withColumn("attribute", F.lit("x"))}).count() > base
    for name, column, code in (("purpose", "purpose_type", "COMMERCIAL"), ("regulation", "regulation_code", "LAW_A"),
                               ("activity", "activity_code", "ACT1"), ("tenant", "tenant_code", "T7")):
        assert C.tagged({**f, name: f[name].withColumn(column, F.lit(code))}).count() != base, name
    law_a = C.source_rows(f, C.LAW_A)
    assert law_a.where("content IS NULL").count() > C.source_rows({**f, "provision": every}, C.LAW_A).where(
        "content IS NULL").count()


def test_union_by_name_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id int")
    out = union_sources(a, b, allow_missing=True)
    assert sorted(rows(out, "id", "a", "b")) == [(1, "x", None), (2, None, "y")]


def test_exclude_and_attach_equals_two_step_form(spark):
    a, b = _laws(spark,
                 [("1581", "1", 1, ts(5), "a1"), ("1581", "2", 0, ts(9), "a2"), ("1581", "5", None, ts(1), "a5")],
                 [("2300", "1", 0, ts(5), "b1"), ("2300", "2", 1, ts(1), "b2"), ("2300", "4", 1, None, "b4")])
    newest = C.latest_of_laws(a, b)
    people = spark.createDataFrame([(1, "1"), (2, "4"), (3, None), (4, "9"), (5, "5"), (6, "2")],
                                   "row_id int, doc_join string")
    one_join = sorted(rows(C.exclude_and_attach(people, newest), "row_id", "canal_contacto"))
    two_step = sorted(rows(C.exclude(people, C.refused(newest)).join(C.allowed(newest), "doc_join", "left"),
                           "row_id", "canal_contacto"))
    assert one_join == two_step == [(2, "b4"), (3, None), (4, None), (5, None)]


def test_one_read_equals_each_source_by_itself(spark):
    from conftest import SF001
    from tessera.plans import profile as PR
    f = PR.load(spark, SF001)
    whole = sorted(rows(C.tagged(f)), key=str)
    assert whole == sorted((r for s in C.SOURCES for r in rows(C.source_rows(f, s))), key=str)
    one = C.newest_consent(C.tagged(f, (C.LAW_A, C.FORM)))
    two = C.latest_of_laws(*[C.latest_of_law(C.source_rows(f, s)) for s in (C.LAW_A, C.FORM)])
    cols = ["ley", "doc_join", "agree", "ts", "canal_contacto", "consent_id"]
    assert sorted(rows(one, *cols), key=str) == sorted(rows(two, *cols), key=str)


from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 5)),
                          st.integers(0, 3)), min_size=1, max_size=40))
def test_latest_matches_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, t int, v int")
    got = sorted(rows(latest(df, "k", [F.col("t").desc_nulls_last()]), "k", "t", "v"))
    best = {}
    for k, t, v in data:
        if k is None:
            continue
        rank = (0 if t is not None else 1, -(t or 0), v)   # newest first, nulls last, then v ascending
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    assert got == sorted(r for _, r in best.values())


def test_latest_limits_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("CAST(id % 3 AS string) AS k", "id")
    plan = latest(df, "k", [F.col("id").desc()])._jdf.queryExecution().executedPlan().toString()
    exchange = plan.find("Exchange hashpartitioning")
    # one WindowGroupLimit above the exchange (final) and one below it (partial, map side)
    assert plan.count("WindowGroupLimit") == 2 and plan.rfind("WindowGroupLimit") > exchange


def test_document_state_is_gate_and_channel_of_each_document(spark):
    from conftest import SF0001
    from tessera.sources.relations import frames
    from tessera.plans.profile import CONSENT_RELATIONS
    tagged = C.tagged(frames(spark, SF0001, *CONSENT_RELATIONS))
    state = {r.doc_join: r for r in C.document_state(tagged).collect()}
    gate = {r.doc_join for r in C.law_a_gate(tagged).collect()}
    channel = {r.doc_join: (r.origin, r.channel) for r in C.latest_channel(tagged).collect()}
    assert {d for d, r in state.items() if r.passes} == gate and gate
    assert {d: (r.origin, r.channel) for d, r in state.items() if r.origin} == channel and channel
    assert any(not r.passes and r.origin is None for r in state.values()) or set(state) == gate | set(channel)
