from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import periods as P
from tessera.operators.audit import stage_counts
from tessera.operators.decode import active_lists, decode, decode_by, duplicate_codes, labels, one_list, unique_labels


def snapshot(spark, keys, current):
    """Minimal snapshot rows: (key1, key2, product, concept, history measure)."""
    base = {c: None for c in P.ATTRIBUTES + P.MEASURES}
    out = []
    for k1, k2, prod, concept, hist in keys:
        r = dict(base)
        r.update({"STRANOMES": "p", "STRPETIPOCREDITO": "1", "NUMPEPROCODIGO": prod, "NUMTIPOCONCEPTO": concept,
                  "DIAS_MORA": 10})
        for m in P.HISTORY[6:12]:
            r[m] = hist
        out.append((k1, k2) + tuple(r[c] for c in P.ATTRIBUTES + P.MEASURES)
                   + (("M",) if current else ()))
    types = {c: "string" for c in P.ATTRIBUTES}
    types.update({"NUMPEPROCODIGO": "int", "NUMTIPOCONCEPTO": "int", "NUMPETIPOGARANTIA": "int",
                  "TIPO_EMPRESA": "int", "DIAS_MORA": "int", "NUMPIMATRIZ_B": "decimal(18,2)",
                  "PDI": "decimal(18,2)", "VALOR_GAR": "decimal(18,2)"})
    schema = ", ".join([f"{k} string" for k in P.KEYS] + [f"{c} {types[c]}" for c in P.ATTRIBUTES]
                       + [f"{m} decimal(18,2)" for m in P.MEASURES] + (["STROBLMODALIDAD string"] if current else []))
    return spark.createDataFrame(out, schema)


def test_derive_column_counts(spark):
    before = P.derive(snapshot(spark, [("A", "1", 1, 1, Decimal("1.00"))], False))
    now = P.derive(snapshot(spark, [("A", "1", 1, 1, Decimal("1.00"))], True))
    assert len(before.columns) == 49 and len(now.columns) == 50
    assert "STRPETIPOCREDITO" not in before.columns and "TIPO_CREDITO" in before.columns


def test_compare_faithful_and_null_safe(spark):
    d = Decimal
    before = P.derive(snapshot(spark, [("A", "1", 1, 1, d("1.00")), ("B", "1", 1, 1, d("5.00")),
                                       ("D", "1", 1, 1, d("1.00"))], False))
    now = P.derive(snapshot(spark, [("B", "1", 2, 1, d("2.00")), ("C", "1", 3, 1, d("1.00")),
                                    ("D", "1", 45, 1, d("1.00")), ("E", "1", None, None, d("1.00"))], True))
    faithful = P.compare(before, now)
    assert len(faithful.columns) == 98
    got = {r[0]: r[1] for r in rows(faithful, "STRCLINIT", "DIFERENCIAL_ACUM")}
    # A only before (code null after the join) and D (code 45) and E (null code) drop out
    assert got == {"B": d("18.00"), "C": None}
    safe = {r[0]: r[1] for r in rows(P.compare(before, now, null_safe=True), "STRCLINIT", "DIFERENCIAL_ACUM")}
    assert safe == {"A": d("0.00"), "B": d("18.00"), "C": None, "E": d("0.00")}


def test_suffix_ignores_key_case(spark):
    df = spark.createDataFrame([("a", "b", 1)], "strclinit string, STROBLOBLIGSARC string, x int")
    assert P.suffix(df, P.KEYS, "_ANT").columns == ["strclinit", "STROBLOBLIGSARC", "x_ANT"]


def codes(spark):
    return spark.createDataFrame([
        ("DOC", "CC", None, "1", "Cedula", "Y"), ("DOC", "CC", None, "9", "Old", "N"),
        ("DOC", "CE", None, "2", "Extranjeria", "Y"), ("CITY", None, "11", None, "BOGOTA..", "Y"),
        ("CITY", None, "11", None, "BOGOTA DC", "Y"), ("OTHER", "CC", None, "7", "x", "Y")],
        "list_type string, name string, val string, high string, desc_text string, active_flg string")


def test_decode_left_missing_inactive_and_duplicates(spark):
    lists = active_lists(codes(spark), ["DOC", "CITY"])
    facts = spark.createDataFrame([(1, "CC", "11"), (2, "TI", "12"), (3, None, None)], "id int, t string, c string")
    out = decode(facts, one_list(lists, "DOC", "code_name", "code_high"), "t", "doc")
    out = decode(out, one_list(lists, "CITY", "code_val", "code_desc"), "c", "city")
    got = sorted(rows(out, "id", "doc", "city"))
    # the duplicated active city code repeats customer 1
    assert got == [(1, "1", "BOGOTA DC"), (1, "1", "BOGOTA.."), (2, None, None), (3, None, None)]
    inner = decode(facts, one_list(lists, "DOC", "code_name", "code_high"), "t", "doc", how="inner")
    assert sorted(rows(inner, "id")) == [(1,)]
    dups = rows(duplicate_codes(codes(spark), SHAPES), "list_type", "code", "n_rows", "n_active")
    assert sorted(dups) == [("CITY", "11", 2, 2), ("DOC", "CC", 2, 1)]


SHAPES = {"DOC": ("name", "high"), "CITY": ("val", "desc_text")}


def test_each_list_has_its_own_key_and_label(spark):
    # Every row fills every column; only the type says which of them count.
    full = spark.createDataFrame([
        ("DOC", "CC", "11", "1", "Cedula", "Y"), ("CITY", "CC", "11", "wrong", "BOGOTA", "Y"),
        ("CITY", "CC", "12", "wrong", None, "Y"), ("CITY", "CC", None, "wrong", "NOWHERE", "Y"),
        ("DOC", "TI", "12", "5", "Tarjeta", "N"), ("OTHER", "CC", "11", "7", "x", "Y")],
        "list_type string, name string, val string, high string, desc_text string, active_flg string")
    lists = labels(full, SHAPES)
    assert sorted(rows(lists), key=str) == sorted([("DOC|CC", "1"), ("CITY|11", "BOGOTA"), ("CITY|12", None), (None, "NOWHERE")],
                                                  key=str)
    facts = spark.createDataFrame([(1, "CC", "11"), (2, "TI", "12"), (3, None, None)], "id int, t string, c string")
    out = decode_by(decode_by(facts, lists, "DOC", "t", "doc"), lists, "CITY", "c", "city", label_expr=F.lower)
    assert sorted(rows(out, "id", "doc", "city")) == [(1, "1", "bogota"), (2, None, None), (3, None, None)]


def test_unique_codes_repeat_no_fact_and_say_what_they_drop(spark):
    lists = labels(codes(spark), SHAPES)
    facts = spark.createDataFrame([(1, "11")], "id int, c string")
    assert decode_by(facts, lists, "CITY", "c", "city").count() == 2  # as a join does (D17)
    once = unique_labels(lists)
    assert rows(decode_by(facts, once, "CITY", "c", "city"), "id", "city") == [(1, "BOGOTA DC")]
    assert sorted(rows(once)) == [("CITY|11", "BOGOTA DC", 1), ("DOC|CC", "1", 0), ("DOC|CE", "2", 0)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_five_decodes_read_the_lists_once(spark, threshold):
    from tessera.plans.catalog import _decoded
    from tessera.plans.profile import DEFAULT, DECODED
    columns = "list_type string, name string, val string, high string, desc_text string, active_flg string"
    lists = spark.createDataFrame([(DEFAULT.list_types[k], "1", "1", "h", k, "Y") for k in DECODED], columns).repartition(3)
    star = spark.createDataFrame([(i, "1", "1", "1", "1", "1") for i in range(50)],
                                 "customer_id long, id_type string, segment_code string, attention_code string, "
                                 "city_code string, class_code string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        from tessera.operators.decode import labels as made
        out = _decoded(star, made(lists, DEFAULT.shapes(*DECODED)))
        assert {tuple(r)[1:] for r in out.collect()} == {("h", "segment", "attention", "City", "class")}
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("ReusedExchange") >= 4


def test_stage_counts(spark):
    a, b = spark.range(5), spark.range(3).filter(F.col("id") > 0)
    assert sorted(rows(stage_counts({"a": a, "b": b}))) == [("a", 5), ("b", 2)]


def test_compare_null_and_duplicate_keys_and_null_history(spark):
    d = Decimal
    before = P.derive(snapshot(spark, [(None, "1", 1, 1, d("1.00")), ("K", "1", 1, 1, d("1.00")),
                                       ("K", "1", 1, 1, d("2.00")), ("H", "1", 1, 1, None)], False))
    now = P.derive(snapshot(spark, [(None, "1", 1, 1, d("1.00")), ("K", "1", 1, 1, d("1.00")),
                                    ("H", "1", 1, 1, d("1.00"))], True))
    got = sorted(rows(P.compare(before, now, null_safe=True), "STRCLINIT", "DIFERENCIAL_ACUM"), key=str)
    # null keys never match (one row per side), the duplicated key repeats (D13),
    # a null history makes the differential null
    # (the before-only null-key row has no current concept -> 0; the current-only one has no history -> null)
    assert got == sorted([(None, d("0.00")), (None, None), ("H", None), ("K", d("0.00")),
                          ("K", d("6.00"))], key=str)


def test_compare_unique_collapses_repeats_and_keeps_concepts_apart(spark):
    d = Decimal
    before = snapshot(spark, [("K", "1", 1, 1, d("1.00")), ("K", "1", 1, 1, d("2.00")), ("K", "1", 1, 2, d("5.00")),
                              ("N", "1", 1, None, d("4.00")), ("X", "1", 1, 1, d("1.00"))], False)
    now = snapshot(spark, [("K", "1", 1, 1, d("1.00")), ("K", "1", 1, 2, d("1.00")), ("N", "1", 1, None, d("1.00")),
                           ("X", "1", 45, 1, d("1.00")), ("C", "1", 2, 3, d("1.00"))], True)
    both = (before.withColumn("STRANOMES", F.lit("A")).unionByName(now.withColumn("STRANOMES", F.lit("B")), allowMissingColumns=True)
            .unionByName(now.withColumn("STRANOMES", F.lit("other"))))
    out = P.compare_unique(both, "A", "B", "STRANOMES")
    got = sorted(rows(out, "STRCLINIT", "NUMTIPOCONCEPTO", "FILAS_ANT", "FILAS_ACT", "DIFERENCIAL_ACUM"), key=str)
    # six times the history measure; the null concept has no differential; the excluded product is gone
    assert got == sorted([("K", 1, 2, 1, d("12.00")), ("K", 2, 1, 1, d("24.00")), ("N", None, 1, 1, d("0.00")),
                          ("C", 3, 0, 1, None)], key=str)
    assert "STROBLMODALIDAD_ACT" in out.columns and "STROBLMODALIDAD_ANT" not in out.columns
