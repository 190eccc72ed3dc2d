from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import one
from tessera.functions import measures as M

BAND_CASES = [
    ("2", 0, "0 - 30"), ("2", 30, "0 - 30"), ("2", 31, "31 - 60"), ("2", 60, "31 - 60"), ("2", 61, "61 - 90"),
    ("2", 90, "61 - 90"), ("2", 91, "91 - 180"), ("2", 180, "91 - 180"), ("2", 181, "MAYOR A 180"),
    ("1", 30, "0 - 30"), ("1", 31, "31 - 90"), ("1", 90, "31 - 90"), ("1", 91, "91 - 180"),
    ("1", 180, "91 - 180"), ("1", 181, "181 - 360"), ("1", 360, "181 - 360"), ("1", 361, "MAYOR A 360"),
    ("3", 30, "0 - 30"), ("3", 31, "31 - 120"), ("3", 120, "31 - 120"), ("3", 121, "121 - 180"),
    ("3", 180, "121 - 180"), ("3", 181, "181 - 360"), ("3", 360, "181 - 360"), ("3", 361, "361 - 540"),
    ("3", 540, "361 - 540"), ("3", 541, "MAYOR A 540"),
    ("2", -1, None), ("1", None, None), ("4", 10, None), (None, 10, None),
]


def test_arrears_band_edges(spark):
    df = spark.createDataFrame([(c, d) for c, d, _ in BAND_CASES], "c string, d int")
    assert one(df.select(M.arrears_band("c", "d").alias("b")), "b") == [b for _, _, b in BAND_CASES]


def test_arrears_band_fraction_falls_between(spark):
    df = spark.createDataFrame([("2", 30.5), ("1", 360.5), ("3", 540.5)], "c string, d double")
    assert one(df.select(M.arrears_band("c", "d").alias("b")), "b") == [None, "MAYOR A 360", "MAYOR A 540"]


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["1", "2", "3"]), st.integers(0, 100_000)), min_size=1, max_size=30))
def test_arrears_band_total_for_known_categories(spark, pairs):
    df = spark.createDataFrame(pairs, "c string, d int")
    assert None not in one(df.select(M.arrears_band("c", "d").alias("b")), "b")


def test_category_label(spark):
    df = spark.createDataFrame([("1",), ("2",), ("3",), ("0",), (None,)], "c string")
    assert one(df.select(M.category_label("c").alias("l")), "l") == [
        "COMERCIAL", "CONSUMO", "HIPOTECARIO", None, None]


def test_product_line_and_basis(spark):
    codes = [1, 4, 16, 18, 83, 44, 81, 24, 54, 51, 3, 5, 38, 10, 32, 40, 49, 45, 43, 99, None]
    df = spark.createDataFrame([(c,) for c in codes], "p int")
    lines = one(df.select(M.product_line("p").alias("l")), "l")
    assert lines == ["CARTERA_ORDINARIA", "MONEDA EXTRAJERA", "SEGUROS", "TESORERIA", "OPERACIONES LEASING",
                     "LEASING FINANCIERO", "LEASING OPERATIVO", "EMPLEADOS", "LIBRANZA", "VEHICULOS Y MOTOS",
                     "SOBREGIRO", "PRESTAMO_PERSONAL", "TARJETA CREDITO", "ACEPTACIONES BANCARIAS",
                     "OTROS DEUDORES", "FACTORING", "LEASING HABITACIONAL", "LEASING OPERATIVO", "VIVIENDA",
                     "OTROS", "OTROS"]
    basis = one(df.select(M.accounting_basis("p").alias("b")), "b")
    assert basis[6] == "IFRS" and basis[13] == "IFRS" and basis[17] == "COLGAAP"
    assert basis[0] == "IFRS Y COLGAAP" and basis[-1] == "IFRS Y COLGAAP"


def test_balances(spark):
    d = Decimal
    df = spark.createDataFrame([(3, d("1.00"), d("2.00"), d("3.00")), (1, d("1.00"), d("2.00"), None),
                                (None, d("5.00"), d("1.00"), d("1.00")), (1, None, None, None)],
                               "c int, k decimal(18,2), i decimal(18,2), o decimal(18,2)")
    out = df.select(M.balance("c", "k").alias("bk"), M.balance("c", "o").alias("bo"),
                    M.total_balance("c", "k", "i", "o").alias("t"),
                    M.total_balance_null_safe("c", "k", "i", "o").alias("ts"))
    assert [tuple(r) for r in out.collect()] == [
        (d("0.00"), d("0.00"), d("0.00"), d("0.00")), (d("1.00"), d("0.00"), d("0.00"), d("3.00")),
        (d("5.00"), d("1.00"), d("7.00"), d("7.00")), (d("0.00"), d("0.00"), d("0.00"), d("0.00"))]
    assert dict(out.dtypes)["bk"] == "decimal(18,2)"


def test_money_sum_null_propagates_and_differential(spark):
    d = Decimal
    df = spark.createDataFrame([(d("1.10"), d("2.20"), 1), (d("1.10"), None, 1), (d("5.00"), d("1.00"), None)],
                               "a decimal(18,2), b decimal(18,2), c int")
    out = df.select(M.money_sum("a", "b").alias("s"), M.differential("c", "a", "b").alias("diff"))
    assert [tuple(r) for r in out.collect()] == [(d("3.30"), d("-1.10")), (None, None), (d("6.00"), d("0.00"))]
