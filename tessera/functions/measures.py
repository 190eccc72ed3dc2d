"""Labels, bands and money measures of the period snapshot.

All are ``Column`` expressions applied in one ``select`` (no 32-step
``withColumn`` chain).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (labels of the report; they must read exactly like this).
# ---------------------------------------------------------------------------
# Credit category code -> label; other codes have no label.
CATEGORY_LABELS = (("1", "COMERCIAL"), ("2", "CONSUMO"), ("3", "HIPOTECARIO"))

# Days-in-arrears bands per category code: (low, high, label); high None = open.
# Ranges are closed; the first matching row wins, so 360 in category 3 is
# "181 - 360" although the next range starts at 360.
ARREARS_BANDS = (
    ("2", ((0, 30, "0 - 30"), (31, 60, "31 - 60"), (61, 90, "61 - 90"), (91, 180, "91 - 180"),
           (180, None, "MAYOR A 180"))),
    ("1", ((0, 30, "0 - 30"), (31, 90, "31 - 90"), (91, 180, "91 - 180"), (181, 360, "181 - 360"),
           (360, None, "MAYOR A 360"))),
    ("3", ((0, 30, "0 - 30"), (31, 120, "31 - 120"), (121, 180, "121 - 180"), (181, 360, "181 - 360"),
           (360, 540, "361 - 540"), (540, None, "MAYOR A 540"))),
)

# Product code -> credit line, in the order the job tests them; default OTROS.
PRODUCT_LINES = (
    ((1,), "CARTERA_ORDINARIA"),
    ((4,), "MONEDA EXTRAJERA"),
    ((16,), "SEGUROS"),
    ((18,), "TESORERIA"),
    ((83, 84, 85), "OPERACIONES LEASING"),
    ((44, 82), "LEASING FINANCIERO"),
    ((81,), "LEASING OPERATIVO"),
    ((24,), "EMPLEADOS"),
    ((54,), "LIBRANZA"),
    ((51,), "VEHICULOS Y MOTOS"),
    ((3,), "SOBREGIRO"),
    ((5,), "PRESTAMO_PERSONAL"),
    ((6, 7, 38, 56), "TARJETA CREDITO"),
    ((9, 10), "ACEPTACIONES BANCARIAS"),
    ((32,), "OTROS DEUDORES"),
    ((40,), "FACTORING"),
    ((49,), "LEASING HABITACIONAL"),
    ((45,), "LEASING OPERATIVO"),
    ((43,), "VIVIENDA"),
)
PRODUCT_LINE_DEFAULT = "OTROS"

# Product code -> accounting basis.
IFRS_ONLY_CODES = (81, 82, 83, 84, 85, 9, 10)
COLGAAP_ONLY_CODES = (45,)
BASIS_IFRS, BASIS_COLGAAP, BASIS_BOTH = "IFRS", "COLGAAP", "IFRS Y COLGAAP"

# Concept type whose balances count as zero.
ZERO_BALANCE_CONCEPT = 3

# Result type of money sums: exact, no overflow for sums of decimal(18,2).
MONEY_SUM = "decimal(38,2)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_label(cat) -> Column:
    """M1: no ``otherwise``, so unknown codes give null."""
    cat = _c(cat)
    expr = None
    for code, label in CATEGORY_LABELS:
        expr = (F.when(cat == code, F.lit(label)) if expr is None
                else expr.when(cat == code, F.lit(label)))
    return expr


def arrears_band(cat, days) -> Column:
    """Band label by category and days; first match wins, else null."""
    cat, days = _c(cat), _c(days)
    expr = None
    for code, bands in ARREARS_BANDS:
        for low, high, label in bands:
            cond = (cat == code) & (days > low if high is None else days.between(low, high))
            expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(None).cast("string"))


def product_line(code) -> Column:
    """M3: first listed code set containing the code, else OTROS."""
    code = _c(code)
    expr = None
    for codes, label in PRODUCT_LINES:
        cond = code == codes[0] if len(codes) == 1 else code.isin(*codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(PRODUCT_LINE_DEFAULT))


def accounting_basis(code) -> Column:
    """M4."""
    code = _c(code)
    return (F.when(code.isin(*IFRS_ONLY_CODES), F.lit(BASIS_IFRS))
            .when(code.isin(*COLGAAP_ONLY_CODES), F.lit(BASIS_COLGAAP))
            .otherwise(F.lit(BASIS_BOTH)))


def balance(concept, amount) -> Column:
    """M5: zero for the zero-balance concept, else the amount with null as 0.

    A null concept is not the zero-balance concept.
    """
    return (F.when(_c(concept) == ZERO_BALANCE_CONCEPT, F.lit(0))
            .otherwise(F.coalesce(_c(amount), F.lit(0))))


def total_balance(concept, *amounts) -> Column:
    """M6 as the job has it: one null component makes the whole total 0."""
    total = None
    for a in amounts:
        total = _c(a) if total is None else total + _c(a)
    return (F.when(_c(concept) == ZERO_BALANCE_CONCEPT, F.lit(0))
            .otherwise(F.coalesce(total, F.lit(0))))


def total_balance_null_safe(concept, *amounts) -> Column:
    """M6 variant that equals the sum of the M5 balances."""
    total = None
    for a in amounts:
        term = F.coalesce(_c(a), F.lit(0))
        total = term if total is None else total + term
    return F.when(_c(concept) == ZERO_BALANCE_CONCEPT, F.lit(0)).otherwise(total)


def money_sum(*cols) -> Column:
    """M7-M9: plain sum; a null term makes the sum null."""
    total = None
    for c in cols:
        total = _c(c) if total is None else total + _c(c)
    return total.cast(MONEY_SUM)


def differential(concept_now, before, now) -> Column:
    """0 when the current concept is missing, else before - now."""
    return (F.when(_c(concept_now).isNull(), F.lit(0))
            .otherwise(_c(before) - _c(now))).cast(MONEY_SUM)
