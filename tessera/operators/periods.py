"""Monthly snapshot comparison.

Two snapshots of one provision table (previous and current period) get the
same derived columns, their non-key columns a period suffix, and meet in a
full outer join on the two-column key. All derivations are a single
``select``; the join shuffles each side once on the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M

# Key, attribute and measure column names of the provision table.
KEYS = ("STRCLINIT", "STROBLOBLIGSARC")
ATTRIBUTES = ("STRANOMES", "STRPETIPOCREDITO", "NUMPEPROCODIGO", "NUMTIPOCONCEPTO", "STRPECONCEPTO",
              "NUMPIMATRIZ_B", "STRPECALIFICACION", "STRCALIFHOMOLOGADA", "STRCALIFICACIONTEMP",
              "STRCALIFICACIONREF", "STRPEMAXGARANTIA", "NUMPETIPOGARANTIA", "PDI", "VALOR_GAR",
              "TIPO_EMPRESA", "DIAS_MORA")
BALANCES = ("NUMPEEDIK", "NUMPEEDII", "NUMPEEDIKOTROS")
PROVISIONS = ("NUMPEDIFK", "NUMPEDIFI", "NUMDIFCAPOTROS", "NUMPEANTICICLICADIFCAPITAL",
              "NUMPEANTICICLICADIFINTERES", "NUMPEANTICICLICADIFOTROS", "NUMPECONTABLEK", "NUMPECONTABLEI",
              "NUMCAPOTROS", "NUMPEANTICICLICACAPITAL", "NUMPEANTICICLICAINTERES", "NUMPEANTICICLICAOTROS")
HISTORY = ("NUM_PE_DIF_K_ACU", "NUM_PE_DIF_I_ACU", "NUM_DIF_KOTROS_ACU", "NUM_PE_CIC_DIF_K_ACU",
           "NUM_PE_CIC_DIF_I_ACU", "NUM_PE_CIC_DIF_KOTROS_ACU", "NUM_PE_K_ACU", "NUM_PE_I_ACU", "NUM_KOTROS_ACU",
           "NUM_PE_CIC_K_ACU", "NUM_PE_CIC_I_ACU", "NUM_PE_CIC_KOTROS_ACU", "NUM_PE_CIC_K_DES",
           "NUM_PE_CIC_I_DES", "NUM_PE_CIC_KOTROS_DES")
CURRENT_ONLY = ("STROBLMODALIDAD",)
MEASURES = BALANCES + PROVISIONS + HISTORY
# Columns dropped after deriving (P5): the category code and every base measure.
DROPPED = ("STRPETIPOCREDITO",) + MEASURES
CONCEPT, CATEGORY, PRODUCT, DAYS = "NUMTIPOCONCEPTO", "STRPETIPOCREDITO", "NUMPEPROCODIGO", "DIAS_MORA"
PRODUCT_EXCLUDED = 45
SUFFIX_BEFORE, SUFFIX_NOW = "_ANT", "_ACT"


# The summed measures of the report, in output order, each with
# the base measures it adds up (a single input is a plain copy).
MONEY_COLUMNS = (
    ("PROV_DIF_PRO_K", ("NUMPEDIFK",)),
    ("PROV_DIF_ANT_K", ("NUMPEANTICICLICADIFCAPITAL",)),
    ("PROV_DIF_K", ("NUMPEDIFK", "NUMPEANTICICLICADIFCAPITAL")),
    ("PROV_DIF_PRO_I", ("NUMPEDIFI",)),
    ("PROV_DIF_ANT_I", ("NUMPEANTICICLICADIFINTERES",)),
    ("PROV_DIF_I", ("NUMPEDIFI", "NUMPEANTICICLICADIFINTERES")),
    ("PROV_DIF_PRO_OT", ("NUMDIFCAPOTROS",)),
    ("PROV_DIF_ANT_OT", ("NUMPEANTICICLICADIFOTROS",)),
    ("PROV_DIF_O", ("NUMDIFCAPOTROS", "NUMPEANTICICLICADIFOTROS")),
    ("PROV_DIF", ("NUMPEDIFK", "NUMPEDIFI", "NUMDIFCAPOTROS", "NUMPEANTICICLICADIFCAPITAL",
                  "NUMPEANTICICLICADIFINTERES", "NUMPEANTICICLICADIFOTROS")),
    ("PROV_ACUM_PRO_K", ("NUMPECONTABLEK",)),
    ("PROV_ACUM_ANT_K", ("NUMPEANTICICLICACAPITAL",)),
    ("PROV_ACUM_K", ("NUMPECONTABLEK", "NUMPEANTICICLICACAPITAL")),
    ("PROV_ACUM_PRO_I", ("NUMPECONTABLEI",)),
    ("PROV_ACUM_ANT_I", ("NUMPEANTICICLICAINTERES",)),
    ("PROV_ACUM_I", ("NUMPECONTABLEI", "NUMPEANTICICLICAINTERES")),
    ("PROV_ACUM_PRO_OT", ("NUMCAPOTROS",)),
    ("PROV_ACUM_ANT_OT", ("NUMPEANTICICLICAOTROS",)),
    ("PROV_ACUM_O", ("NUMCAPOTROS", "NUMPEANTICICLICAOTROS")),
    ("PROV_ACUM", ("NUMPECONTABLEK", "NUMPECONTABLEI", "NUMCAPOTROS", "NUMPEANTICICLICACAPITAL",
                   "NUMPEANTICICLICAINTERES", "NUMPEANTICICLICAOTROS")),
    ("PROV_DIF_ACUM", ("NUM_PE_DIF_K_ACU", "NUM_PE_DIF_I_ACU", "NUM_DIF_KOTROS_ACU", "NUM_PE_CIC_DIF_K_ACU",
                       "NUM_PE_CIC_DIF_I_ACU", "NUM_PE_CIC_DIF_KOTROS_ACU")),
    ("PROV_ACUM_ACUM", ("NUM_PE_K_ACU", "NUM_PE_I_ACU", "NUM_KOTROS_ACU", "NUM_PE_CIC_K_ACU",
                        "NUM_PE_CIC_I_ACU", "NUM_PE_CIC_KOTROS_ACU")),
    ("PROV_DESACUM_CIC", ("NUM_PE_CIC_K_DES", "NUM_PE_CIC_I_DES", "NUM_PE_CIC_KOTROS_DES")),
)
# A derived column that every wide projection has.
APART = "PROV_DIF"
# The balance columns (zero for the zero-balance concept) and their inputs.
BALANCE_COLUMNS = (("SALDO_K", "NUMPEEDIK"), ("SALDO_I", "NUMPEEDII"), ("SALDO_O", "NUMPEEDIKOTROS"))


def derived_columns() -> list[tuple[str, object]]:
    """(name, expression) of the 32 derived columns, in output order."""
    out: list[tuple[str, object]] = [
        ("TIPO_CREDITO", M.category_label(CATEGORY)),
        ("RANGOS_MORA", M.arrears_band(CATEGORY, DAYS)),
        ("LINEA_CREDITO", M.product_line(PRODUCT)),
        ("LINEA_CREDITO_2", M.product_line(PRODUCT)),
        ("IFRS_COLGAAP", M.accounting_basis(PRODUCT)),
    ]
    out += [(name, M.balance(CONCEPT, col).cast(M.MONEY_SUM)) for name, col in BALANCE_COLUMNS]
    out.append(("SALDO_TOTAL", M.total_balance(CONCEPT, *BALANCES).cast(M.MONEY_SUM)))
    out += [(name, M.money_sum(*cols)) for name, cols in MONEY_COLUMNS]
    return out


def derive(df: DataFrame) -> DataFrame:
    """Add the derived columns and drop the base measures, in one projection.

    One column passes a lambda: Spark then compiles the projection in parts. As
    one method it is longer than what the JIT compiles, and three times slower.
    """
    kept = [F.col(c) for c in df.columns if c not in DROPPED]
    return df.select(*kept, *[(F.transform(F.array(e), lambda x: x)[0] if n == APART else e).alias(n)
                              for n, e in derived_columns()])


def suffix(df: DataFrame, keys=KEYS, sfx: str = SUFFIX_BEFORE) -> DataFrame:
    """Append ``sfx`` to every non-key column; keys compared ignoring case."""
    low = {k.lower() for k in keys}
    return df.select(*[F.col(c) if c.lower() in low else F.col(c).alias(c + sfx) for c in df.columns])


def compare(before: DataFrame, now: DataFrame, keys=KEYS, null_safe: bool = False) -> DataFrame:
    """Full outer join of the two suffixed periods + differential + product filter.

    ``null_safe=False`` is the job as written: ``code != 45`` also drops rows
    with no current code, so keys present only in the previous period vanish
    and the optimizer turns the full join into a right join (D12).
    ``null_safe=True`` keeps them: ``NOT (code <=> 45)``.
    """
    keys = list(keys)
    joined = suffix(before, keys, SUFFIX_BEFORE).join(suffix(now, keys, SUFFIX_NOW), on=keys, how="full_outer")
    diff = M.differential(CONCEPT + SUFFIX_NOW, "PROV_ACUM_ACUM" + SUFFIX_BEFORE, "PROV_ACUM_ACUM" + SUFFIX_NOW)
    joined = joined.withColumn("DIFERENCIAL_ACUM", diff)
    code = F.col(PRODUCT + SUFFIX_NOW)
    cond = ~code.eqNullSafe(PRODUCT_EXCLUDED) if null_safe else code != PRODUCT_EXCLUDED
    return joined.filter(cond)


def duplicate_keys(df: DataFrame, keys=KEYS) -> DataFrame:
    """Composite keys held by more than one row (D13): such keys multiply in ``compare``.

    One aggregation (partial on the map side); a key held by a third of all
    rows is one group, counted without being collected.
    """
    keys = list(keys)
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


# Columns that count the rows a line of ``compare_unique`` stands for.
N_ROWS = "FILAS"


def compare_unique(snapshots: DataFrame, before: str, now: str, period_col: str, keys=KEYS) -> DataFrame:
    """Two periods side by side, one row per key and concept (D13): repeated keys neither multiply nor meet another concept.

    A full outer join of two periods that are first made unique is one
    aggregation over both: rows of a key and concept (null is a concept of its
    own) sum their money columns by period and take the least value of each
    attribute; ``FILAS_ANT`` and ``FILAS_ACT`` say how many rows they were, 0
    for a period without any. Stored snapshots bucketed by the keys are read
    once and not shuffled. The differential is 0 without a current row or
    concept; rows whose current product is the excluded one go, others stay.
    """
    money = [name for name, _ in BALANCE_COLUMNS] + ["SALDO_TOTAL"] + [name for name, _ in MONEY_COLUMNS]
    rows = derive(snapshots.filter(F.col(period_col).isin(before, now)))
    attributes = [c for c in rows.columns if c not in (*keys, CONCEPT, *money)]
    columns = []
    for period, sfx in ((before, SUFFIX_BEFORE), (now, SUFFIX_NOW)):
        own = F.col(period_col) == period
        columns.append(F.count_if(own).alias(N_ROWS + sfx))
        columns += [F.min(F.when(own, F.col(c))).alias(c + sfx) for c in attributes
                    if sfx == SUFFIX_NOW or c not in CURRENT_ONLY]
        columns += [F.sum(F.when(own, F.col(c))).cast(M.MONEY_SUM).alias(c + sfx) for c in money]
    out = rows.groupBy(*keys, CONCEPT).agg(*columns)
    current = F.when(F.col(N_ROWS + SUFFIX_NOW) > 0, F.col(CONCEPT))
    total = "PROV_ACUM_ACUM"
    difference = F.when(current.isNull(), F.lit(0)).otherwise(F.col(total + SUFFIX_BEFORE) - F.col(total + SUFFIX_NOW))
    return (out.withColumn("DIFERENCIAL_ACUM", difference.cast(M.MONEY_SUM))
            .filter(~F.col(PRODUCT + SUFFIX_NOW).eqNullSafe(PRODUCT_EXCLUDED)))
