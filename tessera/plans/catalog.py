"""Registered queries: one per operator group of the inventory.

``QUERIES[name](spark, sf_dir) -> DataFrame`` builds the Spark plan (lazy);
``ORACLE[name]`` is the DuckDB SQL that must give the same rows. Every query
reads the test tables through ``sources.relations`` and runs over whole
tables; only the period queries that are about one month or two
(``period_scan``, ``period_full_outer``, ``period_compare``) select months.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import flags as FL
from ..functions import measures as M
from ..functions import text as T
from ..functions import times as TM
from ..operators import consent as C
from ..operators import periods as P
from ..operators.audit import counts_of
from ..operators.decode import active_lists, decode_by, duplicate_codes, unique_labels
from ..operators.lists import ordered_list
from ..sources.relations import PERIOD, cte, deal_parts, frames, read_snapshot, snapshot, snapshot_store
from ..sources.tables import csv_lines, parse_csv_lines, sql, table
from . import oracle_sql as O
from . import profile as PR

# Periods compared by the period queries (previous, current).
PERIOD_BEFORE, PERIOD_NOW = "199806", "199807"
# Run date of the recency filter.
RUN_DATE = "1998-08-02"
RECENT_MONTHS = 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _f(spark, sf_dir, *names):
    return frames(spark, sf_dir, *names)


# =================================================================== text
@register("full_name", f"""{cte('contact')}
SELECT row_id, {O.fullname('fst_name', 'last_name', 'maiden_name')} AS full_name FROM contact""")
def q_full_name(spark, d):
    """Names of customers and employees."""
    return _f(spark, d, "contact")["contact"].select(
        "row_id", T.full_name("fst_name", "last_name", "maiden_name").alias("full_name"))


@register("city_label", f"""{cte('code_list')}
SELECT val AS city_code, desc_text, {O.clean('desc_text')} AS city FROM code_list WHERE list_type = 'CITY'""")
def q_city_label(spark, d):
    codes = _f(spark, d, "code_list")["code_list"]
    return (codes.filter(F.col("list_type") == "CITY")
            .select(F.col("val").alias("city_code"), "desc_text", T.clean_label("desc_text").alias("city")))


@register("doc_key", f"""{cte('contact', 'identifier')}
SELECT 'C' AS side, row_id AS id, id_num AS raw_doc, {O.dockey('id_num')} AS doc_join,
       {O.dockey('CAST(row_id AS DECIMAL(38,0))')} AS doc_from_number FROM contact
UNION ALL
SELECT 'E' AS side, owner_id AS id, ref_num AS raw_doc, {O.dockey('ref_num')} AS doc_join,
       {O.dockey('CAST(owner_id AS DECIMAL(38,0))')} AS doc_from_number FROM identifier""")
def q_doc_key(spark, d):
    f = _f(spark, d, "contact", "identifier")
    a = f["contact"].select(F.lit("C").alias("side"), F.col("row_id").alias("id"), F.col("id_num").alias("raw_doc"),
                            T.doc_key("id_num").alias("doc_join"), T.doc_key_of_number("row_id").alias("doc_from_number"))
    b = f["identifier"].select(F.lit("E").alias("side"), F.col("owner_id").alias("id"),
                            F.col("ref_num").alias("raw_doc"), T.doc_key("ref_num").alias("doc_join"),
                            T.doc_key_of_number("owner_id").alias("doc_from_number"))
    return a.unionByName(b)


@register("null_defaults", f"""{cte('contact')}
SELECT row_id, coalesce(fst_name, 'N/A') AS fst_name, coalesce(maiden_name, '-') AS maiden_name FROM contact""")
def q_null_defaults(spark, d):
    c = _f(spark, d, "contact")["contact"]
    return c.select("row_id", T.or_default("fst_name").alias("fst_name"),
                    T.or_default("maiden_name", "-").alias("maiden_name"))


# ================================================================== times
@register("parse_timestamps", f"""{cte('consent')}
SELECT consent_id, create_date,
       {O.parse('create_date', TM.LAW_A_FORMATS)} AS ts_law_a,
       {O.parse('create_date', TM.FORM_FORMATS)} AS ts_form,
       {O.parse('create_date', TM.DAY_FIRST_FORMATS)} AS ts_day_first,
       {O.iso_cast('create_date')} AS ts_cast
FROM consent""")
def q_parse_timestamps(spark, d):
    c = _f(spark, d, "consent")["consent"]
    return c.select("consent_id", "create_date",
                    TM.parse_any("create_date", TM.LAW_A_FORMATS).alias("ts_law_a"),
                    TM.parse_any("create_date", TM.FORM_FORMATS).alias("ts_form"),
                    TM.parse_any("create_date", TM.DAY_FIRST_FORMATS).alias("ts_day_first"),
                    TM.as_timestamp("create_date").alias("ts_cast"))


@register("consent_flags", f"""{cte('consent')}
SELECT consent_id, agree_ind, CAST(agree_ind AS VARCHAR) AS agree_text, {O.safe_int('agree_ind')} AS agree_int,
       {O.law_a_flag('agree_ind')} AS agree_law_a, {O.law_b_flag('agree_ind')} AS agree_law_b
FROM consent""")
def q_consent_flags(spark, d):
    c = _f(spark, d, "consent")["consent"]
    return c.select("consent_id", "agree_ind", F.col("agree_ind").cast("string").alias("agree_text"),
                    FL.safe_int("agree_ind").alias("agree_int"), FL.law_a_flag("agree_ind").alias("agree_law_a"),
                    FL.law_b_flag("agree_ind").alias("agree_law_b"))


# =========================================================== rows / filters
@register("active_rows", f"""{cte('point')}
SELECT owner_id, point_id, number, extension FROM point WHERE end_date IS NULL""")
def q_active_rows(spark, d):
    return PR.open_points(_f(spark, d, "point")).select("owner_id", "point_id", "number", "extension")


@register("recent_rows", f"""SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE CAST(o_orderdate AS DATE) >= CAST('{RUN_DATE}' AS DATE) - INTERVAL {RECENT_MONTHS} MONTH""")
def q_recent_rows(spark, d):
    o = table(spark, d, "orders")
    since = F.add_months(F.lit(RUN_DATE).cast("date"), -RECENT_MONTHS)
    return o.filter(F.to_date("o_orderdate") >= since).select("o_orderkey", "o_custkey", "o_orderdate")


# ================================================================== star
STAR_SQL = """
SELECT c.row_id AS customer_id, c.id_num, c.id_type, c.primary_point_id, o.org_loc, o.org_name, pos.position_name,
       boss.emp_num, att.attention_code, ad.addr, ad.city_code, sa.segment_code, pr.class_code
FROM {contact} c
     LEFT JOIN {attention} att ON att.contact_id = c.row_id
     LEFT JOIN {address} ad ON ad.addr_id = c.addr_id,
     {segment_attr} sa, {position_link} pl, {position} pos, {org_unit} o, {contact} boss, {employee} emp,
     {holding} h, {asset} a, {product} pr
WHERE 1 = 1
  AND sa.contact_id = c.row_id
  AND pl.contact_id = c.row_id
  AND pl.position_id = c.primary_position_id
  AND pos.position_id = pl.position_id
  AND o.org_id = pos.org_id
  AND boss.row_id = pos.manager_id
  AND emp.contact_id = boss.row_id
  AND h.contact_id = c.row_id
  AND a.asset_id = h.asset_id
  AND pr.product_id = a.product_id
  AND sa.segment_flag = :flag
  AND o.org_name <> :unit
  AND pos.position_name <> :position
  AND a.status_code IN ('O')
  AND h.relation_type IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""


@register("star_join_base", f"""{O.with_ctes([O.star_rows_cte()])}
SELECT * FROM star""")
def q_star_join_base(spark, d):
    """The star as SQL text over the relations; Catalyst turns the comma joins into equi-joins.

    The comma list is ordered so that every relation has an equality with the
    ones before it; the join reordering then never needs a cross product.
    Contacts are read in two roles: customers and the managers of positions.
    """
    p = PR.DEFAULT
    return sql(spark, STAR_SQL, {"flag": p.commercial_flag, "unit": p.excluded_unit, "position": p.excluded_position},
               **_f(spark, d, *[r for r in PR.PROFILE_RELATIONS if r not in ("code_list", "point")]))


def _decoded(star, labelled):
    """The star with all five lists decoded from one frame of labels."""
    out = PR.decode_customers(star, labelled)
    out = decode_by(out, labelled, PR.DEFAULT.list_types["class"], "class_code", "product_class")
    return out.select("customer_id", "doc_type", "segment", "attention", "city", "product_class")


@register("decode_five_lists", f"""{O.with_ctes([O.star_rows_cte()])}
SELECT s.customer_id, td.high AS doc_type, sg.desc_text AS segment, atn.desc_text AS attention,
       {O.clean('ci.desc_text')} AS city, cl.desc_text AS product_class
FROM star s {O.code('td', 'doc', 'name', 's.id_type')} {O.code('sg', 'segment', 'name', 's.segment_code')}
{O.code('atn', 'attention', 'name', 's.attention_code')} {O.code('ci', 'city', 'val', 's.city_code')}
{O.code('cl', 'class', 'val', 's.class_code')}""")
def q_decode_five_lists(spark, d):
    """S4a/J4 as written: a code listed twice repeats the facts."""
    return _decoded(q_star_join_base(spark, d), PR.labels(_f(spark, d, "code_list")))


def _unique_code(kind: str, on: str) -> str:
    """A fact's label by a list of which each code counts once."""
    key, label = {"doc": ("name", "high"), "city": ("val", "desc_text"), "class": ("val", "desc_text")}.get(
        kind, ("name", "desc_text"))
    return (f"(SELECT min({label}) FROM code_list l WHERE l.list_type = {O.q(PR.DEFAULT.list_types[kind])} "
            f"AND l.active_flg = 'Y' AND l.{key} = {on})")


@register("decode_unique_codes", f"""{O.with_ctes([O.star_rows_cte()])}
SELECT s.customer_id, {_unique_code('doc', 's.id_type')} AS doc_type, {_unique_code('segment', 's.segment_code')} AS segment,
       {_unique_code('attention', 's.attention_code')} AS attention,
       {O.clean(_unique_code('city', 's.city_code'))} AS city, {_unique_code('class', 's.class_code')} AS product_class
FROM star s""")
def q_decode_unique_codes(spark, d):
    """The same decode by lists of unique codes; no fact is repeated."""
    return _decoded(q_star_join_base(spark, d), unique_labels(PR.labels(_f(spark, d, "code_list"))))


@register("dropped_codes", f"""{cte('code_list')},
    coded AS (SELECT list_type || '|' || CASE WHEN list_type IN ('CITY', 'PROD_CLASS') THEN val ELSE name END AS list_code,
                     CASE WHEN list_type = 'DOC_TYPE' THEN high ELSE desc_text END AS label
              FROM code_list WHERE active_flg = 'Y' AND list_type <> 'SUBSEGMENT')
SELECT list_code, min(label) AS label, count(*) - 1 AS n_dropped FROM coded WHERE list_code IS NOT NULL GROUP BY list_code""")
def q_dropped_codes(spark, d):
    """The label that each code keeps, and how many rows it had beside it."""
    return unique_labels(PR.labels(_f(spark, d, "code_list")))


@register("decode_label_filter", f"""{O.with_ctes([O.people_cte(), O.classes_cte()])}
SELECT DISTINCT p.row_id, p.segment FROM people p JOIN classes cl ON cl.row_id = p.row_id""")
def q_decode_label_filter(spark, d):
    f = _f(spark, d, *PR.PROFILE_RELATIONS)
    return PR.customer_rows(f).join(PR.holders(f), "row_id", "left_semi").select("row_id", "segment").distinct()


@register("dup_codes", f"""{cte('code_list')},
    coded AS (SELECT *, CASE WHEN list_type IN ('CITY', 'PROD_CLASS') THEN val ELSE name END AS code FROM code_list)
SELECT list_type, code, count(*) AS n_rows,
       CAST(sum(CASE WHEN active_flg = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS n_active
FROM coded GROUP BY list_type, code HAVING count(*) > 1""")
def q_dup_codes(spark, d):
    return duplicate_codes(_f(spark, d, "code_list")["code_list"], PR.DEFAULT.shapes())


@register("left_join_on_constant", f"""{cte('attention', 'code_list')}
SELECT a.contact_id, a.attention_code, t.desc_text AS attention
FROM attention a LEFT JOIN code_list t
  ON a.attention_code = t.name AND t.list_type = 'ATTENTION' AND t.active_flg = 'Y'""")
def q_left_join_on_constant(spark, d):
    """The list constants sit in the ON clause, so unmatched rows stay."""
    f = _f(spark, d, "attention", "code_list")
    a, t = f["attention"].alias("a"), f["code_list"].alias("t")
    cond = ((F.col("a.attention_code") == F.col("t.name")) & (F.col("t.list_type") == "ATTENTION")
            & (F.col("t.active_flg") == "Y"))
    return a.join(t, cond, "left").select("a.contact_id", "a.attention_code",
                                          F.col("t.desc_text").alias("attention"))


# ================================================================= lists
@register("points_by_number", f"""{cte('point', 'contact')},
    {O.phones_cte()}
SELECT owner_id, TELEFONOS FROM phones""")
def q_points_by_number(spark, d):
    f = _f(spark, d, "point", "contact")
    return PR.point_lists(PR.open_points(f), f["contact"], "left")


def _point_labels(f, points):
    """(owner_id, rnk, num, fmt): ``number|ext`` with the primary point marked.

    The mark comes from a join on (owner, point), so a hot owner's points stay
    spread over tasks and shrink there before the lists are shuffled.
    """
    text = T.point_text("number", "extension")
    return PR.marked(points, f["contact"]).select(
        "owner_id", F.when(F.col("is_primary"), 0).otherwise(1).alias("rnk"), F.trim("number").alias("num"),
        F.when(F.col("is_primary"), F.concat(F.lit(T.PRIMARY_MARK), text)).otherwise(text).alias("fmt"))


@register("points_primary_first", f"""{cte('point', 'contact')}
{O.distinct_points('rnk, num', O.NOT_BLANK)}""")
def q_points_primary_first(spark, d):
    """``number|ext``, primary first, each text once per owner."""
    f = _f(spark, d, "point", "contact")
    labels = _point_labels(f, PR.open_points(f).filter(T.non_blank("number")))
    return ordered_list(labels, ["owner_id"], ["rnk", "num"], "fmt", "TELEFONOS", distinct=True)


@register("points_right_join", f"""{cte('point', 'contact')},
    {O.right_phones_cte()}
SELECT owner_id AS row_id, TELEFONOS FROM phones""")
def q_points_right_join(spark, d):
    f = _f(spark, d, "point", "contact")
    return PR.point_lists_by_customer(PR.open_points(f), f["contact"])


@register("points_inner_join", f"""{cte('point', 'contact')}
SELECT owner_id, string_agg(txt, ', ' ORDER BY num ASC NULLS FIRST, txt ASC NULLS FIRST) AS TELEFONOS
FROM ({O.point_rows(O.point_text('p.number', 'p.extension'), 'AND EXISTS (SELECT 1 FROM contact c WHERE c.row_id = p.owner_id)')})
GROUP BY owner_id""")
def q_points_inner_join(spark, d):
    """Open points of known contacts, blank numbers kept, ordered by number then text.

    Whether the owner is known is tested on its list, one row per owner.
    """
    f = _f(spark, d, "point", "contact")
    # listagg gives null for a group of only null texts (the array form gives '').
    lists = ordered_list(_point_labels(f, PR.open_points(f)), ["owner_id"], ["num"], "fmt", "TELEFONOS",
                         empty_as_null=True)
    return lists.join(f["contact"].select(F.col("row_id").alias("owner_id")), "owner_id", "left_semi")


@register("classes_list", f"""{cte('holding', 'asset', 'product', 'code_list')},
    {O.classes_cte()}
SELECT row_id, classes FROM classes""")
def q_classes_list(spark, d):
    return PR.class_lists(_f(spark, d, "holding", "asset", "product", "code_list"))


@register("dedupe_subset", f"""{cte('holding')}
SELECT contact_id, asset_id, relation_type, count(*) AS n_rows FROM holding
GROUP BY contact_id, asset_id, relation_type""")
def q_dedupe_subset(spark, d):
    """One row per (customer, asset, relation), with how many rows it stood for."""
    h = _f(spark, d, "holding")["holding"]
    return h.groupBy("contact_id", "asset_id", "relation_type").agg(F.count(F.lit(1)).alias("n_rows"))


@register("profile_with_points", f"""{O.with_ctes([O.people_cte(), O.classes_cte(), O.phones_cte()])}
SELECT DISTINCT p.row_id, p.customer_name, ph.TELEFONOS FROM {O.REPORT_FROM}""")
def q_profile_with_points(spark, d):
    """Customers with their point list (null without points), the job's unused phase-5 frame."""
    f = _f(spark, d, *PR.PROFILE_RELATIONS)
    cust = (PR.customer_rows(f).join(PR.holders(f), "row_id", "left_semi")
            .select("row_id", "customer_name").distinct())
    pts = PR.point_lists(PR.open_points(f), f["contact"]).withColumnRenamed("owner_id", "row_id")
    return cust.join(pts, "row_id", "left").select("row_id", "customer_name", "TELEFONOS")


# ================================================================ consent
def _consent(spark, d):
    return _f(spark, d, *PR.CONSENT_RELATIONS)


def _consent_with(*ctes, contact: bool = False) -> str:
    return cte(*(("contact",) if contact else ()), *PR.CONSENT_RELATIONS) + ",\n    " + ",\n    ".join(ctes)


@register("consent_star", f"""{_consent_with(O.LAW_A_ROWS, O.FORM_ROWS, O.REGISTRY_ROWS)}
SELECT 'A' AS source, * FROM law_a_rows
UNION ALL SELECT 'F' AS source, * FROM form_rows
UNION ALL SELECT 'R' AS source, * FROM registry_rows""")
def q_consent_star(spark, d):
    return C.tagged(_consent(spark, d))


@register("latest_per_key", f"""{_consent_with(O.LAW_A_ROWS)}
{O.newest(O.LAW_A_KEYED)}""")
def q_latest_per_key(spark, d):
    return C.latest_of_law(C.source_rows(_consent(spark, d), C.LAW_A))


@register("latest_across_sources", f"""{_consent_with(*O.channel_ctes())}
SELECT * FROM channel""")
def q_latest_across_sources(spark, d):
    return C.latest_channel(C.tagged(_consent(spark, d), (C.FORM, C.REGISTRY)))


@register("union_missing_columns", f"""{_consent_with(*O.channel_ctes())}
SELECT * FROM channel_rows""")
def q_union_missing_columns(spark, d):
    return C.channel_rows(C.tagged(_consent(spark, d), (C.FORM, C.REGISTRY)))


def _newest_consent(f):
    return C.newest_consent(C.tagged(f, (C.LAW_A, C.FORM)))


@register("latest_across_laws", f"""{_consent_with(*O.laws_ctes())}
SELECT * FROM newest""")
def q_latest_across_laws(spark, d):
    return _newest_consent(_consent(spark, d))


_DOCUMENTS = f"ck AS (SELECT row_id, {O.dockey('id_num')} AS doc_join FROM contact)"


def _contacts_keyed(f):
    return f["contact"].select("row_id", T.doc_key("id_num").alias("doc_join"))


@register("consent_gate", f"""{_consent_with(*O.gate_ctes(), _DOCUMENTS, contact=True)}
SELECT row_id, doc_join FROM ck WHERE EXISTS (SELECT 1 FROM gate g WHERE g.doc_join = ck.doc_join)""")
def q_consent_gate(spark, d):
    f = _f(spark, d, "contact", *PR.CONSENT_RELATIONS)
    return C.gate(_contacts_keyed(f), C.law_a_gate(C.source_rows(f, C.LAW_A)))


@register("consent_exclude", f"""{_consent_with(*O.laws_ctes(), _DOCUMENTS, contact=True)}
SELECT row_id, doc_join FROM ck WHERE NOT EXISTS (SELECT 1 FROM refused r WHERE r.doc_join = ck.doc_join)""")
def q_consent_exclude(spark, d):
    f = _f(spark, d, "contact", *PR.CONSENT_RELATIONS)
    return C.exclude(_contacts_keyed(f), C.refused(_newest_consent(f)))


@register("consent_channel", f"""{_consent_with(*O.channel_ctes(), _DOCUMENTS, contact=True)}
SELECT ck.row_id, ck.doc_join, {O.channel_sql('N/A', 'ch')} AS channel
FROM ck LEFT JOIN channel ch ON ch.doc_join = ck.doc_join""")
def q_consent_channel(spark, d):
    f = _f(spark, d, "contact", *PR.CONSENT_RELATIONS)
    channel = C.latest_channel(C.tagged(f, (C.FORM, C.REGISTRY)))
    return _contacts_keyed(f).join(channel, "doc_join", "left").select(
        "row_id", "doc_join", C.winning_channel("N/A").alias("channel"))


# ================================================================ periods
# Every period's snapshot: its rows by key and period.
_EVERY = P.KEYS + (PERIOD,)


def _every(spark, d):
    return snapshot(spark, d, None, True)


def _period_oracle(select: str) -> str:
    return f"WITH {O.derived_cte('s', None, True)}\nSELECT {select} FROM s"


@register("period_scan", f"""{O.snapshot_sql(PERIOD_NOW, True, 'duckdb')}""")
def q_period_scan(spark, d):
    """One period of the stored snapshots; the others' folders are not read."""
    return read_snapshot(spark, d, PERIOD_NOW)


@register("category_label", _period_oracle("STRCLINIT, STROBLOBLIGSARC, STRANOMES, TIPO_CREDITO"))
def q_category_label(spark, d):
    s = _every(spark, d)
    return s.select(*_EVERY, M.category_label(P.CATEGORY).alias("TIPO_CREDITO"))


@register("arrears_band", f"""WITH s AS ({O.snapshot_sql(None, True, 'duckdb')})
SELECT STRCLINIT, STROBLOBLIGSARC, STRANOMES, STRPETIPOCREDITO, DIAS_MORA,
       {O.band_sql('STRPETIPOCREDITO', 'DIAS_MORA')} AS RANGOS_MORA FROM s""")
def q_arrears_band(spark, d):
    s = _every(spark, d)
    return s.select(*_EVERY, P.CATEGORY, P.DAYS, M.arrears_band(P.CATEGORY, P.DAYS).alias("RANGOS_MORA"))


@register("product_line", _period_oracle("STRCLINIT, STROBLOBLIGSARC, STRANOMES, NUMPEPROCODIGO, LINEA_CREDITO, IFRS_COLGAAP"))
def q_product_line(spark, d):
    s = _every(spark, d)
    return s.select(*_EVERY, P.PRODUCT, M.product_line(P.PRODUCT).alias("LINEA_CREDITO"),
                    M.accounting_basis(P.PRODUCT).alias("IFRS_COLGAAP"))


_BAL = ("SALDO_K", "SALDO_I", "SALDO_O", "SALDO_TOTAL")
_BAL_SAFE_SQL = (f"CAST(CASE WHEN NUMTIPOCONCEPTO = {M.ZERO_BALANCE_CONCEPT} THEN 0 ELSE "
                 f"coalesce(NUMPEEDIK, 0) + coalesce(NUMPEEDII, 0) + coalesce(NUMPEEDIKOTROS, 0) END AS DECIMAL(38,2))")


@register("balances", f"""WITH s AS ({O.snapshot_sql(None, True, 'duckdb')})
SELECT STRCLINIT, STROBLOBLIGSARC, STRANOMES, NUMTIPOCONCEPTO,
       {', '.join(f"{e} AS {n}" for n, e in O.derived_sql() if n in _BAL)},
       {_BAL_SAFE_SQL} AS SALDO_TOTAL_NULL_SAFE
FROM s""")
def q_balances(spark, d):
    """M5/M6: balances as the job has them, plus the total that equals the sum of the parts."""
    s = _every(spark, d)
    derived = dict(P.derived_columns())
    return s.select(*_EVERY, P.CONCEPT, *[derived[n].alias(n) for n in _BAL],
                    M.total_balance_null_safe(P.CONCEPT, *P.BALANCES).cast(M.MONEY_SUM).alias("SALDO_TOTAL_NULL_SAFE"))


_PROV = [n for n, _ in O.derived_sql() if n.startswith("PROV_")]


@register("provision_sums", _period_oracle("STRCLINIT, STROBLOBLIGSARC, STRANOMES, " + ", ".join(_PROV)))
def q_provision_sums(spark, d):
    s = P.derive(_every(spark, d))
    return s.select(*_EVERY, *_PROV)


@register("period_measures", _period_oracle(", ".join(O.period_columns(True))))
def q_period_measures(spark, d):
    return P.derive(_every(spark, d))


@register("period_suffix", _period_oracle(", ".join(
    c if c in P.KEYS else f"{c} AS {c}{P.SUFFIX_BEFORE}" for c in O.period_columns(True))))
def q_period_suffix(spark, d):
    return P.suffix(P.derive(_every(spark, d)), P.KEYS, P.SUFFIX_BEFORE)


def _compare_oracle(null_safe: bool) -> str:
    ant = [f"ant.{c} AS {c}{P.SUFFIX_BEFORE}" for c in O.period_columns(False) if c not in P.KEYS]
    act = [f"act.{c} AS {c}{P.SUFFIX_NOW}" for c in O.period_columns(True) if c not in P.KEYS]
    keys = [f"coalesce(ant.{k}, act.{k}) AS {k}" for k in P.KEYS]
    diff = ("CAST(CASE WHEN act.NUMTIPOCONCEPTO IS NULL THEN 0 "
            "ELSE ant.PROV_ACUM_ACUM - act.PROV_ACUM_ACUM END AS DECIMAL(38,2)) AS DIFERENCIAL_ACUM")
    cond = ("act.NUMPEPROCODIGO IS DISTINCT FROM 45" if null_safe else "act.NUMPEPROCODIGO <> 45")
    on = " AND ".join(f"ant.{k} = act.{k}" for k in P.KEYS)
    return (f"WITH {O.derived_cte('ant', PERIOD_BEFORE, False)},\n{O.derived_cte('act', PERIOD_NOW, True)}\nSELECT {', '.join(keys + ant + act)}, {diff}\n"
            f"FROM ant FULL OUTER JOIN act ON {on}\nWHERE {cond}")


@register("duplicate_keys", f"""WITH s AS ({O.snapshot_sql(None, True, 'duckdb')})
SELECT STRCLINIT, STROBLOBLIGSARC, STRANOMES, count(*) AS n_rows FROM s
GROUP BY STRCLINIT, STROBLOBLIGSARC, STRANOMES HAVING count(*) > 1""")
def q_duplicate_keys(spark, d):
    """Keys that a period's snapshot has several rows of; the comparison as written multiplies them."""
    return P.duplicate_keys(snapshot(spark, d, None, True, (deal_parts(spark, d), _EVERY)), _EVERY)


def _periods(spark, d):
    return (P.derive(read_snapshot(spark, d, PERIOD_BEFORE, current=False)),
            P.derive(read_snapshot(spark, d, PERIOD_NOW)))


@register("period_full_outer", _compare_oracle(True))
def q_period_full_outer(spark, d):
    return P.compare(*_periods(spark, d), null_safe=True)


@register("period_compare", _compare_oracle(False))
def q_period_compare(spark, d):
    return P.compare(*_periods(spark, d))


def _unique_oracle() -> str:
    money = [n for n, e in O.derived_sql() if n.startswith(("SALDO", "PROV_"))]
    sides, out = [], [f"coalesce(ant.{k}, act.{k}) AS {k}" for k in (*P.KEYS, P.CONCEPT)]
    for name, current, sfx in (("ant", False, P.SUFFIX_BEFORE), ("act", True, P.SUFFIX_NOW)):
        attributes = [c for c in O.period_columns(current) if c not in (*P.KEYS, P.CONCEPT, *money)]
        own = [f"min({c}) AS {c}" for c in attributes] + [f"CAST(sum({c}) AS DECIMAL(38,2)) AS {c}" for c in money]
        sides.append(f"{name}_unique AS (SELECT {', '.join((*P.KEYS, P.CONCEPT))}, count(*) AS n, {', '.join(own)} "
                     f"FROM {name} GROUP BY ALL)")
        out += [f"coalesce({name}.n, 0) AS {P.N_ROWS}{sfx}"] + [f"{name}.{c} AS {c}{sfx}" for c in (*attributes, *money)]
    on = " AND ".join(f"ant.{k} IS NOT DISTINCT FROM act.{k}" for k in (*P.KEYS, P.CONCEPT))
    diff = ("CAST(CASE WHEN act.n IS NULL OR act.NUMTIPOCONCEPTO IS NULL THEN 0 "
            "ELSE ant.PROV_ACUM_ACUM - act.PROV_ACUM_ACUM END AS DECIMAL(38,2)) AS DIFERENCIAL_ACUM")
    return (f"WITH {O.derived_cte('ant', PERIOD_BEFORE, False)},\n{O.derived_cte('act', PERIOD_NOW, True)},\n"
            f"{', '.join(sides)}\nSELECT {', '.join(out)}, {diff}\nFROM ant_unique ant FULL OUTER JOIN act_unique act ON {on}\n"
            "WHERE act.NUMPEPROCODIGO IS DISTINCT FROM 45")


@register("period_compare_unique", _unique_oracle())
def q_period_compare_unique(spark, d):
    """The comparison with one row per customer, obligation and concept, and how many rows each period had of it."""
    return P.compare_unique(snapshot_store(spark, d), PERIOD_BEFORE, PERIOD_NOW, PERIOD)


# ============================================================== pipelines
@register("profile_final", O.profile_final_sql())
def q_profile_final(spark, d):
    return PR.profile_final(PR.load(spark, d))


@register("preview_top10", O.profile_final_sql(order=False) + " ORDER BY CLIENTE, IDENT LIMIT 10")
def q_preview_top10(spark, d):
    """The first ten report rows in a unique order (top-k, no full sort)."""
    rep = PR.profile_final(PR.load(spark, d), sort=False)
    return rep.orderBy("CLIENTE", "IDENT").limit(10)


def _gated_oracle() -> str:
    ctes = [O.people_cte(), O.classes_cte(), O.phones_cte(), *O.gate_ctes(), *O.channel_ctes()]
    tel = f"coalesce(ph.TELEFONOS, {O.q(PR.NO_POINTS)})"
    doc = O.dockey("p.id_num")
    return f"""{O.with_ctes(ctes, PR.RELATIONS)}
    SELECT {O.report_select(tel)}, {O.channel_sql('N/A', 'ch')} AS {PR.GATED_CHANNEL}
    FROM {O.REPORT_FROM} LEFT JOIN channel ch ON ch.doc_join = {doc}
    WHERE {doc} IN (SELECT doc_join FROM gate) ORDER BY CLIENTE"""


@register("profile_gated", _gated_oracle())
def q_profile_gated(spark, d):
    return PR.profile_gated(PR.load(spark, d))


def _excluded_oracle() -> str:
    ctes = [O.people_cte(), O.classes_cte(), O.right_phones_cte(), *O.laws_ctes()]
    doc = O.dockey("p.id_num")
    return f"""{O.with_ctes(ctes, PR.RELATIONS)}
    SELECT {O.report_select("ph.TELEFONOS")}, al.canal_contacto AS {PR.EXCLUDED_CHANNEL}
    FROM {O.REPORT_FROM} LEFT JOIN allowed al ON al.doc_join = {doc}
    WHERE NOT EXISTS (SELECT 1 FROM refused r WHERE r.doc_join = {doc}) ORDER BY CLIENTE"""


@register("profile_excluded", _excluded_oracle())
def q_profile_excluded(spark, d):
    return PR.profile_excluded(PR.load(spark, d))


# ====================================================== profile as one SQL
PROFILE_SQL = """
WITH code AS (
    SELECT DISTINCT list_type,
           CASE WHEN array_contains(map_keys(:key_columns), list_type)
                THEN CASE :key_columns[list_type] WHEN 'val' THEN val ELSE name END END AS code,
           CASE WHEN array_contains(map_keys(:label_columns), list_type)
                THEN CASE :label_columns[list_type] WHEN 'high' THEN high ELSE desc_text END END AS label
    FROM {code_list} WHERE active_flg = 'Y'
),
named AS (
    SELECT *, trim(regexp_replace(concat_ws(' ', fst_name, last_name, maiden_name), '\\\\s+', ' ')) AS raw_name
    FROM {contact}
),
person AS (
    SELECT *, concat(upper(left(raw_name, 1)), lower(substring(raw_name, 2))) AS person_name FROM named
),
seat AS (
    SELECT pl.contact_id, pl.position_id, o.org_loc, boss.emp_num, boss.person_name AS manager_name
    FROM {position_link} pl
    JOIN {position} pos ON pos.position_id = pl.position_id AND pos.position_name <> :position
    JOIN {org_unit} o ON o.org_id = pos.org_id AND o.org_name <> :unit
    JOIN person boss ON boss.row_id = pos.manager_id
    LEFT SEMI JOIN {employee} e ON e.contact_id = pos.manager_id
),
place AS (
    SELECT ad.addr_id, ad.addr, trim(regexp_replace(regexp_replace(ct.label, '\\\\.+\\\\s*$', ''), '\\\\s+', ' ')) AS city
    FROM {address} ad JOIN code ct ON ct.list_type = :city_list AND ct.code = ad.city_code
),
customer AS (
    SELECT DISTINCT c.row_id, c.id_num, td.label AS doc_type, c.person_name, s.org_loc, s.manager_name, s.emp_num,
           sg.label AS segment, atn.label AS attention, pl.addr,
           concat(upper(left(pl.city, 1)), lower(substring(pl.city, 2))) AS city
    FROM person c
    JOIN seat s ON s.contact_id = c.row_id AND s.position_id = c.primary_position_id
    JOIN {segment_attr} sa ON sa.contact_id = c.row_id AND sa.segment_flag = :flag
    JOIN code sg ON sg.list_type = :segment_list AND sg.code = sa.segment_code
    JOIN code sub ON sub.list_type = :subsegment_list AND sub.code = sa.subsegment_code
    JOIN code td ON td.list_type = :doc_list AND td.code = c.id_type
    JOIN place pl ON pl.addr_id = c.addr_id
    JOIN {attention} att ON att.contact_id = c.row_id
    LEFT JOIN code atn ON atn.list_type = :attention_list AND atn.code = att.attention_code
    WHERE array_contains(:segments, sg.label)
),
held AS (
    SELECT DISTINCT h.contact_id, cl.label
    FROM {holding} h
    JOIN {asset} a ON a.asset_id = h.asset_id AND array_contains(:statuses, a.status_code)
    JOIN {product} pr ON pr.product_id = a.product_id
    JOIN code cl ON cl.list_type = :class_list AND cl.code = pr.class_code
    WHERE array_contains(:relations, h.relation_type)
),
products AS (
    SELECT contact_id, listagg(label, ', ') WITHIN GROUP (ORDER BY label) AS labels FROM held GROUP BY contact_id
),
points AS (
    SELECT p.owner_id, trim(p.number) AS num,
           concat(CASE WHEN k.row_id IS NOT NULL THEN 'P-' ELSE '' END, trim(p.number),
                  CASE WHEN length(trim(p.extension)) > 0 THEN concat('|', trim(p.extension)) ELSE '' END) AS label
    FROM {point} p LEFT JOIN (SELECT DISTINCT row_id, primary_point_id FROM {contact}) k
         ON k.row_id = p.owner_id AND k.primary_point_id = p.point_id
    WHERE p.end_date IS NULL
),
phones AS (
    SELECT owner_id, listagg(label, ', ') WITHIN GROUP (ORDER BY num, label) AS labels FROM points GROUP BY owner_id
)
SELECT c.segment AS SEGMENTO, c.doc_type AS `TIPO DE DOCUMENTO`, c.id_num AS IDENT, c.person_name AS CLIENTE,
       c.attention AS CAPA, c.org_loc AS `CODIGO ZONAL`, c.emp_num AS `CODIGO SAP GERENTE`,
       c.manager_name AS NOMBRE_GERENTE, pr.labels AS PRODUCTO, ph.labels AS TELEFONOS, c.addr AS DIRECCION,
       c.city AS CIUDAD
FROM customer c JOIN products pr ON pr.contact_id = c.row_id JOIN phones ph ON ph.owner_id = c.row_id
ORDER BY c.person_name, c.id_num
"""


def _profile_sql_oracle() -> str:
    points = O.point_rows(O.point_text("p.number", "p.extension"), "")
    phones = f"""phones AS (SELECT owner_id, string_agg(txt, ', ' ORDER BY num ASC NULLS FIRST, txt ASC NULLS FIRST)
        AS TELEFONOS FROM ({points}) GROUP BY owner_id)"""
    ctes = [O.people_cte(inner=True), O.classes_cte(inner=True), phones]
    return f"""{O.with_ctes(ctes)}
    SELECT {O.report_select("ph.TELEFONOS")}
    FROM people p JOIN classes cl ON cl.row_id = p.row_id JOIN phones ph ON ph.owner_id = p.row_id
    ORDER BY CLIENTE, IDENT"""


@register("profile_sql", _profile_sql_oracle())
def q_profile_sql(spark, d):
    """The whole profile as one SQL statement (S12), planned by Catalyst.

    Customers are made distinct once, holdings and points become one list per
    owner before they meet them.
    """
    return profile_sql(spark, _f(spark, d, *PR.PROFILE_RELATIONS))


def profile_sql(spark, f, p=PR.DEFAULT):
    def listed(values):
        return F.array(*[F.lit(v) for v in values])

    def mapped(which: int):
        return F.create_map(*[F.lit(x) for t, columns in p.shapes().items() for x in (t, columns[which])])

    args = {"flag": p.commercial_flag, "unit": p.excluded_unit, "position": p.excluded_position,
            "segments": listed(p.segments), "statuses": listed(p.active_status), "relations": listed(p.relation_types),
            "key_columns": mapped(0), "label_columns": mapped(1),
            **{f"{kind}_list": t for kind, t in p.list_types.items()}}
    return sql(spark, PROFILE_SQL, args, **f)


# ========================================================== sinks / audit
EXPORT_SCHEMA = StructType([StructField(c, StringType()) for c in PR.REPORT_COLUMNS])


@register("csv_round_trip", O.profile_final_sql(order=False))
def q_csv_round_trip(spark, d):
    """The report as the lines of the CSV export, read back with a schema.

    Blanks, quotes, line breaks, empty text and null come back as they were.
    Lines are made and read at run time; ``write_csv`` and ``read_csv`` put the
    same lines to files.
    """
    return parse_csv_lines(csv_lines(PR.profile_final(PR.load(spark, d))), EXPORT_SCHEMA)


def _stage_oracle() -> str:
    t = PR.DEFAULT.list_types
    types = O.in_list([t["doc"], t["segment"], t["city"], t["class"], t["attention"]])
    ctes = [O.people_cte(), O.classes_cte(), O.phones_cte(), *O.gate_ctes(), *O.channel_ctes()]
    return f"""{O.with_ctes(ctes, PR.RELATIONS)},
    report AS (SELECT {O.dockey('p.id_num')} AS doc_join FROM {O.REPORT_FROM})
    SELECT 'code_lists' AS stage, count(*) AS row_count FROM code_list
      WHERE list_type IN ({types}) AND active_flg = 'Y'
    UNION ALL SELECT 'open_points', count(*) FROM point WHERE end_date IS NULL
    UNION ALL SELECT 'customers', count(*) FROM people
    UNION ALL SELECT 'report', count(*) FROM report
    UNION ALL SELECT 'law_a_gate', count(*) FROM gate
    UNION ALL SELECT 'law_b_latest', count(*) FROM channel
    UNION ALL SELECT 'gated', count(*) FROM report WHERE doc_join IN (SELECT doc_join FROM gate)"""


@register("stage_counts", _stage_oracle())
def q_stage_counts(spark, d):
    """The row counts the jobs print, as one DataFrame computed in one job.

    Customers, report and gated rows are flags of one plan, gate and channel
    documents those of one consent state.
    """
    f = PR.load(spark, d)
    lists = active_lists(f["code_list"], list(PR.DEFAULT.list_types.values())[:5])
    one = F.count(F.lit(1))
    return counts_of([
        (lists, {"code_lists": one}),
        (PR.open_points(f), {"open_points": one}),
        (PR.customer_flags(f), {"customers": one, "report": F.count_if("in_report"),
                                "gated": F.count_if(F.col("in_report") & F.col("passes"))}),
        (C.document_state(C.tagged(f)), {"law_a_gate": F.count_if("passes"), "law_b_latest": F.count("origin")}),
    ])
