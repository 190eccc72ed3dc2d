"""The warehouse relations the jobs read, derived from the test tables.

The jobs read a CRM star (contacts, position links, positions, units,
employees, addresses, segment attributes, holdings, assets, products, code
lists, contact points), a consent store (consents, owners, identifiers,
provisions, entities, purposes, regulations, activities, tenants) and a monthly provision snapshot. The test
folders hold TPC-H-like tables instead, so each relation is derived from them
by one SQL text that Spark and DuckDB both run unchanged. That keeps the
Spark plans and the oracle on exactly the same inputs.

Nulls, blanks, misses, ties, closed rows, odd date texts and refusals do not
occur in the test tables; they are made here from key arithmetic, so every
edge the jobs guard against is present in the data.

Roles (relation <- test table):

    contact      <- customer (+ first or last order as primary contact point), supplier (employees)
    segment_attr <- customer
    position_link <- customer       (primary and other positions of a customer)
    position     <- nation
    org_unit     <- region
    employee     <- nation          (which managers have an employee record)
    attention    <- supplier        (optional attribute, keyed by customer)
    address      <- nation          (optional, keyed by customer % 30)
    holding      <- lineitem x orders
    asset        <- lineitem
    product      <- part            (class = part type)
    code_list    <- region, customer, nation, part (one relation, six list types)
    point        <- orders          (owner, number, extension, close date)
    consent      <- events          (owner, purpose, flag text, date text)
    owner / identifier <- customer
    provision / entity <- events    (channel and attributes of a consent)
    purpose / regulation / activity / tenant <- region, nation
    snapshot     <- lineitem        (rows of supplier x part group and month, some of several concepts, some repeated)

Each template names the frames it reads as ``{name}``: a test table or another
relation. ``frame`` builds the Spark DataFrame; ``cte`` renders a ``WITH`` list
for DuckDB.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .tables import TABLES, sql, table

# Text of a consent date in one of six shapes (ISO ones with and without an offset), built from the event time with
# functions both engines share (no format strings, which differ between them).
_YMD = ("concat(cast(year(e.ts) AS string), '-', lpad(cast(month(e.ts) AS string), 2, '0'), '-', "
        "lpad(cast(day(e.ts) AS string), 2, '0'))")
_HMS = ("concat(lpad(cast(hour(e.ts) AS string), 2, '0'), ':', lpad(cast(minute(e.ts) AS string), 2, '0'), "
        "':', lpad(cast(second(e.ts) AS string), 2, '0'))")
_DMY = ("concat(lpad(cast(day(e.ts) AS string), 2, '0'), '/', lpad(cast(month(e.ts) AS string), 2, '0'), "
        "'/', substring(cast(year(e.ts) AS string), 3, 2))")
_H12 = ("concat(lpad(cast(CASE WHEN hour(e.ts) % 12 = 0 THEN 12 ELSE hour(e.ts) % 12 END AS string), 2, '0'), "
        "':', lpad(cast(minute(e.ts) AS string), 2, '0'), ':', lpad(cast(second(e.ts) AS string), 2, '0'))")
_AMPM = "CASE WHEN hour(e.ts) < 12 THEN 'AM' ELSE 'PM' END"
_MILLI = "lpad(cast(e.event_id % 1000 AS string), 3, '0')"
_MICRO = "lpad(cast(e.event_id % 1000000 AS string), 6, '0')"
DATE_TEXT = f"""CASE e.event_id % 6
            WHEN 0 THEN CASE e.event_id % 18 WHEN 0 THEN concat({_YMD}, 'T', {_HMS}, 'Z')
                                             WHEN 6 THEN concat({_YMD}, ' ', {_HMS}, '+05:30')
                                             ELSE concat({_YMD}, ' ', {_HMS}) END
            WHEN 1 THEN concat({_YMD}, ' ', {_HMS}, '.', {_MILLI})
            WHEN 2 THEN concat({_YMD}, ' ', {_HMS}, '.', {_MICRO})
            WHEN 3 THEN concat({_DMY}, ' ', {_H12}, ' ', {_AMPM})
            WHEN 4 THEN concat({_DMY}, ' ', {_H12}, ',', {_MILLI}, '000000 ', {_AMPM})
            ELSE CASE WHEN e.event_id % 12 = 5 THEN NULL ELSE 'n/a' END
        END"""

# Agreement flag as text: 0 / 1 / 2, with null, padded, decimal and junk values.
AGREE_TEXT = """CASE WHEN e.event_id % 11 = 0 THEN NULL
             WHEN e.event_id % 13 = 0 THEN ' 1 '
             WHEN e.event_id % 17 = 0 THEN '1.0'
             WHEN e.event_id % 19 = 0 THEN 'x'
             ELSE cast(e.event_id % 3 AS string) END"""

# Consent owner: each user's events are spread over ten owners, so consents
# reach every customer document (users are a tenth of the customers).
CONSENT_OWNER = "(e.user_id * 10 + e.event_id % 10)"

RELATIONS: dict[str, str] = {
    # ---------------------------------------------------------------- CRM star
    # Primary contact point of a customer: its first order.
    "first_point": """
        SELECT o_custkey AS owner_id, min(o_orderkey) AS first_point_id
        FROM {orders} GROUP BY o_custkey""",
    # Another one: its last order.
    "last_point": """
        SELECT o_custkey AS owner_id, max(o_orderkey) AS last_point_id
        FROM {orders} GROUP BY o_custkey""",
    # Contacts: customers (some listed twice, with another primary point), and the employees who manage positions (one relation, read in both roles).
    "contact": """
        SELECT c.c_custkey AS row_id,
               concat(CASE WHEN c.c_custkey % 6 = 1 THEN ' ' ELSE '' END,
                      lpad(cast(c.c_custkey AS string), 12, '0')) AS id_num,
               CASE c.c_custkey % 4 WHEN 0 THEN 'CC' WHEN 1 THEN 'CE' WHEN 2 THEN 'NIT' ELSE 'PAS' END AS id_type,
               CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE lower(c.c_mktsegment) END AS fst_name,
               CASE WHEN c.c_custkey % 7 = 0 THEN NULL
                    ELSE concat(chr(9), replace(c.c_name, '#', '  ')) END AS last_name,
               CASE WHEN c.c_custkey % 3 = 0 THEN concat(' del ', c.c_mktsegment, '   ') END AS maiden_name,
               CAST(NULL AS string) AS emp_num,
               CAST(c.c_nationkey AS bigint) AS primary_position_id,
               c.c_custkey % 30 AS addr_id,
               CASE WHEN c.c_custkey % 8 = 3 THEN NULL ELSE fp.first_point_id END AS primary_point_id
        FROM {customer} c LEFT JOIN {first_point} fp ON fp.owner_id = c.c_custkey
        UNION ALL
        SELECT c.c_custkey, concat(CASE WHEN c.c_custkey % 6 = 1 THEN ' ' ELSE '' END, lpad(cast(c.c_custkey AS string), 12, '0')),
               CASE c.c_custkey % 4 WHEN 0 THEN 'CC' WHEN 1 THEN 'CE' WHEN 2 THEN 'NIT' ELSE 'PAS' END,
               CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE lower(c.c_mktsegment) END,
               CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE concat(chr(9), replace(c.c_name, '#', '  ')) END,
               CASE WHEN c.c_custkey % 3 = 0 THEN concat(' del ', c.c_mktsegment, '   ') END,
               CAST(NULL AS string), CAST(c.c_nationkey AS bigint), c.c_custkey % 30, lp.last_point_id
        FROM {customer} c JOIN {last_point} lp ON lp.owner_id = c.c_custkey WHERE c.c_custkey % 9 = 4
        UNION ALL
        SELECT 1000000000000 + s_suppkey, CAST(NULL AS string), CAST(NULL AS string),
               CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE replace(s_name, '#', ' #') END,
               concat('  gestor  ', cast(s_nationkey AS string)), CAST(NULL AS string),
               concat('SAP', lpad(cast(s_suppkey AS string), 6, '0')),
               CAST(NULL AS bigint), CAST(NULL AS bigint), CAST(NULL AS bigint)
        FROM {supplier}""",
    # Segment attributes of a customer.
    "segment_attr": """
        SELECT c_custkey AS contact_id, c_mktsegment AS segment_code,
               substring(c_mktsegment, 1, 2) AS subsegment_code,
               CASE WHEN c_custkey % 10 = 9 THEN '2' ELSE '1' END AS segment_flag
        FROM {customer}""",
    # Links of customers to positions: the primary one (missing for some) and another.
    "position_link": """
        SELECT CAST(c_nationkey AS bigint) AS position_id, c_custkey AS contact_id
        FROM {customer} WHERE c_custkey % 12 <> 5
        UNION ALL
        SELECT CAST((c_nationkey + 1) % 25 AS bigint), c_custkey FROM {customer}""",
    # Position (nation): its unit and its manager.
    "position": """
        SELECT CAST(n_nationkey AS bigint) AS position_id, n_name AS position_name,
               n_regionkey AS org_id, 1000000000000 + n_nationkey AS manager_id
        FROM {nation}""",
    "org_unit": """
        SELECT r_regionkey AS org_id, concat('Z', lpad(cast(r_regionkey AS string), 3, '0')) AS org_loc,
               r_name AS org_name
        FROM {region}""",
    # Employee record of a manager; some managers have none.
    "employee": """
        SELECT 1000000000000 + n_nationkey AS contact_id FROM {nation} WHERE n_nationkey % 10 <> 9""",
    # Optional attention type: only contacts with a supplier of the same key have one; some are listed twice.
    "attention": """
        SELECT s_suppkey AS contact_id, concat('AT', cast(s_nationkey % 5 AS string)) AS attention_code
        FROM {supplier}
        UNION ALL
        SELECT s_suppkey, concat('AT', cast(s_nationkey % 5 AS string)) FROM {supplier} WHERE s_suppkey % 3 = 0""",
    # Optional address; contacts with addr_id 25-29 have none, some addresses are listed twice.
    "address": """
        SELECT CAST(n_nationkey AS bigint) AS addr_id,
               concat('Calle ', cast(n_nationkey AS string), ' # ', lower(n_name)) AS addr,
               cast(n_nationkey AS string) AS city_code
        FROM {nation}
        UNION ALL
        SELECT CAST(n_nationkey AS bigint),
               concat('Calle ', cast(n_nationkey AS string), ' # ', lower(n_name)), cast(n_nationkey AS string)
        FROM {nation} WHERE n_nationkey % 6 = 2""",
    # Holdings of a contact (order line) and the assets they are of (part and line status).
    "holding": """
        SELECT o.o_custkey AS contact_id,
               l.l_partkey * 2 + CASE WHEN l.l_linestatus = 'O' THEN 1 ELSE 0 END AS asset_id,
               o.o_orderpriority AS relation_type
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "asset": """
        SELECT DISTINCT l_partkey * 2 + CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS asset_id,
               l_partkey AS product_id, l_linestatus AS status_code
        FROM {lineitem}""",
    "product": """
        SELECT p_partkey AS product_id, p_type AS class_code FROM {part}""",
    # Code lists, one relation for every list type. Some codes are inactive
    # (or missing from the facts) so decodes also miss; some segments are listed twice.
    # Every row fills all columns; which of them are a list's key and label is up to its type.
    "code_list": """
        SELECT 'DOC_TYPE' AS list_type,
               CASE r_regionkey WHEN 0 THEN 'CC' WHEN 1 THEN 'CE' WHEN 2 THEN 'NIT' WHEN 3 THEN 'CC' ELSE 'TI' END AS name,
               cast(r_regionkey AS string) AS val,
               CASE r_regionkey WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '9' ELSE '4' END AS high,
               concat('Document ', r_name) AS desc_text,
               CASE WHEN r_regionkey = 3 THEN 'N' ELSE 'Y' END AS active_flg
        FROM {region}
        UNION ALL
        SELECT 'SEGMENT', s.seg, concat('S', s.seg), 'high',
               concat('Seg - ', upper(substring(s.seg, 1, 1)), lower(substring(s.seg, 2))), 'Y'
        FROM (SELECT DISTINCT c_mktsegment AS seg FROM {customer}) s
        UNION ALL
        SELECT 'SEGMENT', s.seg, concat('S', s.seg), 'other high',
               concat('Seg - ', upper(substring(s.seg, 1, 1)), lower(substring(s.seg, 2))), 'Y'
        FROM (SELECT DISTINCT c_mktsegment AS seg FROM {customer}) s WHERE s.seg < 'F'
        UNION ALL
        SELECT 'SUBSEGMENT', s.sub, lower(s.sub), CAST(NULL AS string), concat('Sub ', s.sub),
               CASE WHEN s.sub = 'BU' THEN 'N' ELSE 'Y' END
        FROM (SELECT DISTINCT substring(c_mktsegment, 1, 2) AS sub FROM {customer}) s
        UNION ALL
        SELECT 'CITY', n_name, cast(n_nationkey AS string), concat('high ', n_name),
               concat(n_name, CASE n_nationkey % 4 WHEN 0 THEN '..' WHEN 1 THEN '. ' WHEN 2 THEN '.x' ELSE '' END),
               CASE WHEN n_nationkey % 9 = 8 THEN 'N' ELSE 'Y' END
        FROM {nation}
        UNION ALL
        SELECT 'PROD_CLASS', concat('P', t.ptype), t.ptype, upper(t.ptype),
               concat('Class ', lower(t.ptype)), CASE WHEN t.ptype = 'SMALL' THEN 'N' ELSE 'Y' END
        FROM (SELECT DISTINCT p_type AS ptype FROM {part}) t
        UNION ALL
        SELECT 'ATTENTION', concat('AT', cast(r_regionkey AS string)), cast(r_regionkey AS string), CAST(NULL AS string),
               concat('Attention ', lower(r_name)), CASE WHEN r_regionkey = 4 THEN 'N' ELSE 'Y' END
        FROM {region}""",
    # Contact points: owner, id, number, extension and close date. Different
    # numbers and extensions can make one text ('12|5' as it is, '12' with extension 5).
    "point": """
        SELECT o_custkey AS owner_id, o_orderkey AS point_id,
               CASE WHEN o_orderkey % 13 = 0 THEN '   '
                    WHEN o_orderkey % 17 = 0 THEN NULL
                    WHEN o_orderkey % 5 = 1 THEN '12|5'
                    WHEN o_orderkey % 5 = 2 THEN ' 12 '
                    WHEN o_orderkey % 2 = 0 THEN concat(' ', cast(o_orderkey % 97 AS string), ' ')
                    ELSE cast(o_orderkey % 97 AS string) END AS number,
               CASE WHEN o_orderkey % 5 = 1 THEN NULL WHEN o_orderkey % 5 = 2 THEN '5'
                    WHEN o_orderkey % 3 = 0 THEN substring(o_orderpriority, 1, 1)
                    WHEN o_orderkey % 3 = 1 THEN '  ' END AS extension,
               CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS end_date
        FROM {orders}""",
    # ------------------------------------------------------------ consent store
    # Consent facts; owners, their documents and what each consent provides are relations of their own.
    "consent": f"""
        SELECT e.event_id AS consent_id, {CONSENT_OWNER} AS owner_id,
               e.event_id % 5 AS purpose_id, {AGREE_TEXT} AS agree_ind, {DATE_TEXT} AS create_date,
               CASE WHEN e.event_id % 23 = 0 THEN e.ts END AS end_dt,
               CASE WHEN e.event_id % 6 = 1 THEN NULL ELSE cast(1000000 + e.event_id % 4 AS string) END AS auth_channel
        FROM {{events}} e""",
    # Owners: customers; some inactive.
    "owner": """
        SELECT c_custkey AS owner_id,
               CASE WHEN c_custkey % 14 = 3 THEN '2020-01-01' END AS inactivated_dt
        FROM {customer}""",
    # Documents of an owner: zero padded, sometimes with a leading blank; some closed, some owners have two.
    "identifier": """
        SELECT c_custkey AS owner_id, 'CC' AS id_kind,
               concat(CASE WHEN c_custkey % 4 = 0 THEN ' ' ELSE '' END,
                      lpad(cast(c_custkey AS string), 10, '0')) AS ref_num,
               CASE WHEN c_custkey % 15 = 7 THEN '2021-01-01' END AS end_dt
        FROM {customer}
        UNION ALL
        SELECT c_custkey, 'PAS', lpad(cast(c_custkey + 7 AS string), 10, '0'),
               CASE WHEN c_custkey % 20 = 4 THEN '2019-01-01' END
        FROM {customer} WHERE c_custkey % 10 = 4""",
    # What a consent provides: a channel text (null for some); some consents have no provision.
    "provision": """
        SELECT event_id AS consent_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('tel:', props) END AS content
        FROM {events} WHERE event_id % 7 <> 2""",
    # Attributes that a consent concerns: none, one or two.
    "entity": """
        SELECT event_id AS consent_id, 'PHONE' AS attribute FROM {events} WHERE event_id % 4 <> 1
        UNION ALL
        SELECT event_id, 'EMAIL' FROM {events} WHERE event_id % 8 = 0""",
    "purpose": """
        SELECT r_regionkey AS purpose_id,
               CASE WHEN r_regionkey >= 3 THEN 'OTHER' ELSE 'COMMERCIAL' END AS purpose_type
        FROM {region}""",
    # Purposes 2-4 are law A and listed twice (the join repeats those consents),
    # purposes 0-1 are law B.
    "regulation": """
        SELECT n_regionkey AS purpose_id,
               CASE WHEN n_regionkey >= 2 AND n_nationkey < 10 THEN 'LAW_A'
                    WHEN n_regionkey < 2 AND n_nationkey < 5 THEN 'LAW_B'
                    ELSE 'OTHER' END AS regulation_code
        FROM {nation}""",
    "activity": """
        SELECT r_regionkey AS purpose_id,
               CASE WHEN r_regionkey = 0 THEN 'ACT2' WHEN r_regionkey = 4 THEN 'ACT3' ELSE 'ACT1' END
                 AS activity_code
        FROM {region}""",
    "tenant": """
        SELECT r_regionkey AS purpose_id,
               CASE WHEN r_regionkey IN (0, 4) THEN 'T9' ELSE 'T7' END AS tenant_code
        FROM {region}""",
}

_REF = re.compile(r"(?<!\{)\{([a-z_]+)\}(?!\})")


def dependencies(name: str) -> list[str]:
    return sorted(set(_REF.findall(RELATIONS[name])))


def _order(names) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen or n in TABLES:
            return
        for d in dependencies(n):
            visit(d)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def frame(spark: SparkSession, sf_dir: str, name: str, _cache: dict | None = None) -> DataFrame:
    """The Spark DataFrame of a relation or test table (lazy; nothing runs)."""
    cache = {} if _cache is None else _cache
    if name in cache:
        return cache[name]
    if name in TABLES:
        df = table(spark, sf_dir, name)
    else:
        deps = {d: frame(spark, sf_dir, d, cache) for d in dependencies(name)}
        df = sql(spark, RELATIONS[name], **deps)
    cache[name] = df
    return df


def frames(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    cache: dict = {}
    return {n: frame(spark, sf_dir, n, cache) for n in names}


def cte(*names: str) -> str:
    """``WITH`` list (DuckDB) defining the relations and what they read."""
    parts = []
    for n in _order(names):
        body = _REF.sub(lambda m: m.group(1), RELATIONS[n]).replace("{{", "{").replace("}}", "}")
        parts.append(f"{n} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts) if parts else ""


# ------------------------------------------------------------ period snapshot
# The provision table: rows of (supplier, part group) and month of the ship
# date. Attributes are functions of the key; the 30 measures are weighted sums,
# null for some keys so every null path is taken. The two-column key is not
# unique: some keys have a row of a second concept, some have a concept twice.
SNAPSHOT_MEASURE_WEIGHTS = tuple((j % 7 + 1, j % 3) for j in range(30))


def period_bounds(period: str) -> tuple[str, str]:
    """``yyyyMM`` -> first day of the month and of the next month."""
    y, m = int(period[:4]), int(period[4:6])
    ny, nm = (y + 1, 1) if m == 12 else (y, m + 1)
    return f"{y:04d}-{m:02d}-01 00:00:00", f"{ny:04d}-{nm:02d}-01 00:00:00"


PERIOD = "STRANOMES"
MONTH = "concat(cast(year(l_shipdate) AS string), lpad(cast(month(l_shipdate) AS string), 2, '0'))"


def snapshot_sql(period: str | None, current: bool, dialect: str = "spark") -> str:
    """SQL of the snapshot for ``period`` (the Spark text uses parameter markers), or of all periods for None."""
    from ..operators.periods import MEASURES
    src = "{lineitem}" if dialect == "spark" else "lineitem"
    if period is None:
        p, where, by = MONTH, "", f", {MONTH}"
    elif dialect == "spark":
        p, by = ":period", ""
        where = "WHERE l_shipdate >= CAST(:start AS TIMESTAMP_NTZ) AND l_shipdate < CAST(:end AS TIMESTAMP_NTZ)"
    else:
        s, e = period_bounds(period)
        p, by = f"'{period}'", ""
        where = f"WHERE l_shipdate >= CAST('{s}' AS TIMESTAMP) AND l_shipdate < CAST('{e}' AS TIMESTAMP)"
    k1, k2 = "cast(l_suppkey AS string)", "cast(l_partkey % 50 AS string)"
    listed, each = ("array", "explode") if dialect == "spark" else ("list_value", "unnest")
    measures = []
    for j, name in enumerate(MEASURES):
        a, b = SNAPSHOT_MEASURE_WEIGHTS[j]
        measures.append(f"CASE WHEN (s + {j}) % 13 = 0 THEN NULL ELSE CAST((price * {a} - quantity * {b}) * (c + 1) "
                        f"AS DECIMAL(18,2)) END AS {name}")
    extra = ",\n               concat(chr(flag_max), chr(status_min)) AS STROBLMODALIDAD" if current else ""
    # What the snapshot is, as DuckDB runs it; ``snapshot`` gives the same rows by steps that
    # scale (a test holds them against this text). Attributes are functions of the key, read with max(); one-letter
    # flags are aggregated as code points, so every aggregate keeps a fixed-width buffer (hash
    # aggregation, no sort), and the measures are linear in two sums, so a group holds few.
    return f"""
        SELECT STRCLINIT, STROBLOBLIGSARC, STRANOMES,
               cast(s % 5 AS string) AS STRPETIPOCREDITO,
               CASE WHEN (s + g) % 97 = 96 THEN NULL ELSE (s * 7 + g) % 90 END AS NUMPEPROCODIGO,
               CASE WHEN g % 11 = 10 THEN NULL WHEN c = 1 THEN (g + 1) % 4 ELSE g % 4 END AS NUMTIPOCONCEPTO,
               concat('C', cast(g % 4 AS string)) AS STRPECONCEPTO,
               CAST(quantity AS DECIMAL(18,2)) AS NUMPIMATRIZ_B,
               chr(flag_max) AS STRPECALIFICACION,
               chr(flag_min) AS STRCALIFHOMOLOGADA,
               chr(status_max) AS STRCALIFICACIONTEMP,
               chr(status_min) AS STRCALIFICACIONREF,
               cast(line_max AS string) AS STRPEMAXGARANTIA,
               line_min AS NUMPETIPOGARANTIA,
               CAST(tax AS DECIMAL(18,2)) AS PDI,
               CAST(discount AS DECIMAL(18,2)) AS VALOR_GAR,
               CAST(n AS INT) AS TIPO_EMPRESA,
               CAST(CASE WHEN s % 31 = 30 THEN NULL
                         WHEN s % 29 = 28 THEN -1
                         ELSE (n * 37 + s * 11 + g) % 620 END AS INT) AS DIAS_MORA,
               {(','+chr(10)+'               ').join(measures)}{extra}
        FROM (
            SELECT *, {each}(CASE WHEN (s + g) % 5 = 0 AND (s + g) % 17 = 0 THEN {listed}(0, 1, 2)
                                  WHEN (s + g) % 5 = 0 THEN {listed}(0, 1)
                                  WHEN (s + g) % 17 = 0 THEN {listed}(0, 2) ELSE {listed}(0) END) AS c
            FROM (
                SELECT {k1} AS STRCLINIT, {k2} AS STROBLOBLIGSARC, {p} AS STRANOMES,
                       max(l_suppkey) AS s, max(l_partkey % 50) AS g, count(*) AS n,
                       sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price, sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity,
                       sum(CAST(l_tax AS DECIMAL(18,2))) AS tax, sum(CAST(l_discount AS DECIMAL(18,2))) AS discount,
                       max(ascii(l_returnflag)) AS flag_max, min(ascii(l_returnflag)) AS flag_min,
                       max(ascii(l_linestatus)) AS status_max, min(ascii(l_linestatus)) AS status_min,
                       max(l_linenumber) AS line_max, min(l_linenumber) AS line_min
                FROM {src}
                {where}
                GROUP BY {k1}, {k2}{by}) keyed) listed"""


# The Spark text of the snapshot: the rows of ``snapshot_sql``, by steps whose cost per row stays low.
# Groups are formed on numbers (the text keys are made of them, one to one) and dealt as one short row each,
# before they are listed by concept and get the 30 measures.
def keyed_sql(period: str | None) -> str:
    """One row per supplier, part group and month: the text key, the numbers it is made of and the sums."""
    if period is None:
        where, by = "", ", year(l_shipdate), month(l_shipdate)"
        p, months = "concat(cast(y AS string), lpad(cast(m AS string), 2, '0'))", ", year(l_shipdate) AS y, month(l_shipdate) AS m"
    else:
        where = "WHERE l_shipdate >= CAST(:start AS TIMESTAMP_NTZ) AND l_shipdate < CAST(:end AS TIMESTAMP_NTZ)"
        p, by, months = ":period", "", ""
    sums = ",\n                   ".join(f"CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS {name}" for name, c in (
        ("price", "l_extendedprice"), ("quantity", "l_quantity"), ("tax", "l_tax"), ("discount", "l_discount")))
    return f"""
        SELECT cast(s AS string) AS STRCLINIT, cast(g AS string) AS STROBLOBLIGSARC, {p} AS {PERIOD}, *
        FROM (
            SELECT l_suppkey AS s, l_partkey % 50 AS g{months}, count(*) AS n,
                   {sums},
                   max(ascii(l_returnflag)) AS flag_max, min(ascii(l_returnflag)) AS flag_min,
                   max(ascii(l_linestatus)) AS status_max, min(ascii(l_linestatus)) AS status_min,
                   max(l_linenumber) AS line_max, min(l_linenumber) AS line_min
            FROM {{lineitem}}
            {where}
            GROUP BY l_suppkey, l_partkey % 50{by}) grouped"""


# A measure that every wide projection reads.
_APART = "NUMPEDIFK"


def listed_sql(current: bool) -> str:
    """The snapshot's rows of ``keyed`` rows: one per concept, with attributes and measures.

    The factor of the concept and each weight are multiplied in once per row, so
    a measure is one subtraction. One measure passes a lambda: Spark then
    compiles the projection in parts, not as one method too long for the JIT.
    """
    from ..operators.periods import MEASURES

    weights = [SNAPSHOT_MEASURE_WEIGHTS[j] for j in range(len(MEASURES))]
    parts = [f"CAST(price * {a} * CAST(c + 1 AS DECIMAL(1,0)) AS DECIMAL(18,2)) AS price_{a}" for a in sorted({a for a, _ in weights})]
    parts += [f"CAST(quantity * {b} * CAST(c + 1 AS DECIMAL(1,0)) AS DECIMAL(18,2)) AS quantity_{b}"
              for b in sorted({b for _, b in weights})]
    measures = []
    for j, (name, (a, b)) in enumerate(zip(MEASURES, weights)):
        value = f"CASE WHEN (s + {j}) % 13 = 0 THEN NULL ELSE CAST(price_{a} - quantity_{b} AS DECIMAL(18,2)) END"
        measures.append(f"{f'transform(array({value}), x -> x)[0]' if name == _APART else value} AS {name}")
    extra = ",\n               concat(chr(flag_max), chr(status_min)) AS STROBLMODALIDAD" if current else ""
    return f"""
        SELECT STRCLINIT, STROBLOBLIGSARC, STRANOMES,
               cast(s % 5 AS string) AS STRPETIPOCREDITO,
               CASE WHEN (s + g) % 97 = 96 THEN NULL ELSE (s * 7 + g) % 90 END AS NUMPEPROCODIGO,
               CASE WHEN g % 11 = 10 THEN NULL WHEN c = 1 THEN (g + 1) % 4 ELSE g % 4 END AS NUMTIPOCONCEPTO,
               concat('C', cast(g % 4 AS string)) AS STRPECONCEPTO,
               quantity AS NUMPIMATRIZ_B,
               chr(flag_max) AS STRPECALIFICACION,
               chr(flag_min) AS STRCALIFHOMOLOGADA,
               chr(status_max) AS STRCALIFICACIONTEMP,
               chr(status_min) AS STRCALIFICACIONREF,
               cast(line_max AS string) AS STRPEMAXGARANTIA,
               line_min AS NUMPETIPOGARANTIA,
               tax AS PDI,
               discount AS VALOR_GAR,
               CAST(n AS INT) AS TIPO_EMPRESA,
               CAST(CASE WHEN s % 31 = 30 THEN NULL
                         WHEN s % 29 = 28 THEN -1
                         ELSE (n * 37 + s * 11 + g) % 620 END AS INT) AS DIAS_MORA,
               {(','+chr(10)+'               ').join(measures)}{extra}
        FROM (
            SELECT *, {', '.join(parts)}
            FROM (
                SELECT *, explode(CASE WHEN (s + g) % 5 = 0 AND (s + g) % 17 = 0 THEN array(0, 1, 2)
                                       WHEN (s + g) % 5 = 0 THEN array(0, 1)
                                       WHEN (s + g) % 17 = 0 THEN array(0, 2) ELSE array(0) END) AS c
                FROM {{keyed}}) each) weighed"""


def snapshot(spark: SparkSession, sf_dir: str, period: str | None, current: bool,
             deal: tuple[int, tuple[str, ...]] | None = None) -> DataFrame:
    """Snapshot of one period, or of every period in the table for None, derived from the order lines.

    ``deal`` = (partitions, columns) deals the short group rows by these key
    columns before they are widened; the snapshot's rows stay where they are dealt.
    """
    args = {} if period is None else dict(zip(("start", "end"), period_bounds(period)), period=period)
    keyed = sql(spark, keyed_sql(period), args, lineitem=table(spark, sf_dir, "lineitem"))
    if deal is not None:
        keyed = keyed.repartition(deal[0], *deal[1])
    return sql(spark, listed_sql(current), keyed=keyed)


def deal_parts(spark: SparkSession, sf_dir: str) -> int:
    """Partitions to deal groups into whose rows a task holds in memory: the session's, or four for each part that the scan reads.

    A number given to ``repartition`` stays, while Spark joins the small partitions
    of a plain aggregate until a task holds millions of groups.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * table(spark, sf_dir, "lineitem").rdd.getNumPartitions())


# Buckets of the snapshot store: one task of a period join each. At least these, and one for
# so many order lines, so that a bucket of all periods stays about as large however many there are.
SNAPSHOT_BUCKETS, LINES_PER_BUCKET = 4, 1_000_000


def snapshot_buckets(lines: int) -> int:
    """Buckets for the snapshots of so many order lines."""
    return max(SNAPSHOT_BUCKETS, -(-lines // LINES_PER_BUCKET))


_STORES: dict[tuple[str, str], str] = {}


def write_snapshots(snapshots: DataFrame, name: str, folder: str, keys, buckets: int = SNAPSHOT_BUCKETS) -> None:
    """Snapshots of many periods as table ``name`` in ``folder``: partitioned by period, bucketed and sorted by the keys.

    The rows are dealt by the hash that buckets use (not again if they are dealt so), so that each
    task writes one file for each period, and a join or aggregate on the keys shuffles nothing.
    """
    (snapshots.repartition(buckets, *keys).write.mode("overwrite").option("path", folder)
     .partitionBy(PERIOD).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))


def snapshot_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored snapshots of every period: the provision table as the warehouse has it.

    The test folders have no such table, so the first use in a Spark
    application writes it, next to the checkpoints (shared storage on a
    cluster); after that it is read.
    """
    from ..operators.periods import KEYS

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STORES or not spark.catalog.tableExists(_STORES[key]):
        name = "tessera_snapshot_" + hashlib.md5("\x00".join(key).encode()).hexdigest()[:16]
        folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
        buckets = snapshot_buckets(table(spark, sf_dir, "lineitem").count())  # by the files' footers
        write_snapshots(snapshot(spark, sf_dir, None, True, (buckets, KEYS)), name, folder, KEYS, buckets)
        _STORES[key] = name
    return spark.table(_STORES[key])


def read_snapshot(spark: SparkSession, sf_dir: str, period: str, current: bool = True) -> DataFrame:
    """One period of the store (S2); only its own folder is read. Earlier periods lack the columns of the current one."""
    from ..operators.periods import CURRENT_ONLY

    rows = snapshot_store(spark, sf_dir).where(F.col(PERIOD) == period)
    return rows if current else rows.drop(*CURRENT_ONLY)
