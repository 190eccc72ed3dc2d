"""Customer profile jobs.

The job as written joins the whole star (customer x holding), decodes every
row, deduplicates on twelve columns and groups on eleven. The plan here gives
the same rows with less data in flight:

* customer attributes are built once per customer and made distinct there:
  repeated rows of a dimension (equal code, address or attention rows) repeat
  a customer, and the report has each combination once; the position / unit /
  manager chain and the code lists are small, and whether they are broadcast
  is the planner's decision by their bytes;
* holdings are reduced to distinct (customer, class) pairs with a partial
  aggregate before anything wide is shuffled, then listed per customer;
* contact points get their primary mark from a join on (owner, point id),
  are listed per owner with the two-step list aggregate (``operators.lists``)
  and only then matched to customers, one row per owner;
* the report is sorted once, at the end.

The oracle SQL keeps the job's own shape, so the comparison checks that both
shapes agree.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PRIMARY_MARK, clean_label, doc_key, full_name, non_blank, or_default, point_text
from ..operators import consent as C
from ..operators import decode as D
from ..operators.lists import distinct_list, ordered_list
from ..sources.relations import frames

PROFILE_RELATIONS = ("contact", "segment_attr", "position_link", "position", "org_unit", "employee", "attention",
                     "address", "holding", "asset", "product", "code_list", "point")
CONSENT_RELATIONS = ("consent", "owner", "identifier", "provision", "entity", "purpose", "regulation", "activity",
                     "tenant")
RELATIONS = PROFILE_RELATIONS + CONSENT_RELATIONS

# Report column names, in report order.
REPORT_COLUMNS = ("SEGMENTO", "TIPO DE DOCUMENTO", "IDENT", "CLIENTE", "CAPA", "CODIGO ZONAL",
                  "CODIGO SAP GERENTE", "NOMBRE_GERENTE", "PRODUCTO", "TELEFONOS", "DIRECCION", "CIUDAD")
GATED_CHANNEL, EXCLUDED_CHANNEL = "CANAL_CONTACTO_FINAL", "CANAL_DE_CONTACTO"
NO_POINTS = "N/A"


def by_name(df: DataFrame) -> DataFrame:
    """Report order: by customer name (T1), then document.

    The document does not change the order by name; it gives the range
    partitioner a second key, so a name shared by a third of all rows is
    split over many sort tasks instead of one.
    """
    return df.orderBy(F.col("CLIENTE").asc(), F.col("IDENT").asc())


@dataclass(frozen=True)
class ProfileParams:
    """Selection codes of the profile (values of the test relations)."""
    commercial_flag: str = "1"
    excluded_unit: str = "MIDDLE EAST"
    excluded_position: str = "NATION_7"
    active_status: tuple = ("O",)
    relation_types: tuple = ("1-URGENT", "2-HIGH", "3-MEDIUM")
    segments: tuple = ("Seg - Automobile", "Seg - Building", "Seg - Furniture", "Seg - Household")
    list_types: dict = field(default_factory=lambda: {
        "doc": "DOC_TYPE", "segment": "SEGMENT", "city": "CITY", "class": "PROD_CLASS",
        "attention": "ATTENTION", "subsegment": "SUBSEGMENT"})
    # Which columns of a list are its key and its label.
    list_columns: dict = field(default_factory=lambda: {
        "doc": ("name", "high"), "segment": ("name", "desc_text"), "city": ("val", "desc_text"),
        "class": ("val", "desc_text"), "attention": ("name", "desc_text"), "subsegment": ("name", "desc_text")})

    def shapes(self, *kinds: str) -> dict[str, tuple[str, str]]:
        """Key and label column by list type, of all lists or some."""
        return {self.list_types[k]: self.list_columns[k] for k in kinds or self.list_types}


DEFAULT = ProfileParams()


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return frames(spark, sf_dir, *RELATIONS)


# The lists that the job decodes.
DECODED = ("doc", "segment", "attention", "city", "class")


def labels(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """The five lists of the job as (list and code, label), from one read."""
    return D.labels(f["code_list"], p.shapes(*DECODED))


def primary_positions(f: dict) -> DataFrame:
    """(row_id, position_id) of customers that are linked to their primary position (F8)."""
    links = f["position_link"].select(F.col("contact_id").alias("row_id"), "position_id").distinct()
    wanted = f["contact"].select("row_id", F.col("primary_position_id").alias("position_id"))
    return links.join(wanted, ["row_id", "position_id"])


def position_chain(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """Positions with their unit and manager; the manager is a contact too, and has an employee record."""
    managers = f["contact"].select(F.col("row_id").alias("manager_id"), "emp_num",
                                   full_name("fst_name", "last_name", "maiden_name").alias("manager_name"))
    employed = f["employee"].select(F.col("contact_id").alias("manager_id"))
    return (f["position"].filter(F.col("position_name") != p.excluded_position)
            .join(f["org_unit"].filter(F.col("org_name") != p.excluded_unit), "org_id")
            .join(employed, "manager_id").join(managers, "manager_id")
            .select("position_id", "org_loc", "emp_num", "manager_name"))


def decode_customers(df: DataFrame, labelled: DataFrame, p: ProfileParams = DEFAULT) -> DataFrame:
    """Document type, segment, attention and city of customers by their codes."""
    t = p.list_types
    df = D.decode_by(df, labelled, t["doc"], "id_type", "doc_type")
    df = D.decode_by(df, labelled, t["segment"], "segment_code", "segment")
    df = D.decode_by(df, labelled, t["attention"], "attention_code", "attention")
    return D.decode_by(df, labelled, t["city"], "city_code", "city", label_expr=clean_label)


def customer_rows(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """One row per selected customer and combination of decoded, cleaned attributes."""
    def keyed(name: str) -> DataFrame:
        return f[name].withColumnRenamed("contact_id", "row_id")

    people = f["contact"].select("row_id", "id_num", "id_type", "addr_id",
                                 full_name("fst_name", "last_name", "maiden_name").alias("customer_name"))
    cust = (people.join(primary_positions(f), "row_id")
            .join(keyed("segment_attr").filter(F.col("segment_flag") == p.commercial_flag), "row_id")
            .join(position_chain(f, p), "position_id")
            .join(keyed("attention"), "row_id", "left")
            .join(f["address"], "addr_id", "left"))
    cust = decode_customers(cust, labels(f, p), p)
    return (cust.filter(F.col("segment").isin(*p.segments))
            .select("row_id", "id_num", "doc_type", "customer_name", "org_loc", "emp_num",
                    "manager_name", "segment", "attention", "addr", "city").distinct())


def held_classes(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """Distinct (row_id, class_code) of qualifying holdings: holding, its asset, the asset's product.

    The pairs shrink with a partial aggregate right after the joins.
    """
    held = (f["holding"].filter(F.col("relation_type").isin(*p.relation_types))
            .select(F.col("contact_id").alias("row_id"), "asset_id"))
    assets = f["asset"].filter(F.col("status_code").isin(*p.active_status)).select("asset_id", "product_id")
    products = assets.join(f["product"], "product_id").select("asset_id", "class_code")
    return held.join(products, "asset_id").select("row_id", "class_code").distinct()


def holders(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """Customers with any qualifying holding, to test for existence only."""
    return held_classes(f, p).select("row_id").distinct()


def class_lists(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """``(row_id, classes)``: sorted distinct class labels of qualifying holdings."""
    pairs = D.decode_by(held_classes(f, p), labels(f, p), p.list_types["class"], "class_code", "class_label")
    return distinct_list(pairs, ["row_id"], "class_label", "classes")


def open_points(f: dict) -> DataFrame:
    """Contact points without a close date."""
    return f["point"].filter(F.col("end_date").isNull())


def _primaries(keys: DataFrame) -> DataFrame:
    """``(owner_id, point_id, is_primary)`` of the customers' primary points."""
    return (keys.filter(F.col("primary_point_id").isNotNull())
            .select(F.col("row_id").alias("owner_id"), F.col("primary_point_id").alias("point_id"))
            .distinct().withColumn("is_primary", F.lit(True)))


def marked(points: DataFrame, keys: DataFrame) -> DataFrame:
    """Points with their primary flag.

    The flag comes from a join on (owner, point id): point ids are unique, so
    an owner holding a third of all points is spread over many tasks instead
    of landing in one join partition.
    """
    return points.join(_primaries(keys), ["owner_id", "point_id"], "left").withColumn(
        "is_primary", F.coalesce(F.col("is_primary"), F.lit(False)))


def point_lists(points: DataFrame, keys: DataFrame, how: str = "left") -> DataFrame:
    """``(owner_id, TELEFONOS)``: trimmed numbers, primary marked, ordered as text.

    ``how='left'`` lists every owner (orphans too, J5); ``'inner'`` keeps owners
    that are customers in ``keys``, checked after the lists are built, on one
    row per owner.
    """
    pre = (points.withColumn("num", F.trim("number")).filter(non_blank("num"))
           .select("owner_id", "point_id", "num"))
    labeled = marked(pre, keys).withColumn(
        "fmt", F.when(F.col("is_primary"), F.concat(F.lit(PRIMARY_MARK), point_text("num")))
        .otherwise(point_text("num")))
    lists = ordered_list(labeled, ["owner_id"], ["num"], "fmt", "TELEFONOS")
    if how == "inner":
        lists = lists.join(keys.select(F.col("row_id").alias("owner_id")).distinct(), "owner_id", "left_semi")
    return lists


def point_lists_by_customer(points: DataFrame, keys: DataFrame, every_customer: bool = True) -> DataFrame:
    """``(row_id, TELEFONOS)`` as the right-join variant: every customer, ``''`` without points.

    Points are deduplicated on (owner, text) and ordered by number; lists are
    built per owner first and then attached to every customer, which is the
    job's right join grouped by the customer rather than the point's owner (D18).
    With ``every_customer=False`` the per-owner lists are returned as they are,
    for a caller whose own left join supplies the ``''`` default.
    """
    pts = points.select("owner_id", "point_id", "number", "extension")
    pts = marked(pts, keys)
    text = point_text("number", "extension")
    labeled = pts.select("owner_id", F.trim("number").alias("ord"),
                           F.when(F.col("is_primary"), F.concat(F.lit(PRIMARY_MARK), text)).otherwise(text)
                           .alias("fmt"))
    lists = ordered_list(labeled, ["owner_id"], ["ord"], "fmt", "TELEFONOS", distinct=True)
    if not every_customer:
        return lists.withColumnRenamed("owner_id", "row_id")
    customers = keys.select("row_id").distinct()
    return customers.join(lists.withColumnRenamed("owner_id", "row_id"), "row_id", "left").select(
        "row_id", F.coalesce(F.col("TELEFONOS"), F.lit("")).alias("TELEFONOS"))


def report(customers: DataFrame, classes: DataFrame, points: DataFrame, na: str | None = NO_POINTS) -> DataFrame:
    """The 12-column report."""
    pts = points.withColumnRenamed("owner_id", "row_id") if "owner_id" in points.columns else points
    tel = or_default("TELEFONOS", na) if na is not None else F.col("TELEFONOS")
    return (customers.join(classes, "row_id").join(pts, "row_id", "left")
            .select(F.col("segment").alias("SEGMENTO"), F.col("doc_type").alias("TIPO DE DOCUMENTO"),
                    F.col("id_num").alias("IDENT"), F.col("customer_name").alias("CLIENTE"),
                    F.col("attention").alias("CAPA"), F.col("org_loc").alias("CODIGO ZONAL"),
                    F.col("emp_num").alias("CODIGO SAP GERENTE"), F.col("manager_name").alias("NOMBRE_GERENTE"),
                    F.col("classes").alias("PRODUCTO"), tel.alias("TELEFONOS"),
                    F.col("addr").alias("DIRECCION"), F.col("city").alias("CIUDAD")))


# ------------------------------------------------------------------ jobs
def profile_final(f: dict, p: ProfileParams = DEFAULT, sort: bool = True) -> DataFrame:
    """L1: profile with ordered point lists; customers without points show N/A."""
    cust = customer_rows(f, p)
    # Primary ids come from the contacts; the report's join keeps customers' lists only,
    # so the customer plan is not built a second time for the keys.
    out = report(cust, class_lists(f, p), point_lists(open_points(f), f["contact"]))
    return by_name(out) if sort else out


def customer_flags(f: dict, p: ProfileParams = DEFAULT) -> DataFrame:
    """(in_report, passes) of every selected customer: has a qualifying class list, and passes the law A gate.

    One plan for the counts of customers, report rows and gated rows; contact
    points change none of them.
    """
    cust = customer_rows(f, p).withColumn("doc_join", doc_key("id_num"))
    held = class_lists(f, p).select("row_id", F.lit(True).alias("in_report"))
    state = C.document_state(C.tagged(f)).select("doc_join", "passes")
    out = cust.join(held, "row_id", "left").join(state, "doc_join", "left")
    return out.select(F.coalesce("in_report", F.lit(False)).alias("in_report"), F.coalesce("passes", F.lit(False)).alias("passes"))


def profile_gated(f: dict, p: ProfileParams = DEFAULT, sort: bool = True) -> DataFrame:
    """L2: law A latest must be 1 or 2; law B latest (form or registry) gives the channel.

    Gate and channel come from one state per document, so the consent facts are
    read once and joined once.
    """
    state = C.document_state(C.tagged(f)).filter("passes")
    pn = profile_final(f, p, sort=False).withColumn("doc_join", doc_key("IDENT"))
    out = pn.join(state, "doc_join").select(
        *[F.col(f"`{c}`") for c in REPORT_COLUMNS], C.winning_channel("N/A").alias(GATED_CHANNEL))
    return by_name(out) if sort else out


def profile_excluded(f: dict, p: ProfileParams = DEFAULT, sort: bool = True) -> DataFrame:
    """L3: newest of law A / law B decides; refusals dropped, no consent kept with null channel."""
    cust = customer_rows(f, p)
    lists = point_lists_by_customer(open_points(f), f["contact"], every_customer=False)
    pn = report(cust, class_lists(f, p), lists, na="").withColumn("doc_join", doc_key("IDENT"))
    newest = C.newest_consent(C.tagged(f, (C.LAW_A, C.FORM)))
    out = (C.exclude_and_attach(pn, newest)
           .select(*[F.col(f"`{c}`") for c in REPORT_COLUMNS], F.col("canal_contacto").alias(EXCLUDED_CHANNEL)))
    return by_name(out) if sort else out
