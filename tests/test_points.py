import datetime as dt

from conftest import rows
from tessera.plans import profile as PR

POINTS = "owner_id long, point_id long, number string, extension string, end_date timestamp"
KEYS = "row_id long, primary_point_id long"
CLOSED = dt.datetime(2020, 1, 1)


def points(spark):
    return spark.createDataFrame([
        (1, 10, " 2 ", None, None),      # customer 1: '2' and '10' (text order: '10' first), primary 11
        (1, 11, "10", " 7 ", None),
        (1, 12, "10", "  ", None),       # second point with number 10, blank extension
        (1, 13, "   ", "9", None),       # blank number
        (1, 14, None, "9", None),        # null number
        (2, 20, "5", None, CLOSED),      # customer 2: only a closed point
        (4, 40, "8", None, None),        # customer 4: null primary id
        (9, 90, "3", None, None),        # orphan owner (not a customer)
    ], POINTS)


def keys(spark):
    return spark.createDataFrame([(1, 11), (2, 20), (3, None), (4, None)], KEYS)


def test_point_lists_by_number(spark):
    pts = PR.open_points({"point": points(spark)})
    got = dict(rows(PR.point_lists(pts, keys(spark)), "owner_id", "TELEFONOS"))
    assert got == {1: "10, P-10, 2", 4: "8", 9: "3"}
    inner = dict(rows(PR.point_lists(pts, keys(spark), "inner"), "owner_id", "TELEFONOS"))
    assert inner == {1: "10, P-10, 2", 4: "8"}


def test_point_lists_right_join_variant(spark):
    pts = PR.open_points({"point": points(spark)})
    got = dict(rows(PR.point_lists_by_customer(pts, keys(spark)), "row_id", "TELEFONOS"))
    # number|ext, deduplicated per text, blank number kept as '|9', null number skipped,
    # every customer present ('' without open points), orphans dropped
    assert got == {1: "|9, 10, P-10|7, 2", 2: "", 3: "", 4: "8"}


def test_one_entry_for_one_text_of_different_numbers(spark):
    pts = spark.createDataFrame([(1, 10, "12|5", None, None), (1, 11, "12", "5", None), (1, 12, "3", None, None)], POINTS)
    keys = spark.createDataFrame([(1, None)], KEYS)
    got = dict(rows(PR.point_lists_by_customer(PR.open_points({"point": pts}), keys), "row_id", "TELEFONOS"))
    assert got == {1: "12|5, 3"}
