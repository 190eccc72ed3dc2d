from conftest import rows
from tessera.operators.lists import distinct_list, ordered_list


def test_ordered_list_text_order_and_duplicates(spark):
    df = spark.createDataFrame([("a", "10", "10"), ("a", "2", "2"), ("a", "2", "2"), ("b", None, None),
                                ("c", "a", "y"), ("c", None, "x")], "g string, k string, v string")
    got = dict(rows(ordered_list(df, ["g"], ["k"], "v", "out"), "g", "out"))
    assert got == {"a": "10, 2, 2", "b": "", "c": "x, y"}
    dist = dict(rows(ordered_list(df, ["g"], ["k"], "v", "out", distinct=True), "g", "out"))
    assert dist["a"] == "10, 2"
    nulls = dict(rows(ordered_list(df, ["g"], ["k"], "v", "out", empty_as_null=True), "g", "out"))
    assert nulls["b"] is None and nulls["a"] == "10, 2, 2"


def test_ordered_list_many_equal_entries_of_one_owner(spark):
    # a hot owner: 50,000 rows, two distinct entries; pre-aggregation keeps the text whole
    df = spark.range(50_000).selectExpr("'hot' AS g", "CAST(id % 2 AS string) AS k", "CAST(id % 2 AS string) AS v")
    out = rows(ordered_list(df, ["g"], ["k"], "v", "out"), "out")[0][0]
    parts = out.split(", ")
    assert len(parts) == 50_000 and parts[0] == "0" and parts[-1] == "1" and parts.count("0") == 25_000


def test_distinct_list(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "a"), ("a", "b"), ("a", None), ("z", None)], "g string, v string")
    assert dict(rows(distinct_list(df, ["g"], "v", "out"), "g", "out")) == {"a": "a, b", "z": ""}
