import random

from hypothesis import given, settings
from hypothesis import strategies as st

from llm_helpers import components_of
from tessera.llm.components import components


def found(spark, edges):
    df = spark.createDataFrame(edges, "u long, v long")
    return {r.node: r.root for r in components(df).collect()}


def test_chain_star_loops_and_nulls(spark):
    r = random.Random(1)
    order = list(range(200))
    r.shuffle(order)
    edges = list(zip(order, order[1:])) + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (None, 3), (7, None)]
    got = found(spark, edges)
    assert {got[i] for i in range(200)} == {0} and {got[i] for i in range(1000, 1100)} == {1000} and 5000 not in got


def test_no_edges(spark):
    assert found(spark, []) == {}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=30))
def test_any_graph(spark, edges):
    nodes = sorted({n for e in edges if e[0] != e[1] for n in e})
    assert found(spark, edges) == components_of(nodes, [e for e in edges if e[0] != e[1]])
