import numpy as np

from fieldnotes.llm.util import KeyFilter, components, key_filter
from tests.llm.helpers import union_find


def test_components_of_random_graphs(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(-100, 300, (260, 2))]
    edges += [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(2001, 2040)] + [(7, 7), (3000, 3000)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges + edges[:5], "u long, v long")).collect()}
    assert got == union_find(edges)


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_key_filter_loses_no_key(spark):
    rng = np.random.default_rng(2)
    keys = rng.integers(-(2**63), 2**63 - 1, 500)
    made = key_filter(spark.createDataFrame([(int(k),) for k in keys], "k long"), 16)
    assert isinstance(made, KeyFilter) and made.may_hold(keys).all()
    assert made.may_hold(rng.integers(-(2**63), 2**63 - 1, 5000)).mean() < 0.01
    assert not key_filter(spark.createDataFrame([], "k long"), 10).may_hold(keys).any()
