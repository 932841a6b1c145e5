import random

import pytest

from ebbtide.llm import graph

from .plain import groups


def edges_of(seed):
    """Chains, a hub of 300, copies of edges, loops, and nodes far apart."""
    rng = random.Random(seed)
    chain = [(k, k + 1) for k in range(1000, 1040)]
    hub = [(2300, n) for n in range(2000, 2300)] + [(n, 2300) for n in range(2000, 2010)]
    some = [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)]
    far = [(2**40, 7), (2**40, 2**41), (8, 8)]
    rows = chain + hub + some + far + some[:5]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("least", [1000, 0, 20])
def test_against_plain(spark, monkeypatch, least):
    """The same groups with no heavy key, with every key heavy, and with the hub and its group heavy."""
    monkeypatch.setattr(graph, "HEAVY_LEAST", least)
    rows = edges_of(least)
    nodes = {n for edge in rows if edge[0] != edge[1] for n in edge}
    linked = {frozenset(edge) for edge in rows}
    got = graph.components(spark.createDataFrame(rows, "a long, b long")).collect()
    assert len(got) == len(nodes)
    assert {r["node"]: r["component"] for r in got} == groups(nodes, lambda a, b: frozenset((a, b)) in linked)


def test_heavy_keys_are_few(spark, monkeypatch):
    monkeypatch.setattr(graph, "HEAVY_LEAST", 5)
    rows = spark.createDataFrame([(k, 1) for k in range(9)] + [(k, 2) for k in range(5)] + [(0, None)] * 3, "a long, b long")
    assert [r["heavy"] for r in graph.heavy_keys(rows, "b").collect()] == [1]


def test_no_edges(spark):
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert graph.components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


@pytest.mark.parametrize("least", [1000, 0, 20])
@pytest.mark.parametrize("held", [0, 150, 480])
def test_links_added_later(spark, monkeypatch, least, held):
    """Known groups and further links give the groups of all edges: new nodes, merged groups, nothing known."""
    monkeypatch.setattr(graph, "HEAVY_LEAST", least)
    rows = edges_of(held)
    nodes = {n for edge in rows if edge[0] != edge[1] for n in edge}
    linked = {frozenset(edge) for edge in rows}
    known = graph.components(spark.createDataFrame(rows[:held], "a long, b long"))
    got = graph.joined_components(known, spark.createDataFrame(rows[held:], "a long, b long")).collect()
    assert len(got) == len(nodes)
    assert {r["node"]: r["component"] for r in got} == groups(nodes, lambda a, b: frozenset((a, b)) in linked)


def test_no_links_added(spark):
    known = graph.components(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"))
    for links in ([], [(1, 3)], [(2, 2)]):
        got = graph.joined_components(known, spark.createDataFrame(links, "a long, b long")).collect()
        assert sorted((r["node"], r["component"]) for r in got) == [(1, 1), (2, 1), (3, 1)]


def test_an_edge_is_read_again_only_while_its_ends_lie_apart(spark, monkeypatch):
    """Rows whose ends are looked up do not add up to a multiple of the edges for every round."""
    rng = random.Random(5)
    rows = list({(low, rng.randrange(100, 700)) for low in range(30) for _ in range(60)}) + [(k, k + 1) for k in range(900, 930)]
    looked_up = []
    plain = graph.with_label_of

    def counted(frame, key, *rest):
        if key in ("a", "b"):
            looked_up.append(frame.count())
        return plain(frame, key, *rest)

    monkeypatch.setattr(graph, "with_label_of", counted)
    got = graph.components(spark.createDataFrame(rows, "a long, b long")).collect()
    linked = {frozenset(edge) for edge in rows}
    assert {r["node"]: r["component"] for r in got} == groups({n for e in rows for n in e}, lambda a, b: frozenset((a, b)) in linked)
    assert sum(looked_up) <= 3 * len(rows)
