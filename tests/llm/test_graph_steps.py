"""Connected components end as soon as every node points to its root."""

from orderflow.llm import graph


def test_a_finished_graph_takes_no_further_step(spark, monkeypatch):
    writes = []
    monkeypatch.setattr(graph, "written", lambda df, what: writes.append(what) or df.localCheckpoint())
    star = [(1, k) for k in range(2, 30)] + [(41, 40), (42, 40), (42, 40), (7, 7)]
    found = graph.stars(spark.createDataFrame(star, "a long, b long"))
    assert len(writes) == 1  # two steps were taken at first, only to see that nothing changes
    assert {tuple(r) for r in found.collect()} == {(k, 1) for k in range(2, 30)} | {(41, 40), (42, 40)}


def test_chains_and_rings_reach_their_root(spark, monkeypatch):
    monkeypatch.setattr(graph, "written", lambda df, what: df.localCheckpoint())
    ring = [(100 + k, 100 + (k + 1) % 9) for k in range(9)]
    edges = [(k + 1, k) for k in range(1, 40)] + ring
    found = graph.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {tuple(r) for r in found} == {(k, 1) for k in range(1, 41)} | {(k, 100) for k in range(100, 109)}
