"""Whole-graph questions against small graphs worked out by hand or by brute force."""

from types import SimpleNamespace

from quillmesh.plans.walks import b10_amends_replaces_depth_distribution, document_pagerank


def graph(spark, edges):
    return SimpleNamespace(edge=spark.createDataFrame(edges, "src string, rel string, dst string"))


def test_trails_of_five_edges_are_counted(spark):
    chain = [(f"n{k}", "AMENDS" if k % 2 else "REPLACES", f"n{k + 1}") for k in range(6)]
    got = {r["depth"]: r["n"] for r in b10_amends_replaces_depth_distribution(graph(spark, [*chain, ("n0", "BASED_ON", "n1")])).collect()}
    assert got == {1: 6, 2: 5, 3: 4, 4: 3, 5: 2}


def test_pagerank_is_iterated_until_it_settles(spark):
    edges = [(f"n{k}", f"n{k + 1}") for k in range(12)] + [("n12", "n10"), ("x", "n0")]
    nodes = sorted({n for e in edges for n in e})
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(300):
        out = {n: sum(a == n for a, _ in edges) for n in nodes}
        gone = sum(r for n, r in rank.items() if not out[n])
        rank = {n: (0.15 + 0.85 * gone) / len(nodes) + 0.85 * sum(rank[a] / out[a] for a, b in edges if b == n) for n in nodes}
    got = {r["doc_key"]: r["rank"] for r in document_pagerank(graph(spark, [(a, "BASED_ON", b) for a, b in edges])).collect()}
    assert set(got) == set(nodes) and sum(abs(got[n] - rank[n]) for n in nodes) < 1e-5
