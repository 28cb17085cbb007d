import random

import pytest

from quillmesh.operators.paths import components, ego, pagerank, reversed_edges, shortest, trails

EDGES = [("a", "R", "b"), ("b", "R", "c"), ("c", "R", "a"), ("a", "S", "b"), ("c", "R", "d"), (None, "R", "a"), ("d", "R", None)]


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame(EDGES, "src string, rel string, dst string")


def brute(start, least, most):
    out, todo = [], [((start,), ())]
    while todo:
        nodes, used = todo.pop()
        if least <= len(used):
            out.append((nodes, used))
        if len(used) < most:
            todo += [((*nodes, e[2]), (*used, e)) for e in EDGES if e[0] == nodes[-1] and e[2] and e not in used]
    return sorted((n[0], n[-1], len(u), u[-1][1] if u else None, list(n)) for n, u in out)


@pytest.mark.parametrize("least,most", [(0, 2), (1, 3), (2, 6)])
def test_trails(spark, edges, least, most):
    start = spark.createDataFrame([("a",), ("a",), (None,)], "node string")
    key = lambda r: (r[0], r[1], r[2], r[3] or "", r[4])
    assert sorted((tuple(r) for r in trails(edges, least, most, start).collect()), key=key) == sorted(brute("a", least, most), key=key)


def test_shortest_and_reverse(spark, edges):
    got = {(r["start"], r["end"]): r["depth"] for r in shortest(trails(edges, 1, 4)).collect()}
    assert got["a", "a"] == 3 and got["a", "d"] == 3 and got["c", "b"] == 2
    assert reversed_edges(edges).where("src = 'b'").count() == 2


def test_bound(edges):
    with pytest.raises(ValueError):
        trails(edges, 1, 9)


def test_pagerank_components_ego(spark, edges):
    rank = {r["node"]: r["rank"] for r in pagerank(edges, rounds=30).collect()}
    assert abs(sum(rank.values()) - 1) < 1e-9 and rank["d"] < rank["c"]
    more = edges.union(spark.createDataFrame([(f"p{i}", "R", f"p{i + 1}") for i in range(12)], "src string, rel string, dst string"))
    comp = {r["node"]: r["component"] for r in components(more).collect()}
    assert comp["d"] == "a" and {comp[f"p{i}"] for i in range(13)} == {"p0"}
    none = edges.limit(0)
    assert pagerank(none).count() == 0 and components(none).count() == 0
    assert [tuple(r) for r in ego(edges.where("src is not null and dst is not null"), "a", 1).orderBy("depth", "node").collect()] == [("a", 0), ("b", 1), ("c", 1)]


def test_components_of_long_chains_and_hubs(spark):
    rng = random.Random(11)
    names = [f"{rng.getrandbits(40):x}" for _ in range(600)]
    chain, hub = names[:400], names[400:]
    pairs = [(a, b) if rng.random() < 0.5 else (b, a) for a, b in zip(chain, chain[1:], strict=False)] + [(hub[0], n) for n in hub[1:]] + [("x", "x"), (chain[0], chain[1])]
    edges = spark.createDataFrame([(a, "R", b) for a, b in pairs], "src string, rel string, dst string")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == dict.fromkeys(chain, min(chain)) | dict.fromkeys(hub, min(hub))
