import random

import pytest

from quillmesh.operators.hierarchy import descendants, further_parents, hierarchy, subtree_sizes
from quillmesh.runtime import cut


def brute(parent):
    out = {}
    for n in set(parent) | set(parent.values()):
        path, x = [n], n
        while x in parent and parent[x] not in path:
            x = parent[x]
            path.append(x)
        if x in parent:
            loop = path[path.index(parent[x]) :]
            on = {*loop}
            first = next(k for k, y in enumerate(path) if y in on)
            out[n] = (min(loop), -1, path[: first + 1][::-1])
        else:
            out[n] = (x, len(path) - 1, path[::-1])
    return out


def made(rng, n):
    parent = {}
    for i in range(1, n):
        parent[f"n{i:04}"] = f"n{rng.randrange(max(0, i - rng.choice([1, 1, 3, 50])), i):04}"
    for a in rng.sample(sorted(parent), 2):  # loops, one of them a node of its own
        parent[a] = rng.choice([a, f"n{rng.randrange(n):04}"])
    parent |= {f"c{i}": f"c{i + 1}" for i in range(40)}  # a long chain
    parent |= {"x": "y", "y": "x", "z": "z"}
    return parent


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    parent = made(random.Random(seed), 120)
    rows = [(c, p, "c") for c, p in parent.items()]
    rows += rows[:10] + [(None, "a", ""), ("a", None, ""), (None, None, "")]
    links = spark.createDataFrame(rows, "child string, parent string, root string")
    tree = cut(hierarchy(links))
    want = brute(parent)
    got = {r["node"]: (r["root"], r["depth"], r["path"]) for r in tree.collect()}
    assert got == want
    reach = {}
    for n in want:
        x, d = n, 0
        while x in parent and (n, parent[x]) not in reach and parent[x] != n:
            x, d = parent[x], d + 1
            reach[n, x] = d
    below = [(r["descendant"], r["node"], r["distance"]) for r in descendants(tree).collect()]
    assert len(below) == len(reach) and {(a, b): d for a, b, d in below} == reach
    sizes = {r["node"]: r["subtree_size"] for r in subtree_sizes(tree).collect()}
    assert sizes == {n: 1 + sum(b == n for _, b in reach) for n in want}
    assert {(r["node"], r["around"]) for r in tree.where("around is not null").collect()} >= {("x", 2), ("y", 2), ("z", 1)}
    bare = {r["node"]: (r["root"], r["depth"]) for r in hierarchy(links, paths=False).collect()}
    assert bare == {n: w[:2] for n, w in want.items()}


def test_further_parents_are_told(spark):
    links = spark.createDataFrame([("a", "b"), ("a", "c"), ("a", "c"), ("d", "b"), (None, "b")], "child string, parent string")
    assert [tuple(r) for r in further_parents(links).collect()] == [("a", "c")]


def test_empty_and_without_paths(spark):
    none = spark.createDataFrame([], "child string, parent string")
    assert hierarchy(none).count() == 0
    one = spark.createDataFrame([("b", "a")], "child string, parent string")
    assert sorted(tuple(r) for r in hierarchy(one, paths=False).collect()) == [("a", "a", 0), ("b", "a", 1)]
