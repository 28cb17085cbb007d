from math import log2

import pytest

from quillmesh.operators import metrics


def frames(spark, run, gold):
    return spark.createDataFrame(run, "qid string, key string, rank int"), spark.createDataFrame(gold, "qid string, key string")


def test_sets(spark):
    run, gold = frames(spark, [("a", "x", 1), ("a", "y", 2), ("a", "y", 3), ("c", "x", 1)], [("a", "x"), ("a", "z"), ("b", "x")])
    got = {r["qid"]: (r["precision"], r["recall"], r["f1"]) for r in metrics.score_sets(run, gold).collect()}
    assert got == {"a": (0.5, 0.5, 0.5), "b": (1.0, 0.0, 0.0), "c": (0.0, 1.0, 0.0)}


def test_ranked(spark):
    run, gold = frames(spark, [("a", "n", 1), ("a", "x", 2), ("a", "x", 5), ("a", "z", 3)], [("a", "x"), ("a", "z"), ("a", "w"), ("b", "q")])
    got = {r["qid"]: tuple(r)[1:] for r in metrics.score_ranked(run, gold, 5).collect()}
    dcg = 1 / log2(3) + 1 / log2(4)
    best = 1 + 1 / log2(3) + 1 / log2(4)
    assert got["a"] == pytest.approx((0.4, 2 / 3, dcg / best, 0.5, 2 / 3), abs=1e-6)
    assert got["b"] == (0.0,) * 5
    other = {r["qid"]: r["ndcg"] for r in metrics.score_ranked(run, gold, 5, ideal="retrieved").collect()}
    assert other["a"] == pytest.approx(dcg / (1 + 1 / log2(3)), abs=1e-6) and other["b"] == 0.0


def test_kappa(spark):
    mk = lambda rows: tuple(metrics.kappa(spark.createDataFrame(rows, "a string, b string")).first())
    assert mk([("x", "x"), ("x", "y"), ("y", "y"), ("y", "y"), (None, "x")]) == pytest.approx((4, 0.75, 0.5, 0.5))
    assert mk([("x", "x"), ("x", "x")])[3] == 1.0
    assert mk([])[3] is None


def test_errors_and_sample(spark):
    pairs = spark.createDataFrame([("abcd", "abxd"), ("ab", "ab"), (None, "x"), ("", "x")], "truth string, text string")
    assert tuple(metrics.error_rates(pairs).first()) == pytest.approx((2, 1 / 6, 0.0), abs=1e-6)
    rows = spark.range(100).selectExpr("id", "id % 3 as s")
    one, two = (sorted(map(tuple, metrics.sample(rows, "s", "id", 5, 1).collect())) for _ in "ab")
    assert one == two and len(one) == 15
