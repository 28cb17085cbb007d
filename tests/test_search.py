from math import log

import pytest
from pyspark.sql import functions as F

from quillmesh.operators.search import And, Boost, Or, Phrase, Term, TextIndex, any_of, cosine_top, expand_once, fuse, pack, phrase_or_all, ranked, search

TEXTS = [(1, "Học bổng khuyến học"), (2, "học phí và học bổng học bổng"), (3, None), (4, ""), (5, "Bổng lộc"), (6, "học bổng khuyến học")]


@pytest.fixture()
def index(spark):
    return TextIndex(spark.createDataFrame([(k, t, 1) for k, t in TEXTS], "key long, text string, score int"))


def bm25(tf, length, df, n, mean):
    return log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / mean))


def test_terms_and_ties(index):
    got = [tuple(r) for r in search(index, any_of("Bổng?"), 10).orderBy("rank").collect()]
    mean = (4 + 7 + 0 + 0 + 2 + 4) / 6
    want = {2: bm25(2, 7, 4, 6, mean), 5: bm25(1, 2, 4, 6, mean), 1: bm25(1, 4, 4, 6, mean), 6: bm25(1, 4, 4, 6, mean)}
    assert {k: pytest.approx(s) for k, s, _ in got} == want
    assert [k for k, _, _ in got if k in (1, 6)] == [1, 6]


def test_phrases(index):
    assert {r["key"]: r["tf"] for r in Phrase("hoc bong").hits(index).collect()} == {1: 1, 2: 2, 6: 1}
    assert {r["key"] for r in search(index, Phrase("bong hoc")).collect()} == {2}
    assert search(index, Phrase("khong co")).count() == 0


def test_trees(index):
    both = And((Term("hoc"), Or((Term("phi"), Term("loc")))))
    assert {r["key"] for r in search(index, both).collect()} == {2}
    plain, twice = (search(index, q).collect()[0]["score"] for q in (Term("phi"), Boost(Term("phi"), 2)))
    assert twice == pytest.approx(2 * plain)
    assert {r["key"] for r in search(index, phrase_or_all("học bổng khuyến học")).collect()} == {1, 6}


def test_fusion(spark):
    lists = [ranked(spark.createDataFrame(x, "key string, score double")) for x in ([("a", 2.0), ("b", 1.0)], [("c", 2.0), ("b", 1.0)])]
    got = fuse(lists).orderBy(F.desc("score"), "key").collect()
    assert got[0]["key"] == "b" and got[0]["via"] == [0, 1] and got[0]["score"] == pytest.approx(2 / 62)


def test_cosine(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [0.0, 0.0]), (5, None)], "key long, vector array<double>")
    q = spark.createDataFrame([(9, [2.0, 0.0]), (8, None)], "qid long, vector array<double>")
    assert [(r["key"], r["score"]) for r in cosine_top(v, q, 2).orderBy("rank").collect()] == [(1, 1.0), (2, 1.0)]
    assert [r["key"] for r in cosine_top(v, q, 2, block=1).orderBy("rank").collect()] == [1, 2]
    assert cosine_top(v, q.limit(0), 2).count() == 0


def test_expand(spark):
    e = spark.createDataFrame([("a", "x"), ("b", "x"), ("y", "a"), ("a", "b")], "src string, dst string")
    s = spark.createDataFrame([("a",), ("b",)], "key string")
    assert {tuple(r) for r in expand_once(e, s).collect()} == {("x", 2), ("y", 1)}


def packed(spark, docs, budget, clip):
    df = spark.createDataFrame([(docs,)], "docs array<struct<doc: string, texts: array<string>>>")
    return [(r["doc"], [len(t) for t in r["taken"]]) for r in df.select(F.explode(pack(F.col("docs"), budget, clip)).alias("x")).select("x.*").collect()]


def test_packing(spark):
    five = [("d", ["x" * 2000] * 5)]
    assert packed(spark, five, 1200, 500) == [("d", [500, 500])]
    assert packed(spark, five, 1398, 500) == [("d", [500, 500, 398])]
    # a document that is over does not stop the next
    assert packed(spark, [("a", ["x" * 900, "y" * 900]), ("b", ["z" * 50])], 1000, 2000) == [("a", [900]), ("b", [50])]
