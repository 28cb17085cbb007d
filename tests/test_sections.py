import pytest
from pyspark.sql import functions as F

from quillmesh.plans.graph import PropertyGraph
from quillmesh.plans.sections import guarded, rerank, select_seeds
from quillmesh.sources.listing import parse_listing, read_page_map


def ranks(spark, *keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys, 1)], "key string, rank int")


def test_seeds(spark):
    got = [tuple(r) for r in select_seeds(ranks(spark, "a", "b", "x"), ranks(spark, "c", "b"), ranks(spark, "b", "s"), 2).orderBy("pos").collect()]
    assert got == [("b", ["fulltext", "scope", "vector"], 1), ("a", ["vector"], 2), ("s", ["scope"], 3)]


def test_rerank_is_stable(spark):
    hits = ranks(spark, "a", "b", "c", "d").withColumn("s", F.expr("case key when 'c' then 5.0 when 'd' then 9.0 else 1.0 end"))
    assert [r["key"] for r in rerank(hits, F.col("s"), head=3).orderBy("rank").collect()] == ["c", "a", "b", "d"]
    assert [r["key"] for r in rerank(hits, F.lit(None).cast("double")).orderBy("rank").collect()] == ["a", "b", "c", "d"]


def test_guard(spark, small):
    g = PropertyGraph.of(spark, small)
    assert guarded(g, "SELECT doc_key FROM document ORDER BY doc_key", cap=3).count() == 3
    assert guarded(g, "WITH x AS (SELECT src FROM edge) SELECT count(*) AS n FROM x").first()["n"] > 0
    for bad in ("SELECT * FROM secrets", "DROP TABLE document", "SET a=b", "SELECT reflect('a', 'b') FROM document", "CREATE TABLE t AS SELECT * FROM document"):
        with pytest.raises(Exception):
            guarded(g, bad)


def test_listing(spark, tmp_path):
    html = "<table><tr><th>x</th></tr><tr>" + "".join(f"<td> c{i}&amp; </td>" for i in range(10)) + "<a href='a.html'>n</a><a href='/f/1.PDF?x=1'>p</a><a href='2.pdf'>q</a></tr>"
    got = parse_listing(spark.createDataFrame([(1, html), (2, None), (3, "<td>loose")], "page_id long, html string")).collect()
    assert [(r["page_id"], r["row_no"], r["cells"][0], r["pdf_url"]) for r in got] == [(1, 1, "c0&", "/f/1.PDF?x=1")]
    (tmp_path / "m.json").write_text('{"1/A#Điều 1": {"source": "s", "page_start": 2, "page_end": 3}}')
    assert tuple(read_page_map(spark, str(tmp_path / "m.json")).first()) == ("1/A#Điều 1", "s", 2, 3, None)
