from pyspark.sql import functions as F

from quillmesh.functions.pages import even, page_chunks


def test_chunks(spark):
    mark = lambda n: f"----- [Trang {n}] -----"
    page = lambda n, size: f"{mark(n)}\n\n{'a' * size}"
    texts = ["dau" + "\n\n" + page(1, 10) + "\n\n" + page(2, 10) + "\n\n" + page(3, 120), mark(1) + "\n\n" + "\n\n".join(c * 30 for c in "bcdef"), "x" * 200, "", None]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(page_chunks(F.col("t"), 90)).collect()]
    squeezed = lambda xs: "".join("".join(xs).split())
    for text, chunks in zip(texts[:3], got):
        assert squeezed(chunks) == squeezed([text])
    assert all(len(c) <= 90 for c in got[0][:-1]) and got[0][-1] == "a" * 120 and got[0][0].startswith("dau")
    assert all(len(c) <= 90 for c in got[1]) and len(got[1]) == 3 and got[2] == ["x" * 200] and got[3] == [] and got[4] is None


def test_even(spark):
    df = spark.createDataFrame([("“a”  –\n‘b’",), (None,)], "t string")
    assert [r[0] for r in df.select(even(F.col("t"))).collect()] == ["\"a\" - 'b'", None]
