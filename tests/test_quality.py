from pyspark.sql import functions as F

from quillmesh.functions import quality as Q


def run(spark, make, *rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string")
    return [r[0] for r in df.select("i", make(F.col("a"), F.col("b")).alias("o")).orderBy("i").select("o").collect()]


def test_levels(spark):
    rows = [("Nghị định", None), ("Nghị định", "dai_hoc_vung"), ("HIẾN PHÁP", "bo_nganh"), ("Quyết định", "truong_thanh_vien"), ("Luật", "phong_ban"), ("Quyết định", "?"), (None, None)]
    got = run(spark, Q.authority_level, *rows)
    assert [g[0] for g in got] == [4, 2, 6, 1, 5, None, None]
    assert [g[1] for g in got] == ["onto: theo-loai", "onto", "onto", "onto", "onto: theo-loai", "khong-suy-duoc", "khong-suy-duoc"]


def test_validity(spark):
    make = lambda a, b: Q.validity(a, b, F.lit("2024-06-01"))
    got = run(spark, make, ("Hết hiệu lực 01/01/2024", None), ("Hết hiệu lực 01/01/2025", "2020-01-01"), ("Còn hiệu lực", None), (None, "2030-01-01"), (None, None))
    assert [tuple(g) for g in got] == [("HET_HIEU_LUC", "2024-01-01"), ("CON_HIEU_LUC", "2025-01-01"), ("CON_HIEU_LUC", None), ("CHUA_HIEU_LUC", None), (None, None)]


def test_typed(spark):
    one = lambda f, *xs: run(spark, lambda a, _: f(a), *((x, None) for x in xs))
    assert one(Q.digits, "l2O", "5B", "1x", None) == ["120", "58", None, None]
    assert one(Q.position_rank, "KT. Hiệu trưởng", "Phó Trưởng phòng", "Quyền Giám đốc", "Chánh văn phòng", "Chuyên viên") == ["deputy", "deputy", "acting", "head", "other"]
    assert one(Q.academic_titles, "PGS. TS", "ths", "ông") == ["PGS.TS", "ThS", None]
    assert one(lambda c: Q.sanitize(c, 8), ' a/b:"c"  d e f ', None) == ["a b c d", None]


def test_gate(spark):
    df = spark.createDataFrame([(1, "x" * 400, 1), (2, "x" * 400, 9), (3, None, 1), (4, "def a\nimport b\nreturn c\n" + "x" * 400, 1)], "i int, t string, p int")
    assert [r[0] for r in df.orderBy("i").select(Q.page_gate(F.col("t"), F.col("p"))).collect()] == ["ok", "thin", "short", "code"]
