from unicodedata import normalize

from pyspark.sql import functions as F

from quillmesh.functions import text
from quillmesh.functions.numbers import plain_number
from quillmesh.operators.text_keys import as_query, numbers_in, phrase_query, terms_of


def one(spark, column, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.select("i", column(F.col("c")).alias("o")).orderBy("i").select("o").collect()]


def test_plain_number(spark):
    typed = ["số . 007 / 1998 / ct–uvw", "Số:31/TB-KLM", normalize("NFD", "số 64/ÐA-Ố"), "0/Z", "  ", None, "", "Số :", "00012-xyz/pq"]
    assert one(spark, plain_number, *typed) == ["SỐ.007/1998/CT-UVW".replace("SỐ.007", "7"), "31/TB-KLM", "64/ĐA-Ố", "0/Z", None, None, None, None, "12-XYZ/PQ"]


def test_folds(spark):
    assert one(spark, text.deaccent, "Đường Trưởng ố", None, "") == ["Duong Truong o", None, ""]
    assert one(spark, text.slug, "  Bộ Học chính! ", normalize("NFD", "Đại học"), "") == ["bo_hoc_chinh", "dai_hoc", ""]
    assert one(spark, text.tokens, "Điều 5, khoản 2") == [["dieu", "5", "khoan", "2"]]


def test_dates(spark):
    got = one(spark, text.iso_date, "ngày 5/3/2020", "2019-1-9", "31/02/2020", "không", None)
    assert got == ["2020-03-05", "2019-01-09", None, None, None]
    assert one(spark, text.first_year, "từ 1998 đến 2003", "x") == [1998, None]


def test_number_parts(spark):
    got = one(spark, text.number_parts, "41/CT-UVW", "8/1999/ND-KLM-RS", "305/UVW-HC", "12/2004/QH11", "77/QĐ", "6/1990", "x")
    assert [tuple(g) for g in got] == [
        ("41", None, "CT", "UVW"), ("8", "1999", "ND", "KLM-RS"), ("305", None, None, "UVW-HC"), ("12", "2004", "QH", "QH11"), ("77", None, "QĐ", None), ("6", "1990", None, None), (None, None, None, None),
    ]


def test_cleaning(spark):
    assert one(spark, text.clean_page, "a \r\nb\n\n\n\nc") == ["a\nb\n\nc"]
    assert one(spark, text.markdown_off, "# **T** [x](u) `c`") == ["T x c"]
    assert one(spark, text.articles_heading_number, "Điều 12. X", "khoản 3") == [12, None]


def test_numbers_in_questions(spark):
    asked = {
        "Bản 71/TB-UVW, rồi 071/tb-uvw và 5/1987/CT-KL&M.": ["71/TB-UVW", "5/1987/CT-KL&M"],
        "theo (18b/2003/LT-PQ) – 9/2001/TTLT/PQ-RS-UV": ["18b/2003/LT-PQ", "9/2001/TTLT/PQ-RS-UV"],
        "kết luận 14-KL/XYU": ["14-KL/XYU"],
        "hạn 30/11/2031, tỉ số 2/1, khoá 2019/2023, kỳ 2/2019-2020, phòng B3/2": [],
        "": [],
        None: None,
    }
    assert one(spark, numbers_in, *asked) == list(asked.values())


def test_terms_of_questions(spark):
    query = lambda c: as_query(terms_of(c, ("Viện UVW",)))
    asked = {
        "Thư viện mở cửa ra sao?": '"thư viện"^2 OR "viện mở"^2 OR "mở cửa"^2 OR thư OR viện OR mở OR cửa',
        "Bản 71/TB-UVW nêu lệ phí thi, lệ phí của Viện UVW": '"lệ phí"^2 OR "phí thi"^2 OR "thi lệ"^2 OR bản OR lệ OR phí OR thi',
        "Khoản 3 là gì": '"khoản 3"^2 OR khoản',
        "hiện nay ai được?": "",
        "": "",
        None: None,
    }
    got = dict(zip(asked, one(spark, query, *asked)))
    assert got["Thư viện mở cửa ra sao?"] == asked["Thư viện mở cửa ra sao?"] and got["Khoản 3 là gì"] == asked["Khoản 3 là gì"]
    assert got["hiện nay ai được?"] == "" and got[""] == "" and got[None] is None
    assert set(got["Bản 71/TB-UVW nêu lệ phí thi, lệ phí của Viện UVW"].split(" OR ")) == set(asked["Bản 71/TB-UVW nêu lệ phí thi, lệ phí của Viện UVW"].split(" OR "))
    assert one(spark, phrase_query, "lịch thi", 'ca thi "bù" (sáng)') == ['"lịch thi"', '"ca thi bù sáng"^2 OR (ca AND thi AND bù AND sáng)']
