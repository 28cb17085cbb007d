import random

from pyspark.sql import functions as F

from quillmesh.functions import registry
from quillmesh.operators import evidence, resolve


def test_names(spark):
    options = spark.createDataFrame([(x,) for x in ("Trường Đại học Kinh thương", "Viện Sông Hồ", "Viện Sông Núi", "Ban Mai", None)], "name string")
    aliases = spark.createDataFrame([("TKT", "Trường Đại học Kinh thương"), ("cũ", "Không còn"), (None, "Ban Mai")], "alias string, canonical string")
    asked = ["tkt", "VIỆN SÔNG HỒ", "đại học kinh thương", "Viện Sông", "Trường Đại học Ven Đèo", "cũ", "", None, "tkt", "ban"]
    got = {r["mention"]: r for r in resolve.pick(spark.createDataFrame([(x, 1) for x in asked], "mention string, name int"), options, aliases).collect()}
    assert len(got) == 8
    told = lambda m: (got[m]["outcome"], got[m]["value"], got[m]["candidates"])
    assert told("tkt") == ("resolved", "truong_dai_hoc_kinh_thuong", []) == told("đại học kinh thương")
    assert told("VIỆN SÔNG HỒ")[1] == "vien_song_ho" and told("ban")[1] == "ban_mai"
    assert told("Viện Sông") == ("ambiguous", None, ["Viện Sông Hồ", "Viện Sông Núi"])
    assert told("Trường Đại học Ven Đèo")[0] == told("cũ")[0] == told("")[0] == "not_found"
    assert resolve.pick(options.limit(0).select(F.col("name").alias("mention")), options).count() == 0


def test_prefix_filter_loses_no_pair(spark):
    rng = random.Random(5)
    word = [f"w{k}" for k in range(9)]
    names = sorted({" ".join(rng.sample(word, rng.randint(1, 5))) for _ in range(60)})
    asked = sorted({" ".join(rng.sample(word, rng.randint(1, 5))) for _ in range(60)} - set(names))
    got = {r["mention"]: r for r in resolve.pick(spark.createDataFrame([(x,) for x in asked], "mention string"), spark.createDataFrame([(x,) for x in names], "name string")).collect()}
    for m in asked:
        a = set(m.split())
        s = sorted(((-round(len(a & set(n.split())) / len(a | set(n.split())), 9), n.replace(" ", "_"), n) for n in names))
        s = [x for x in s if -x[0] >= 0.5]
        sure = len(s) == 1 or len(s) > 1 and round(s[1][0] - s[0][0], 9) >= 0.08
        want = "not_found" if not s else "resolved" if sure else "ambiguous"
        assert got[m]["outcome"] == want, m
        if want == "ambiguous":
            assert got[m]["candidates"] == [x[2] for x in s[:3]]


def test_people(spark):
    options = spark.createDataFrame([("Kha Thế Lữ",), ("Kha Bảo Vinh",), ("Thầy Đồ",)], "name string")
    asked = ["thầy Lữ", "PGS. TS Kha Bảo Vinh", "Kha", "cô Mận", "Thầy Đồ", "bàng"]
    got = {r["mention"]: (r["outcome"], r["value"]) for r in resolve.pick_person(spark.createDataFrame([(x,) for x in asked], "mention string"), options).collect()}
    assert got["thầy Lữ"] == ("resolved", "kha_the_lu") and got["PGS. TS Kha Bảo Vinh"] == ("resolved", "kha_bao_vinh")
    assert got["Kha"] == ("ambiguous", None) and got["cô Mận"][0] == got["bàng"][0] == "not_found"


def people_brute(asked, names):
    words = lambda x: set(x.removeprefix("truong ").split())
    out = {}
    for m in asked:
        a, key = words(m), lambda n: n.replace(" ", "_")
        s = sorted((-round(len(a & words(n)) / len(a | words(n)), 9), key(n), n) for n in names)
        s = [x for x in s if -x[0] >= 0.5]
        part = sorted((key(n), n) for n in names if set(m.split()) <= set(n.split()))
        if m in names:
            out[m] = ("resolved", key(m), [])
        elif s:
            sure = len(s) == 1 or round(s[1][0] - s[0][0], 9) >= 0.08
            out[m] = ("resolved", s[0][1], []) if sure else ("ambiguous", None, [x[2] for x in s[:3]])
        elif len(part) == 1:
            out[m] = ("resolved", part[0][0], [])
        else:
            out[m] = ("ambiguous", None, [x[1] for x in part[:5]]) if part else ("not_found", None, [])
    return out


def test_people_against_all_pairs(spark):
    rng = random.Random(8)
    word = ["truong", *(f"w{k:02}" for k in range(25))]
    draw = lambda n: " ".join((["truong"] if rng.random() < 0.2 else []) + rng.sample(word[1:], n))
    names = sorted({draw(rng.choice((1, 3, 4, 4, 4, 6, 9, 10, 11, 14))) for _ in range(150)})
    near = [" ".join((n.split() + ["w90", "w91", "w92"])[rng.randint(0, 2) : rng.randint(2, 16)]) for n in names]
    asked = sorted({draw(rng.choice((1, 1, 2, 4, 5, 8, 12))) for _ in range(80)} | {n for n in near if n} | set(names[:5]) | {"w90"})
    got = resolve.pick_person(spark.createDataFrame([(x,) for x in asked], "mention string"), spark.createDataFrame([(x,) for x in names], "name string")).collect()
    assert {r["mention"]: (r["outcome"], r["value"], r["candidates"]) for r in got} == people_brute(asked, set(names)) and len(got) == len(asked)


def test_names_out_of_few_words_make_few_candidates(spark, monkeypatch):
    rng = random.Random(9)
    word = [f"w{k:02}" for k in range(12)]
    names = sorted({" ".join(rng.sample(word, 4)) for _ in range(1500)})
    asked = [*word, *(f"{n} nay" for n in names[:200])]
    seen, ranked = [], resolve._ranked
    monkeypatch.setattr(resolve, "_ranked", lambda pairs, *a: seen.append(pairs.count()) or ranked(pairs, *a))
    got = resolve.pick_person(spark.createDataFrame([(x,) for x in asked], "mention string"), spark.createDataFrame([(x,) for x in names], "name string")).collect()
    assert {r["mention"]: (r["outcome"], r["value"], r["candidates"]) for r in got} == people_brute(asked, set(names))
    assert 0 < sum(seen) <= 20 * len(asked)


def test_articles_and_lines(spark):
    asked = {"điều 12b": "Điều 12b", "9": "Điều 9", "Điểm c khoản 1 ĐIỀU 30": "Điều 30", "phần iii": "III", "Mục 4.2.": "4.2", "1.3": "1.3", "phụ lục": None, "": None, None: None}
    df = spark.createDataFrame([(i, x) for i, x in enumerate(asked)], "i int, c string").orderBy("i")
    assert [r[0] for r in df.select(resolve.article_number(F.col("c"))).collect()] == list(asked.values())
    assert [r[0] for r in spark.createDataFrame([(" a \n b ",), ("  ",)], "c string").select(resolve.one_line(F.col("c"))).collect()] == ["a b", None]


def test_selection(spark):
    class T:
        def __init__(self, name, action, required=(), optional=()):
            self.name, self.action, self.required, self.optional = name, action, required, optional

    known = evidence.rules(spark, [T("a1", "a", ("x",)), T("a2", "a", ("x", "y"), ("z",)), T("b1", "b")])
    rows = [(1, "a", {"x": "1"}), (2, "a", {"x": "1", "y": "2"}), (3, "a", {"z": "1"}), (4, "a", {"x": "1", "w": "2"}), (5, "b", {}), (6, "c", {"x": "1"}), (7, "b", None), (8, "b", {"limit": "3"}), (9, "a", {"x": ""})]
    got = {r["id"]: tuple(r)[1:] for r in evidence.select_template(spark.createDataFrame(rows, "id int, action string, slots map<string,string>"), known).collect()}
    assert got[1] == ("template", "a1", [], []) and got[2] == ("template", "a2", [], [])
    assert got[3] == ("clarify", None, ["x", "y"], []) and got[4] == ("agent", None, [], ["w"])
    assert got[5][:2] == got[7][:2] == got[8][:2] == ("template", "b1") and got[6] == ("agent", None, [], [])
    assert got[9] == ("clarify", None, ["x", "y"], [])
    frames = spark.createDataFrame([(1, {}, ["7/A"]), (2, {"doc_number": "1/B"}, ["7/A"]), (3, None, ["7/A", "8/A"]), (4, {"doc_number": ""}, ["7/A"])], "id int, slots map<string,string>, n array<string>")
    assert [r["slots"] for r in evidence.fill_number(frames, F.col("n")).orderBy("id").collect()] == [{"doc_number": "7/A"}, {"doc_number": "1/B"}, {}, {"doc_number": "7/A"}]


def test_sources_and_rows(spark):
    cols = "pos int, document string, article string, content string, title string, status string"
    rows = spark.createDataFrame([(1, "d1", None, None, "T1", "old"), (2, None, None, None, "x", None), (3, "d1", None, None, "again", "old"), (4, None, None, "c1", "C", None)], cols)
    hits = spark.createDataFrame([(1, "d1", "a1", "H1", "new"), (2, "d1", "a1", "H1", "new"), (3, "d2", "a2", "H2", None)], "pos int, document string, article string, title string, status string")
    got = [tuple(r) for r in evidence.sources(rows, hits).collect()]
    assert got == [(1, "d1", None, None, "T1", "new"), (2, None, None, "c1", "C", None), (3, "d1", "a1", None, "H1", "new"), (4, "d2", "a2", None, "H2", None)]
    assert evidence.sources(rows, hits, 2).count() == 2
    text = evidence.rows_as_text(spark.range(5).selectExpr("id", "repeat('x', 400) AS t"), 2, 5)
    assert text.startswith("5 rows (2 of 5 shown; the query's limit of 5 was reached: there are at least 5):\n[{") and "…" in text


def semi_brute(a, b):
    lev = lambda x, y: sum(1 for _ in ()) or _lev(x, y)
    return min(lev(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))


def _lev(x, y):
    p = list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        q = [i]
        for j, d in enumerate(y, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (c != d)))
        p = q
    return p[-1]


def test_nearest_part():
    rng = random.Random(3)
    for _ in range(150):
        a, b = ("".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(2))
        n, i, j = registry.semi_global(a, b)
        assert n == semi_brute(a, b) == _lev(a, b[i:j]), (a, b)


def test_functions_by_name(spark):
    names = registry.install(spark)
    assert "qm_slug" in names
    row = spark.sql("SELECT qm_slug('Hội  Đồng'), qm_one_line(' a  b '), qm_first_year('năm 1987'), qm_iso_date('5/3/2020'), qm_nearest_part('abd', 'xxabcd').edits").first()
    assert tuple(row) == ("hoi_dong", "a b", "1987", "2020-03-05", 1)
    assert [tuple(r) for r in spark.sql("SELECT * FROM qm_lines('a\\nbc')").collect()] == [(1, 0, "a"), (2, 2, "bc")]
    score = registry.scorer(spark, "by_length", lambda qs, ts: [float(len(t)) for t in ts])
    assert spark.sql("SELECT by_length('q', 'abc')").first()[0] == 3.0 and spark.range(1).select(score(F.lit("q"), F.lit("ab"))).first()[0] == 2.0
    plain = spark.createDataFrame([("a", 1)], "key string, rank int")

    def fails():
        return plain.select("key", F.raise_error(F.lit("no model")).cast("int").alias("rank"))

    assert registry.guarded(fails, plain).collect() == plain.collect()
