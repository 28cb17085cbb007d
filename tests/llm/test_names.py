import random
from itertools import combinations

from quillmesh.llm import names as N
from quillmesh.llm.canonical import damerau
from quillmesh.llm.names import gap_keys, link_organizations, link_people, name_words, one_apart, pairs, parsed, readings, telex, whole_key

PEOPLE = {
    "A": ["Mạc Khuê Bội Diệu", "mac khue boi dieu", "MẠC KHUÊ BỘI DIỆU", "  Mạc  Khuê Bội Diệu ", "PGS.TS. Mạc Khuê Bội Diệu", "Mạc K. B. Diệu", "M.K.B. Diệu", "dieu mac", "mac.khue.boi.dieu", "mackhueboidieu", "Diệu, Mạc Khuê Bội", "Diệu Khuê Bội Mạc", "Macj Khuee Booij Dieeuj", "Cô Diệu", "Bội Diệu", "Mạc Khuê Bội Diệuu", "Mạc Khuê Bội Diệu (đã nghỉ)", "KT. HIỆU TRƯỞNG - Mạc Khuê Bội Diệu", "Mạc Khuê Bội Diệu"],
    "B": ["Hồ Sĩ Gia Cẩn", "Ho Si Gia Can", "Hồ Cẩn", "Thầy Cẩn", "H.S.G. Cẩn"],
    "C": ["Hồ Sĩ Gia Mẫn", "Ho Si Gia Man", "Hồ Mẫn", "(Đã ký) Hồ Sĩ Gia Mẫn"],
}
NOBODY = [None, "", "   ", "Đã ký", "(không rõ)"]


def rows():
    out, n = [], 0
    for unit in ("U1", "U2", "U3", "U4"):
        for who, names in PEOPLE.items():
            for name in names:
                out.append((n, unit, name, f"{unit}{who}"))
                n += 1
    # what makes words of the corpus frequent
    for k in range(60):
        for name in ("Mạc Sĩ Gia Diệu", "Hồ Khuê Bội Cẩn", "Hồ Khuê Bội Mẫn"):
            out.append((n, f"V{k}", name, f"V{k}{name}"))
            n += 1
    return out, n


def test_variants_link_within_their_unit(spark):
    known, n = rows()
    data = [(i, u, name, "x") for i, u, name, _ in known] + [(n + k, "U1", x, "x") for k, x in enumerate(NOBODY)]
    df = spark.createDataFrame(data + data[:30], "id long, unit string, name string, entity string")
    linked = link_people(df)
    ids = [r["id"] for r in linked.collect()]
    assert len(ids) == len(set(ids)) == len(known)
    got = {tuple(r) for r in pairs(linked, "unit", "entity").collect()}
    want = {(a[0], b[0]) for a, b in combinations(known, 2) if a[3] == b[3]}
    assert got == want


def test_corner_cases(spark):
    empty = spark.createDataFrame([], "id long, unit string, name string")
    assert link_people(empty).count() == 0
    one = spark.createDataFrame([(1, None, "Lý An"), (2, None, "Lý An"), (3, "u", "dài " * 5000)], "id long, unit string, name string")
    assert {tuple(r) for r in pairs(link_people(one), "unit", "entity").collect()} == {(1, 2)}
    assert telex("Nguyeenx".lower()) == "nguyen" and telex("ddinhf") == "dinh" and telex("can") == "can"
    assert name_words("Người ký: Hồ An") == ["ho", "an"] and name_words("Đ/c Tạ Lục") == ["ta", "luc"]


def test_organizations(spark):
    ref = spark.createDataFrame([("a", "Bộ Học chính", "BHC"), ("b", "Trường Đại học Sư phạm Hải Lam", "ĐHSPHL"), ("c", "Trường Đại học Sư phạm Vân Kỳ", "ĐHSPVK")], "code string, name string, short string")
    want = {"BHC": "a", "bo hoc chinh": "a", "Bộ Họcc chính": "a", "Hải Lam, Trường Đại học Sư phạm": "b", "Trường ĐH Sư phạm Hải Lam;": "b", "DHSPVK": "c", "TM. Trường Đại học Sư phạm Vân Kỳ": "c", "Trưng Đại học Sư phm Vân Kỳ": "c"}
    rows = [(i, name) for i, name in enumerate(want)] + [(90, "Hợp tác xã X"), (91, "hợp tác xã x"), (92, None), (93, "")]
    got = {r["id"]: r["entity"] for r in link_organizations(spark.createDataFrame(rows, "id long, name string"), ref).collect()}
    assert [got[i] for i in range(len(want))] == list(want.values())
    assert got[90] == got[91] and 92 not in got and 93 not in got


FAMILIES = ["Lê Văn An", "Lê Hữu Phúc", "Mai Đức Tú", "Mai Bá Lộc", "Chu Văn An", "Chu Thị Lan", "Đỗ Nam Hải", "Ông Ích Khiêm"]


def test_family_names_are_no_words_of_address(spark):
    rows = [(i, "U", x) for i, x in enumerate(FAMILIES)]
    asked = {"bà Lê Hữu Phúc": "Lê Hữu Phúc", "BA LE HUU PHUC": "Lê Hữu Phúc", "chu van an": "Chu Văn An", "Chu Lan": "Chu Thị Lan", "anh Lộc": "Mai Bá Lộc", "Út Phúc": "Lê Hữu Phúc", "Tú": "Mai Đức Tú", "ông Hải": "Đỗ Nam Hải", "ong ich khiem": "Ông Ích Khiêm"}
    rows += [(100 + i, "U", x) for i, x in enumerate(asked)] + [(300, "U", "An")]
    got = {r["id"]: (r["entity"], r["score"]) for r in link_people(spark.createDataFrame(rows, "id long, unit string, name string")).collect()}
    assert len({got[i][0] for i in range(len(FAMILIES))}) == len(FAMILIES)
    for i, who in enumerate(asked.values()):
        assert got[100 + i][0] == got[FAMILIES.index(who)][0], list(asked)[i]
    # two people of the unit are called An
    assert got[300] == ("?300", 0.5)


def test_address():
    assert [parsed(x)[1] for x in ("Chu Văn An", "chú An", "Chú An", "chú an", "CHU AN", "Lê An", "ba")] == [3, 1, 2, 2, 3, 0, 0]
    assert parsed("PGS. TS. Lê An")[0] == ["le", "an"] and name_words("Tú") == ["tu"] and name_words("(đã ký)") == []


def test_slips_of_any_length():
    rng = random.Random(2)
    words = ["".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(80)]
    for a in words:
        for b in words:
            assert one_apart(a, b) == (damerau(a, b) == 1)
            if one_apart(a, b):
                assert gap_keys(a) & gap_keys(b)
        assert whole_key(a) in gap_keys(a)
    long = "x" * 30_000 + "y" * 30_000
    assert gap_keys(long) & gap_keys(long[:500] + long[501:]) and one_apart(long, long[:-1] + "z")


def test_readings_are_bounded():
    place = [("a", 1, 1, 1), ("b", 0, 0, 0)]
    assert len(readings([place] * 3)) == 8
    many = readings([place] * 60)
    assert len(many) == 61 and [w[0] for w in many[0]] == ["a"] * 60


def test_hot_groups_are_cut(spark, monkeypatch):
    monkeypatch.setattr(N, "GROUP", 7)
    m = spark.createDataFrame([(i, "hot" if i < 40 else f"g{i % 5}") for i in range(60)] + [(99, None)], "id long, entity string")
    got = sorted(map(tuple, pairs(m, "entity").collect()))
    rows = [(r["id"], r["entity"]) for r in m.where("entity is not null").collect()]
    assert got == sorted((a, b) for (a, x), (b, y) in combinations(sorted(rows), 2) if x == y)
