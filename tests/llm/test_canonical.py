import random

import pytest
from pyspark.sql import functions as F

from quillmesh.llm import canonical as C


def lev(a, b):
    p = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        q = [i]
        for j, y in enumerate(b, 1):
            q.append(min(p[j] + 1, q[-1] + 1, p[j - 1] + (x != y)))
        p = q
    return p[-1]


def test_tree_finds_all_within():
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcđ", k=rng.randint(1, 9)))
    words, asked = [word() for _ in range(200)], [word() for _ in range(80)]
    tree = C.BkTree(words)
    for r in (0, 1, 2, 4):
        got = tree.within(asked, [r] * len(asked))
        assert [sorted(g) for g in got] == [sorted(w for w in set(words) if lev(a, w) <= r) for a in asked]
    assert C.BkTree([]).within(["a"], [1]) == [[]]


def test_damerau_is_a_metric():
    rng = random.Random(4)
    ws = ["".join(rng.choices("abc", k=rng.randint(0, 6))) for _ in range(25)]
    d = {(a, b): C.damerau(a, b) for a in ws for b in ws}
    assert all(d[a, b] == d[b, a] and (d[a, b] == 0) == (a == b) and d[a, b] <= lev(a, b) <= 2 * d[a, b] for a, b in d)
    assert all(d[a, c] <= d[a, b] + d[b, c] for a in ws for b in ws for c in ws)
    assert C.damerau("ab", "ba") == 1 and C.damerau("", "ab") == 2


ENTRIES = [("bo_hoc_chinh", "Bộ Học chính", "BHC"), ("dh_hl", "Đại học Vùng Hải Lam", "ĐHVHL"), ("hd_hl", "Hội đồng Đại học Vùng Hải Lam", "HĐĐHHL"), ("phong", "Phòng Đào luyện và Khảo thí", "PĐL"), ("le", "Lệnh", "LE")]


def test_rewritings():
    ref = C.Reference(ENTRIES)
    want = {
        "bo hoc chinh": "bo_hoc_chinh", "BỘ HỌC CHÍNH;": "bo_hoc_chinh", "bộ_học_chính": "bo_hoc_chinh", "TM. Bộ Học chính": "bo_hoc_chinh", "Bộ Học chính (BHC)": "bo_hoc_chinh", "BHC": "bo_hoc_chinh",
        "Bộ Họcc chnh": "bo_hoc_chinh", "DHVHL": "dh_hl", "Hải Lam, Đại học Vùng": "dh_hl", "Hải Lam - Hội đồng Đại học Vùng": "hd_hl", "HĐ ĐH Vùng Hải Lam.": "hd_hl", "ĐH Vùng Hải Lam": "dh_hl",
        "Phòng Đào luyện & Khảo thí": "phong", "Lnệh": "le", "Lệnh số": "le", "Bộ Hải đảo": "NONE", "Nhiều cơ quan": "NONE", "???": "NONE", "Đại học Vùng Mộc Diêm": "NONE",
    }
    assert dict(zip(want, ref.resolve(list(want)))) == want


def frames(spark, values):
    v = spark.createDataFrame([(i, "f", x, "k") for i, x in enumerate(values)], "rec_id long, field_name string, value string, code string")
    return v, spark.createDataFrame(ENTRIES, "code string, name string, short string")


def test_mapping(spark):
    v, ref = frames(spark, ["Bộ Học chính", "bo hoc chinh", None, "", "  ", "xyz", "bo hoc chinh", "dài " * 9000])
    got = sorted((r["rec_id"], r["ref_code"]) for r in C.map_values(v, ref).collect())
    assert got == [(1, "bo_hoc_chinh"), (5, "NONE"), (6, "bo_hoc_chinh"), (7, "NONE")]
    assert C.map_values(v.limit(0), ref).count() == 0
    assert {r["ref_code"] for r in C.map_values(v, ref.limit(0)).collect()} == {"NONE"}


TIED = [("a1", "Phòng Lưu trữ một", "PLT"), ("a2", "Phòng Lưu trữ hai", "PLT"), ("b1", "Ban Xây dựng", "BXD"), ("b2", "Ban Xay dung", "X2"), ("c1", "Kho Sách", "KS"), ("c2", "Kho Sạch đồ", "kho sach"), ("d1", "Tổ Nghiệm thu", "TNT"), ("d2", "Viện Hải", "TNT2")]


@pytest.mark.parametrize("shard", [8, 4, 2, 1])
def test_shards_decide_as_one_tree(spark, monkeypatch, shard):
    """Ties between entries of one shard and of two, codes, exact against near, blanks."""
    values = ["PLT", "phong luu tru mot", "Phòng Lưu trữ", "Phòng Lưu trữ mhi", "ban xay dung", "Ban Xây  dựngg", "KHO SÁCH", "kho sahc", "to nghiem thi", "TNT2", "tnt", "Bộ Học chính", "\t", " \u00a0", "\x1f", "", None, "vien hai", "Kho Sách", "ổ" * 70_000]
    both = spark.createDataFrame(TIED + ENTRIES + [(None, "Không mã", None), ("z", None, None)], "code string, name string, short string")
    v, _ = frames(spark, values)
    want = dict(zip(values, C.Reference(TIED + ENTRIES).resolve([x or "?" for x in values])))
    assert want["PLT"] == want["ban xay dung"] == want["Phòng Lưu trữ mhi"] == "NONE" and want["KHO SÁCH"] == "c1" and want["tnt"] == "d1"
    monkeypatch.setattr(C, "SHARD", {8: 100, 4: 7, 2: 6, 1: 2}[shard])
    got = {values[r["rec_id"]]: r["ref_code"] for r in C.map_values(v, both).collect()}
    skipped = {"\t", " \u00a0", "\x1f", "", None, "Bộ Học chính", "Kho Sách"}
    assert got == {x: c for x, c in want.items() if x not in skipped}
