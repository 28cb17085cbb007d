import json

import pytest

from quillmesh.sources import records as R


def record(number, **more):
    doc = {"documentNumber": number, "title": "T", "documentType": "Quyết định", "status": "CON_HIEU_LUC", "issueDate": "05/03/2020", "topics": ["A", "A"], "targetGroups": ["G"]} | more.pop("document", {})
    return {"document": doc, "organization": {"name": "Bộ Học chính", "orgType": "bo"}, "signers": [{"fullName": "Lý Văn", "position": ["X"]}], "citations": [], "articles": []} | more


@pytest.fixture()
def folder(tmp_path):
    out = tmp_path / "in"
    (out / "_skip").mkdir(parents=True)
    put = lambda name, x: (out / name).write_text(x if isinstance(x, str) else json.dumps(x, ensure_ascii=False))
    cite = {"targetDocumentNumber": "Số: 7/QĐ-B", "relationType": "REPLACES", "context": "c"}
    put("a.json", record("1/QĐ-A", citations=[cite, cite | {"context": "d"}], mentions=["Bộ X"], normativeContents=[{"contentType": "Quy chế", "title": "N", "articles": [{"number": "Điều 1", "text": "t"}]}]))
    put("b.json", record("02/QĐ-A", organization={"name": "Bộ Học Chính", "parentOrg": "Hội đồng"}, signers=[{"fullName": "Lý Văn", "academicTitle": "TS", "position": ["Y", "X"]}]))
    put("_skip/c.json", record("3/QĐ-A"))
    return out, put


def test_tables(spark, folder, tmp_path):
    records = R.read_records(spark, str(folder[0]))
    assert {r["doc_key"] for r in records.collect()} == {"1/QĐ-A", "2/QĐ-A"}
    assert all(not r["errors"] for r in R.validate(records).collect())
    t = R.graph_tables(records)
    assert {(r["doc_key"], r["is_stub"]) for r in t["document"].collect()} == {("1/QĐ-A", 0), ("2/QĐ-A", 0), ("7/QĐ-B", 1)}
    assert [(r["src"], r["dst"], r["context"]) for r in t["edge"].collect()] == [("1/QĐ-A", "7/QĐ-B", "d")]
    org = {r["org_id"]: (r["name"], r["org_type"], r["parent"]) for r in t["org"].collect()}
    assert org == {"bo_hoc_chinh": ("Bộ Học chính", "bo", "Hội đồng"), "hoi_dong": ("Hội đồng", None, None)}
    assert [(r["full_name"], r["academic_title"], r["positions"]) for r in t["person"].collect()] == [("Lý Văn", "TS", ["X", "Y"])]
    assert t["content"].first()["content_id"] == "1/QĐ-A#nd1" and t["content"].first()["status"] == "CON_HIEU_LUC"
    assert t["article"].first()["article_id"] == "1/QĐ-A#nd1#Điều 1"
    R.write_graph(t, str(tmp_path / "g"))
    R.write_graph(t, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g/edge")).where("rel = 'REPLACES'").count() == 1


def test_unsound(spark, folder):
    out, put = folder
    put("x.json", "{ broken")
    put("y.json", record("9/QĐ-A", document={"status": "?", "issueDate": "40/40/2020"}, citations=[{"targetDocumentNumber": "9/QĐ-A", "relationType": "EATS"}], articles=[{"number": "1"}, {"number": "1"}]))
    put("z.json", record("1/QĐ-A"))
    records = R.read_records(spark, str(out))
    errors = {r["file"][-6:]: set(r["errors"]) for r in R.validate(records).collect()}
    assert errors["y.json"] == {"unknown_status", "unknown_relation", "cites_itself", "repeated_article", "bad_date"}
    assert "unreadable" in errors["x.json"]
    assert [[f[-6:] for f in r["files"]] for r in R.collisions(records).collect()] == [["a.json", "z.json"]]
    with pytest.raises(ValueError):
        R.graph_tables(records)


def test_files(spark, tmp_path):
    (tmp_path / "q.csv").write_text('id,nhom,cau_hoi,tu_khoa,cypher_tham_so,loai_truy_van,nguon_dap_an,DAP_AN\n1,n,"a, b",k,{},t,s,x; y;\n')
    assert R.read_questions(spark, str(tmp_path / "q.csv")).first()["answers"] == ["x", "y"]
    (tmp_path / "m.csv").write_text("id,linh_vuc,ten_van_ban,so_hieu,ngay_ban_hanh,ngay_hieu_luc,co_quan_ban_hanh,loai,tinh_trang,pdf_url\n7,a,b,c,d,e,f,g,h,i\nx,,,,,,,,,\n7,a2,b,c,d,e,f,g,h,i\n")
    assert [(r["id"], r["linh_vuc"]) for r in R.read_crawl(spark, str(tmp_path / "m.csv")).collect()] == [("0007", "a2")]
    (tmp_path / "t/law").mkdir(parents=True)
    (tmp_path / "t/law/d1.txt").write_text("x\ny")
    assert tuple(R.read_texts(spark, str(tmp_path / "t")).select("topic", "stem", "text").first()) == ("law", "d1", "x\ny")
    old, new = (spark.createDataFrame(x, "k int, v string") for x in ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")]))
    assert sorted(map(tuple, R.upsert(old, new, "k").collect())) == [(1, "a"), (2, "c"), (3, "d")]
