from quillmesh.operators.segments import APPENDIX, CONTENT, MAIN, Marks, _merged, segment, segments, zone_at

FILL = "Đơn vị lập hồ sơ và gửi về kho lưu trữ trong tuần. " * 12


def article(n, extra=""):
    return f"Điều {n}. Việc thứ {n}\n{FILL}{extra}\n"


HEAD = "VIỆN UVW\nSố: 71/QĐ-UVW\nQUYẾT ĐỊNH\nCăn cứ Luật Kho;\nCăn cứ Thông tư số 9/2001/TT-PQ;\n"
SIGN = "Nơi nhận:\n- Như trên\n"
CONTENT_HEAD = "----- [Trang 3] -----\nVIỆN UVW\nQUY CHẾ\nvề kho\n(Kèm theo Quyết định số 71/QĐ-UVW ngày 1/2/2003)\n"
MAIN_TEXT = HEAD + article(1) + article(2) + article(3, "Bản này thay thế bản 5/QĐ-UVW.") + SIGN


def cutout(text, part):
    return text[part.start : part.end]


def test_three_parts():
    text = MAIN_TEXT + CONTENT_HEAD + "".join(map(article, (1, 2, 3, 4, 5))) + "PHỤ LỤC\n" + article(1) + article(2) + FILL * 6 + "DANH MỤC\n" + FILL
    parts = segment(text, "Quyết định")
    assert [p.kind for p in parts] == [MAIN, CONTENT, APPENDIX] and parts[1].marker == "attached at page" and cutout(text, parts[1]).startswith("----- [Trang 3]")
    assert "".join(cutout(text, p) for p in parts) == text and cutout(text, parts[2]).startswith("PHỤ LỤC")
    assert [a[1] for a in parts[1].articles] == [1, 2, 3, 4, 5] and [a[6] for a in parts[0].articles] == [0, 0, 1]
    main = parts[0]
    assert list(main.zones) == ["header", "basis", "body", "sign"] and text[slice(*main.zones["basis"])].startswith("Căn cứ Luật") and text[slice(*main.zones["sign"])].startswith("Nơi nhận")
    assert "basis" not in parts[1].zones
    assert zone_at(parts, main.zones["basis"][0] + 3) == (0, "basis", None) and zone_at(parts, parts[1].articles[2][4]) == (1, "body", 2) and zone_at(parts, len(text)) is None


def test_a_law_attaches_nothing_and_only_one_content_stands():
    text = MAIN_TEXT + CONTENT_HEAD + "".join(map(article, (1, 2, 3, 4, 5))) + "QUY TRÌNH\n" + "".join(map(article, (1, 2, 3, 4, 5)))
    assert [p.kind for p in segment(text, "Quyết định")] == [MAIN, CONTENT, APPENDIX]
    assert [p.kind for p in segment(text, "Luật")] == [MAIN, APPENDIX] and [p.kind for p in segment(text, None)][1] == CONTENT


def test_what_is_no_boundary():
    inside = HEAD + article(1, "ban hành quy chế kèm theo Quyết định số 5/QĐ-UVW ngày 2/3/2004") + "".join(map(article, (2, 3)))
    assert len(segment(inside)) == 1
    scanned = HEAD + "".join(map(article, (1, 2, 3, 1, 4, 5)))
    assert not Marks(scanned).boundaries() and len(segment(scanned)) == 1
    assert len(segment("QUY CHẾ\nvề kho\n" + "".join(map(article, (1, 2, 3))))) == 1


def test_signs_of_one_boundary():
    got = _merged([(100, CONTENT, "QUY CHE", "title"), (900, CONTENT, "", "attached"), (2700, CONTENT, "", "articles restart"), (5300, APPENDIX, "PHU LUC", "title")])
    assert got == [(100, CONTENT, "QUY CHE", "attached"), (2700, CONTENT, "", "articles restart"), (5300, APPENDIX, "PHU LUC", "title")]


def test_table(spark):
    rows = [(1, MAIN_TEXT, "Quyết định", "x"), (2, None, None, "x"), (3, "", None, "x")]
    got = segments(spark.createDataFrame(rows, "rec_id long, raw_txt string, doc_type string, kind string")).collect()
    assert [(r["rec_id"], r["part_index"], len(r["articles"])) for r in got] == [(1, 0, 3), (3, 0, 0)]
