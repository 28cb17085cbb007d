import random

from quillmesh.llm.scans import Layout, Misread, alike, candidate, find_faults, fit, rough_breaks, rough_states, token, tokens_of

SUBJECTS = "phòng chức năng;hội đồng khoa;người học;ban quản lý;thư viện trung tâm".split(";")
VERBS = "phải nộp;được giao gia hạn;cần kiểm kê;nên công khai".split(";")
OBJECTS = "học bổng khuyến học;thẻ ra vào;danh mục tạp chí;chứng chỉ ngoại văn;hồ sơ tốt nghiệp".split(";")


def sentence(rng):
    return f"{rng.choice(SUBJECTS).capitalize()} {rng.choice(VERBS)} {rng.choice(OBJECTS)} và {rng.choice(OBJECTS)} trong vòng {rng.randint(3, 40)} giờ."


def scan(rng, n):
    """A text of three pages, and its faults."""
    lines, faults = ["BỘ HỌC CHÍNH", "Số: 12/QĐ-BHC", "QUYẾT ĐỊNH"], []
    for page in range(3):
        words = " ".join(sentence(rng) for _ in range(6)).split()
        at = 0
        while at < len(words):
            part = words[at : at + 12]
            at += 12
            lines.append(" ".join(part))
        k = len(lines) - 3
        last = lines[k].split()
        if len(last[-1]) > 3 and last[-1].isalpha():
            lines[k + 1] = last[-1][2:] + " " + lines[k + 1]
            lines[k] = " ".join([*last[:-1], last[-1][:2] + "-"])
            faults.append((k + 1, "broken_word"))
        j = len(lines) - 5
        right = rng.choice([w for w in lines[j].split() if w.isalpha() and any(c in w for c in "hmnct")])
        letter = rng.choice([c for c in right if c in "hmnct"])
        wrong = right.replace(letter, {"h": "li", "m": "rn", "n": "ri", "c": "e", "t": "f"}[letter], 1)
        lines[j] = lines[j].replace(right, wrong, 1)
        faults.append((j + 1, "misread"))
        lines.append("Tài liệu lưu hành nội bộ")
        faults.append((len(lines), "running_header"))
        lines.append(f"Trang {n + page}/9")
        faults.append((len(lines), "page_number"))
    return "\n".join(lines), set(faults)


def corpus():
    rng = random.Random(5)
    rows, want = [], {}
    for i in range(40):
        rows.append(("docs", i, "\n".join(" ".join(sentence(rng) for _ in range(4)) for _ in range(5)), "x"))
    for i in range(100, 140):
        text, faults = scan(rng, i)
        rows.append(("docs", i, text, "x"))
        want |= {(i, *f): 1 for f in faults}
    return rows, want


SCHEMA = "tbl string, row_id long, text string, kind string"


def test_faults(spark):
    rows, want = corpus()
    rows += [("docs", 900, None, "x"), ("docs", 901, "", "x"), ("docs", 902, "\n\n", "x"), rows[50]]
    got = [(r["row_id"], r["line_no"], r["kind"]) for r in find_faults(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got))
    assert len(set(got) & set(want)) >= 0.98 * len(want) and len(set(got) - set(want)) <= 0.02 * len(want)


def test_copies_of_a_scan_do_not_make_its_misreadings_a_form(spark):
    rows, _ = corpus()
    rows += [("docs", 50 + i, "Ban quản lý phải nộp danh mục nhạc cụ cho thư viện trung tâm. " * 5, "x") for i in range(5)]
    text = "BỘ HỌC CHÍNH\nBan quản lý phải kiểm kê danh mục tạp chí và hồ sơ\nNgười học nên công khai danh mục nliạc cụ\ntrong vòng 9 giờ."
    hot = range(1000, 1000 + len(rows) // 2)
    rows += [("docs", i, text, "x") for i in hot]
    got = {(r["row_id"], r["line_no"]) for r in find_faults(spark.createDataFrame(rows, SCHEMA)).collect() if r["kind"] == "misread"}
    assert {(i, 3) for i in hot} <= got


def test_repair(spark):
    rows, _ = corpus()
    out = {r["row_id"]: r["text"] for r in find_faults(spark.createDataFrame(rows, SCHEMA), text_too=True).collect()}
    for i, text in out.items():
        if i >= 100:
            assert "Trang" not in text and "nội bộ" not in text and "-\n" not in text


def test_corner_cases(spark):
    assert find_faults(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "một câu rất dài " * 20000
    assert find_faults(spark.createDataFrame([("docs", 1, long, ""), ("article_evidence", 1, "835/QĐ-\nBLY có hiệu lực", "")], SCHEMA)).count() == 0
    assert [candidate(s) for s in ("", "----- [Trang 3] -----", "Trang 1/2", "— 13940 —", "13940 | Trang", "Điều 3. X", "và các đơn vị", "Sổ tay quy chế")] == ["", "m", "p", "p", "p", "b", "b", "h"]
    assert alike("liọc") == alike("học") and alike("trầrn") == alike("trầm") and alike("kh0a") == alike("khóa") and alike("nô.i") == alike("nội")
    assert token("(học),") == "học" and token("12/QĐ-A") == "" and token("2024") == ""


def test_no_line_or_word_is_too_long():
    ornament = "—" * 60
    assert candidate(f"{ornament} 7 {ornament}") == "p" and candidate("TÀI LIỆU " * 30 + "LƯU") == "h"
    assert tokens_of("và/hoặc,") == ("và", "hoặc") and tokens_of("12/QĐ-A") == () and tokens_of("http://a/b") == ()
    assert tokens_of("x" * 50) == ("x" * 50,)
    misread = Misread({"hoặe": "hoặc", "n" * 40: "m" * 40})
    assert misread.fixed("(và/hoặe),") == "(và/hoặc)," and misread.fixed("Hoặe.") == "Hoặc." and misread.fixed("HOẶE") == "HOẶC" and misread.fixed("n" * 40) == "m" * 40


def test_breaks_and_cuts_are_labelled():
    rng = random.Random(11)
    texts, want = [], []
    for _ in range(60):
        lines, ends = [], set()
        for _ in range(4):
            words = " ".join(sentence(rng) for _ in range(4)).split()
            for at in range(0, len(words), 12):
                lines.append(" ".join(words[at : at + 12]))
            ends.add(len(lines) - 1)
        texts.append("\n".join(lines))
        want.append(ends)
    model = fit(texts)
    got = [model.breaks(x := Layout(t), model.decode(x)) for t in texts]
    hits, every, right = sum(len(a & b) for a, b in zip(got, want)), sum(map(len, got)), sum(map(len, want))
    assert hits >= 0.8 * right and hits >= 0.8 * every
    cut = Layout("Người học phải nộp học bổng khuyến học và danh mục tạp ch-\ní trong vòng 5 giờ.")
    assert rough_states(cut)[0] == "C" and 0 not in rough_breaks(cut, rough_states(cut))


def test_blocks_of_words_change_nothing(spark, monkeypatch):
    rows, _ = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    whole = {tuple(r) for r in find_faults(df).collect()}, {tuple(r) for r in find_faults(df, text_too=True).collect()}
    monkeypatch.setattr("quillmesh.llm.scans.BLOCK", 5)
    assert ({tuple(r) for r in find_faults(df).collect()}, {tuple(r) for r in find_faults(df, text_too=True).collect()}) == whole


def test_without_digital_files_nothing_is_called_misread(spark):
    rows = [r for r in corpus()[0] if r[1] >= 100]
    assert {r["kind"] for r in find_faults(spark.createDataFrame(rows, SCHEMA)).collect()} == {"running_header", "page_number", "broken_word"}
