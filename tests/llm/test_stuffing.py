import random

import numpy as np

from quillmesh.llm.stuffing import LINK, Batch, Words, find_stuffed, pair_keys

NOUNS = "phòng chức năng;hội đồng khoa;người học;ban quản lý;thư viện trung tâm;cố vấn lớp;đơn vị đào luyện;tổ bảo vệ;nhóm nghiên cứu;trạm y tế".split(";")
VERBS = "phải nộp;được giao gia hạn;cần kiểm kê;nên công khai;chịu trách nhiệm rà soát;có thể bổ sung;không được cấp lại".split(";")
OBJECTS = "học bổng khuyến học;thẻ ra vào;danh mục tạp chí;chứng chỉ ngoại văn;hồ sơ tốt nghiệp;biên bản họp lớp;lịch trực phòng máy;quỹ hỗ trợ khởi nghiệp".split(";")
SPAM = "gia sư tại nhà;thuê nhà trọ;biểu mẫu word;tuyển sinh gấp;luận văn giá rẻ".split(";")


def plain(rng, n=12):
    return " ".join(f"{rng.choice(NOUNS).capitalize()} {rng.choice(VERBS)} {rng.choice(OBJECTS)} trong vòng {rng.randint(2, 50)} giờ." for _ in range(n))


def made():
    rng = random.Random(9)
    docs = {i: plain(rng, rng.randint(5, 20)) for i in range(300)}
    few = lambda: rng.sample(SPAM, 2)
    bad = {
        1000: "Từ khóa: " + "; ".join(rng.choice(few()) for _ in range(60)),
        1001: " ".join(f"#{rng.choice(SPAM).replace(' ', '_')}" for _ in range(60)),
        1002: "\n".join(f"https://a{k}.test/x/{k} - {rng.choice(OBJECTS)}" for k in range(20)),
        1003: "".join(f'<li><a href="http://b.test/{k}">{rng.choice(SPAM)}</a></li>' for k in range(30)),
        1004: "\n".join(f"» {rng.choice(SPAM)} › {rng.choice(OBJECTS)} › {rng.choice(OBJECTS)} ({k})" for k in range(20)),
        1005: "\n".join(f"{rng.choice(OBJECTS)} uy tín | Giá: {k}00.000đ | Còn hàng" for k in range(1, 20)),
        1006: " | ".join(rng.choice(SPAM[:2]) for _ in range(70)),
        1008: " ".join(f"{SPAM[0].capitalize()}: {rng.choice(NOUNS)} {rng.choice(VERBS)} {SPAM[0]}, {SPAM[3]}, {SPAM[0]} {rng.choice(['uy tín', 'số 1', 'full'])}." for _ in range(14)),
        1009: " ".join(f"{SPAM[4].capitalize()} {rng.choice(['cho', 'từ', 'với'])} {rng.choice(OBJECTS)}, {SPAM[4]} {rng.choice(['mới', 'hot'])}, {SPAM[1]} {SPAM[4]}." for _ in range(14)),
        1007: plain(rng, 1) + "\n" + "\n".join(f"[{rng.choice(SPAM)}](http://c.test/{k})" for k in range(20)),
    }
    good = {
        2000: "MỤC LỤC\n" + "\n".join(f"Điều {k}. {rng.choice(OBJECTS)} ........ {k}" for k in range(1, 25)),
        2001: plain(rng, 10) + "\nTài liệu tham khảo\n" + "\n".join(f"- https://d.test/{k}" for k in range(3)),
        2002: " ".join(f"{s.rstrip('.')} theo quy định về thẻ ra vào." for s in plain(rng, 14).split(". ")),
        2003: "0123456789" * 50,
        2004: "a" * 500,
        2005: "=-" * 300,
        2006: plain(rng, 10) + " Cụm từ “thuê nhà trọ” hay được tìm.",
        2007: "",
        2008: None,
        2009: "   \n ",
    }
    return docs | bad | good, set(bad)


def test_pages(spark):
    docs, bad = made()
    rows = [(i, t, "x") for i, t in docs.items()]
    got = [r["doc_id"] for r in find_stuffed(spark.createDataFrame(rows + rows[300:305], "doc_id long, text string, chunk string")).collect()]
    assert len(got) == len(set(got)) and set(got) == bad


def test_chunks_change_nothing(spark, monkeypatch):
    docs, bad = made()
    monkeypatch.setattr("quillmesh.llm.stuffing.BATCH", 40)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    assert {r["doc_id"] for r in find_stuffed(df).collect()} == bad


def test_a_third_of_the_rows_is_spam_of_one_source(spark):
    docs, bad = made()
    rng = random.Random(4)
    hot = {5000 + i: "Từ khóa: " + "; ".join(rng.choice(SPAM[:2]) for _ in range(60)) for i in range(160)}
    df = spark.createDataFrame(list((docs | hot).items()), "doc_id long, text string")
    assert {r["doc_id"] for r in find_stuffed(df).collect()} == bad | set(hot)


def test_empty(spark):
    assert find_stuffed(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert find_stuffed(spark.createDataFrame([(1, "x " * 200000)], "doc_id long, text string")).count() <= 1


def test_batches_come_back_as_they_were():
    docs, _ = made()
    batch = Batch.of(list(docs.values()), Words())
    back = Batch.unpacked(batch.packed())
    for f in Batch.FIELDS:
        assert np.array_equal(getattr(batch, f), getattr(back, f)), f
    assert len(Batch.unpacked(Batch.of([None, ""], Words()).packed()).word) == 0


def test_counts_and_pairs():
    batch = Batch.of(["Ban thi đua #thi ban thi. Thi đua", "ban thi"], Words())
    key, n, words, again = batch.counts()
    assert words.sum() == len(batch.word) == 10 and n.sum() == 2 * len(batch.word) - 2 and again.sum() == 0
    assert len(np.unique(key)) == len(key) and dict(zip(key.tolist(), n.tolist()))[LINK] == 1


def test_word_salad_is_below_chance():
    """Frequent words whose neighbours hardly ever meet otherwise."""
    rng = random.Random(3)
    words = [f"tu{chr(97 + k)}x" for k in range(26)]
    salad = " ".join(rng.choice(words) for _ in range(40)) + "."
    batch = Batch.of([salad], Words())
    key = np.unique(batch.counts()[0])
    n = np.where(np.isin(key, batch.vocab), 1000.0, 1.0)
    again = np.zeros(len(key), np.int64)
    assert batch.stuffed(key, n, again, 100_000.0, 100_000.0).tolist() == [True]
    assert batch.stuffed(key, np.full(len(key), 1000.0), again, 100_000.0, 100_000.0).tolist() == [False]
    assert pair_keys(np.array([1]), np.array([2])) != pair_keys(np.array([2]), np.array([1]))
