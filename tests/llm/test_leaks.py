import random

import numpy as np

from quillmesh.llm.leaks import APART, LEAST, Items, find_leaks, longest_passage, plain_words, repaired, smith_waterman

WORDS = [f"{a}{b}" for a in "bcdghklmnprstvx" for b in ("a", "anh", "oi", "uc", "em", "ong", "iet", "uan")]


def text(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def holds(doc, item):
    """Brute force: some stretch of LEAST words kept in order, at most one changed in any eight, its ends kept."""
    for d in range(len(doc) - LEAST + 1):
        for i in range(len(item) - LEAST + 1):
            same = [a == b for a, b in zip(doc[d : d + LEAST], item[i : i + LEAST])]
            if same[0] and same[-1] and all(same[k : k + APART].count(False) <= 1 for k in range(LEAST)):
                return True
    return False


def planted(rng, item, n, gap):
    at = rng.randrange(len(item) - n + 1)
    part = item[at : at + n]
    if gap:
        for k in range(rng.randrange(1, gap), n - 1, gap):
            part[k] = "khac"
    return part


def test_against_brute_force(spark):
    rng = random.Random(7)
    items = {i: text(rng, rng.choice([10, 30, 60])) for i in range(8)}
    docs = {}
    for d in range(90):
        words = text(rng, rng.randint(0, 40))
        item = items[rng.choice([i for i in items if len(items[i]) >= 30])]
        kind = d % 5
        if kind < 4:
            words += planted(rng, item, [20, 28, 19, 26][kind], [0, 8, 0, 6][kind])
        docs[d] = words + text(rng, rng.randint(0, 20))
    dress = lambda ws: " ".join(rng.choice([w, w.upper(), w + ",", f"<b>{w}</b>", w[:1] + "​" + w[1:]]) for w in ws).replace(" ", " \n", 2)
    rows = [(d, dress(w), "x") for d, w in docs.items()] + [(900, None, "x"), (901, "", "x")]
    df = spark.createDataFrame(rows + rows[:5], "doc_id long, text string, item_id string")
    held = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()] + [(50, None), (51, "")], "item_id long, text string")
    got = sorted(map(tuple, find_leaks(df, held, some=7).collect()))
    assert got == sorted((d, i) for d, w in docs.items() for i, x in items.items() if holds(w, x))
    assert find_leaks(df.limit(0), held).count() == 0 and find_leaks(df, held.limit(0)).count() == 0


def test_blocks_find_the_same(spark, monkeypatch):
    rng = random.Random(8)
    items = [(i, " ".join(text(rng, 40))) for i in range(6)]
    df = spark.createDataFrame([(i, "x y " + t) for i, t in items], "doc_id long, text string")
    held = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr("quillmesh.llm.leaks.BLOCK", 2)
    assert sorted(map(tuple, find_leaks(df, held).collect())) == [(i, i) for i in range(6)]


def test_passages():
    run = lambda s: longest_passage(np.array([c == "#" for c in s]))
    assert run("#" * 20) == 20 and run("." * 9) == 0 and run("###.###") == 7
    assert run("#######.#######.####") == 20 and run("####.####.####") == 9
    assert run("..####.########.##") == 16


def test_alignment():
    a = np.array([[1, 2, 3, 9, 4, 5]], np.int32)
    assert smith_waterman(a, np.array([[1, 2, 3, 4, 5]], np.int32)).tolist() == [4]
    assert smith_waterman(a, np.array([[7, 7, -2, -2]], np.int32)).tolist() == [0]


def test_reading():
    words = lambda t: plain_words(t, {})
    assert words("Điều&nbsp;5<br>kho<b>ản</b> khu­vực hà-\nnội") == ["dieu", "5", "khoan", "khuvuc", "hanoi"]
    assert repaired("Điều khoản".encode().decode("latin-1")) == "Điều khoản"
    assert Items([(1, "quá ngắn")]).ids == []


def test_boilerplate_is_found_in_every_document(spark, monkeypatch):
    """A passage that many items share and many documents hold: no seed of it is rare."""
    rng = random.Random(12)
    shared = text(rng, 30)
    items = {i: text(rng, 12) + shared + text(rng, 12) for i in range(6)}
    docs = {d: text(rng, 15) + (shared[d % 4 : d % 4 + 25] if d % 3 else shared[:15]) + text(rng, 9) for d in range(60)}
    docs |= {100 + i: x[:40] for i, x in items.items()}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    held = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")
    want = sorted((d, i) for d, w in docs.items() for i, x in items.items() if holds(w, x))
    assert len(want) > 200
    assert sorted(map(tuple, find_leaks(df, held).collect())) == want
    monkeypatch.setattr("quillmesh.llm.leaks.RARE", 1.0)
    assert sorted(map(tuple, find_leaks(df, held).collect())) == want


def test_garbled_runs_are_decoded_beside_other_letters():
    assert repaired("Ж " + "Điều kiện".encode().decode("latin-1") + " đúng") == "Ж Điều kiện đúng"
    assert repaired("Khoản é ÂÊ Ã") == "Khoản é ÂÊ Ã"
    assert repaired("“trích” " + "nhà".encode().decode("cp1252")) == "“trích” nhà"
