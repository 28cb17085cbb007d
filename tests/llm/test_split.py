import json
import random
from unicodedata import normalize

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmesh.llm.split import _zones, heading_items, pieces, split_oversized, tidy, zone_items


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab cđ.,\ń", max_size=900), st.integers(20, 90), st.integers(0, 9))
def test_pieces_are_whole(text, limit, overlap):
    out = pieces(text, limit, overlap)
    assert all(len(p) <= limit for p in out)
    assert out[0] + "".join(p[overlap:] for p in out[1:]) == text
    assert all(b.startswith(a[len(a) - overlap :]) for a, b in zip(out, out[1:]))
    assert len(out) == 1 or len(text) > limit


def test_cuts_between_topics():
    rng = random.Random(1)
    a, b = ([" ".join(rng.choices(words, k=8)) + "." for _ in range(9)] for words in ("học bổng sinh viên điểm tín chỉ".split(), "kho hàng xe tải phòng máy lịch".split()))
    text = " ".join([*a, *b])
    edge = len(" ".join(a)) + 1
    assert len(pieces(text, edge + 120, 20)[0]) == edge


def test_prefers_sentence_ends():
    text = ("x" * 30 + ". ") * 40
    assert all(p.endswith(". ") for p in pieces(text, 200, 20)[:-1])
    with pytest.raises(ValueError):
        pieces("abc", 10, 5)


def test_zone_shapes():
    want = [("a", 1, 5)]
    for z in ({"a": [1, 5]}, {"a": {"start": 1, "end": 5}}, {"a": ["1", "5"]}, {"a": "1-5"}):
        assert _zones(json.dumps(z)) == want and _zones(json.dumps(json.dumps(z))) == want
    for none in (None, "", "{", "[]", "3", '{"a": null}', '{"a": [5, 1]}', '{"a": [5, 5]}', '{"a": "x-y"}', '{"a": [1]}', '{"a": [1, 2, 3]}', '{"a": [-3, 5]}'):
        assert _zones(none) == []


def test_items(spark):
    long = "câu một hai. " * 20
    arts = spark.createDataFrame([(1, 0, 2, "  " + long + "　", "k"), (1, 0, 3, "x" * 200 + " ", "k"), (1, 0, 4, normalize("NFD", "ố" * 150), "k"), (1, 0, 5, None, "k"), (1, 0, 6, "", "k")], "rec_id long, part_index int, seq int, heading string, text string")
    got = split_oversized(heading_items(arts, 200), 200, 20).collect()
    assert [(r["item_name"], r["n_chars"]) for r in got] == [("2", len(tidy(long)))]
    docs = spark.createDataFrame([(1, "é" + "a b. " * 1000, "q"), (2, None, "q"), (3, "short", "q")], "rec_id long, raw_txt string, zones string")
    parts = spark.createDataFrame([(1, 0, '{"than": [1, 99999], "ky": [0, 3001], "low": [0, 3000]}', "q"), (2, 0, '{"than": [0, 9000]}', "q"), (3, 0, None, "q"), (9, 0, '{"than": [0, 9000]}', "q")], "rec_id long, part_index int, zones string, raw_txt string")
    got = {r["item_name"]: r for r in split_oversized(zone_items(parts, docs, 3000), 3000, 200).collect()}
    assert set(got) == {"than"} and got["than"]["n_chars"] == 4999
    assert zone_items(parts.limit(0), docs, 3000).count() == 0 and split_oversized(heading_items(arts.limit(0), 200), 200, 20).count() == 0
