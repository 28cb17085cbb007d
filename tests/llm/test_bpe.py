import base64
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmesh.llm.bpe import LONG, ByteBpe, encode_corpus
from quillmesh.llm.queries import BYTE_BPE_PATTERN, TOKENIZERS

FILE = Path(TOKENIZERS, "byte_bpe_50k.json")
pytestmark = pytest.mark.skipif(not FILE.exists(), reason="no tokenizer files")
ODD = ["", " ", "\n\n  x\t", "a" * 3000, "=-" * 900, " " * 5000 + "z", "<|endoftext|> I'll it's", "漢字🙂 Việt́ ﬁ", "\x00\x01", "x y z", "l’été 12345 ½", " a  b \n c", "kh\xadông ok"]


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe(FILE.read_bytes(), BYTE_BPE_PATTERN)


@pytest.fixture(scope="module")
def reference():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(str(FILE))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def ranks():
    import tiktoken

    lines = Path(TOKENIZERS, "byte_bpe_50k.tiktoken").read_bytes().splitlines()
    vocab = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=BYTE_BPE_PATTERN, mergeable_ranks=vocab, special_tokens={})


def test_odd(bpe, reference, ranks):
    assert bpe.encode(ODD) == reference(ODD)
    assert bpe.encode(ODD) == [ranks.encode_ordinary(t) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("  \n\teatnhiươ'"))), max_size=4))
def test_any_text(bpe, reference, texts):
    assert bpe.encode(texts) == reference(texts)


def test_heap_and_matrix_agree(bpe):
    for piece in ("ab" * 100, "xin" * 80, "q" * LONG):
        b = piece.encode()
        assert bpe._long(b) == bpe.encode([piece])[0]


def test_forgetting_changes_nothing(bpe, monkeypatch):
    want = bpe.encode(ODD)
    monkeypatch.setattr("quillmesh.llm.bpe.REMEMBER", 2)
    assert [bpe.encode([t])[0] for t in ODD] == want


def test_corpus(spark, reference):
    rows = [(1, "Điều 1. Xin chào", "x"), (2, None, "y"), (3, "", "z"), (1, "Điều 1. Xin chào", "x"), (None, "a b", "w"), (5, "dài " * 20000, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(((r["doc_id"], list(r["ids"])) for r in encode_corpus(df, str(FILE), BYTE_BPE_PATTERN, some=2).collect()), key=repr)
    assert got == sorted(((i, reference([t])[0] if t else []) for i, t, _ in rows), key=repr)
    assert encode_corpus(df.limit(0), str(FILE), BYTE_BPE_PATTERN).count() == 0
