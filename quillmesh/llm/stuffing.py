"""Keyword-stuffed pages and link lists.

A text is read as words and marks of layout: a link or tag, a price, a separator of menus and
tables. From counts over the whole corpus comes the pointwise mutual information (PMI) of
neighbouring words, and that of a pair of neighbours with a document: how many times more often the
document has the pair than the rest of the corpus would lead one to expect. The rest leaves out the
documents that repeat the pair themselves, so that a large group of spam does not make its own
keywords look usual. A pair that a document repeats excessively is a stuffed collocation; what
stands beside a mark of layout counts by the mark, so lists of links, offers and menus are
collocations too. A unit of text (a line, or a sentence of a long line) is no sentence when such
collocations cover enough of it, or when the mean PMI of its neighbours is below chance (word
salad). A page is stuffed when such units hold most of its characters.

Texts are read once: each batch is written as word numbers beside its own counts. The counts are
summed over the corpus by pair and sent back only to the batches that have the pair; so neither a
pair's occurrences nor a document's are ever gathered, and no corpus-wide table is broadcast.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.fold import fold_words
from quillmesh.llm.leaks import repaired
from quillmesh.runtime import cut, spread

#: Documents and characters of a batch; a longer text is a batch of its own.
BATCH, CHARS = 2_000, 4_000_000
#: A pair is repeated excessively when a document has it so often, as such a share of its pairs, and so many times more than in the documents that do not repeat it so.
OFTEN, SHARE, EXCESS = 3, 0.025, 15.0
#: Share of a unit that stuffed collocations must cover: where one of them comes twice in it, where it has marks of layout, else.
TWICE, MARKED, ELSE = 0.3, 0.4, 0.6
#: Share of such units in a page.
MOSTLY = 0.5
#: Pairs from which on a unit can be judged as word salad, and the mean PMI under which it is.
SALAD_PAIRS, SALAD_PMI = 8, 0.0

_LINK = re.compile(
    r"\[[^\[\]\n]*\]\([^()\s]*\)|<a\b[^<>]*>[^<>]*</a>|<[^<>]*>|(?:https?://|www\.)\S+|(?<![\w@])[\w-]+(?:\.[\w-]+)+/\S*|(?<!\w)#\w+", re.I
)
_PRICE = re.compile(r"\d[\d.,]*\s?(?:đ|₫|vnđ|vnd|usd|€|\$|k)(?!\w)|[$€]\s?\d", re.I)
_BAR = re.compile(r"[»›>→▸•·|¦]")
_ANY_MARK = re.compile(r"[/#<\[»›>→▸•·|¦₫€$]|\d\s?(?:đ|k|vn|usd)", re.I)
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_LONG = 240
#: Keys of the marks, of a unit's begin before a mark, and of any word beside a mark.
LINK, PRICE, BAR, BEGIN, WORD = -5, -4, -3, -2, -1
_MARKS = {"\x01": LINK, "\x02": PRICE, "\x03": BAR}
_NO_MARKS = {ord(c): " " for c in _MARKS}


def units(text: str) -> list[str]:
    """Lines, long ones cut at sentence ends."""
    out = []
    for line in text.splitlines():
        line = line.strip()
        if len(line) > _LONG:
            out += _SENTENCE.split(line)
        elif line:
            out.append(line)
    return out


def _hash(word: str) -> int:
    key = int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)
    return key if key < LINK or key > WORD else 1


def pair_keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One key of two word keys, in their order."""
    with np.errstate(over="ignore"):
        return (left * np.int64(-7046029254386353131)) ^ (right * np.int64(-4417276706812531889) + np.int64(1442695040888963407))


class _Chunks(dict):
    """The number of each chunk of text between blanks; a new one is taken apart once."""

    def __init__(self, words: Words):
        self.words = words

    def __missing__(self, chunk: str) -> int:
        w = self.words
        self[chunk] = k = len(w.first)
        w.first.append(len(w.flat))
        w.flat.extend(w.number[x] if x in w.number else w.new(x) for x in fold_words(chunk) if len(x) > 1 and not x.isdigit())
        w.count.append(len(w.flat) - w.first[k])
        return k


class Words:
    """Words and marks by number, with their keys and lengths, and the chunks of text they stand in."""

    def __init__(self):
        self.begin()

    def begin(self) -> None:
        self.number: dict[str, int] = {}
        self.keys, self.size = array("q", range(LINK, WORD + 1)), array("i", [1, 6, 1, 0, 0])
        self.first, self.count, self.flat = array("i"), array("i"), array("i")
        self.chunks = _Chunks(self)
        for k, mark in enumerate([*_MARKS, "\x04"]):
            self.chunks[mark] = k
            self.first.append(k)
            self.count.append(1)
            self.flat.append(k)

    def new(self, word: str) -> int:
        self.number[word] = k = len(self.keys)
        self.keys.append(_hash(word))
        self.size.append(len(word))
        return k

    def marked(self, unit: str, ids: array, links: list[tuple[int, int]]) -> None:
        """The chunks of a unit with marks to ``ids``, the lengths of its links to ``links``; a mark at its begin has the begin before it."""
        lens: list[int] = []

        def link(m: re.Match) -> str:
            lens.append(len(m[0]))
            return " \x01 "

        text = _BAR.sub(" \x03 ", _PRICE.sub(" \x02 ", _LINK.sub(link, unit.translate(_NO_MARKS))))
        got = [self.chunks[c] for c in text.split()]
        first = next((k for k in got if self.count[k]), None)
        if first is not None and first < BEGIN - LINK:
            ids.append(BEGIN - LINK)
        at = len(ids)
        ids.extend(got)
        links += zip((at + k for k, c in enumerate(got) if c == 0), lens)


class Batch:
    """Texts as numbers of the distinct words they have, with the lengths of words, units and documents."""

    FIELDS = ("vocab", "word", "lens", "unit", "doc", "chars")

    def __init__(self, texts: int, **arrays: np.ndarray):
        self.texts = texts
        self.__dict__.update(arrays)

    @staticmethod
    def of(texts: list[str | None], words: Words) -> Batch:
        if len(words.first) > 500_000:
            words.begin()
        get = words.chunks.__getitem__
        ids, links = array("i"), []
        n_chunks, doc, chars = array("i"), array("i"), array("i")
        for d, text in enumerate(texts):
            for u in units(repaired(text)) if text else ():
                before = len(ids)
                if _ANY_MARK.search(u):
                    words.marked(u, ids, links)
                else:
                    ids.extend(map(get, u.split()))
                n_chunks.append(len(ids) - before)
                doc.append(d)
                chars.append(len(u))
        ids = np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32)
        count, first = np.array(words.count)[ids].astype(np.int64), np.array(words.first)[ids]
        begins = np.cumsum(count) - count
        word = np.array(words.flat)[np.arange(count.sum()) + np.repeat(first - begins, count)]
        lens = np.array(words.size)[word].astype(np.int64)
        if links:
            at, n = np.array(links).T
            lens[begins[at]] = n
        unit = np.repeat(np.repeat(np.arange(len(doc)), np.array(n_chunks, np.int64)), count)
        used = np.nonzero(np.bincount(word, minlength=1))[0] if len(word) else np.zeros(0, np.int64)
        local = np.zeros(int(used[-1]) + 1 if len(used) else 1, np.int64)
        local[used] = np.arange(len(used))
        vocab = np.array(words.keys, np.int64)[used]
        return Batch(len(texts), vocab=vocab, word=local[word], lens=lens, unit=unit, doc=np.array(doc, np.int64), chars=np.array(chars, np.int64))

    def packed(self) -> bytes:
        """The batch in few bytes."""
        n = np.bincount(self.unit, minlength=len(self.doc))
        small = (x.astype(np.int32).tobytes() for x in (self.word, self.lens, n, self.doc, self.chars))
        raw = b"".join([np.array([self.texts, len(self.vocab), len(self.word), len(n)], np.int64).tobytes(), self.vocab.tobytes(), *small])
        return len(raw).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)

    @staticmethod
    def unpacked(blob: bytes) -> Batch:
        raw = pa.Codec("zstd").decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
        texts, a, b, c = np.frombuffer(raw, np.int64, 4).tolist()
        vocab = np.frombuffer(raw, np.int64, a, 32)
        word, lens, n, doc, chars = (x.astype(np.int64) for x in np.split(np.frombuffer(raw, np.int32, -1, 32 + 8 * a), np.cumsum([b, b, c, c])))
        return Batch(texts, vocab=vocab, word=word, lens=lens, unit=np.repeat(np.arange(c), n), doc=doc, chars=chars)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """(positions of the left of neighbours in one unit, numbers of pair and document together); a word beside a mark is any word."""
        at = np.nonzero(self.unit[:-1] == self.unit[1:])[0] if len(self.word) > 1 else np.zeros(0, np.int64)
        a, b = self.word[at], self.word[at + 1]
        mark = (self.vocab >= LINK) & (self.vocab < WORD)
        if mark.any():
            ma, mb = mark[a], mark[b]
            a, b = np.where(mb & ~ma, len(self.vocab), a), np.where(ma & ~mb, len(self.vocab), b)
        return at, (a * (len(self.vocab) + 1) + b) * self.texts + self.doc[self.unit[at]]

    def _grouped(self, ordered: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of sorted numbers of pair and document: (begins, counts, words of the document, whether it repeats the pair, begins of the pairs among these, pairs)."""
        begins = np.nonzero(np.diff(ordered, prepend=-1))[0]
        mine = np.diff(begins, append=len(ordered))
        pair, of = ordered[begins] // max(self.texts, 1), ordered[begins] % max(self.texts, 1)
        size = np.bincount(self.doc[self.unit], minlength=self.texts)[of]
        first = np.nonzero(np.diff(pair, prepend=-1))[0]
        return begins, mine, size, (mine >= OFTEN) & (mine >= SHARE * size), first, pair[first]

    def _keys_of(self, pair: np.ndarray) -> np.ndarray:
        keys = np.append(self.vocab, WORD)
        return pair_keys(keys[pair // len(keys)], keys[pair % len(keys)])

    def counts(self) -> tuple[np.ndarray, ...]:
        """(key, n, words, again) of the distinct words and pairs."""
        n1 = np.bincount(self.word, minlength=len(self.vocab)).astype(np.int64)
        ordered = np.sort(self._pairs()[1])
        if not len(ordered):
            return self.vocab, n1, n1, np.zeros(len(n1), np.int64)
        _, mine, _, repeats, first, pair = self._grouped(ordered)
        n2, again = np.add.reduceat(mine, first), np.add.reduceat(mine * repeats, first)
        none = lambda x: np.zeros(len(x), np.int64)
        return np.concatenate([self.vocab, self._keys_of(pair)]), np.concatenate([n1, n2]), np.concatenate([n1, none(n2)]), np.concatenate([none(n1), again])

    def stuffed(self, key: np.ndarray, count: np.ndarray, again: np.ndarray, total: float, rest: float) -> np.ndarray:
        """Which of the texts are stuffed, given the corpus counts of all their words and pairs (sorted by key).

        ``again`` has the part of each count that is in documents repeating the pair; ``total`` are
        the words of the corpus, ``rest`` those without all such parts.
        """
        n_units = len(self.doc)
        at, number = self._pairs()
        excess, pmi = np.zeros(len(at), bool), np.zeros(len(at))
        word = (self.vocab < LINK) | (self.vocab > WORD)
        if len(at):
            order = np.argsort(number)
            _, mine, size, repeats, first, pair = self._grouped(number[order])
            where = np.searchsorted(key, self._keys_of(pair))
            pair_n, seldom = count[where], np.maximum(count[where] - again[where], 1)
            of = np.append(count[np.searchsorted(key, self.vocab)], 1.0)
            a, b = pair // (len(self.vocab) + 1), pair % (len(self.vocab) + 1)
            groups = np.diff(first, append=len(mine))
            # the pair's count in its document against what the rest of the corpus has of it
            excess[order] = np.repeat(repeats & (mine * rest >= EXCESS * size * np.repeat(seldom, groups)), mine)
            pmi[order] = np.repeat(np.repeat(np.log(pair_n * total / (of[a] * of[b])), groups), mine)
        per_unit = lambda w: np.bincount(self.unit[at], weights=w, minlength=n_units) if len(at) else np.zeros(n_units)
        by_unit = lambda w: np.bincount(self.unit, weights=w, minlength=n_units) if len(self.unit) else np.zeros(n_units)
        plain = word[self.word[at]] & word[self.word[at + 1]] if len(at) else excess
        per = per_unit(plain)
        salad = (per >= SALAD_PAIRS) & (per_unit(pmi * plain) / np.maximum(per, 1) < SALAD_PMI)
        covered = np.zeros(len(self.word), bool)
        covered[at[excess]] = True
        covered[at[excess] + 1] = True
        share = by_unit(self.lens * covered) / np.maximum(by_unit(self.lens), 1)
        inside, times = np.unique(np.stack([self.unit[at[excess]], number[excess]]), axis=1, return_counts=True)
        twice = np.zeros(n_units, bool)
        twice[inside[0][times >= 2]] = True
        marked = by_unit(~word[self.word]) > 0
        bad = salad | (twice & (share >= TWICE)) | (marked & (share >= MARKED)) | (share >= ELSE)
        whole = np.bincount(self.doc, weights=self.chars, minlength=self.texts)
        part = np.bincount(self.doc, weights=self.chars * bad, minlength=self.texts)
        return (part > MOSTLY * whole) & (whole > 0)


_ROW = pa.schema([("batch", pa.int64()), ("key", pa.int64()), ("n", pa.int64()), ("words", pa.int64()), ("again", pa.int64()), ("ids", pa.binary()), ("packed", pa.binary())])


def _batches(batches: Iterator[pa.RecordBatch], rows: int, most: int) -> Iterator[tuple[list[int], list[str]]]:
    """(ids, texts) of up to so many rows and ``most`` characters."""
    ids, texts, chars = [], [], 0
    for b in batches:
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ids and (len(ids) >= rows or chars + len(text) > most):
                yield ids, texts
                ids, texts, chars = [], [], 0
            ids.append(i)
            texts.append(text)
            chars += len(text)
    if ids:
        yield ids, texts


def find_stuffed(docs: DataFrame) -> DataFrame:
    """(doc_id) of the stuffed documents of (doc_id, text).

    Null, empty and wordless texts are not stuffed; repeated rows give one id. One pass over the
    texts without a shuffle, the sums of its counts by word and pair, and the judgement of each
    batch beside the sums it needs.
    """
    words = Words()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 32
        for k, (ids, texts) in enumerate(_batches(batches, BATCH, CHARS)):
            batch = Batch.of(texts, words)
            key, n, single, again = batch.counts()
            no, none = first + k, [None]
            yield pa.record_batch([[no], *(pa.array(none, pa.int64()) for _ in range(4)), [np.array(ids, np.int64).tobytes()], [batch.packed()]], schema=_ROW)
            for lo in range(0, len(key), 100_000):
                part = slice(lo, lo + 100_000)
                m = len(key[part])
                yield pa.record_batch([np.full(m, no), key[part], n[part], single[part], again[part], pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())], schema=_ROW)

    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = cut(spread(rows).mapInArrow(read, "batch bigint, key bigint, n bigint, words bigint, again bigint, ids binary, packed binary"))
    counts, packed = made.where("key is not null"), made.where("key is null").select(F.col("batch").alias("no"), "ids", "packed")
    total, repeated = (float(x or 0) for x in counts.agg(F.sum("words"), F.sum("again")).first())
    sums = counts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("again").alias("again"))
    wanted = counts.select("batch", "key").join(sums, "key")

    def judge(texts: pa.Table, known: pa.Table) -> pa.Table:
        found: list[np.ndarray] = [np.zeros(0, np.int64)]
        key, n, again = (known.column(c).to_numpy() for c in ("key", "n", "again"))
        order = np.argsort(key)
        for ids, blob in zip(texts.column("ids").to_pylist(), texts.column("packed").to_pylist()):
            ids = np.frombuffer(ids, np.int64)
            found.append(ids[Batch.unpacked(blob).stuffed(key[order], n[order].astype(float), again[order], total, total - repeated)])
        return pa.table({"doc_id": pa.array(np.concatenate(found), pa.int64())})

    return packed.groupBy("no").cogroup(wanted.groupBy("batch")).applyInArrow(judge, "doc_id bigint").distinct()
