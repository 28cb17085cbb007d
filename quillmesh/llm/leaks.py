"""Passages of held-out test items inside training documents.

Words are compared folded, without markup, accents and invisible characters. Runs of SEED words of
an item seed the search: they join the documents to the items on equal words. One pass over the
documents counts in how many of them each seed stands, and gives the windows where enough seeds lie
along a diagonal. A window with a rare seed is aligned to the item by Smith and Waterman's local
alignment, all windows of a batch at once; what scores like a passage is checked against the exact
definition (at least LEAST words in their order, at most one in any eight in a row changed). Windows
of common seeds alone are boilerplate: each different one is aligned once for all documents that
have it, so they are found as exactly and cost no more than their number of wordings.
"""

from __future__ import annotations

import html
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.llm.fold import fold_words
from quillmesh.runtime import cut, spread

#: Words of a seed, of a passage at the least, and between two changes.
SEED, LEAST, APART = 5, 20, 8
#: Seeds that any passage keeps: with changes as close as they may be, two runs of seven, or one of ten, stay whole.
SEEDS_KEPT = 6
#: Diagonals that a passage may drift by words put in or left out.
DRIFT = 3
#: Smith-Waterman scores: match, change, gap; and the least of a passage (17 kept words, 3 changes).
MATCH, CHANGE, GAP, SCORE = 1, -1, -1, 13
#: A seed is rare while it stands in at most such a share of the documents, or in so few.
RARE, FEW = 0.002, 5
#: Items and characters of items held by a task at once; more are searched in blocks, each a pass over the documents.
BLOCK, CHARS = 50_000, 50_000_000

_INLINE = re.compile(r"</?(?:b|i|u|em|strong|span|font|a|sup|sub|mark|small|wbr)\b[^<>]*>", re.I)
_TAG = re.compile(r"<[!/?a-zA-Z][^<>]*>")
_BROKEN = re.compile(r"(?<=[^\W\d_])[-‐‑¬­] *\n\s*(?=[^\W\d_])")
_GARBLED = re.compile(r"[ÃÂÄÆÅ][\x80-¿‘-›€„†‡ˆ‰ŠŒŽšœžŸƒ˜]|áº|á»")


def _wrong_bytes() -> dict[str, int]:
    """The characters that single bytes from 0x80 on become when read as Windows-1252 or Latin-1."""
    out = {chr(b): b for b in range(0x80, 0x100)}
    for b in range(0x80, 0xA0):
        try:
            out[bytes([b]).decode("cp1252")] = b
        except UnicodeDecodeError:
            continue
    return out


_BYTE = _wrong_bytes()
_WRONG_RUN = re.compile("[" + "".join(map(re.escape, _BYTE)) + "]{2,}")


def _decoded(m: re.Match) -> str:
    try:
        return bytes(map(_BYTE.__getitem__, m[0])).decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


def repaired(text: str) -> str:
    """``text`` decoded again where UTF-8 was read as Windows-1252 or Latin-1, run by run; what is no UTF-8 stays."""
    return _WRONG_RUN.sub(_decoded, text) if _GARBLED.search(text) else text


def plain_words(text: str, memory: dict[str, list[str]]) -> list[str]:
    """The folded words of ``text`` as a reader sees them."""
    text = repaired(text)
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", _INLINE.sub("", text))
    if "\n" in text:
        text = _BROKEN.sub("", text)
    out: list[str] = []
    if len(memory) > 500_000:
        memory.clear()
    for chunk in text.split():
        words = memory.get(chunk)
        if words is None:
            words = fold_words(chunk)
            if len(chunk) < 64:
                memory[chunk] = words
        out += words
    return out


def longest_passage(same: np.ndarray) -> int:
    """Words of the longest stretch of a diagonal with at most one change in any APART in a row, ends kept."""
    best, start, last = 0, -1, -APART
    changes: list[int] = []
    for i, ok in enumerate(same.tolist()):
        if ok:
            if start < 0:
                start, changes = i, []
            best = max(best, i - start + 1)
        elif start >= 0:
            if changes and i - changes[-1] < APART:
                # the stretch has to begin after the earlier of the two
                start = changes[-1] + 1
                changes = [i]
                if start == i:
                    start, changes = -1, []
            else:
                changes.append(i)
    return best


def path_passage(doc: list[int], item: list[int]) -> int:
    """The same along the best local alignment of two short word lists, a gap counting as a change."""
    n, m = len(doc), len(item)
    h = [[0] * (m + 1) for _ in range(n + 1)]
    top = (0, 0, 0)
    for i in range(1, n + 1):
        for j in range(1, m + 1):
            s = max(0, h[i - 1][j - 1] + (MATCH if doc[i - 1] == item[j - 1] else CHANGE), h[i - 1][j] + GAP, h[i][j - 1] + GAP)
            h[i][j] = s
            top = max(top, (s, i, j))
    _, i, j = top
    steps = []
    while h[i][j] > 0:
        same = doc[i - 1] == item[j - 1]
        if h[i][j] == h[i - 1][j - 1] + (MATCH if same else CHANGE):
            steps.append(same)
            i, j = i - 1, j - 1
        elif h[i][j] == h[i - 1][j] + GAP:
            steps.append(False)
            i -= 1
        else:
            steps.append(False)
            j -= 1
    return longest_passage(np.array(steps[::-1], bool))


def smith_waterman(docs: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Best local scores of the rows of ``docs`` with those of ``items``; -1 and -2 pad them."""
    n, w = docs.shape
    row, best = np.zeros((n, w + 1), np.int16), np.zeros(n, np.int16)
    steps = np.arange(w + 1, dtype=np.int16)
    for j in range(items.shape[1]):
        word = items[:, j : j + 1]
        new = np.zeros_like(row)
        np.maximum(row[:, :-1] + np.where(docs == word, MATCH, CHANGE).astype(np.int16), row[:, 1:] + GAP, out=new[:, 1:])
        np.maximum(new, 0, out=new)
        # gaps along the row: the best so far, less the distance
        new -= GAP * steps
        np.maximum.accumulate(new, axis=1, out=new)
        new += GAP * steps
        # an item that has ended must not go on
        new[word[:, 0] < 0] = 0
        row = new
        np.maximum(best, row.max(1), out=best)
    return best


class Items:
    """Test items as word ids, with their seeds sorted by hash."""

    MULT = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, rows: list[tuple[int, str | None]]):
        self.vocab: dict[str, int] = {}
        self.ids, self.words = [], []
        memory: dict[str, list[str]] = {}
        for item, text in rows:
            words = [self.vocab.setdefault(w, len(self.vocab)) for w in plain_words(text or "", memory)]
            if len(words) >= LEAST:
                self.ids.append(item)
                self.words.append(np.array(words, np.int32))
        seeds = [(self.hashes(w), k) for k, w in enumerate(self.words)]
        key = np.concatenate([h for h, _ in seeds]) if seeds else np.zeros(0, np.uint64)
        who = np.concatenate([np.full(len(h), k, np.int32) for h, k in seeds]) if seeds else np.zeros(0, np.int32)
        at = np.concatenate([np.arange(len(h), dtype=np.int32) for h, _ in seeds]) if seeds else np.zeros(0, np.int32)
        order = np.argsort(key, kind="stable")
        self.key, self.who, self.at = key[order], who[order], at[order]

    def hashes(self, words: np.ndarray) -> np.ndarray:
        """A hash of every SEED words in a row."""
        n = max(0, len(words) - SEED + 1)
        h = np.zeros(n, np.uint64)
        for k in range(SEED):
            h = (h ^ (words[k : k + n].astype(np.uint64) + np.uint64(1))) * self.MULT
        return h

    def candidates(self, words: np.ndarray) -> tuple[list[tuple[int, int, int, np.ndarray]], np.ndarray]:
        """((item, first, last diagonal, seeds) where enough seeds lie close together, distinct seeds of the text)."""
        known, no_seeds = words >= 0, np.zeros(0, np.int64)
        if known.sum() < LEAST - 3 or not len(self.key):
            return [], no_seeds
        h = self.hashes(words)
        run = np.convolve(known, np.ones(SEED, int), "valid") == SEED if len(words) >= SEED else np.zeros(0, bool)
        pos = np.nonzero(run)[0]
        lo = np.searchsorted(self.key, h[pos], "left")
        n = np.searchsorted(self.key, h[pos], "right") - lo
        seeds = np.unique(lo[n > 0])
        if n.sum() < SEEDS_KEPT:
            return [], seeds
        seed = np.repeat(lo, n)
        k = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        who, diag = self.who[k].astype(np.int64), np.repeat(pos, n) - self.at[k]
        order = np.lexsort((diag, who))
        who, diag, seed = who[order], diag[order], seed[order]
        m, out = SEEDS_KEPT - 1, []
        # SEEDS_KEPT seeds of one item within DRIFT diagonals
        near = np.nonzero((who[m:] == who[:-m]) & (diag[m:] - diag[:-m] <= DRIFT))[0] if len(who) > m else []
        for i in near.tolist() if len(near) else ():
            if out and out[-1][0] == who[i] and diag[i] - out[-1][2] <= DRIFT:
                out[-1] = (out[-1][0], out[-1][1], int(diag[i + m]), out[-1][3], i + m + 1)
            else:
                out.append((int(who[i]), int(diag[i]), int(diag[i + m]), i, i + m + 1))
        return [(w, a, b, np.unique(seed[x:y])) for w, a, b, x, y in out], seeds


def verified(items: Items, cands: list[tuple[np.ndarray, int, int, int]]) -> list[bool]:
    """Whether the window of each candidate (words, item, first, last diagonal) holds a passage; the first word is on diagonal 0."""
    out = [False] * len(cands)
    for k in range(0, len(cands), 2_000):
        some = cands[k : k + 2_000]
        left = np.full((len(some), max(len(w) for w, *_ in some)), -1, np.int32)
        right = np.full((len(some), max(len(items.words[i]) for _, i, _, _ in some)), -2, np.int32)
        for r, (w, i, _, _) in enumerate(some):
            left[r, : len(w)] = w
            right[r, : len(items.words[i])] = items.words[i]
        for r in np.nonzero(smith_waterman(left, right) >= SCORE)[0].tolist():
            w, i, a, b = some[r]
            item = items.words[i]
            long = 0
            for diag in range(a, b + 1):
                part = w[max(0, diag) : max(0, diag + len(item))]
                long = max(long, longest_passage(part == item[max(0, -diag) :][: len(part)]))
            if long < LEAST and b > a:
                long = path_passage(w.tolist(), item.tolist())
            out[k + r] = long >= LEAST
    return out


_HELD: dict[str, Items] = {}


def held(token: str, rows: list[tuple[int, str | None]]) -> Items:
    """The items of a block, built once in each Python worker."""
    if token not in _HELD:
        _HELD.clear()
        _HELD[token] = Items(rows)
    return _HELD[token]


_FOUND = "doc_id bigint, item int, a int, b int, words binary, seeds binary, seed bigint, n bigint"
_TYPES = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64())


def _record(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [()] * len(_TYPES)
    return pa.record_batch([pa.array(c, t) for c, t in zip(cols, _TYPES)], names=[x.split()[0] for x in _FOUND.split(", ")])


def _block(docs: DataFrame, rows: list[tuple[int, str | None]], n_docs: int, some: int) -> DataFrame:
    """(doc_id, item_id) for a block of items."""
    token, sc = uuid.uuid4().hex, docs.sparkSession.sparkContext
    shared = sc.broadcast(rows)

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, memory, having = held(token, shared.value), {}, Counter()
        get = items.vocab.get
        for batch in batches:
            for lo in range(0, batch.num_rows, some):
                out = []
                for doc, text in zip(*(c.to_pylist() for c in batch.slice(lo, some).columns)):
                    words = np.array([get(w, -1) for w in plain_words(text, memory)], np.int32)
                    cands, seeds = items.candidates(words)
                    having.update(seeds.tolist())
                    for i, a, b, of in cands:
                        begin = max(0, a - DRIFT)
                        window = words[begin : max(0, b + DRIFT + len(items.words[i]))]
                        out.append((doc, i, a - begin, b - begin, window.tobytes(), of.astype(np.int64).tobytes(), None, None))
                yield _record(out)
        yield _record([(*[None] * 6, seed, n) for seed, n in having.items()])

    met = cut(docs.mapInArrow(seek, _FOUND))
    # at most one row for each seed of the items, which are held here anyway
    often = max(FEW, RARE * n_docs)
    common = np.array(sorted(r["seed"] for r in met.where("seed is not null").groupBy("seed").agg(F.sum("n").alias("n")).where(F.col("n") > often).select("seed").collect()), np.int64)
    cands = met.where("item is not null").select("doc_id", "item", "a", "b", "words", "seeds")
    if not len(common):
        return cands.mapInArrow(_verifier(token, shared), "key bigint, item_id bigint").select(F.col("key").alias("doc_id"), "item_id")
    known = sc.broadcast(common)

    @F.arrow_udf("boolean")
    def has_rare(seeds: pa.Array) -> pa.Array:
        return pa.array([not np.isin(np.frombuffer(s, np.int64), known.value).all() for s in seeds.to_pylist()], pa.bool_())

    cands = cands.withColumn("rare", has_rare("seeds"))
    first = cands.where("rare").mapInArrow(_verifier(token, shared), "key bigint, item_id bigint").select(F.col("key").alias("doc_id"), "item_id")
    plain = cands.where("not rare")
    wordings = plain.groupBy("item", "a", "b", "words").agg(F.count(F.lit(1)).alias("n")).select(F.xxhash64("item", "a", "b", "words").alias("doc_id"), "item", "a", "b", "words", F.lit(b"").alias("seeds"))
    hold = wordings.mapInArrow(_verifier(token, shared), "key bigint, item_id bigint")
    again = plain.select("doc_id", F.xxhash64("item", "a", "b", "words").alias("key")).join(hold, "key").select("doc_id", "item_id")
    return first.unionByName(again)


def _verifier(token: str, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held(token, shared.value)
        for b in batches:
            ids, which, first, last, words = (b.column(k).to_pylist() for k in range(5))
            ok = verified(items, [(np.frombuffer(w, np.int32), i, x, y) for w, i, x, y in zip(words, which, first, last)])
            pairs = [(k, items.ids[i]) for k, i, good in zip(ids, which, ok) if good]
            yield pa.record_batch([pa.array([k for k, _ in pairs], pa.int64()), pa.array([i for _, i in pairs], pa.int64())], names=["key", "item_id"])

    return run


def find_leaks(docs: DataFrame, items: DataFrame, some: int = 500) -> DataFrame:
    """(doc_id, item_id) of documents (doc_id, text) that hold a passage of an item (item_id, text).

    Several rows of one item_id are its texts. Null and empty texts hold nothing; items shorter than
    a passage cannot leak; repeated rows give one pair. The items are a held-out set: they are
    broadcast in blocks of at most BLOCK rows and CHARS characters, each searched in one pass over
    the documents without a shuffle; only windows of common seeds and the pairs found are shuffled.
    """
    size = F.length(F.coalesce("text", F.lit("")))
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK), -(-chars // CHARS))
    texts = docs.where("doc_id is not null and text is not null and text <> ''").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    n_docs = texts.count()
    texts = spread(texts)
    out = None
    for b in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        found = _block(texts, [tuple(r) for r in part.where("item_id is not null").select("item_id", "text").collect()], n_docs, some)
        out = found if out is None else out.unionByName(found)
    return out.distinct()
