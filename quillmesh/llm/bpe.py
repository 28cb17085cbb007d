"""Encoding of a corpus with a public byte-level BPE vocabulary.

A task splits its texts into pieces, and encodes each piece it has not seen yet. Pieces go by
length into buckets, each a padded numpy matrix of ids with a matrix of pair ranks beside it. In
every round all rows of a matrix merge their leftmost pair of minimum rank; the merged position is
compacted away, so the matrix loses a column, and rows without a pair to merge leave it. Pairs are
looked up in an open-addressing hash table held in numpy arrays.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pieces longer than this many bytes are merged with a heap, in n log n, instead of in a matrix.
LONG = 256
#: Pieces whose ids a task remembers; when full, it starts afresh.
REMEMBER = 400_000
NONE = np.int32(2**31 - 1)
MAX_VOCAB_BYTES = 32_000_000
_BLANKS = regex.compile(r"\s ").search


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """(left id, right id) -> (rank, merged id) by open addressing with linear probing."""

    BITS = 18

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        while (1 << self.BITS) < 4 * len(left):
            self.BITS += 1
        self.key = np.full(1 << self.BITS, -1, np.int64)
        self.val = np.full(1 << self.BITS, NONE, np.int32)
        self.merged = np.append(merged, 0).astype(np.int32)
        keys = (left.astype(np.int64) << 32) | right
        at = self._home(keys)
        todo, self.probes = np.arange(len(keys)), 0
        while len(todo):
            self.probes += 1
            free = self.key[at[todo]] == -1
            cand = todo[free]
            # of several that want one free slot, the first takes it
            _, first = np.unique(at[cand], return_index=True)
            won = cand[first]
            self.key[at[won]] = keys[won]
            self.val[at[won]] = won
            lost = np.ones(len(keys), bool)
            lost[won] = False
            todo = todo[lost[todo]]
            at[todo] = (at[todo] + 1) & ((1 << self.BITS) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of the pairs, NONE where they do not merge; ids below 0 are padding."""
        keys = (left.astype(np.int64) << 32) | (right.astype(np.int64) & 0xFFFFFFFF)
        out = np.full(keys.shape, NONE, np.int32)
        at = self._home(keys)
        live = np.nonzero((left >= 0) & (right >= 0))
        for _ in range(self.probes):
            if not len(live[0]):
                break
            slot = at[live]
            there = self.key[slot]
            hit = there == keys[live]
            out[tuple(x[hit] for x in live)] = self.val[slot[hit]]
            on = ~hit & (there != -1)
            live = tuple(x[on] for x in live)
            at[live] = (at[live] + 1) & ((1 << self.BITS) - 1)
        return out


class ByteBpe:
    """An encoder from the bytes of a tokenizer file (JSON: model.vocab, model.merges)."""

    def __init__(self, file: bytes, pattern: str):
        model = json.loads(file)["model"]
        vocab = model["vocab"]
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        as_ids = lambda xs: np.fromiter((vocab[x] for x in xs), np.int32, len(pairs))
        left, right = as_ids(a for a, _ in pairs), as_ids(b for _, b in pairs)
        self.pairs = PairTable(left, right, as_ids(a + b for a, b in pairs))
        self.by_pair: dict | None = None
        self._parts = (left, right)
        letters = _byte_letters()
        self.of_byte = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.of_byte[b] = vocab[letter]
        self.split = regex.compile(pattern).findall
        self.seen: dict[str, list[int]] = {}
        self.words: dict[str, list[int]] = {}

    def _matrix(self, ids: np.ndarray) -> list[np.ndarray]:
        """Ids of equal-bucket pieces, rows padded with -1 on the right."""
        n = len(ids)
        out: list[np.ndarray] = [None] * n
        rows = np.arange(n)
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.zeros((n, 0), np.int32)
        while len(rows):
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            best = ranks[np.arange(len(rows)), at] if ranks.shape[1] else np.full(len(rows), NONE)
            over = best == NONE
            for r, row in zip(rows[over], ids[over]):
                out[r] = row[row >= 0]
            go = ~over
            rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
            if not len(rows):
                break
            k = np.arange(len(rows))
            ids[k, at] = self.pairs.merged[best]
            keep = np.ones(ids.shape, bool)
            keep[k, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[k, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            width = ids.shape[1]
            # only the pairs beside the merged id are new
            for j in (at - 1, at):
                ok = (j >= 0) & (j < width - 1)
                ranks[k[ok], j[ok]] = self.pairs.ranks(ids[k[ok], j[ok]], ids[k[ok], j[ok] + 1])
        return out

    def _long(self, piece: bytes) -> list[int]:
        """The same merges for one long piece, by a heap over a linked list."""
        if self.by_pair is None:
            left, right = self._parts
            self.by_pair = {(a, b): i for i, (a, b) in enumerate(zip(left.tolist(), right.tolist()))}
        get, merged = self.by_pair.get, self.pairs.merged
        ids = self.of_byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = int(merged[r]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for p in (before[i], i):
                if p >= 0 and after[p] >= 0 and (q := get((ids[p], ids[after[p]]))) is not None:
                    heapq.heappush(heap, (q, p, ids[p], ids[after[p]]))
        return [x for x in ids if x >= 0]

    def learn(self, pieces: set[str]) -> None:
        """Encodes the pieces not seen yet."""
        new = [p for p in pieces if p not in self.seen]
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for p in new:
            b = p.encode("utf-8", "surrogatepass")
            if len(b) > LONG:
                self.seen[p] = self._long(b)
            else:
                buckets.setdefault(max(1, (len(b) - 1).bit_length()), []).append((p, b))
        for bits, many in buckets.items():
            for k in range(0, len(many), 20_000):
                some = many[k : k + 20_000]
                width = min(1 << bits, max(len(b) for _, b in some))
                lens = np.fromiter((len(b) for _, b in some), np.int64, len(some))
                flat = np.frombuffer(b"".join(b for _, b in some), np.uint8)
                ids = np.full((len(some), width), -1, np.int32)
                ids[np.arange(width) < lens[:, None]] = self.of_byte[flat]
                for (p, _), row in zip(some, self._matrix(ids)):
                    self.seen[p] = row.tolist()

    def _words(self, text: str) -> list[str]:
        """``text`` cut before each blank between two words.

        No piece spans such a place and none looks across it (the part before it ends with no white
        space), so the parts can be split on their own, and each distinct part only once. Texts with
        a blank after other white space are left in one part.
        """
        if _BLANKS(text):
            return [text]
        head, *rest = text.split(" ")
        return [head, *map(" ".__add__, rest)]

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text; null and empty texts give an empty list."""
        words = [self._words(t) if t else [] for t in texts]
        if len(self.words) > REMEMBER or len(self.seen) > REMEMBER:
            self.words.clear()
            self.seen.clear()
        new = {w: self.split(w) for w in set(chain.from_iterable(words)) if w not in self.words}
        self.learn(set(chain.from_iterable(new.values())))
        get = self.seen.__getitem__
        whole = {}
        for w, pieces in new.items():
            ids = list(chain.from_iterable(map(get, pieces)))
            (whole if len(w) > LONG else self.words)[w] = ids
        known = self.words
        return [list(chain.from_iterable([known[w] if w in known else whole[w] for w in ws])) for ws in words]


_LOADED: dict[int, ByteBpe] = {}


def encode_corpus(docs: DataFrame, file: str, pattern: str, key: str = "doc_id", text: str = "text", some: int = 500) -> DataFrame:
    """(key, ids) of every row: the ids of ``text`` by the byte-level BPE in ``file``, no special tokens.

    Null and empty texts give an empty list; the strings of special tokens are ordinary text;
    repeated rows stay; whole texts are encoded, long unbroken ones too. One pass without a shuffle.
    The file is read by the driver and broadcast (at most MAX_VOCAB_BYTES). ``some``: texts encoded at once.
    """
    with open(file, "rb") as f:
        raw = f.read()
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError(f"{file} is larger than a vocabulary may be")
    shared = docs.sparkSession.sparkContext.broadcast(raw)
    token = hash((raw, pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _LOADED.get(token)
        if bpe is None:
            _LOADED.clear()
            bpe = _LOADED[token] = ByteBpe(shared.value, pattern)
        for batch in batches:
            for k in range(0, batch.num_rows, some):
                part = batch.slice(k, some)
                ids = bpe.encode(part.column(1).to_pylist())
                offsets = np.zeros(len(ids) + 1, np.int32)
                np.cumsum([len(x) for x in ids], out=offsets[1:])
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(offsets[-1]))
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")
