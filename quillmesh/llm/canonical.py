"""Mapping freely typed values to the entry of a reference list that is meant.

A value is rewritten (case, accents, lead words, notes, inverted order) and looked up among the
forms of the entries (name, code, name with runs of words cut to initials). What is not found
goes through a BK-tree over the entries: its metric is Levenshtein's, whose triangle inequality
prunes the tree and returns every entry within the radius; of these the Damerau distance, in which
a swap of neighbours counts one, must be within the threshold. The tree is searched by whole
batches of values, a node comparing all values that reach it at once. All hits of a value are judged by
one rule (``decide``), whether they come from one tree or from the shards of a long list.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.llm.fold import fold_words

#: A reference list of at most so many entries is broadcast as one tree; a longer one in shards of this size.
SHARD = 20_000
NO_ENTRY = "NONE"

# fixed values: words set before a name, notes set after it
LEAD = ["tm", "kt", "tl", "tuq", "theo", "thu truong", "van thu", "nguoi ky", "loai", "ten", "co quan", "don vi"]
NOTES = ["so", "v v", "sua doi", "ban sao", "ban chinh", "du thao", "dinh kem"]

_BRACKETS = re.compile(r"\([^()]*\)|\[[^\[\]]*\]")
_INVERTED = re.compile(r"\s*,\s*|\s+[-–—]\s+")


def damerau(a: str, b: str) -> int:
    """Edits of one letter and swaps of neighbours, without limits (a metric)."""
    last: dict[str, int] = {}
    big = len(a) + len(b)
    # row and column 0 stand for "before the word", 1 for the empty word
    d = [[big] * (len(b) + 2)] + [[big, i] + [0] * len(b) for i in range(len(a) + 1)]
    d[1][1:] = range(len(b) + 1)
    for i, x in enumerate(a, 1):
        swap, above, row = 0, d[i], d[i + 1]
        for j, y in enumerate(b, 1):
            k, m = last.get(y, 0), swap
            if x == y:
                swap = j
            row[j + 1] = min(above[j] + (x != y), row[j] + 1, above[j + 1] + 1, d[k][m] + (i - k - 1) + 1 + (j - m - 1))
        last[x] = i
    return d[-1][-1]


def allowed(length: int) -> int:
    """Edits that a value of so many letters may have."""
    return 0 if length < 4 else 1 if length < 9 else 2


def as_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points padded with 0, and lengths."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.int32)
    out = np.zeros((len(words), max(1, int(lens.max(initial=1)))), np.int32)
    out[np.arange(out.shape[1]) < lens[:, None]] = flat
    return out, lens


def levenshtein(many: np.ndarray, lens: np.ndarray, word: str) -> np.ndarray:
    """Distances of all rows of ``many`` to ``word``."""
    steps = np.arange(many.shape[1] + 1, dtype=np.int16)
    row = np.broadcast_to(steps, (len(many), len(steps))).copy()
    for i, c in enumerate(word, 1):
        new = np.empty_like(row)
        new[:, 0] = i
        np.minimum(row[:, :-1] + (many != ord(c)), row[:, 1:] + 1, out=new[:, 1:])
        new -= steps
        np.minimum.accumulate(new, axis=1, out=new)
        new += steps
        row = new
    return row[np.arange(len(many)), lens]


class BkTree:
    """A tree in which a child's subtree has one and the same distance to its parent."""

    def __init__(self, words: list[str]):
        self.words = list(dict.fromkeys(words))
        self.kids: list[dict[int, int]] = [{} for _ in self.words]
        mat, lens = as_matrix(self.words) if self.words else (np.zeros((0, 1), np.int32), np.zeros(0, np.int64))
        todo = [(0, np.arange(1, len(self.words)))] if self.words else []
        while todo:
            node, below = todo.pop()
            if len(below):
                d = levenshtein(mat[below], lens[below], self.words[node])
                for k in np.unique(d).tolist():
                    same = below[d == k]
                    self.kids[node][k] = int(same[0])
                    todo.append((int(same[0]), same[1:]))

    def within(self, values: list[str], radius: list[int]) -> list[list[str]]:
        """For each value every word whose Levenshtein distance is at most its radius."""
        out: list[list[str]] = [[] for _ in values]
        if not values or not self.words:
            return out
        mat, lens = as_matrix(values)
        r = np.asarray(radius)
        todo = [(0, np.arange(len(values)))]
        while todo:
            node, who = todo.pop()
            width = max(1, int(lens[who].max()))
            d = levenshtein(mat[who, :width], lens[who], self.words[node]).astype(np.int64)
            for i in who[d <= r[who]].tolist():
                out[i].append(self.words[node])
            for k, kid in self.kids[node].items():
                on = who[abs(d - k) <= r[who]]
                if len(on):
                    todo.append((kid, on))
        return out


def _initials(words: list[str]) -> set[str]:
    """``words`` with at most two runs cut to their initials; not the whole."""
    n, out = len(words), set()
    runs = [(i, j) for i in range(n) for j in range(i + 1, n + 1) if j - i < n]
    short = lambda i, j: "".join(w[0] for w in words[i:j])
    for i, j in runs:
        head = [*words[:i], short(i, j)]
        out.add(" ".join([*head, *words[j:]]))
        for k, m in runs:
            if k >= j and (j - i > 1 and m - k > 1):
                out.add(" ".join([*head, *words[j:k], short(k, m), *words[m:]]))
    return out


#: Kinds of hits, each going before the next: by a code as typed, by a whole name, by a short form, by edits.
LETTERS, FULL, SHORT, NEAR = range(4)


class Reference:
    """The forms of a reference list of (code to give, name, short code or None)."""

    def __init__(self, entries: list[tuple[str, str, str | None]]):
        self.names = {name for _, name, _ in entries}
        self.full: dict[str, set[str]] = {}
        self.letters: dict[str, set[str]] = {}
        self.short: dict[str, set[str]] = {}
        for code, name, abbr in entries:
            words = fold_words(name)
            self.full.setdefault(" ".join(words), set()).add(code)
            for other in (abbr, code):
                if other:
                    self.letters.setdefault(normalize("NFC", other).upper(), set()).add(code)
                    self.short.setdefault(" ".join(fold_words(other)), set()).add(code)
            for form in _initials(words):
                self.short.setdefault(form, set()).add(code)
        self.tree = BkTree(list(self.full))
        self.longest = max(map(len, self.full), default=0)

    @staticmethod
    def _forms(value: str) -> list[str]:
        """Rewritings of a typed value, the plainest first."""
        value = value.replace("&", " và ")
        bare = _BRACKETS.sub(" ", value)
        inside = [x[1:-1] for x in _BRACKETS.findall(value)]
        parts = [p for p in _INVERTED.split(bare) if p.strip()]
        texts = [bare, value]
        if len(parts) == 2:
            texts.append(f"{parts[1]} {parts[0]}")
        forms = [" ".join(fold_words(t)) for t in texts]
        for f in list(forms):
            for lead in LEAD:
                if f.startswith(lead + " "):
                    forms.append(f[len(lead) + 1 :])
            for note in NOTES:
                if f.endswith(" " + note):
                    forms.append(f[: -len(note) - 1])
        if len(parts) > 1:
            forms.append(" ".join(fold_words(parts[0])))
        forms += [" ".join(fold_words(t)) for t in inside]
        return [f for f in dict.fromkeys(forms) if f]

    def hits(self, values: list[str]) -> list[tuple[int, int, int, int, str]]:
        """(index of value, kind, rank of the form, edits, code) of all that the entries offer.

        A form longer than every name by more than it may have edits is near none, and is not padded
        to be searched.
        """
        out, open_ = [], []
        for i, v in enumerate(values):
            out += [(i, LETTERS, 0, 0, c) for c in self.letters.get(normalize("NFC", v).strip(" .;:,").upper(), ())]
            for k, f in enumerate(self._forms(v)):
                out += [(i, FULL, k, 0, c) for c in self.full.get(f, ())]
                out += [(i, SHORT, k, 0, c) for c in self.short.get(f, ())]
                if allowed(len(f)) and len(f) <= self.longest + allowed(len(f)):
                    open_.append((i, k, f))
        near = self.tree.within([f for _, _, f in open_], [2 * allowed(len(f)) for _, _, f in open_])
        for (i, k, f), names in zip(open_, near):
            for name in names:
                d = damerau(f, name)
                if d <= allowed(min(len(f), len(name))):
                    out += [(i, NEAR, k, d, c) for c in self.full[name]]
        return out

    def resolve(self, values: list[str]) -> list[str]:
        """The code of the entry meant by each value, or NO_ENTRY."""
        per: list[list[tuple]] = [[] for _ in values]
        for i, *hit in self.hits(values):
            per[i].append(tuple(hit))
        return list(map(decide, per))


def decide(hits: list[tuple[int, int, int, str]]) -> str:
    """The one code that the hits (kind, rank, edits, code) of a value speak for, or NO_ENTRY.

    A code as typed goes first, then the plainest form that is a whole name or, if it is nobody's
    whole name, a short form; then the fewest edits, then the plainest form. What two entries share
    speaks for neither.
    """
    codes: dict[tuple[int, int, int], set[str]] = {}
    for kind, rank, d, code in hits:
        codes.setdefault((kind, rank, d), set()).add(code)
    for kind, rank, d in sorted(codes, key=lambda x: (x[0] > LETTERS, x[0] == NEAR, x[2], x[1], x[0])):
        of = codes[kind, rank, d]
        if kind == NEAR:
            return next(iter(of)) if len(of) == 1 else NO_ENTRY
        if len(of) == 1 and not (kind == SHORT and (FULL, rank, 0) in codes):
            return next(iter(of))
    return NO_ENTRY


_HELD: dict[str, Reference] = {}


def held(token: str, entries: list[tuple[str, str, str | None]]) -> Reference:
    """The reference list ``token``, built once in each Python worker."""
    if token not in _HELD:
        _HELD.clear()
        _HELD[token] = Reference(entries)
    return _HELD[token]


def map_values(values: DataFrame, reference: DataFrame) -> DataFrame:
    """(rec_id, field_name, ref_code) of rows (rec_id, field_name, value), against (code, name, short).

    Null and blank values, and values that are a name of the list character for character, are no
    rows. A value that fits two entries equally well, or none, gives NO_ENTRY. Repeated rows stay;
    an empty list gives NO_ENTRY for all. A list of up to SHARD entries is one broadcast tree and
    takes no shuffle (each batch resolves its distinct values once). A longer one is cut into
    shards; every distinct value visits every shard, and what all shards offer is decided by the
    same rule, so the size of the list changes no result.
    """
    entries = [tuple(r) for r in reference.select("code", "name", "short").where("code is not null and name is not null").limit(SHARD + 1).collect()]
    # Unicode white space, and the separators that Python counts as such
    values = values.where(F.col("value").rlike(r"[^\p{IsWhite_Space}\x1c-\x1f]"))
    if len(entries) > SHARD:
        return _sharded(values, reference)
    token = uuid.uuid4().hex
    shared = values.sparkSession.sparkContext.broadcast(entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ref, known = held(token, shared.value), {}
        for b in batches:
            typed = b.column(2).to_pylist()
            ask = [v for v in dict.fromkeys(typed) if v not in ref.names and v not in known]
            known.update(zip(ask, ref.resolve(ask)))
            at = pa.array([i for i, v in enumerate(typed) if v in known], pa.int32())
            codes = pa.array([known[v] for v in typed if v in known], pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), codes], names=["rec_id", "field_name", "ref_code"])
            if len(known) > 200_000:
                known.clear()

    return values.select("rec_id", "field_name", "value").mapInArrow(run, "rec_id bigint, field_name string, ref_code string")


def _sharded(values: DataFrame, reference: DataFrame, chunk: int = 20_000) -> DataFrame:
    """``map_values`` for a list too long to broadcast: distinct values x shards, then ``decide`` over what all shards offer."""
    reference = reference.where("code is not null and name is not null")
    shards = -(-reference.count() // SHARD)
    typed = values.join(reference.select(F.col("name").alias("value")), "value", "left_anti")
    distinct = typed.select("value").distinct()
    chunks = max(1, -(-distinct.count() // chunk))
    one = lambda k, c: F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias(c)
    left = distinct.select("value", F.pmod(F.xxhash64("value"), F.lit(chunks)).cast("int").alias("chunk"), one(shards, "shard"))
    right = reference.select("code", "name", "short", F.pmod(F.xxhash64("name"), F.lit(shards)).cast("int").alias("shard"), one(chunks, "chunk"))

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        ref = Reference(list(zip(*(b.column(c).to_pylist() for c in ("code", "name", "short")))))
        asked = a.column("value").to_pylist()
        rows = [(asked[i], *hit) for i, *hit in ref.hits(asked)]
        cols = zip(*rows) if rows else [()] * 5
        types = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("value", "kind", "rank", "d", "code"), cols, types)})

    hits = left.groupBy("shard", "chunk").cogroup(right.groupBy("shard", "chunk")).applyInArrow(search, "value string, kind int, rank int, d int, code string")
    # of each kind, form and number of edits: the code, null where entries share it
    agreed = hits.groupBy("value", "kind", "rank", "d").agg(F.when(F.min("code") == F.max("code"), F.min("code")).alias("code"))
    agreed = agreed.withColumn("whole", F.max((F.col("kind") == FULL).cast("int")).over(Window.partitionBy("value", "rank")))
    speaks = F.col("code").isNotNull() & ~((F.col("kind") == SHORT) & (F.col("whole") == 1)) | (F.col("kind") == NEAR)
    order = F.struct((F.col("kind") > LETTERS).alias("a"), (F.col("kind") == NEAR).alias("b"), "d", "rank", "kind")
    best = agreed.where(speaks).groupBy("value").agg(F.min_by(F.coalesce("code", F.lit(NO_ENTRY)), order).alias("ref_code"))
    return typed.join(best, "value", "left").select("rec_id", "field_name", F.coalesce("ref_code", F.lit(NO_ENTRY)).alias("ref_code"))
