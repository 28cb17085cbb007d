"""Repair of text from scanned pages.

Lines are labelled as body, cut body (its last word goes on in the next text line), running header,
page number, page mark or blank by a hidden Markov model over layout features (shape, length, case,
repetition in the document, what such lines are elsewhere, how a line ends and the next begins),
decoded with Viterbi; a second chain over the text lines alone labels those that end a paragraph
as breaks, and paragraphs are put together accordingly. The model is fitted on a bounded sample of
documents that rules label roughly, and refined by labelling the sample again with itself.

Misread words are found by the counts of the whole corpus: a word that digital files hardly have
although scans do, and that becomes one of theirs when the letters mistaken for each other are
written alike. The texts are read where they stand, once to count and once to judge; the misread
words, whose number is measured, go to all readers in blocks of at most BLOCK.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import islice
from math import log
from unicodedata import combining, is_normalized, normalize

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.runtime import cut, spread

#: The line model is fitted on at most twice so many documents, of at most so many characters each.
SAMPLE, FIT_CHARS = 1_500, 200_000
#: Misread words that are broadcast at once; more take one reading of the texts a block.
BLOCK = 200_000
#: Distinct words a task counts before it hands on what it has.
PARTIAL = 300_000
#: A text with a line longer than this is digital: scans are wrapped.
WRAPPED = 150
#: A word is proper when digital files have it so often, at such a share of the scans' rate.
PROPER, RATE = 3, 0.2
#: A word that so large a share of the scans have, and so many for one that has what it may be misread from, is no misreading: it belongs to their form.
COMMON, BESIDE = 0.2, 0.5

_MARK = re.compile(r"^-{2,} ?\[Trang \d+\] ?-{2,}$")
_PAGE = re.compile(r"^[\W_]*(?:trang|page|tr)?[\W_]*[0-9lIoO]{1,6}(?:\s*[/|]\s*[0-9lIoO]{1,6})?[\W_]*(?:trang|page)?[\W_]*$", re.I)
_DIGITS = re.compile(r"[0-9]+(?:[0-9lOo]*[0-9]+)?")
_NUMBER = re.compile(r"[0-9lOo#]+(?:[/|][0-9lOo#]+)?[/|]?[A-ZĐ]*[/~|–-]?[A-ZĐ#0-9]*[A-ZĐ](?=[\s()]|$)")
_ITEM = re.compile(r"[0-9]{1,3}(?:[.)]\s| (?=[^\W\d_A-ZĐ])[a-zà-ỹđ])|(?:Điều|ĐIỀU|Chương|CHƯƠNG|Mục|MỤC)\s+[0-9IVX]+\b")
CUTS = " -‐‑¬­"
_CUT = re.compile(r"([^\W\d_]+)[-‐‑¬­] *$")
_PARAGRAPH = re.compile(r"(?:[-+•]|\d+[.)]|[a-zđ]\)|Điều\s|Căn cứ\s|Nơi nhận)")
STRIP = ".,;:!?()[]{}\"“”‘’-‐‑¬­–—…*/|«»"

# fixed values: letters that scans take for each other, both sides written alike
_ALIKE = [("6", "b"), ("8", "b"), ("5", "s"), ("0", "o"), ("f", "t"), ("q", "g"), ("y", "v"), ("e", "c"), ("m", "rn"), ("d", "ct"), ("h", "li"), ("n", "ri"), ("l", "i"), ("1", "i"), ("|", "i")]


def alike(word: str) -> str:
    """``word`` with everything that scans mistake written in one way."""
    s = "".join(c for c in normalize("NFD", word) if not combining(c) and (c.isalnum() or c == "|")).replace("đ", "d")
    for a, b in _ALIKE:
        s = s.replace(a, b)
    return s


def composed(text: str) -> str:
    return text if text.isascii() or is_normalized("NFC", text) else normalize("NFC", text)


def token(raw: str) -> str:
    """A word without the punctuation around it, in lower case; empty for numbers, codes and links."""
    w = raw.strip(STRIP).lower()
    if not w or "/" in w or w.isdigit() or not any(c.isalpha() for c in w):
        return ""
    return w


def tokens_of(raw: str) -> tuple[str, ...]:
    """The token of a raw word; of words joined by strokes ("và/hoặc") each; none for numbers, codes and links."""
    if "/" not in raw:
        t = token(raw)
        return (t,) if t else ()
    parts = raw.strip(STRIP).split("/")
    return tuple(p.lower() for p in parts) if all(len(p) > 1 and p.isalpha() and p.islower() for p in parts) else ()


# --- lines


def lines_of(text: str) -> list[str]:
    return composed(text).split("\n")


def line_key(s: str) -> str:
    """A stripped line with its numbers masked."""
    return (_DIGITS.sub("#", _NUMBER.sub("#", s)) if _DIGITS.search(s) else s).lower()


def candidate(s: str) -> str:
    """Kind of a stripped line: "" blank, "m" mark, "p" like a page number, "h" may be a header, "b" body."""
    if not s:
        return ""
    if s[0] == "-" and _MARK.match(s):
        return "m"
    # a long one can only be a number between ornaments
    if (len(s) < 24 or not s[0].isalpha() or s[:2].lower() in ("tr", "pa")) and _PAGE.match(s) and any(c in "0123456789lIO" for c in s):
        return "p"
    if s[-1] in ".;,:" or s[0].islower() or s[0] in "-+(" or _ITEM.match(s):
        return "b"
    return "h"


def shape(word: str) -> str:
    """What kind of word begins or ends a line."""
    if not word:
        return "-"
    if any(map(str.isdigit, word)) or "/" in word:
        return "1"
    if not any(map(str.isalpha, word)):
        return "."
    return "A" if word.isupper() and len(word) > 1 else "U" if word[0].isupper() else "a"


class Layout:
    """The lines of a text, their kinds and, where they may be headers or page numbers, their masked forms."""

    def __init__(self, text: str):
        self.lines = lines_of(text)
        stripped = [s.strip() for s in self.lines]
        self.kinds = [candidate(s) for s in stripped]
        self.keys = [line_key(s) if k in "hp" and k else "" for s, k in zip(stripped, self.kinds)]
        # a letterhead stands in capitals at the top, and only on a first page
        top = next((s for s, k in zip(stripped, self.kinds) if k and k != "m"), "")
        self.head = 8 if top.isupper() else 0
        self.times = Counter(k.strip("# \t") for i, k in enumerate(self.keys) if self.kinds[i] == "h" and i >= self.head)

    def features(self, nth: int) -> tuple[str, ...]:
        """What the model sees of a line that may be a header or a page number."""
        key = self.keys[nth]
        bare = key.strip("# \t")
        words = bare.split()
        line = self.lines[nth]
        s = line.strip()
        return (
            f"r{min(self.times[bare], 3)}",
            f"n{'head' if nth < self.head else 'later'}",
            f"c{'U' if s.isupper() else 'l'}{'F' if line[:1] == chr(12) else '-'}{'#' if key != bare else '-'}{min(len(s) // 50, 4)}",
            f"w{' '.join(words[:2])}{'U' if s.isupper() else ''}",
            f"k{bare}",
        )

    def cut_at(self, nth: int) -> re.Match | None:
        """The letters before a mark of cutting at a line's end."""
        line = self.lines[nth]
        return _CUT.search(line) if line.rstrip(" ")[-1:] in CUTS else None

    def ending(self, nth: int, then: int | None) -> tuple[str, ...]:
        """What the model sees of a line that ends in a mark of cutting, before the next text line."""
        left = self.cut_at(nth)[1]
        last = self.lines[nth].rstrip().split()[-1]
        first = (self.lines[then].split() or [""])[0] if then is not None else ""
        return f"e{shape(last.rstrip(CUTS))}", f"g{shape(first)}{'A' if left.isupper() else 'a'}"

    def between(self, nth: int, then: int) -> tuple[str, ...]:
        """What the model sees of a text line and the next one when it looks for the ends of paragraphs."""
        s, t = self.lines[nth].strip(), self.lines[then].strip()
        short = len(s) < 0.7 * self.width
        end = s[-1] if s[-1] in ".;:,!?" else "a" if s[-1].isalpha() else "1" if s[-1].isdigit() else "*"
        start = "i" if _PARAGRAPH.match(t) else "n" if _ITEM.match(t) else shape(t.split()[0])
        return f"E{end}{'s' if short else 'l'}", f"S{start}", f"c{'U' if s.isupper() else 'l'}{'U' if t.isupper() else 'l'}", f"g{min(then - nth, 3)}"

    @property
    def width(self) -> int:
        """The length that most lines come up to."""
        if not hasattr(self, "_width"):
            lens = sorted(len(x) for x, k in zip(self.lines, self.kinds) if k in "bh" and k)
            self._width = lens[len(lens) * 3 // 4] if lens else 0
        return self._width


class LineModel:
    """States B, C, H, P of lines, and K for B where a paragraph ends; lines of a plain kind have only one."""

    STATES = "BCHPbkc"

    def __init__(self):
        self.seen = {s: Counter() for s in self.STATES}
        self.size = {s: 1 for s in self.STATES}
        self.moves = Counter()
        self.turns = Counter()

    def _note(self, state: str, features: tuple[str, ...]) -> None:
        self.size[state] += 1
        self.seen[state].update(features)

    def learn(self, docs: list[tuple[Layout, str, set[int] | None]]) -> None:
        """Counts from layouts, their states and their breaks; blank lines are passed over, marks are page edges."""
        self.__init__()
        for text, states, breaks in docs:
            last = "^"
            body = [i for i, s in enumerate(states) if s in "BC"]
            for nth, (kind, state) in enumerate(zip(text.kinds, states)):
                if kind == "":
                    continue
                if kind in "hp" and state != "M":
                    self._note("B" if state == "C" else state, text.features(nth))
                here = "B" if state == "C" else state
                self.moves[last, here] += 1
                last = here
            self.moves[last, "$"] += 1
            before = "k"
            for i, then in zip(body, [*body[1:], None]):
                if text.cut_at(i):
                    self._note("C" if states[i] == "C" else "c", text.ending(i, then))
                if breaks is not None and then is not None and states[i] != "C":
                    here = "k" if i in breaks else "b"
                    self._note(here, text.between(i, then))
                    self.turns[before, here] += 1
                    before = here
        self.out = Counter()
        for (a, _), n in self.moves.items():
            self.out[a] += n
        self.known: dict[tuple, float] = {}

    def emit(self, f: tuple[str, ...], state: str) -> float:
        seen, size = self.seen[state], self.size[state]
        # features by themselves, the more telling the rarer; unseen ones count little
        return sum(log((seen[x] + 0.2) / (size + 2)) for x in f)

    def move(self, a: str, b: str) -> float:
        return log((self.moves[a, b] + 0.5) / (self.out[a] + 3))

    def turn(self, a: str, b: str) -> float:
        return log((self.turns[a, b] + 0.5) / (self.turns[a, "b"] + self.turns[a, "k"] + 1))

    def is_cut(self, f: tuple[str, ...]) -> bool:
        """Whether a line that ends so goes on within its last word."""
        if f not in self.known:
            prior = log((self.size["C"] + 1) / (self.size["c"] + 1))
            self.known[f] = prior + self.emit(f, "C") - self.emit(f, "c")
        return self.known[f] > 0

    def decode(self, text: Layout) -> str:
        """The likeliest states: B body, C cut body, H header, P page number, M mark, - blank."""
        kinds = text.kinds
        states = ["-" if k == "" else "M" if k == "m" else "B" for k in kinds]
        at = [i for i, k in enumerate(kinds) if k]
        pos = 0
        while pos < len(at):
            if kinds[at[pos]] not in "hp":
                pos += 1
                continue
            stop = pos
            while stop < len(at) and kinds[at[stop]] in "hp":
                stop += 1
            before = "^" if pos == 0 else states[at[pos - 1]]
            after = "$" if stop == len(at) else ("M" if kinds[at[stop]] == "m" else "B")
            best = {before: (0.0, "")}
            for k in range(pos, stop):
                i = at[k]
                f = text.features(i)
                options = "BP" if kinds[i] == "p" else "BH"
                new = {}
                for s in options:
                    e = self.emit(f, s) + (-4.0 if kinds[i] == "p" and s == "B" else 0.0)
                    new[s] = max((v + self.move(a, s) + e, path + s) for a, (v, path) in best.items())
                best = new
            _, path = max((v + self.move(a, after), p) for a, (v, p) in best.items())
            for k in range(pos, stop):
                states[at[k]] = path[k - pos]
            pos = stop
        # a cut line needs a text line to go on in
        then = None
        for i in reversed(at):
            if states[i] == "B":
                if then is not None and text.cut_at(i) and self.is_cut(text.ending(i, then)):
                    states[i] = "C"
                then = i
        return "".join(states)

    def breaks(self, text: Layout, states: str) -> set[int]:
        """The text lines that end a paragraph, the likeliest labels of all; a cut line ends none."""
        body = [i for i, s in enumerate(states) if s in "BC"]
        best = {"k": (0.0, None)}
        for i, then in zip(body, body[1:]):
            if states[i] == "C":
                best = {"b": max((v, path) for v, path in best.values())} if len(best) == 1 else {"b": max(best.values(), key=lambda x: x[0])}
                continue
            f = text.between(i, then)
            new = {}
            for s in "bk":
                key = (f, s)
                if key not in self.known:
                    self.known[key] = self.emit(f, s)
                v, path = max(((v + self.turn(a, s), path) for a, (v, path) in best.items()), key=lambda x: x[0])
                new[s] = (v + self.known[key], (i, path) if s == "k" else path)
            best = new
        _, path = max(best.values(), key=lambda x: x[0])
        out = set(body[-1:])
        while path:
            i, path = path
            out.add(i)
        return out


def rough_states(text: Layout) -> str:
    """Labels by rule for the sample: page numbers by shape, headers by repetition beside a page edge, cuts by the words around them."""
    kinds, lines = text.kinds, text.lines
    at = [i for i, k in enumerate(kinds) if k]
    states = ["-" if k == "" else "M" if k == "m" else "P" if k == "p" else "B" for k in kinds]
    for _ in range(2):
        for n, i in enumerate(at):
            if kinds[i] != "h" or i < text.head:
                continue
            edge = n + 1 == len(at) or states[at[n + 1]] in "PMH" or n and states[at[n - 1]] in "PMH" or lines[i][:1] == "\f" or lines[at[n + 1]][:1] == "\f"
            if edge and text.times[text.keys[i].strip("# \t")] >= 2:
                states[i] = "H"
    body = [i for i in at if states[i] == "B"]
    for i, then in zip(body, body[1:]):
        if left := text.cut_at(i):
            last, first = lines[i].rstrip().split()[-1], lines[then].split()[0]
            goes_on = any(map(str.isalpha, first)) and (not first[0].isupper() or left[1].isupper())
            if goes_on and not any(map(str.isdigit, last)) and "/" not in last:
                states[i] = "C"
    return "".join(states)


def rough_breaks(text: Layout, states: str) -> set[int]:
    """Ends of paragraphs by rule for the sample: before items and headings, after the end of a sentence on a short line."""
    body = [i for i, s in enumerate(states) if s in "BC"]
    out = set()
    for i, then in zip(body, body[1:]):
        s, t = text.lines[i].strip(), text.lines[then].strip()
        if states[i] == "B" and (_PARAGRAPH.match(t) or s[-1] in ";:" or s.isupper() or t.isupper() or s[-1] in ".!?" and len(s) < 0.7 * text.width):
            out.add(i)
    return out


def fit(texts: list[str], breaks: bool = True) -> LineModel:
    """A model from texts: rough labels first, then twice its own; of the ends of paragraphs only if they are asked for."""
    ends = lambda f, x, y: f(x, y) if breaks else None
    docs = [(x := Layout(t), y := rough_states(x), ends(rough_breaks, x, y)) for t in texts]
    model = LineModel()
    model.learn(docs)
    for _ in range(2):
        model.learn([(x, y := model.decode(x), ends(model.breaks, x, y)) for x, *_ in docs])
    return model


# --- words


def judge_lines(text: str, model: LineModel, is_bad: Callable[[str], bool], bad: dict[str, str]) -> tuple[Layout, str, list[tuple[int, str]]]:
    """(layout, states, faults): the faults as (line number from 1, kind); ``bad`` has the misread raw words of the text."""
    layout = Layout(text)
    lines, states = layout.lines, model.decode(layout)
    faults = [(i + 1, _KINDS[s]) for i, s in enumerate(states) if s in _KINDS]
    body = [i for i, s in enumerate(states) if s in "BC"]
    carried = False
    for n, i in enumerate(body):
        words = lines[i].split()
        wrong = False
        if carried:
            words = words[1:]
        carried = states[i] == "C"
        if carried:
            last, first = lines[i].rstrip().split()[-1], lines[body[n + 1]].split()[0]
            wrong = is_bad(last.rstrip(CUTS) + first)
            words = words[:-1]
        if wrong or not bad.keys().isdisjoint(words):
            faults.append((i + 1, "misread"))
    return layout, states, faults


_KINDS = {"H": "running_header", "P": "page_number", "C": "broken_word"}


def repaired(text: str, model: LineModel, fix: Callable[[str], str]) -> str:
    """``text`` as paragraphs: no headers, page numbers and marks, cut words joined, misread words put right."""
    layout = Layout(text)
    states = model.decode(layout)
    ends = model.breaks(layout, states)
    out, open_, join = [], [], False
    for i, (line, s) in enumerate(zip(layout.lines, states)):
        if s not in "BC":
            continue
        words = line.split()
        if join and words and open_:
            open_[-1] = open_[-1].rstrip(CUTS) + words[0]
            words = words[1:]
        open_ += words
        join = s == "C"
        if i in ends:
            out.append(" ".join(map(fix, open_)))
            open_ = []
    out.append(" ".join(map(fix, open_)))
    return "\n".join(p for p in out if p)


class Misread:
    """The misread words of a block with what they stand for, and which raw words of texts they are."""

    def __init__(self, fixes: dict[str, str]):
        self.fixes = fixes
        self.seen: set[str] = set()
        self.bad: dict[str, str] = {}

    def fixed(self, raw: str) -> str:
        """A raw word with its misread tokens put right, in their case."""
        for t in tokens_of(raw):
            if t in self.fixes:
                core = raw.strip(STRIP)
                right = self.fixes[t]
                right = right.upper() if len(t) > 1 and core.isupper() else right.capitalize() if core[:1].isupper() else right
                raw = re.sub(re.escape(t), lambda _, r=right: r, raw, count=1, flags=re.I)
        return raw

    def is_bad(self, raw: str) -> bool:
        return any(t in self.fixes for t in tokens_of(raw))

    def of(self, text: str) -> dict[str, str]:
        """The misread raw words met so far, those of ``text`` among them."""
        if len(self.seen) > 1_000_000:
            self.seen.clear()
            self.bad.clear()
        new = set(text.split()) - self.seen
        self.seen |= new
        for w in new:
            if self.is_bad(w):
                self.bad[w] = self.fixed(w)
        return self.bad


class Tokens(dict):
    """The tokens of each raw word, worked out once."""

    def __missing__(self, raw: str) -> tuple[str, ...]:
        self[raw] = out = tokens_of(raw)
        return out


def is_digital(text: str) -> bool:
    return len(text) > WRAPPED and max(map(len, text.split("\n"))) > WRAPPED


def same_key(text: str) -> int:
    """A key that copies and crawls of one scan share: of its longest line."""
    import xxhash

    return xxhash.xxh64_intdigest(max(text.split("\n"), key=lambda s: (len(s), s)).strip().encode()) - (1 << 63)


_HELD: dict[str, tuple] = {}


def held(token: str, value: tuple[LineModel, dict[str, str]]) -> tuple[LineModel, Misread]:
    """The model and a block's words, once in each Python worker."""
    if token not in _HELD:
        _HELD.clear()
        _HELD[token] = value[0], Misread(value[1])
    return _HELD[token]


def _count(texts: DataFrame) -> DataFrame:
    """(word, d, s, same): words with their counts in digital texts and in scans, summed as far as a task sees them; and a key of every scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digital, scans, of = Counter(), Counter(), Tokens()

        def out() -> Iterator[pa.RecordBatch]:
            words = Counter(), Counter()
            for mine, raw in zip(words, (digital, scans)):
                for w, k in raw.items():
                    for t in of[w]:
                        mine[t] += k
                raw.clear()
            every = iter(words[0].keys() | words[1].keys())
            while part := list(islice(every, 50_000)):
                yield pa.record_batch([pa.array(part, pa.string()), *(pa.array([c[w] for w in part], pa.int64()) for c in words), pa.nulls(len(part), pa.int64())], names=["word", "d", "s", "same"])
            of.clear()

        for b in batches:
            same = []
            for t in b.column(2).to_pylist():
                t = composed(t)
                if is_digital(t):
                    digital.update(t.split())
                else:
                    scans.update(t.split())
                    same.append(same_key(t))
                if len(digital) + len(scans) > PARTIAL:
                    yield from out()
            none = pa.nulls(len(same), pa.int64())
            yield pa.record_batch([pa.nulls(len(same), pa.string()), none, none, pa.array(same, pa.int64())], names=["word", "d", "s", "same"])
        yield from out()

    return cut(texts.mapInArrow(run, "word string, d bigint, s bigint, same bigint"))


def _standing(texts: DataFrame, words: set[str]) -> dict[str, int]:
    """In how many different scans each of a few words stands."""
    shared = texts.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, asked = Tokens(), shared.value
        for b in batches:
            out = []
            for t in b.column(2).to_pylist():
                t = composed(t)
                if not is_digital(t):
                    key = same_key(t)
                    out += [(w, key) for w in asked.intersection(x for raw in set(t.split()) for x in of[raw])]
            if len(of) > PARTIAL:
                of.clear()
            yield pa.record_batch([pa.array([w for w, _ in out], pa.string()), pa.array([k for _, k in out], pa.int64())], names=["word", "same"])

    found = texts.mapInArrow(run, "word string, same bigint").distinct().groupBy("word").count()
    return {r["word"]: r["count"] for r in found.collect()}


def misread_words(texts: DataFrame) -> DataFrame:
    """(word, fix) of the misread words of (tbl, row_id, text)."""
    counts = _count(texts)
    total = counts.where("word is not null").groupBy("word").agg(F.sum("d").alias("d"), F.sum("s").alias("s"))
    all_d, all_s, scans = (float(x or 0) for x in counts.agg(F.sum("d"), F.sum("s"), F.count_distinct("same")).first())
    judged = total.withColumn("proper", (F.col("d") >= PROPER) & (F.col("d") * F.lit(all_s) >= RATE * F.col("s") * F.lit(all_d)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [alike(w) for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(keys, pa.string())], names=["word", "n", "s", "proper", "alike"])

    words = cut(judged.select("word", (F.col("d") + F.col("s")).alias("n"), "s", "proper").mapInArrow(keyed, "word string, n bigint, s bigint, proper boolean, alike string"))
    right = words.where("proper and alike <> ''").select("alike", F.col("word").alias("fix"), F.col("n").alias("fix_n"))
    met = words.where("not proper").join(right, "alike")
    near = F.struct(F.levenshtein("word", "fix"), -F.col("fix_n"), "fix")
    found = cut(met.groupBy("word", "s").agg(F.min_by("fix", near).alias("fix")))
    # only a word that is frequent enough in scans can stand in so many of them; such words are few: each holds a share of all lines
    often = max(PROPER, COMMON * scans)
    frequent = met.where(F.col("s") >= often).select("word", "fix").collect()
    if not frequent:
        return found.select("word", "fix")
    standing = _standing(texts, {w for r in frequent for w in r})
    beside: dict[str, int] = {}
    for r in frequent:
        beside[r["word"]] = max(beside.get(r["word"], 0), standing.get(r["fix"], 0))
    formal = [w for w, most in beside.items() if standing.get(w, 0) >= often and standing.get(w, 0) >= BESIDE * most]
    return found.where(~F.col("word").isin(formal)).select("word", "fix")


def find_faults(texts: DataFrame, text_too: bool = False) -> DataFrame:
    """(tbl, row_id, line_no, kind) of the faulty lines of (tbl, row_id, text); with ``text_too`` (tbl, row_id, text) repaired.

    Lines are counted from 1 after splitting at newlines only. Null and empty texts have no lines;
    repeated rows give each fault once. Words are counted over the whole corpus; where no digital
    file tells which words are proper, none is called misread. In how many scans a word stands is
    counted over different texts, so that copies do not turn a misreading into their form.
    """
    texts = texts.select("tbl", "row_id", "text").where("text is not null and text <> ''")
    n = texts.count()
    some = texts.where(F.pmod(F.xxhash64("row_id", "tbl"), F.lit(max(1, n // SAMPLE))) == 0).where(F.length("text") <= FIT_CHARS)
    model = fit([r[0] for r in some.select("text").limit(2 * SAMPLE).collect()], breaks=text_too)
    texts = spread(texts)
    misread = cut(misread_words(texts))
    blocks = max(1, -(-misread.count() // BLOCK))
    outs, sc = [], texts.sparkSession.sparkContext
    for k in range(blocks):
        part = misread if blocks == 1 else misread.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == k)
        shared, token = sc.broadcast((model, {r["word"]: r["fix"] for r in part.collect()})), uuid.uuid4().hex
        if text_too:
            # every block puts its words right, the last one also puts the paragraphs together
            texts = texts.mapInArrow(_repairer(token, shared, k == blocks - 1), "tbl string, row_id bigint, text string")
        else:
            outs.append(texts.mapInArrow(_judge(token, shared, k == 0), "tbl string, row_id bigint, line_no int, kind string"))
    return texts.distinct() if text_too else reduce(DataFrame.unionByName, outs).distinct()


def _judge(token: str, shared, layout_too: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, misread = held(token, shared.value)
        for b in batches:
            out = []
            for tbl, row, text in zip(*(c.to_pylist() for c in b.columns)):
                faults = judge_lines(text, model, misread.is_bad, misread.of(composed(text)))[2]
                out += [(tbl, row, *f) for f in faults if layout_too or f[1] == "misread"]
            cols = list(zip(*out)) or [()] * 4
            types = (pa.string(), pa.int64(), pa.int32(), pa.string())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names=["tbl", "row_id", "line_no", "kind"])

    return run


def _repairer(token: str, shared, last: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, misread = held(token, shared.value)
        for b in batches:
            out = []
            for text in b.column(2).to_pylist():
                text = composed(text)
                bad = misread.of(text)
                fix = lambda w: bad[w] if w in bad else misread.fixed(w) if misread.is_bad(w) else w
                out.append(repaired(text, model, fix) if last else re.sub(r"\S+", lambda m: bad.get(m[0], m[0]), text))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(out, pa.string())], names=["tbl", "row_id", "text"])

    return run
