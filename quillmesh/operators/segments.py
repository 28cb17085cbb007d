"""Parts, zones and articles of documents that hold several texts: a decision, what it puts into force, appendices.

A text is read once into marks with offsets (page lines, titles, attachment lines, article lines,
legal bases, the signature block); parts follow from the marks alone, by looking up the nearest one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from unicodedata import normalize

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.text import _BARE, _MARKED

# fixed values: titles of attached contents and of appendices, kinds of document that can put a content into force, phrases of articles of implementation
CONTENTS = ["QUY DINH", "QUY CHE", "DIEU LE", "QUY TRINH", "NOI QUY", "DE AN", "KE HOACH", "HUONG DAN", "CHUONG TRINH"]
APPENDICES = ["PHU LUC", "DANH MUC", "BIEU MAU", "MAU"]
PROMULGATING = ["Quyết định", "Thông tư", "Thông tư liên tịch", "Nghị quyết", "Chỉ thị", "Văn bản hợp nhất"]
IMPLEMENTS = ["hieu luc thi hanh", "co hieu luc", "het hieu luc", "thay the", "bai bo", "chiu trach nhiem thi hanh", "trach nhiem thi hanh"]
#: Signs within so many characters point to one boundary; a title this far above an attachment line is its own; the first part has at least so many.
NEAR, ABOVE, FIRST = 2500, 1500, 1500
#: How sure each sign of a boundary is.
SURE = {"attached at page": 4, "attached below title": 3, "attached": 3, "title confirmed": 3, "title": 2, "articles restart": 1}
MAIN, CONTENT, APPENDIX = "main", "attached", "appendix"

_FLAT = str.maketrans(_MARKED, _BARE)
_GAP = r"[\s_.·-]{0,3}"
_KINDS = ["quyet dinh", "thong tu", "nghi dinh", "nghi quyet", "chi thi", "ke hoach", "cong van", "luat"]
_ATTACHED = re.compile(rf"(?:ban\s*hanh\s*)?kem{_GAP}theo\s+(?:{'|'.join(k.replace(' ', _GAP) for k in _KINDS)})\s*s[o0][^\n]{{0,25}}?\d", re.I)
_LINE = {
    "page": re.compile(r"^-{3,}\s*\[Trang\s*\d+\]\s*-{3,}\s*$", re.M),
    "title": re.compile(rf"^[ \t]*({'|'.join([*CONTENTS, *APPENDICES])})\b[ \t]*$", re.M),
    "appendix": re.compile(rf"^[ \t]*(?:{'|'.join(APPENDICES)})\b", re.M),
    "basis": re.compile(r"^[ \t]*can\s*cu\b", re.M | re.I),
    "sign": re.compile(r"^[ \t]*noi\s*nhan\s*[:.]", re.M | re.I),
}
_CONFIRMED = re.compile(r"\(\s*ban\s*hanh\s*kem\s*theo", re.I)
_ARTICLE = re.compile(r"^[ \t]*Điều\s+(\d+)([a-zA-ZđĐ]?)\s*[.:]\s*(.*)$", re.M)


@dataclass
class Part:
    kind: str
    title: str
    marker: str
    start: int
    end: int
    zones: dict[str, tuple[int, int]] = field(default_factory=dict)
    articles: list[tuple] = field(default_factory=list)


class Marks:
    """The offsets of a text's marks by kind, in order."""

    def __init__(self, text: str):
        self.text, self.flat = text, text.translate(_FLAT)
        self.found = {k: list(p.finditer(self.flat)) for k, p in _LINE.items()}
        self.at = {k: [m.start() for m in ms] for k, ms in self.found.items()}
        self.articles = list(_ARTICLE.finditer(text))
        self.article_at = [m.start() for m in self.articles]

    def last(self, kind: str, before: int, within: int) -> int | None:
        """The start of the last mark of a kind that ends before an offset and not further off."""
        k = bisect_left(self.at[kind], before) - 1
        return self.at[kind][k] if k >= 0 and before - (self.found[kind][k].end() if kind == "page" else self.at[kind][k]) <= within else None

    def first(self, kind: str, start: int, end: int) -> int | None:
        k = bisect_left(self.at[kind], start)
        return self.at[kind][k] if k < len(self.at[kind]) and self.at[kind][k] < end else None

    def boundaries(self) -> list[tuple[int, str, str, str]]:
        """(start, kind, title, sign) where another part may begin."""
        out = []
        for m in _ATTACHED.finditer(self.flat):
            line = self.flat.rfind("\n", 0, m.start()) + 1
            # only an opening line, no citation within a sentence
            if m.start() - line > 12 or self.flat[line : m.start()].strip(" \t("):
                continue
            page, title = self.last("page", m.start(), NEAR), self.last("title", m.start(), ABOVE)
            start, sign = (page, "attached at page") if page is not None else (title, "attached below title") if title is not None else (line, "attached")
            out.append((start, APPENDIX if self.first("appendix", start, m.start()) is not None else CONTENT, "", sign))
        for m in self.found["title"]:
            sure = _CONFIRMED.search(self.flat, m.end(), m.end() + 400)
            out.append((m.start(), APPENDIX if m[1] in APPENDICES else CONTENT, m[1], "title confirmed" if sure else "title"))
        numbers = [int(m[1]) for m in self.articles]
        # a series begins anew with a first article that a second one follows
        for before, n, after, at in zip(numbers, numbers[1:], [*numbers[2:], 2], self.article_at[1:]):
            if n == 1 <= before and after == 2:
                out.append((at, CONTENT, "", "articles restart"))
        return sorted(out)


def _merged(boundaries: list[tuple[int, str, str, str]]) -> list[tuple[int, str, str, str]]:
    """Signs near the boundary that is kept are one: its place is the first one's, its kind the surest one's."""
    out: list[tuple[int, str, str, str]] = []
    for b in boundaries:
        if not out or b[0] - out[-1][0] > NEAR:
            out.append(b)
        elif SURE[b[3]] > SURE[out[-1][3]]:
            out[-1] = (out[-1][0], b[1], b[2] or out[-1][2], b[3])
    return out


def segment(text: str, doc_type: str | None = None) -> list[Part]:
    """The parts of a text in order, with their zones and articles.

    At most one attached content: a document puts one into force, and only of some kinds (a document
    of unknown kind may). What follows an appendix is part of it; neighbouring appendices are one.
    """
    marks = Marks(text)
    parts = [Part(MAIN, "", "begin", 0, len(text))]
    free = doc_type is None or doc_type in PROMULGATING
    for start, kind, title, sign in _merged(marks.boundaries()):
        if start < FIRST:
            continue
        last = parts[-1]
        kind = CONTENT if kind == CONTENT and free and last.kind == MAIN else APPENDIX
        if kind == last.kind == APPENDIX:
            continue
        last.end = start
        parts.append(Part(kind, title, sign, start, len(text)))
    for k, part in enumerate(parts):
        lo, hi = bisect_left(marks.article_at, part.start), bisect_left(marks.article_at, part.end)
        ends = [*marks.article_at[lo + 1 : hi], part.end]
        for seq, (m, end) in enumerate(zip(marks.articles[lo:hi], ends)):
            body = marks.flat[m.start() : end].lower()
            part.articles.append((seq, int(m[1]), m[2].lower(), m[3].strip()[:200], m.start(), end, int(any(t in body for t in IMPLEMENTS))))
        body = part.articles[0][4] if part.articles else None
        sign = marks.first("sign", part.articles[-1][4] if part.articles else part.start, part.end)
        # only the first part has legal bases; elsewhere the words stand in sentences
        basis = marks.first("basis", part.start, body if body is not None else part.end) if k == 0 else None
        stops = [("header", part.start), ("basis", basis), ("body", body), ("sign", sign)]
        stops = [(n, at) for n, at in stops if at is not None]
        for (name, at), (_, end) in zip(stops, [*stops[1:], ("", part.end)]):
            part.zones[name] = (at, end)
    return parts


def zone_at(parts: list[Part], offset: int) -> tuple[int, str, int | None] | None:
    """(part, zone, article) of an offset."""
    k = bisect_right([p.start for p in parts], offset) - 1
    if k < 0 or offset >= parts[k].end:
        return None
    zone = next((n for n, (a, b) in parts[k].zones.items() if a <= offset < b), "")
    return k, zone, next((a[0] for a in parts[k].articles if a[4] <= offset < a[5]), None)


_ARTICLE_TYPE = [("seq", pa.int32()), ("number", pa.int64()), ("suffix", pa.string()), ("heading", pa.string()), ("start_pos", pa.int32()), ("end_pos", pa.int32()), ("implements", pa.int32())]
_SPAN = pa.struct([("start_pos", pa.int32()), ("end_pos", pa.int32())])
SCHEMA = (
    "rec_id bigint, part_index int, kind string, title string, marker string, start_pos int, end_pos int, zones map<string, struct<start_pos: int, end_pos: int>>, "
    "articles array<struct<seq: int, number: bigint, suffix: string, heading: string, start_pos: int, end_pos: int, implements: int>>"
)


def segments(docs: DataFrame) -> DataFrame:
    """One row per part of the texts of (rec_id, raw_txt, doc_type), see SCHEMA; offsets are those of the composed text.

    Null texts have no parts, an empty one has a part of no length; no shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for rec, text, kind in zip(*(c.to_pylist() for c in b.columns)):
                for k, p in enumerate(segment(normalize("NFC", text), kind)):
                    zones = [(n, {"start_pos": a, "end_pos": e}) for n, (a, e) in p.zones.items()]
                    rows.append((rec, k, p.kind, p.title, p.marker, p.start, p.end, zones, [dict(zip((n for n, _ in _ARTICLE_TYPE), a)) for a in p.articles]))
            types = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.map_(pa.string(), _SPAN), pa.list_(pa.struct(_ARTICLE_TYPE))]
            names = ["rec_id", "part_index", "kind", "title", "marker", "start_pos", "end_pos", "zones", "articles"]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(types), types)], names=names)

    return docs.where("raw_txt is not null").select(F.col("rec_id").cast("bigint"), "raw_txt", "doc_type").mapInArrow(run, SCHEMA)
