"""Splitting oversized items at natural boundaries, with overlap, by lexical cohesion.

The words left and right of every possible cut are compared, block against block; a valley in this
similarity marks a change of topic. Each piece ends at the deepest valley in the window of sizes
still allowed, among the strongest kind of boundary found there (line or sentence end, clause end,
blank, anywhere). Every next piece repeats the end of the one before.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from math import sqrt
from unicodedata import combining, normalize

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: the characters with the Unicode property White_Space
WHITE = "\t\n\v\f\r \x85\xa0                　"
_WORD = re.compile(r"\w+")
_STRONG = re.compile(r"\n+[ \t]*|(?<=[.;!?…])\s+")
_WEAK = re.compile(r"(?<=[,:)\]–—])\s+")
_BLANK = re.compile(r"\s+")
#: Words compared on each side of a possible cut.
BLOCK = 20
#: A piece is at least this share of the largest allowed, if a boundary can be had there.
LEAST = 0.4


def tidy(text: str) -> str:
    """The text whose length counts: composed, without white space at its ends."""
    return (text if text.isascii() else normalize("NFC", text)).strip(WHITE)


def _depths(text: str, cuts: list[int]) -> list[float]:
    """How deep the valley of similarity is at each place."""
    spans = [(m.start(), m.group().lower()) for m in _WORD.finditer(text, max(0, cuts[0] - 12 * BLOCK), cuts[-1] + 12 * BLOCK)]
    starts, words = [s for s, _ in spans], [w for _, w in spans]
    sims, k = [], 0
    for c in cuts:
        while k < len(starts) and starts[k] < c:
            k += 1
        a, b = Counter(words[max(0, k - BLOCK) : k]), Counter(words[k : k + BLOCK])
        norm = sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        sims.append(sum(n * b[w] for w, n in a.items()) / norm if norm else 0.0)
    out = []
    for i, s in enumerate(sims):
        left = right = s
        for j in range(i - 1, -1, -1):
            if sims[j] < left:
                break
            left = sims[j]
        for j in range(i + 1, len(sims)):
            if sims[j] < right:
                break
            right = sims[j]
        out.append(left + right - 2 * s)
    return out


def cut_places(text: str, limit: int, overlap: int) -> list[int]:
    """Ends of the pieces but the last, for pieces of at most ``limit`` characters with their overlap."""
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be less than half the limit")
    at, out = 0, []
    while len(text) - at > (room := limit - overlap * bool(out)):
        # of a rest that two pieces hold, neither need be tiny
        low, high = at + int(LEAST * room), at + room
        best = None
        for kind in (_STRONG, _WEAK, _BLANK):
            cuts = [m.end() for m in kind.finditer(text, low, min(high + 64, len(text))) if low < m.end() <= high and m.end() < len(text)]
            if cuts:
                depths = _depths(text, cuts)
                best = max(zip(depths, cuts))[1]
                break
        if best is None:
            best = high
            while best > low + 1 and combining(text[best]):
                best -= 1
        out.append(best)
        at = best
    return out


def pieces(text: str, limit: int, overlap: int) -> list[str]:
    """The pieces of ``text``: each at most ``limit`` long, each but the first beginning with the last ``overlap`` characters of the one before."""
    ends = [*cut_places(text, limit, overlap), len(text)]
    begins = [0, *(e - overlap for e in ends[:-1])]
    return [text[b:e] for b, e in zip(begins, ends)]


def _zones(value: str | None) -> list[tuple[str, int, int]]:
    """The readable spans of a JSON zone map, in any of its shapes."""
    try:
        got = json.loads(value)
        if isinstance(got, str):
            got = json.loads(got)
    except (TypeError, ValueError):
        return []
    out = []
    for name, span in got.items() if isinstance(got, dict) else ():
        if isinstance(span, dict):
            span = [span.get("start"), span.get("end")]
        elif isinstance(span, str):
            span = span.split("-")
        try:
            start, end = (int(x) for x in span)
        except (TypeError, ValueError):
            continue
        if 0 <= start < end < 2**31:
            out.append((name, start, end))
    return out


def zone_spans(parts: DataFrame) -> DataFrame:
    """(rec_id, part_index, item_name, start, end) of every readable span in ``zones``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, *z) for i, v in enumerate(b.column(2).to_pylist()) for z in _zones(v)]
            at = pa.array([r[0] for r in rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), *(pa.array([r[k] for r in rows], t) for k, t in ((1, pa.string()), (2, pa.int32()), (3, pa.int32())))],
                names=["rec_id", "part_index", "item_name", "start", "end"],
            )

    cols = parts.select(F.col("rec_id").cast("bigint"), F.col("part_index").cast("int"), "zones")
    return cols.mapInArrow(run, "rec_id bigint, part_index int, item_name string, start int, end int")


def zone_items(parts: DataFrame, docs: DataFrame, limit: int) -> DataFrame:
    """Texts of the zones that may be above ``limit``, cut out on the JVM as the texts arrive.

    Composing a text makes it at most three times as long, so shorter spans than a third are left
    before the join.
    """
    spans = zone_spans(parts).where(F.col("end") - F.col("start") > limit // 3)
    texts = docs.select(F.col("rec_id").cast("bigint").alias("rec_id"), "raw_txt").where(F.length("raw_txt") > limit // 3)
    cut = F.substring("raw_txt", F.col("start") + 1, F.col("end") - F.col("start"))
    return texts.join(spans, "rec_id").select("rec_id", "part_index", F.lit("zone").alias("item_kind"), "item_name", cut.alias("text"))


def heading_items(articles: DataFrame, limit: int) -> DataFrame:
    """Texts of the headings that may be above ``limit``; item_name is seq as a string."""
    return articles.where(F.length("heading") > limit // 3).select(
        F.col("rec_id").cast("bigint").alias("rec_id"),
        F.col("part_index").cast("int").alias("part_index"),
        F.lit("heading").alias("item_kind"),
        F.col("seq").cast("string").alias("item_name"),
        F.col("heading").alias("text"),
    )


def split_oversized(items: DataFrame, limit: int, overlap: int) -> DataFrame:
    """One row per item of (rec_id, part_index, item_kind, item_name, text) above ``limit``, with its pieces.

    Null, empty and blank texts, and those within the limit, are no rows; repeated rows stay
    repeated; a text without any boundary is cut at the limit. ``n_chars`` is the length that counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [tidy(t) if t is not None else "" for t in b.column(4).to_pylist()]
            over = [i for i, t in enumerate(texts) if len(t) > limit]
            at = pa.array(over, pa.int32())
            cut = [pieces(texts[i], limit, overlap) for i in over]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(k).take(at) for k in range(4)), pa.array([len(texts[i]) for i in over], pa.int32()), pa.array(cut, pa.list_(pa.string()))],
                names=["rec_id", "part_index", "item_kind", "item_name", "n_chars", "pieces"],
            )

    return items.mapInArrow(run, "rec_id bigint, part_index int, item_kind string, item_name string, n_chars int, pieces array<string>")
