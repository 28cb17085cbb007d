"""Column expressions for the pages of a text: chunks along page marks, and text made even for scoring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillmesh.functions.numbers import DASHES


def _packed(units: Column, most: int, glue: str) -> Column:
    """Neighbouring units put together while they stay within ``most`` characters; a longer one stands alone."""
    start = F.struct(F.lit("").alias("open"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, u: Column) -> Column:
        fits = (acc["open"] == "") | (F.length(acc["open"]) + F.length(u) + len(glue) <= most)
        joined = F.when(acc["open"] == "", u).otherwise(F.concat(acc["open"], F.lit(glue), u))
        return F.struct(F.when(fits, joined).otherwise(u).alias("open"), F.when(fits, acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["open"]))).alias("out"))

    return F.aggregate(units, start, step, lambda acc: F.when(acc["open"] == "", acc["out"]).otherwise(F.concat(acc["out"], F.array(acc["open"]))))


def page_chunks(text: Column, most: int) -> Column:
    """A text as chunks of at most ``most`` characters, cut before page marks where that is enough, else between paragraphs.

    A page too long is cut between its paragraphs; a paragraph that is longer by itself stays whole.
    Neighbours that fit are put together again. Null gives null, an empty text an empty array.
    """
    pages = F.filter(F.transform(F.split(text, r"(?=----- \[Trang [0-9]+\] -----)"), lambda p: F.trim(p)), lambda p: p != "")
    paragraphs = lambda p: F.filter(F.transform(F.split(p, "\n\n+"), lambda x: F.trim(x)), lambda x: x != "")
    sized = F.flatten(F.transform(pages, lambda p: F.when(F.length(p) <= most, F.array(p)).otherwise(_packed(paragraphs(p), most, "\n\n"))))
    return _packed(sized, most, "\n\n")


def even(composed: Column) -> Column:
    """Composed text with one kind of quotes and dashes and single blanks, for comparing readings of a page."""
    s = F.translate(composed, "“”„‟«»‘’‚‛`´" + DASHES, '""""""' + "''''''" + "-" * len(DASHES))
    return F.trim(F.regexp_replace(s, r"\s+", " "))
