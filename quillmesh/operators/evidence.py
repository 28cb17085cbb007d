"""Which template answers a question, and what is shown of an answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rules(spark, templates) -> DataFrame:
    """(template, action, required, accepted, nth) of a registry of templates; ``limit`` is accepted by all."""
    rows = [(t.name, t.action, sorted(t.required), sorted({*t.required, *t.optional, "limit"}), k) for k, t in enumerate(templates)]
    return spark.createDataFrame(rows, "template string, action string, required array<string>, accepted array<string>, nth int")


def fill_number(frames: DataFrame, numbers: Column) -> DataFrame:
    """``frames`` (slots map) with the slot doc_number from an array of the numbers in the question, if it is empty and there is exactly one."""
    bare = F.coalesce("slots", F.create_map().cast("map<string,string>"))
    empty = F.coalesce(F.try_element_at(bare, F.lit("doc_number")), F.lit("")) == ""
    rest = F.map_filter(bare, lambda k, _: k != "doc_number")
    filled = F.map_concat(rest, F.create_map(F.lit("doc_number"), F.element_at(numbers, 1)))
    return frames.withColumn("slots", F.when(empty & (F.size(numbers) == 1), filled).otherwise(bare))


def select_template(frames: DataFrame, known: DataFrame) -> DataFrame:
    """(id, decision, template, missing, extra) of frames (id, action, slots map) by ``rules``.

    ``template``: all slots filled are accepted and all required ones are filled; of several the one
    that requires most, then the first. ``clarify``: nothing is too much but something is missing.
    ``agent``: no template has the action, or none takes all slots, whose names are told: a
    condition that was asked for is never left out. Slots with null or empty values are not filled.
    """
    filled = F.array_sort(F.map_keys(F.map_filter(F.coalesce("slots", F.create_map().cast("map<string,string>")), lambda _, v: v.isNotNull() & (v != ""))))
    f = frames.select("id", "action", filled.alias("names"))
    met = f.join(known, "action")
    fits = F.size(F.array_except("names", "accepted")) == 0
    lacks = F.array_sort(F.array_except("required", "names"))
    met = met.withColumn("fits", fits).withColumn("lacks", lacks)
    whole = F.when(F.col("fits") & (F.size("lacks") == 0), F.struct(-F.size("required"), "nth"))
    some = F.when(F.col("fits") & (F.size("lacks") > 0), F.struct("nth", "lacks"))
    each = met.groupBy("id", "names").agg(
        F.min_by("template", whole).alias("template"), F.array_sort(F.collect_list(some)).alias("some"), F.array_distinct(F.flatten(F.collect_list("accepted"))).alias("any")
    )
    missing = F.array_distinct(F.flatten(F.transform("some", lambda x: x["lacks"])))
    over = F.array_except("names", "any")
    none = F.array().cast("array<string>")
    out = f.select("id", F.col("names").alias("asked")).join(each, "id", "left")
    is_template, is_clarify = F.col("template").isNotNull(), F.coalesce(F.size("some") > 0, F.lit(False))
    return out.select(
        "id",
        F.when(is_template, "template").when(is_clarify, "clarify").otherwise("agent").alias("decision"),
        "template",
        F.when(~is_template & is_clarify, missing).otherwise(none).alias("missing"),
        F.when(is_template | is_clarify | F.col("any").isNull(), none).when(F.size(over) > 0, over).otherwise(F.col("asked")).alias("extra"),
    )


def sources(rows: DataFrame, hits: DataFrame, most: int = 20) -> DataFrame:
    """(pos, document, article, content, title, status): what an answer rests on, at most ``most``, in order of first appearance.

    ``rows`` (pos, document, article, content, title, status) come before ``hits`` (the same, without
    content). The status that a hit has of a document goes before that of a row. What names nothing
    is no source; a source comes once. Both are short lists of one answer, already cut to a page.
    """
    ours = rows.select(F.lit(0).alias("part"), "pos", "document", "article", "content", "title", "status")
    theirs = hits.select(F.lit(1).alias("part"), "pos", "document", "article", F.lit(None).cast("string").alias("content"), "title", "status")
    right = hits.where("document is not null and status is not null").groupBy("document").agg(F.max_by("status", "pos").alias("right"))
    each = ours.unionByName(theirs).where("coalesce(document, article, content) is not null").join(right, "document", "left")
    key = [F.coalesce(c, F.lit("\x00")).alias(f"k{i}") for i, c in enumerate(("document", "article", "content"))]
    status = F.when(F.col("part") == 0, F.coalesce("right", "status")).otherwise(F.col("status"))
    first = each.select("*", *key).groupBy("k0", "k1", "k2").agg(F.min_by(F.struct("document", "article", "content", "title", status.alias("status")), F.struct("part", "pos")).alias("x"), F.min(F.struct("part", "pos")).alias("at"))
    return first.orderBy("at").limit(most).select(F.row_number().over(Window.orderBy("at")).alias("pos"), "x.*")


def rows_as_text(rows: DataFrame, limit: int, query_limit: int | None = None, clip: int = 300) -> str:
    """The first ``limit`` rows of an answer as JSON, with the number of rows, and a word where the query's own limit was reached; long texts are clipped for display."""
    short = [F.when(F.length(c) > clip, F.concat(F.substring(c, 1, clip), F.lit("…"))).otherwise(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    n = rows.count()
    shown = [r[0] for r in rows.limit(limit).select(F.to_json(F.struct(*short))).collect()]
    notes = [f"{len(shown)} of {n} shown"] if n > limit else []
    if query_limit is not None and n >= query_limit:
        notes.append(f"the query's limit of {query_limit} was reached: there are at least {n}")
    return f"{n} rows{' (' + '; '.join(notes) + ')' if notes else ''}:\n[{', '.join(shown)}]"


def seeds(hits: DataFrame, articles: DataFrame, k: int) -> DataFrame:
    """(key, score, rank): of ranked hits the first 3k, without articles (key, implements) of implementation, cut to ``k``.

    More than ``k`` are taken first because those articles are dropped after the search.
    """
    some = hits.where(F.col("rank") <= 3 * k).join(articles.where("coalesce(implements, 0) = 0").select("key"), "key", "left_semi")
    return some.select("key", "score", F.row_number().over(Window.orderBy("rank", "key")).alias("rank")).where(F.col("rank") <= k)


def short_seeds(seeds: DataFrame, articles: DataFrame, least: int = 400) -> DataFrame:
    """(key): seeds whose article (key, text) is too short to stand alone."""
    return seeds.join(articles.where(F.length(F.coalesce("text", F.lit(""))) < least).select("key"), "key", "left_semi").select("key")
