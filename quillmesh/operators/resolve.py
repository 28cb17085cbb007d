"""What the words of a question mean: names, numbers, kinds and articles, resolved for whole tables of mentions.

Every resolver gives (mention, outcome, value, candidates): ``resolved`` with one value, ``ambiguous``
with the names of the nearest, or ``not_found``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions.text import slug
from quillmesh.runtime import cut, maybe_broadcast

#: The least similarity of a name, and by how much the best has to lead.
LEAST, MARGIN = 0.5, 0.08
#: Names told of an ambiguous mention, and of one that only names a part.
TELL, TELL_PART = 3, 5
#: Names of at most so many words are met on every part of them.
WORDS = 10
# fixed values: beginnings that most names of organisations share, and words of respect before a person's name
GENERIC = ["truong_dai_hoc_", "dai_hoc_", "truong_"]
HONORIFICS = ["thầy", "cô", "ông", "bà", "anh", "chị", "đồng chí", "gs", "pgs", "ts", "ths"]


def telling_tokens(key: Column) -> Column:
    """The distinct words of a slug without a beginning that most names share."""
    bare = F.regexp_replace(key, f"^(?:{'|'.join(GENERIC)})", "")
    return F.array_distinct(F.filter(F.split(bare, "_"), lambda t: t != ""))


def without_honorifics(name: Column) -> Column:
    """A name without the words of respect before it; only whole words are taken off."""
    return F.trim(F.regexp_replace(name, rf"(?iu)^\s*(?:(?:{'|'.join(HONORIFICS)})(?:\.\s*|\s+))+", ""))


def article_number(raw: Column) -> Column:
    """ "Điều 5" for "điều 5", "5" or "khoản 2 Điều 5"; the bare number of a section ("Mục 2.1", "Phần IV"); else null."""
    c = F.trim(raw)
    word = F.regexp_extract(c, r"[Đđ][Ii][Ềề][Uu]\s+([0-9]+[a-zA-Z]?)", 1)
    section = F.upper(F.regexp_extract(c, r"^(?:(?:[Mm][Ụụ][Cc]|[Pp][Hh][Ầầ][Nn])\s+)?([0-9]+(?:\.[0-9]+)*|[IVXLivxl]+)\.?$", 1))
    return F.when(word != "", F.concat(F.lit("Điều "), word)).when(c.rlike("^[0-9]+[a-zA-Z]?$"), F.concat(F.lit("Điều "), c)).when(section != "", section)


def one_line(raw: Column) -> Column:
    """Text with single blanks; null if nothing is left."""
    return F.nullif(F.trim(F.regexp_replace(raw, r"\s+", " ")), F.lit(""))


def _found(mentions: DataFrame, *answers: DataFrame) -> DataFrame:
    """The first answer (mention, outcome, value, candidates) of each mention, else not_found."""
    out = mentions.select("mention")
    for k, a in enumerate(answers):
        out = out.join(a.select("mention", F.struct("outcome", "value", "candidates").alias(f"a{k}")), "mention", "left")
    x = F.coalesce(*(F.col(f"a{k}") for k in range(len(answers))))
    none = F.array().cast("array<string>")
    return out.select("mention", F.coalesce(x["outcome"], F.lit("not_found")).alias("outcome"), x["value"].alias("value"), F.coalesce(x["candidates"], none).alias("candidates"))


def _sure(mentions: DataFrame, value: str) -> DataFrame:
    return mentions.select("mention", F.lit("resolved").alias("outcome"), F.col(value).alias("value"), F.array().cast("array<string>").alias("candidates"))


def _ranked(pairs: DataFrame, tell: int, sure: Column) -> DataFrame:
    """Answers from candidates (mention, score, key, name), the best first; ``sure`` says of the array ``x`` whether its first stands."""
    best = pairs.groupBy("mention").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "key", "name"))).alias("x"))
    names = F.transform(F.slice("x", 1, tell), lambda c: c["name"])
    none = F.array().cast("array<string>")
    return best.select(
        "mention", F.when(sure, "resolved").otherwise("ambiguous").alias("outcome"), F.when(sure, F.element_at("x", 1)["key"]).alias("value"), F.when(sure, none).otherwise(names).alias("candidates")
    )


def _on_rarest(mt: DataFrame, ot: DataFrame) -> DataFrame:
    """(mention, key) that share one of their rarest words, as many as two names with the least similarity cannot both lack (a prefix filter: no pair is lost)."""
    df = ot.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))

    def rarest(rows: DataFrame, of: str) -> DataFrame:
        each = rows.select(of, F.size("tokens").alias("n"), F.explode("tokens").alias("t")).join(df, "t", "left")
        nth = F.row_number().over(Window.partitionBy(of).orderBy(F.coalesce("df", F.lit(0)), "t"))
        return each.withColumn("nth", nth).where(F.col("nth") <= F.col("n") - F.ceil(F.col("n") * LEAST) + 1).select(of, "t")

    return rarest(mt, "mention").join(rarest(ot, "key"), "t").select("mention", "key").distinct()


def _parts(tokens: Column, least: Column) -> Column:
    """Every choice of at least ``least`` of the words, each in order as one string; for at most WORDS words."""
    words = F.array_sort(tokens)
    chosen = F.filter(F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), F.size(words)) - 1), lambda k: F.bit_count(k) >= least)
    return F.transform(chosen, lambda k: F.array_join(F.filter(words, lambda t, i: F.getbit(k, i) == 1), "_"))


def _first(lists: DataFrame, most: int, *by: str) -> DataFrame:
    return lists.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy("key"))).where(F.col("nth") <= most).drop("nth")


def _on_parts(mt: DataFrame, ot: DataFrame) -> DataFrame:
    """(mention, key): of every mention that is no option's slug at least the TELL best options, for names out of few words, where each word is in many.

    They meet on all the words they share. Options of one size that have the same words are listed by
    key, TELL of them: whatever is left out has TELL of its size before it that share as much and come
    first. So rows grow with the names, not with their pairs. Names of more than WORDS words meet on
    their rarest.
    """
    mt, n = mt.join(ot.select(F.col("key").alias("slug")), "slug", "left_anti"), F.size("tokens")
    few, least = n.between(1, WORDS), F.ceil(n * LEAST)
    lists = _first(ot.where(few).select("key", n.alias("nb"), F.explode(_parts(F.col("tokens"), least)).alias("s")), TELL, "s", "nb")
    asked = mt.where(few).select("mention", n.alias("na"), F.explode(_parts(F.col("tokens"), least)).alias("s"))
    o = F.size(F.split("s", "_"))
    met = asked.join(lists, "s").where(F.round(o / (F.col("na") + F.col("nb") - o), 9) >= LEAST).select("mention", "key").distinct()
    # only names of at least this many words can be like one of more than WORDS
    many, near = n > WORDS, n >= int((WORDS + 1) * LEAST)
    return met.unionByName(_on_rarest(mt.where(many), ot.where(near))).unionByName(_on_rarest(mt.where(near & ~many), ot.where(many)))


def pick(mentions: DataFrame, options: DataFrame, aliases: DataFrame | None = None, meet: Callable[[DataFrame, DataFrame], DataFrame] = _on_rarest) -> DataFrame:
    """Names (mention) among options (name): by alias (alias, canonical), by slug, else by the share of telling words.

    The value is the slug of the option's name. Candidates meet on the rarest of their words, so words
    that all names have join nothing, or as ``meet`` has it. Null, empty and repeated mentions: a null
    is no mention, an empty one is not found, repeated ones count once.
    """
    m = mentions.where("mention is not null").select("mention").distinct().withColumn("slug", slug(F.col("mention")))
    o = options.where("name is not null").groupBy(slug(F.col("name")).alias("key")).agg(F.min("name").alias("name")).where("key <> ''")
    answers = []
    if aliases is not None:
        a = aliases.select(slug(F.col("alias")).alias("slug"), slug(F.col("canonical")).alias("key")).where("slug <> '' and key <> ''")
        a = a.join(o.select("key"), "key", "left_semi").groupBy("slug").agg(F.min("key").alias("key"))
        answers.append(_sure(m.join(a, "slug"), "key"))
    answers.append(_sure(m.join(o.select(F.col("key").alias("slug")), "slug", "left_semi"), "slug"))
    mt, ot = m.withColumn("tokens", telling_tokens(F.col("slug"))), o.withColumn("tokens", telling_tokens(F.col("key")))
    met = meet(mt, ot)
    pairs = met.join(mt.select("mention", F.col("tokens").alias("a")), "mention").join(ot.select("key", "name", F.col("tokens").alias("b")), "key")
    score = F.round(F.size(F.array_intersect("a", "b")) / F.size(F.array_union("a", "b")), 9)
    scored = pairs.select("mention", "key", "name", score.alias("score")).where(F.col("score") >= LEAST)
    lead = F.round(F.element_at("x", 2)["s"] - F.element_at("x", 1)["s"], 9) >= MARGIN
    answers.append(_ranked(scored, TELL, (F.size("x") == 1) | F.when(F.size("x") > 1, lead)))
    return _found(m, *answers)


def pick_person(mentions: DataFrame, options: DataFrame) -> DataFrame:
    """Names of persons (mention) among options (name): without honorifics by ``pick``, else the one whose name has all words of it."""
    m = cut(mentions.where("mention is not null").select("mention").distinct().withColumn("bare", without_honorifics(F.col("mention"))))
    whole = cut(m.join(pick(m.select(F.col("bare").alias("mention")), options, meet=_on_parts).withColumnRenamed("mention", "bare"), "bare"))
    o = options.where("name is not null").groupBy(slug(F.col("name")).alias("key")).agg(F.min("name").alias("name")).where("key <> ''").withColumn("b", F.array_distinct(F.split("key", "_")))
    a = F.array_sort(F.array_distinct(F.filter(F.split(slug(F.col("bare")), "_"), lambda t: t != "")))
    left = whole.where("outcome = 'not_found'").select("mention", a.alias("a")).where("size(a) > 0").withColumn("s", F.array_join("a", "_"))
    # options are listed under those of their parts that are asked for, the first by key
    asked = maybe_broadcast(cut(left.where(F.size("a") <= WORDS).select("s").distinct()))
    few = F.size("b") <= WORDS
    listed = _first(o.where(few).select("key", "name", F.explode(_parts(F.col("b"), F.lit(1))).alias("s")).join(asked, "s", "left_semi"), TELL_PART, "s")
    # options of more words are met on the rarest word of the mention; a word that no such name has rules it out
    each = o.where(~few).select("key", "name", "b", F.explode("b").alias("t"))
    df = each.groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    words = left.select("mention", "a", F.explode("a").alias("t")).join(df, "t").groupBy("mention", "a").agg(F.min_by("t", F.struct("df", "t")).alias("t"), F.count(F.lit(1)).alias("n")).where("n = size(a)")
    long = words.join(each, "t").where(F.size(F.array_except("a", "b")) == 0).select("mention", "key", "name")
    part = left.join(listed, "s").select("mention", "key", "name").unionByName(long).withColumn("score", F.lit(0.0))
    return _found(m, whole.where("outcome <> 'not_found'"), _ranked(part, TELL_PART, F.size("x") == 1))


def pick_key(mentions: DataFrame, known: DataFrame, key: Column) -> DataFrame:
    """Mentions whose ``key`` is a row of ``known`` (key): a number that some document has, a kind whose slug is listed."""
    m = mentions.where("mention is not null").select("mention").distinct().withColumn("key", key)
    return _found(m, _sure(m.join(known.select("key").distinct(), "key", "left_semi"), "key"))
