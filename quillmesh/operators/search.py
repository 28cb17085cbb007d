"""Lexical and vector search: postings, BM25 over query trees, exact cosine, rank fusion."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmesh.functions.text import tokens
from quillmesh.runtime import stored

K1, B = 1.5, 0.75
#: Constant of reciprocal rank fusion.
RRF_K = 60


class TextIndex:
    """Postings of (key, text): (term, key, tf, len, positions). Null and empty texts have no postings but count as texts."""

    def __init__(self, texts: DataFrame):
        self.texts = texts.select("key", tokens(F.coalesce("text", F.lit(""))).alias("words"))

    @cached_property
    def postings(self) -> DataFrame:
        """A stored table in ranges of the term: a query reads only the row groups of its words."""
        each = self.texts.select("key", F.size("words").alias("len"), F.posexplode("words").alias("pos", "term"))
        return stored(each.groupBy("term", "key", "len").agg(F.count(F.lit(1)).alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions")), "term")

    @cached_property
    def frequencies(self) -> DataFrame:
        """(term, df): the number of texts that have a term, summed once when the index is made."""
        return stored(self.postings.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "term")

    @cached_property
    def stats(self) -> tuple[int, float]:
        n, mean = self.texts.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
        return n, float(mean or 1.0) or 1.0

    def df(self, words: list[str]) -> dict[str, int]:
        """The document frequencies of a query's words: a row each."""
        found = self.frequencies.where(F.col("term").isin(*words)).collect()
        return {r["term"]: r["df"] for r in found}

    def weigh(self, hits: DataFrame, df: Column, k1: float, b: float) -> DataFrame:
        """(key, score) of hits (key, tf, len): BM25 with the document frequency ``df`` of their leaf."""
        n, mean = self.stats
        idf = F.log(1 + (F.lit(n) - df + 0.5) / (df + 0.5))
        score = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("len") / F.lit(mean)))
        return hits.select("key", score.alias("score"))


@dataclass(frozen=True)
class Term:
    word: str

    def hits(self, index: TextIndex) -> DataFrame:
        return index.postings.where(F.col("term") == self.word).select("key", "tf", "len")

    def scores(self, index: TextIndex, k1: float, b: float) -> DataFrame:
        return index.weigh(self.hits(index), F.lit(index.df([self.word]).get(self.word, 0)), k1, b)


@dataclass(frozen=True)
class Phrase(Term):
    """Words in a row, as a term of its own: its frequency is the number of places it starts at."""

    @property
    def words(self) -> list[str]:
        return self.word.split()

    def hits(self, index: TextIndex) -> DataFrame:
        words = self.words
        if len(words) == 1:
            return Term(words[0]).hits(index)
        back = lambda k: F.transform("positions", lambda p: p - k)
        parts = [index.postings.where(F.col("term") == w).select("key", *(["len"] if k == 0 else []), back(k).alias(f"p{k}")) for k, w in enumerate(words)]
        met = reduce(lambda x, y: x.join(y, "key"), parts)
        starts = reduce(lambda x, y: F.array_intersect(x, y), [F.col(f"p{k}") for k in range(len(words))])
        return met.select("key", F.size(starts).cast("bigint").alias("tf"), "len").where("tf > 0")

    def scores(self, index: TextIndex, k1: float, b: float) -> DataFrame:
        if len(self.words) == 1:
            return Term(self.words[0]).scores(index, k1, b)
        hits = self.hits(index)
        # its frequency is one number, summed where the hits are
        n = F.broadcast(hits.agg(F.count(F.lit(1)).alias("df")))
        return index.weigh(hits.crossJoin(n), F.col("df"), k1, b)


@dataclass(frozen=True)
class Boost:
    of: object
    by: float

    def scores(self, index: TextIndex, k1: float, b: float) -> DataFrame:
        return self.of.scores(index, k1, b).withColumn("score", F.col("score") * self.by)


@dataclass(frozen=True)
class Or:
    parts: tuple

    def scores(self, index: TextIndex, k1: float, b: float) -> DataFrame:
        words = [p.word for p in self.parts if type(p) is Term]
        rest = [p.scores(index, k1, b) for p in self.parts if type(p) is not Term]
        if words:
            df = index.df(words)
            of = F.create_map(*(F.lit(x) for w in words for x in (w, df.get(w, 0))))[F.col("term")]
            rest.append(index.weigh(index.postings.where(F.col("term").isin(*words)), of, k1, b))
        return reduce(DataFrame.unionByName, rest).groupBy("key").agg(F.sum("score").alias("score"))


@dataclass(frozen=True)
class And:
    parts: tuple

    def scores(self, index: TextIndex, k1: float, b: float) -> DataFrame:
        each = reduce(DataFrame.unionByName, [p.scores(index, k1, b).withColumn("part", F.lit(k)) for k, p in enumerate(self.parts)])
        return each.groupBy("key").agg(F.sum("score").alias("score"), F.count_distinct("part").alias("n")).where(F.col("n") == len(self.parts)).drop("n")


def any_of(text: str) -> Or:
    """The bag of words of a plain question: folded, anything else taken for blanks."""
    from quillmesh.operators.text_keys import fold_query

    return Or(tuple(Term(w) for w in dict.fromkeys(fold_query(text))))


def phrase_or_all(text: str, boost: float = 2.0) -> object:
    """The phrase, boosted, or, from three words on, all its words."""
    from quillmesh.operators.text_keys import fold_query

    words = fold_query(text)
    phrase = Phrase(" ".join(words))
    return Or((Boost(phrase, boost), And(tuple(Term(w) for w in words)))) if len(words) >= 3 else phrase


def search(index: TextIndex, query: object, k: int | None = None, k1: float = K1, b: float = B) -> DataFrame:
    """(key, score) of all hits, or with ``k`` (key, score, rank) of the best; ties by key, so ranks are unique."""
    scored = query.scores(index, k1, b).select("key", F.round("score", 9).alias("score"))
    return ranked(scored.orderBy(F.desc("score"), "key").limit(k)) if k else scored


def ranked(scored: DataFrame) -> DataFrame:
    """(key, score) with their rank from 1; for lists that were cut to their best already."""
    return scored.select("key", "score", F.row_number().over(Window.orderBy(F.desc("score"), "key")).alias("rank"))


def fuse(lists: list[DataFrame], k: int = RRF_K) -> DataFrame:
    """(key, score, via) of ranked lists by reciprocal ranks; via names the lists by their place."""
    each = reduce(DataFrame.unionByName, [x.select("key", "rank", F.lit(i).alias("list")) for i, x in enumerate(lists)])
    return each.groupBy("key").agg(F.sum(1.0 / (k + F.col("rank"))).alias("score"), F.array_sort(F.collect_set("list")).alias("via"))


def cosine_top(vectors: DataFrame, queries: DataFrame, k: int, block: int = 4096, scope: str | None = None) -> DataFrame:
    """(qid, key, score, rank): for each query (qid, vector) the ``k`` nearest (key, vector) by cosine, ties by key.

    With ``scope``, a column of the vectors, the ``k`` nearest of each of its values, which is given
    too. Exact. The queries are a stated set, held in blocks of ``block``; every batch of vectors is
    multiplied with the block at once and keeps its own best, so what is shuffled is k rows a query
    (and scope) and batch. Null vectors are left out, a zero vector has cosine 0 with everything.
    """
    of = F.col(scope).cast("string") if scope else F.lit("")
    near_to = vectors.where("vector is not null").select(F.col("key").cast("bigint"), "vector", of.alias("scope"))
    n = queries.count()
    blocks = max(1, -(-n // block))
    out = []
    for i in range(blocks):
        part = queries if blocks == 1 else queries.where(F.pmod(F.xxhash64("qid"), F.lit(blocks)) == i)
        held = [(r["qid"], r["vector"]) for r in part.where("vector is not null").select("qid", "vector").collect()]
        if not held:
            continue
        shared = vectors.sparkSession.sparkContext.broadcast(([q for q, _ in held], np.array([v for _, v in held], float)))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300)
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = batch.column(0).to_numpy(zero_copy_only=False)
                v = np.array(batch.column(1).to_pylist(), float)
                s = q @ (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300)).T
                scopes = batch.column(2).dictionary_encode()
                places = scopes.indices.to_numpy(zero_copy_only=False) if not scopes.indices.null_count else np.array([-1 if x is None else x for x in scopes.indices.to_pylist()])
                for place in np.unique(places).tolist():
                    cols = np.nonzero(places == place)[0]
                    mine = s[:, cols]
                    m = min(k, len(cols))
                    # all that tie with the m-th stay, so that the key decides over the whole
                    least = -np.partition(-mine, m - 1, axis=1)[:, m - 1 : m]
                    at, hit = np.nonzero(mine >= least - 1e-9)
                    name = None if place < 0 else scopes.dictionary[place].as_py()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[i] for i in at], pa.int64()), pa.array(keys[cols[hit]].astype(np.int64)), pa.array(mine[at, hit]), pa.array([name] * len(at), pa.string())],
                        names=["qid", "key", "score", "scope"],
                    )

        near = near_to.mapInArrow(run, "qid bigint, key bigint, score double, scope string").withColumn("score", F.round("score", 9))
        best = near.withColumn("rank", F.row_number().over(Window.partitionBy("qid", "scope").orderBy(F.desc("score"), "key"))).where(F.col("rank") <= k)
        out.append(best.withColumnRenamed("scope", scope) if scope else best.drop("scope"))
    empty = vectors.sparkSession.createDataFrame([], f"qid bigint, key bigint, score double, {f'{scope} string, ' if scope else ''}rank int")
    return reduce(DataFrame.unionByName, out, empty) if len(out) != 1 else out[0]


def expand_once(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(key, n): neighbours of the seeds (key) in either direction, with the number of seeds they touch; seeds left out."""
    both = edges.select("src", "dst").union(edges.select("dst", "src")).distinct()
    near = both.join(seeds.select(F.col("key").alias("src")), "src").groupBy(F.col("dst").alias("key")).agg(F.count_distinct("src").alias("n"))
    return near.join(seeds.select("key"), "key", "left_anti")


def pack(docs: Column, budget: int, clip: int, least: int = 300) -> Column:
    """Greedy packing of an array of (doc, texts) in order: (doc, taken) under ``budget`` characters.

    Each text is clipped to ``clip``; one that does not fit is clipped to what is left, if that is
    at least ``least``; else the rest of its document is passed over, but later documents may fit.
    """
    text_type = "struct<left: bigint, taken: array<string>, over: boolean>"

    def one(acc: Column, text: Column) -> Column:
        t = F.substring(text, 1, clip)
        fits = F.length(t) <= acc["left"]
        short = F.substring(t, F.lit(1), F.greatest(acc["left"], F.lit(0)).cast("int"))
        take = F.when(fits, t).when(acc["left"] >= least, short)
        go = ~acc["over"] & take.isNotNull()
        return F.struct(
            F.when(go, acc["left"] - F.length(take)).otherwise(acc["left"]).cast("bigint").alias("left"),
            F.when(go, F.concat(acc["taken"], F.array(take))).otherwise(acc["taken"]).alias("taken"),
            (acc["over"] | ~go | ~fits).alias("over"),
        ).cast(text_type)

    def doc(acc: Column, d: Column) -> Column:
        start = F.struct(acc["left"].alias("left"), F.array().cast("array<string>").alias("taken"), F.lit(False).alias("over")).cast(text_type)
        done = F.aggregate(d["texts"], start, one)
        return F.struct(done["left"].alias("left"), F.concat(acc["out"], F.array(F.struct(d["doc"].alias("doc"), done["taken"].alias("taken")))).alias("out")).cast(
            "struct<left: bigint, out: array<struct<doc: string, taken: array<string>>>>"
        )

    zero = F.struct(F.lit(budget).cast("bigint").alias("left"), F.array().cast("array<struct<doc: string, taken: array<string>>>").alias("out"))
    return F.filter(F.aggregate(docs, zero, doc)["out"], lambda x: F.size(x["taken"]) > 0)
