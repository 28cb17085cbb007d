"""One label per item from several annotators who disagree.

Expectation-maximisation after Dawid and Skene: every annotator has a confusion matrix, every item
a posterior over the labels; each is re-estimated from the other until the likelihood stands still.
An annotator's matrix is smoothed towards the pooled one, so that few labels are not overread. The
right number of an item has a model of the same kind: its candidates are the numbers given and
"the shown one is right", each with a posterior, and every annotator has five rates (keeps a right
number or not; gives the right one for a wrong one, misses it, gives another). Agreement is reported
apart, corrected for chance.

The model has a row for each annotator. While there are at most ANNOTATORS of them, which is
counted, it is broadcast, and an item's votes (one for each annotator at most) are packed in one
row: a round is one pass over the items that hands on expected counts, summed where they arise.
Beyond that the model is joined to the votes, and everything is summed by partial aggregates.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmesh.functions.numbers import plain_number
from quillmesh.llm.fold import fold_words
from quillmesh.runtime import cut

LABELS = ["BASED_ON", "REFERENCES", "REPLACES", "AMENDS", "REPEALS", "KHONG"]
# fixed values: the ways of writing the labels, folded
WRITTEN = {
    "based on": "BASED_ON", "can cu": "BASED_ON", "references": "REFERENCES", "reference": "REFERENCES", "dan chieu": "REFERENCES",
    "replaces": "REPLACES", "replace": "REPLACES", "thay the": "REPLACES", "amends": "AMENDS", "amend": "AMENDS", "sua doi": "AMENDS",
    "repeals": "REPEALS", "repeal": "REPEALS", "bai bo": "REPEALS", "khong": "KHONG", "none": "KHONG",
}
#: Annotators whose model is broadcast at most.
ANNOTATORS = 20_000
#: The change of the mean log likelihood that ends the estimation; rounds after which it is given up with a warning.
ENOUGH, ROUNDS = 1e-4, 500
#: Labels that the pooled matrix counts for in an annotator's.
WEIGHT = 4.0
#: Wrong numbers are as likely as one of so many.
WRONG_NUMBERS = 200.0
#: Rates that the estimation of numbers begins with: keeps a right number, or not; for a wrong one gives the right one, misses it, gives another; and the share of right numbers.
RATES, SHOWN_RIGHT = (0.9, 0.1, 0.6, 0.3, 0.1), 0.8


@F.arrow_udf(T.StringType())
def label_code(a: pa.Array) -> pa.Array:
    """The label meant by what was written; null if it is unclear."""
    d = a.dictionary_encode()
    codes = [WRITTEN.get(" ".join(fold_words(x.replace("_", " ")))) if x else None for x in d.dictionary.to_pylist()]
    return pa.array(codes, pa.string()).take(d.indices)


def judgements(sheets: DataFrame) -> DataFrame:
    """(id, annotator, label, number) as each annotator's last word on each item.

    ``label`` is null where unclear; ``number`` is "" where the shown number is taken to be right
    (nothing given, or the shown number again). Repeated rows count once; of two at one time the
    greater row_no stands.
    """
    last = sheets.where("id is not null and nguoi_gan is not null").groupBy("id", F.col("nguoi_gan").alias("annotator")).agg(
        F.max_by(F.struct("nhan", "dich_dung", "so_hieu_duoc_nhac"), F.struct("gan_luc", "row_no")).alias("x")
    )
    given, shown = plain_number(F.col("x.dich_dung")), plain_number(F.col("x.so_hieu_duoc_nhac"))
    return last.select(
        "id",
        "annotator",
        label_code(F.col("x.nhan")).alias("label"),
        F.when(given.isNull() | given.eqNullSafe(shown), F.lit("")).otherwise(given).alias("number"),
    )


def _until_still(start, step: Callable):
    """The model after as many rounds of ``step`` (model -> new model, mean log likelihood) as it takes."""
    model, before = start, None
    for _ in range(ROUNDS):
        model, now = step(model)
        if now is None or before is not None and abs(now - before) < ENOUGH:
            return model
        before = now
    warnings.warn(f"the likelihood still moves after {ROUNDS} rounds", stacklevel=2)
    return model


def _numbered(votes: DataFrame) -> tuple[DataFrame, list[str] | None]:
    """Votes with their annotator's place ``a`` in the list that is given beside them; None for the list if it is too long."""
    names = [r[0] for r in votes.select("annotator").distinct().limit(ANNOTATORS + 1).collect()]
    if len(names) > ANNOTATORS:
        return votes, None
    names.sort()
    at = votes.sparkSession.createDataFrame(list(enumerate(names)), "a int, annotator string")
    return votes.join(F.broadcast(at), "annotator"), names


# --- labels


def label_model(counts: np.ndarray) -> np.ndarray:
    """Log probabilities [annotator, said, meant] from expected counts, smoothed towards the pooled ones."""
    pooled = counts.sum(0) + 0.01
    rate = pooled / pooled.sum(0)
    return np.log((counts + WEIGHT * rate) / (counts.sum(1, keepdims=True) + WEIGHT))


def label_posteriors(offsets: np.ndarray, a: np.ndarray, said: np.ndarray, logs: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(posteriors of the items, their log likelihoods); votes of an item stand between two offsets."""
    s = np.add.reduceat(logs[a, said], offsets[:-1], axis=0) + np.log(prior)
    top = s.max(1, keepdims=True)
    e = np.exp(s - top)
    total = e.sum(1, keepdims=True)
    return e / total, (top + np.log(total))[:, 0]


def _lists(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, a, v) of a batch of items (id, a, v)."""
    x, y = b.column(1), b.column(2)
    offsets = x.offsets.to_numpy()
    return offsets - offsets[0], x.flatten().to_numpy(), y.flatten().to_numpy()


def _summed(items: DataFrame, expect: Callable, width: int) -> tuple[dict[tuple[int, int], np.ndarray], np.ndarray]:
    """Expected counts by (annotator, what was said), and the totals, of one pass over packed items.

    ``expect(batch)`` gives (a, v, counts [votes, width], totals [width + 1]).
    """
    names = [f"c{i}" for i in range(width + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, every = {}, np.zeros(width + 1)
        for b in batches:
            if not b.num_rows:
                continue
            a, v, counts, totals = expect(b)
            key, back = np.unique(a.astype(np.int64) << 32 | v, return_inverse=True)
            part = np.stack([np.bincount(back, weights=counts[:, i], minlength=len(key)) for i in range(width)], 1)
            for k, row in zip(key.tolist(), part):
                sums[k] = sums[k] + row if k in sums else row
            every += totals
        rows = [(k >> 32, k & 0xFFFFFFFF, *row, 0.0) for k, row in sums.items()] + [(-1, 0, *every)]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), *[pa.float64()] * (width + 1)))], names=["a", "v", *names])

    got = items.mapInArrow(run, "a int, v int, " + ", ".join(f"{c} double" for c in names)).groupBy("a", "v").agg(*(F.sum(c).alias(c) for c in names)).collect()
    totals = next((np.array(r[2:]) for r in got if r["a"] < 0), np.zeros(width + 1))
    return {(r["a"], r["v"]): np.array(r[2:-1]) for r in got if r["a"] >= 0}, totals


def estimate_labels(votes: DataFrame, labels: list[str] = LABELS) -> tuple[DataFrame, DataFrame]:
    """(posteriors, matrices) from votes (id, annotator, label) without nulls.

    posteriors: id, p0 .. pK; matrices: annotator, label, c0 .. cK, the expected number of times the
    annotator gave that label to items of each kind.
    """
    votes, names = _numbered(cut(votes))
    if names is None:
        return _labels_joined(votes, labels)
    spark, k = votes.sparkSession, len(labels)
    place = F.array_position(F.array(*map(F.lit, labels)), F.col("label")).cast("int") - 1
    packed = votes.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("a", place.alias("v")))).alias("x"))
    items = cut(packed.select("id", F.col("x.a").alias("a"), F.col("x.v").alias("v")))

    def pass_over(logs: np.ndarray | None, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        shared = spark.sparkContext.broadcast((logs, prior))

        def expect(b: pa.RecordBatch):
            logs, prior = shared.value
            offsets, a, v = _lists(b)
            if logs is None:  # at first every item is what its votes say, in their shares
                n = np.diff(offsets)
                of = np.repeat(np.arange(len(n)), n)
                post = np.bincount(of * k + v, minlength=len(n) * k).reshape(-1, k) / n[:, None]
                likely = np.zeros(len(n))
            else:
                post, likely = label_posteriors(offsets, a, v, logs, prior)
            totals = np.append(post.sum(0), likely.sum())
            return a, v, np.repeat(post, np.diff(offsets), axis=0), totals

        sums, totals = _summed(items, expect, k)
        counts = np.zeros((len(names), k, k))
        for (a, v), row in sums.items():
            counts[a, v] = row
        shared.unpersist()
        return counts, totals

    def step(model):
        counts, prior = model
        new, totals = pass_over(label_model(counts), prior)
        n = totals[:k].sum()
        return (new, np.maximum(totals[:k] / n, 1e-6)) if n else model, totals[k] / n if n else None

    counts, prior = _until_still((pass_over(None, np.ones(k))[0], np.full(k, 1 / k)), step)
    shared = spark.sparkContext.broadcast((label_model(counts), prior))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                post, _ = label_posteriors(*_lists(b), *shared.value)
                yield pa.record_batch([b.column(0), *(pa.array(post[:, i]) for i in range(k))], names=["id", *(f"p{i}" for i in range(k))])

    posts = items.mapInArrow(judge, "id bigint, " + ", ".join(f"p{i} double" for i in range(k)))
    rows = [(names[a], labels[v], *map(float, counts[a, v])) for a, v in zip(*np.nonzero(counts.sum(2)))]
    return posts, spark.createDataFrame(rows, "annotator string, label string, " + ", ".join(f"c{i} double" for i in range(k)))


def _labels_joined(votes: DataFrame, labels: list[str]) -> tuple[DataFrame, DataFrame]:
    """``estimate_labels`` for more annotators than are broadcast: the same rounds by joins and partial aggregates."""
    k = range(len(labels))
    cs, ps = [f"c{i}" for i in k], [f"p{i}" for i in k]
    shares = votes.groupBy("id").agg(*((F.count_if(F.col("label") == x) / F.count(F.lit(1))).alias(p) for x, p in zip(labels, ps)))

    def counted(posts: DataFrame) -> DataFrame:
        return cut(votes.join(posts.select("id", *ps), "id").groupBy("annotator", "label").agg(*(F.sum(p).alias(c) for p, c in zip(ps, cs))))

    def posteriors(counts: DataFrame, prior: list[float]) -> DataFrame:
        pooled = {r["label"]: np.array(r[1:]) for r in counts.groupBy("label").agg(*map(F.sum, cs)).collect()}
        rate = np.array([pooled.get(x, np.zeros(len(labels))) for x in labels]) + 0.01
        rate = WEIGHT * rate / rate.sum(0)
        smooth = lambda i: F.create_map(*(y for x, r in zip(labels, rate) for y in (F.lit(x), F.lit(float(r[i])))))[F.col("label")]
        mine = counts.groupBy("annotator").agg(*(F.sum(c).alias(f"n{i}") for i, c in enumerate(cs)))
        model = counts.join(mine, "annotator").select("annotator", "label", *(F.log((F.col(c) + smooth(i)) / (F.col(f"n{i}") + WEIGHT)).alias(f"l{i}") for i, c in enumerate(cs)))
        item = votes.join(model, ["annotator", "label"]).groupBy("id").agg(*((F.sum(f"l{i}") + F.log(F.lit(prior[i]))).alias(f"s{i}") for i in k))
        top = F.greatest(*(f"s{i}" for i in k))
        item = item.withColumn("top", top).select("id", "top", *(F.exp(F.col(f"s{i}") - F.col("top")).alias(f"e{i}") for i in k))
        total = sum((F.col(f"e{i}") for i in k), F.lit(0.0))
        return item.select("id", *((F.col(f"e{i}") / total).alias(p) for i, p in enumerate(ps)), (F.col("top") + F.log(total)).alias("likely"))

    def step(model):
        posts = cut(posteriors(*model))
        *prior, now = posts.agg(*(F.avg(p) for p in ps), F.avg("likely")).first()
        return (model if now is None else (counted(posts), [max(p, 1e-6) for p in prior])), now

    counts, prior = _until_still((counted(shares), [1 / len(labels)] * len(labels)), step)
    return posteriors(counts, prior).drop("likely"), counts


# --- numbers

#: What a vote says of an item, by what is right: cases of a right number (0 kept, 1 not) and of a wrong one (2 right one given, 3 missed, 4 another given).
CASES = 5


def number_rates(counts: np.ndarray) -> np.ndarray:
    """Rates [annotator, case] from expected counts, smoothed towards the pooled ones."""
    pooled = counts.sum(0) + np.array(RATES)
    out = np.empty_like(counts)
    for group in ([0, 1], [2, 3, 4]):
        rate = pooled[group] / pooled[group].sum()
        out[:, group] = (counts[:, group] + WEIGHT * rate) / (counts[:, group].sum(1, keepdims=True) + WEIGHT)
    return out


def number_posteriors(offsets: np.ndarray, a: np.ndarray, v: np.ndarray, rates: np.ndarray, right: float) -> tuple[np.ndarray, ...]:
    """(posterior of "shown is right" for each item, of each vote's own number, log likelihoods).

    ``v`` is 0 for a vote that keeps the shown number, else the place of the number it gives among
    the item's. A candidate's score is that of "another number is right" for all votes, put right for
    the votes that give it: linear in the votes, however many candidates there are.
    """
    n = np.diff(offsets)
    of = np.repeat(np.arange(len(n)), n)
    log, wide = np.log(rates), np.log(WRONG_NUMBERS)
    gives = v > 0
    keep = np.bincount(of, weights=np.where(gives, log[a, 1] - wide, log[a, 0]), minlength=len(n)) + np.log(right)
    other = np.bincount(of, weights=np.where(gives, log[a, 4] - wide, log[a, 3]), minlength=len(n)) + np.log1p(-right) - wide
    most = np.maximum.reduceat(v, offsets[:-1])
    first = np.concatenate([[0], np.cumsum(most)])
    cand_of = np.repeat(np.arange(len(n)), most)
    mine = first[of] + v - 1
    gain = np.bincount(mine[gives], weights=(log[a, 2] - log[a, 4] + wide)[gives], minlength=first[-1])
    score = other[cand_of] + gain
    top = keep.copy()
    np.maximum.at(top, cand_of, score)
    e0, e = np.exp(keep - top), np.exp(score - top[cand_of])
    total = e0 + np.bincount(cand_of, weights=e, minlength=len(n))
    own = np.where(gives, (e / total[cand_of])[np.where(gives, mine, 0)] if len(e) else 0.0, 0.0)
    return e0 / total, own, top + np.log(total)


def estimate_numbers(votes: DataFrame) -> DataFrame:
    """(id, number) from votes (id, annotator, number), "" where the shown number is right; ties to that, then to the smaller number."""
    votes, names = _numbered(cut(votes))
    if names is None:
        return _numbers_joined(votes)
    spark = votes.sparkSession
    given = F.array_sort(F.collect_set(F.nullif("number", F.lit(""))))
    packed = votes.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("a", "number"))).alias("x"), given.alias("numbers"))
    place = F.transform("x", lambda y: F.array_position("numbers", y["number"]).cast("int"))
    items = cut(packed.select("id", F.col("x.a").alias("a"), place.alias("v"), "numbers"))

    def pass_over(rates: np.ndarray, right: float) -> tuple[np.ndarray, np.ndarray]:
        shared = spark.sparkContext.broadcast((rates, right))

        def expect(b: pa.RecordBatch):
            offsets, a, v = _lists(b)
            keep, own, likely = number_posteriors(offsets, a, v, *shared.value)
            kept = np.repeat(keep, np.diff(offsets))
            gives = v > 0
            counts = np.stack([kept * ~gives, kept * gives, own, (1 - kept) * ~gives, np.maximum(1 - kept - own, 0) * gives], 1)
            return a, np.zeros_like(a), counts, np.array([keep.sum(), len(keep), 0, 0, 0, likely.sum()])

        sums, totals = _summed(items, expect, CASES)
        counts = np.zeros((len(names), CASES))
        for (a, _), row in sums.items():
            counts[a] = row
        shared.unpersist()
        return counts, totals

    def step(model):
        counts, totals = pass_over(*model)
        n = totals[1]
        return (number_rates(counts), min(max(totals[0] / n, 1e-3), 1 - 1e-3)) if n else model, totals[CASES] / n if n else None

    rates, right = _until_still((np.tile(RATES, (len(names), 1)), SHOWN_RIGHT), step)
    shared = spark.sparkContext.broadcast((rates, right))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            offsets, a, v = _lists(b)
            keep, own, _ = number_posteriors(offsets, a, v, *shared.value)
            out = []
            for i, numbers in enumerate(b.column(3).to_pylist()):
                best, number = keep[i], ""
                for x, p in sorted(zip(v[offsets[i] : offsets[i + 1]].tolist(), own[offsets[i] : offsets[i + 1]].tolist())):
                    if x and p > best * (1 + 1e-9):
                        best, number = p, numbers[x - 1]
                out.append(number)
            yield pa.record_batch([b.column(0), pa.array(out, pa.string())], names=["id", "number"])

    return items.mapInArrow(judge, "id bigint, number string")


def _numbers_joined(votes: DataFrame) -> DataFrame:
    """``estimate_numbers`` for more annotators than are broadcast: the same rounds by joins and partial aggregates."""
    gives, wide = F.col("number") != "", F.lit(float(np.log(WRONG_NUMBERS)))
    start = votes.select("annotator").distinct().select("annotator", *(F.lit(x).alias(f"r{i}") for i, x in enumerate(RATES)))

    def posteriors(rates: DataFrame, right: float) -> DataFrame:
        """(id, number, p, keep, likely): a row for each number given, and one without for the item itself."""
        log = lambda i: F.log(f"r{i}")
        per = votes.join(rates, "annotator").groupBy("id", "number").agg(
            F.sum(F.when(gives, log(1) - wide).otherwise(log(0))).alias("keep"), F.sum(F.when(gives, log(4) - wide).otherwise(log(3))).alias("other"), F.sum(F.when(gives, log(2) - log(4) + wide)).alias("gain")
        )
        item = per.groupBy("id").agg((F.sum("keep") + F.log(F.lit(right))).alias("keep"), (F.sum("other") + F.log1p(F.lit(-right)) - wide).alias("other"))
        cand = per.where(gives).select("id", "number", "gain").join(item, "id").select("id", "number", (F.col("other") + F.col("gain")).alias("s"))
        every = cand.unionByName(item.select("id", F.lit("").alias("number"), F.col("keep").alias("s")))
        top = every.groupBy("id").agg(F.max("s").alias("top"))
        e = every.join(top, "id").select("id", "number", "top", F.exp(F.col("s") - F.col("top")).alias("e"))
        total = e.groupBy("id").agg(F.sum("e").alias("total"), F.max(F.when(~gives, F.col("e"))).alias("e0"))
        return e.join(total, "id").select("id", "number", (F.col("e") / F.col("total")).alias("p"), (F.col("e0") / F.col("total")).alias("kept"), (F.col("top") + F.log("total")).alias("likely"))

    def step(model):
        posts = cut(posteriors(*model))
        right, now = posts.where(~gives).agg(F.avg("kept"), F.avg("likely")).first()
        if now is None:
            return model, None
        of = votes.join(posts, ["id", "number"])
        cases = [F.when(~gives, F.col("kept")), F.when(gives, F.col("kept")), F.when(gives, F.col("p")), F.when(~gives, 1 - F.col("kept")), F.when(gives, F.greatest(1 - F.col("kept") - F.col("p"), F.lit(0.0)))]
        counts = cut(of.groupBy("annotator").agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(f"n{i}") for i, c in enumerate(cases))))
        pooled = np.array(counts.agg(*(F.sum(f"n{i}") for i in range(CASES))).first()) + np.array(RATES)
        cols = []
        for group in ([0, 1], [2, 3, 4]):
            rate = pooled[group] / pooled[group].sum()
            size = sum((F.col(f"n{i}") for i in group), F.lit(WEIGHT))
            cols += [((F.col(f"n{i}") + F.lit(float(WEIGHT * x))) / size).alias(f"r{i}") for i, x in zip(group, rate)]
        return (cut(counts.select("annotator", *cols)), min(max(right, 1e-3), 1 - 1e-3)), now

    posts = posteriors(*_until_still((start, SHOWN_RIGHT), step))
    best = F.max_by("number", F.struct(F.round("p", 9), (~gives).alias("b")))
    first = posts.groupBy("id").agg(best.alias("number"), F.round(F.max("p"), 9).alias("p"))
    # of equally likely numbers the smallest
    tied = posts.join(first.select("id", F.col("number").alias("one"), F.col("p").alias("most")), "id").where(F.round("p", 9) == F.col("most"))
    return tied.groupBy("id").agg(F.min("number").alias("number"))


def consensus(sheets: DataFrame) -> DataFrame:
    """(id, nhan, dich_dung): one row per item with its right label and number.

    An item without a single clear label gets the most frequent label; null ids or annotators are
    left out; an empty table gives an empty result; ties go to the earlier of LABELS.
    """
    said = cut(judgements(sheets))
    posts, _ = estimate_labels(said.where("label is not null").select("id", "annotator", "label"))
    cols = [f"p{i}" for i in range(len(LABELS))]
    first = F.coalesce(*(F.when(F.col(c) == F.greatest(*cols), F.lit(x)) for c, x in zip(cols, LABELS)))
    labels = posts.select("id", first.alias("nhan"))
    labels = cut(labels)
    row = labels.groupBy("nhan").count().orderBy(F.desc("count"), "nhan").first()
    numbers = estimate_numbers(said.select("id", "annotator", "number"))
    return numbers.join(labels, "id", "left").select("id", F.coalesce("nhan", F.lit(row[0] if row else LABELS[0])).alias("nhan"), F.col("number").alias("dich_dung"))


def reliability(sheets: DataFrame) -> DataFrame:
    """(annotator, n_labels, accuracy): the expected share of each annotator's labels that are right."""
    said = judgements(sheets).where("label is not null").select("id", "annotator", "label")
    _, counts = estimate_labels(said)
    cols = [f"c{i}" for i in range(len(LABELS))]
    right = sum((F.when(F.col("label") == x, F.col(c)).otherwise(0.0) for x, c in zip(LABELS, cols)), F.lit(0.0))
    every = sum((F.col(c) for c in cols), F.lit(0.0))
    return counts.groupBy("annotator").agg(F.round(F.sum(every)).cast("bigint").alias("n_labels"), F.round(F.sum(right) / F.sum(every), 4).alias("accuracy"))


def agreement(sheets: DataFrame) -> DataFrame:
    """(field, n_items, n_labels, observed, expected, alpha): Krippendorff's alpha for nominal labels, of nhan and of dich_dung.

    Over items with two answers or more; an unclear label is no answer, an empty number is one
    ("the shown one is right").
    """
    said = judgements(sheets)
    answers = said.where("label is not null").select(F.lit("nhan").alias("field"), "id", "label").unionByName(said.select(F.lit("dich_dung").alias("field"), "id", F.col("number").alias("label")))
    per = answers.groupBy("field", "id", "label").agg(F.count(F.lit(1)).alias("n"))
    unit = per.groupBy("field", "id").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("sq")).where("m > 1")
    seen = unit.groupBy("field").agg(F.count(F.lit(1)).alias("n_items"), F.sum("m").alias("n_labels"), F.sum((F.col("sq") - F.col("m")) / (F.col("m") - 1)).alias("same"))
    margins = per.join(unit.select("field", "id"), ["field", "id"]).groupBy("field", "label").agg(F.sum("n").alias("n")).groupBy("field").agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"))
    both = sheets.sparkSession.createDataFrame([("nhan",), ("dich_dung",)], "field string")
    # two rows on each side
    out = both.join(seen, "field", "left").join(margins, "field", "left").select(
        "field", F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("n_labels", F.lit(0)).alias("n_labels"),
        (F.col("same") / F.col("n_labels")).alias("observed"), (F.col("pairs") / (F.col("n_labels") * (F.col("n_labels") - 1))).alias("expected"),
    )
    alpha = F.when(F.col("expected") < 1, (F.col("observed") - F.col("expected")) / (1 - F.col("expected")))
    return out.select("field", "n_items", "n_labels", F.round("observed", 6).alias("observed"), F.round("expected", 6).alias("expected"), F.round(alpha, 6).alias("alpha"))
