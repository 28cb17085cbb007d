"""Measures of retrieval, extraction and agreement over frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prf(tp, fp, fn, empty: float = 0.0):
    """(precision, recall, f1) as columns; ``empty`` where nothing was found or nothing was to be found."""
    p = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(empty))
    r = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(empty))
    return p, r, F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def score_sets(run: DataFrame, gold: DataFrame) -> DataFrame:
    """(qid, precision, recall, f1) of distinct (qid, key): an empty result has precision 1, an empty gold set recall 1."""
    a = run.select("qid", "key").distinct().withColumn("got", F.lit(1))
    b = gold.select("qid", "key").distinct().withColumn("due", F.lit(1))
    n = a.join(b, ["qid", "key"], "full").groupBy("qid").agg(F.sum(F.col("got") * F.col("due")).alias("tp"), F.sum("got").alias("got"), F.sum("due").alias("due"))
    tp, got, due = (F.coalesce(c, F.lit(0)) for c in ("tp", "got", "due"))
    p, r, f = prf(tp, got - tp, due - tp, 1.0)
    return n.select("qid", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f, 6).alias("f1"))


def score_ranked(run: DataFrame, gold: DataFrame, k: int, ideal: str = "gold") -> DataFrame:
    """(qid, p_at_k, r_at_k, ndcg, mrr, r_prec) of ranked (qid, key, rank); a key counts at its best rank.

    ``ideal``: "gold" takes min(k, number of gold keys) hits for the ideal ranking, "retrieved" the
    retrieved hits sorted to the front. Queries without gold keys are left out.
    """
    best = run.groupBy("qid", "key").agg(F.min("rank").alias("rank"))
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy("rank", "key")))
    hit = best.join(gold.select("qid", "key").distinct().withColumn("rel", F.lit(1)), ["qid", "key"], "left").withColumn("rel", F.coalesce("rel", F.lit(0)))
    size = gold.select("qid", "key").distinct().groupBy("qid").agg(F.count(F.lit(1)).alias("n"))
    at = hit.join(size, "qid")
    top = F.col("rank") <= k
    gain = F.col("rel") / F.log2(F.col("rank") + 1.0)
    m = at.groupBy("qid", "n").agg(
        F.sum(F.when(top, F.col("rel")).otherwise(0)).alias("hits"),
        F.sum(F.when(top, gain).otherwise(0.0)).alias("dcg"),
        F.max(F.when(F.col("rel") == 1, 1.0 / F.col("rank"))).alias("mrr"),
        F.sum(F.when(F.col("rank") <= F.col("n"), F.col("rel")).otherwise(0)).alias("early"),
    )
    m = size.join(m.drop("n"), "qid", "left")
    most = F.least(F.lit(k), F.col("n")) if ideal == "gold" else F.coalesce("hits", F.lit(0))
    best_dcg = F.aggregate(F.sequence(F.lit(1), F.greatest(most, F.lit(1)).cast("int")), F.lit(0.0), lambda acc, i: acc + 1.0 / F.log2(i + 1.0))
    z = lambda c: F.coalesce(c, F.lit(0.0))
    return m.select(
        "qid",
        F.round(z(F.col("hits") / k), 6).alias("p_at_k"),
        F.round(z(F.col("hits") / F.col("n")), 6).alias("r_at_k"),
        F.round(z(F.when(most > 0, F.col("dcg") / best_dcg)), 6).alias("ndcg"),
        F.round(z(F.col("mrr")), 6).alias("mrr"),
        F.round(z(F.col("early") / F.col("n")), 6).alias("r_prec"),
    )


def kappa(pairs: DataFrame) -> DataFrame:
    """(n, observed, expected, kappa) of rows (a, b): Cohen's; 1 where chance alone explains all, null for no rows."""
    rows = pairs.where("a is not null and b is not null")
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("a") == F.col("b")).cast("int")).alias("same"))
    side = lambda c: rows.groupBy(F.col(c).alias("x")).agg(F.count(F.lit(1)).alias(f"n_{c}"))
    chance = side("a").join(side("b"), "x").agg(F.coalesce(F.sum(F.col("n_a") * F.col("n_b")), F.lit(0)).alias("both"))
    po, pe = F.try_divide("same", "n"), F.try_divide(F.col("both"), F.col("n") * F.col("n"))
    k = F.when(F.col("n") == 0, F.lit(None)).when(pe == 1, F.lit(1.0)).otherwise(F.try_divide(po - pe, 1 - pe))
    return n.crossJoin(chance).select("n", F.round(po, 6).alias("observed"), F.round(pe, 6).alias("expected"), F.round(k, 6).alias("kappa"))


def error_rates(pairs: DataFrame) -> DataFrame:
    """(n, cer, median) of (truth, text): edits per character pooled, and the median of the rows' rates (the lower of two)."""
    d = pairs.where("truth is not null and text is not null and truth <> ''").select(F.levenshtein("truth", "text").alias("d"), F.length("truth").alias("len"))
    each = d.withColumn("rate", F.round(F.col("d") / F.col("len"), 9))
    middle = F.expr("percentile_disc(0.5) within group (order by rate)")
    return each.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("d") / F.sum("len"), 6).alias("cer"), F.round(middle, 6).alias("median"))


def sample(rows: DataFrame, stratum: str, key: str, size: int, seed: int) -> DataFrame:
    """``size`` rows a stratum (a sampling operator), chosen by a seeded hash of the key, the same at every run."""
    by = Window.partitionBy(stratum).orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(seed)), key)
    return rows.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= size).drop("nth")
