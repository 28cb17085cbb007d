"""Bounded walks over typed edges, with the semantics of graph patterns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.runtime import checkpoint_dir, cut, delete, drop

#: Longest walk that may be asked for.
MOST_HOPS = 6


def trails(edges: DataFrame, least: int, most: int, starts: DataFrame | None = None, nodes: bool = True) -> DataFrame:
    """(start, end, depth, rel, nodes): one row per trail of ``least`` to ``most`` edges (src, rel, dst).

    A trail uses an edge once but may come back to a node, so a loop returns to its start. ``rel``
    is the type of the last edge, null for the trail of no edges; ``nodes`` runs from start to end
    and is left out unless asked for. ``starts`` (node) bounds where trails begin: without it,
    everywhere. Edges with a null end are no edges; parallel edges of different types are different
    trails. One equi-join per hop; edges on the way are kept as 64-bit keys.
    """
    if not 0 <= least <= most <= MOST_HOPS:
        raise ValueError(f"walks are bounded by {MOST_HOPS} hops")
    e = edges.where("src is not null and dst is not null").select("src", "rel", "dst", F.xxhash64("src", "rel", "dst").alias("eid"))
    if starts is None:
        begin = e.select(F.col("src").alias("node")).union(e.select("dst")).distinct() if least == 0 else e.select(F.col("src").alias("node")).distinct()
    else:
        begin = starts.select(F.col(starts.columns[0]).alias("node")).where("node is not null").distinct()
    way = [F.array("node").alias("nodes")] if nodes else []
    here = begin.select(F.col("node").alias("start"), F.col("node").alias("end"), F.lit(0).alias("depth"), F.lit(None).cast("string").alias("rel"), *way, F.array().cast("array<bigint>").alias("used"))
    out = here if least == 0 else None
    for hop in range(1, most + 1):
        step = e.select(F.col("src").alias("end"), F.col("rel").alias("r"), F.col("dst").alias("to"), "eid")
        way = [F.concat("nodes", F.array("to")).alias("nodes")] if nodes else []
        here = here.join(step, "end").where(~F.array_contains("used", F.col("eid"))).select(
            "start", F.col("to").alias("end"), F.lit(hop).alias("depth"), F.col("r").alias("rel"), *way, F.concat("used", F.array("eid")).alias("used")
        )
        # what is read twice is written; the last hop is not
        if 1 < hop < most:
            here = cut(here)
        if hop >= least:
            out = here if out is None else out.unionByName(here)
    return out.drop("used")


def shortest(walks: DataFrame) -> DataFrame:
    """Of the trails between two nodes the shortest; of equally long ones the least by type and nodes."""
    return walks.groupBy("start", "end").agg(F.min(F.struct("depth", "rel", "nodes")).alias("x")).select("start", "end", "x.depth", "x.rel", "x.nodes")


def reversed_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), "rel", F.col("src").alias("dst"))


def pagerank(edges: DataFrame, alpha: float = 0.85, rounds: int = 20, tolerance: float | None = None) -> DataFrame:
    """(node, rank) after ``rounds`` of the power method over distinct (src, dst), dangling mass spread evenly.

    With a ``tolerance`` it ends as soon as a round changes all ranks together by less than that.
    Loops and null ends are left out; ranks add up to one; an empty graph gives an empty result.
    """
    e = cut(edges.where("src is not null and dst is not null and src <> dst").select("src", "dst").distinct())
    nodes = cut(e.select(F.col("src").alias("node")).union(e.select("dst")).distinct().join(e.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("out")), "node", "left"))
    n = nodes.count()
    if not n:
        return nodes.select("node", F.lit(0.0).alias("rank"))
    rank = nodes.select("node", "out", F.lit(1.0 / n).alias("rank"))
    for k in range(rounds):
        gone = F.sum(F.when(F.col("out").isNull(), F.col("rank"))).alias("gone")
        dangling = rank.agg(gone).first()[0] or 0.0
        sent = e.join(rank.select(F.col("node").alias("src"), (F.col("rank") / F.col("out")).alias("share")), "src").groupBy(F.col("dst").alias("node")).agg(F.sum("share").alias("got"))
        base = nodes if tolerance is None else rank.withColumnRenamed("rank", "old")
        new = (F.lit((1 - alpha) / n + alpha * dangling / n) + alpha * F.coalesce("got", F.lit(0.0))).alias("rank")
        last = rank
        rank = cut(base.join(sent, "node", "left").select("node", "out", new, *([] if tolerance is None else ["old"])))
        if tolerance is not None:
            moved = rank.agg(F.sum(F.abs(F.col("rank") - F.col("old")))).first()[0]
            rank = rank.drop("old")
        if k:
            drop(last)
        if tolerance is not None:
            if moved < tolerance:
                break
    return rank.select("node", "rank")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): weakly connected components, named by their least node.

    Randomised contraction: each round every node is merged into the first of itself and its
    neighbours in an order drawn anew, and edges between what is merged go on to the next round until
    none is left. A round takes about half of the nodes of a chain and at least one of any component,
    so rounds grow with the logarithm of the nodes, whatever the shape. Loops and null ends are left
    out; an empty graph gives an empty result.

    Rounds are stored as tables, not cut: a cut keeps the estimated size of its plan, a join
    multiplies two of them, and after some twenty rounds that number alone fills the driver.
    """
    spark = edges.sparkSession
    at = f"{checkpoint_dir(spark)}/components-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    def pairs(df: DataFrame, a: str, b: str) -> DataFrame:
        return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()

    e, merged = kept(pairs(edges, "src", "dst"), "edges-0"), []
    while not merged or not e.isEmpty():
        k = len(merged)
        place = lambda n: F.struct(F.xxhash64(F.lit(k), n).alias("h"), F.col(n).alias("into"))  # noqa: B023, E731
        first = e.union(e.select("b", "a")).groupBy(F.col("a").alias("node")).agg(F.min(place("b")).alias("x"))
        into = kept(first.select("node", F.least("x", place("node"))["into"].alias("into")), f"merged-{k}")
        left, right = into.toDF("a", "a_into"), into.toDF("b", "b_into")
        e = kept(pairs(e.join(left, "a").join(right, "b"), "a_into", "b_into"), f"edges-{k + 1}")
        delete(spark, f"{at}/edges-{k}")
        merged.append(into)
    # back from the last round to the first: a node goes where the node it was merged into went
    root = merged.pop()
    while merged:
        root = merged.pop().join(root.toDF("into", "further"), "into", "left").select("node", F.coalesce("further", "into").alias("into"))
    root = kept(root, "roots")
    least = root.groupBy("into").agg(F.min("node").alias("component"))
    out = cut(root.join(least, "into").select("node", "component"))
    delete(spark, at)
    return out


def ego(edges: DataFrame, centre: str, hops: int, most: int = 60) -> DataFrame:
    """(node, depth): the undirected neighbourhood of a node, nearest first, at most ``most`` nodes (a feature: a drawing's limit)."""
    e = edges.select("src", "dst").union(edges.select("dst", "src")).distinct()
    seen = edges.sparkSession.createDataFrame([(centre, 0)], "node string, depth int")
    for hop in range(1, hops + 1):
        new = seen.where(F.col("depth") == hop - 1).join(e, F.col("node") == F.col("src")).select(F.col("dst").alias("node")).distinct()
        seen = cut(seen.unionByName(new.join(seen, "node", "left_anti").withColumn("depth", F.lit(hop))).coalesce(4))
    return seen.orderBy("depth", "node").limit(most)
