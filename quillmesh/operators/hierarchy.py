"""Parent-child links of unknown depth: root, depth, path, subtree size and descendants of each node.

Bottom-up leaf peeling: each round takes away the leaves (nodes that are nobody's parent any more),
which send the size of what lies below them to their parents, so that a parent goes only after all
below it. Peeling alone takes as many rounds as the longest chain; so each round also splices out
single-child nodes whose hash is a local minimum, which shortens every chain by a constant factor
and leaves O(log n) rounds. The rounds are then undone in reverse, assigning root, depth and path
from the parent. What is never peeled is a loop, spliced down to one node that refers to itself and
carries the others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmesh.runtime import cut

#: Rounds to be expected for any input are about 3 log2(n); beyond this something is wrong.
MAX_ROUNDS = 400
_MID = "array<struct<node: string, own: bigint>>"


def _edges(links: DataFrame, child: str, parent: str) -> DataFrame:
    """Distinct links without nulls; of two parents of one child the smallest stands."""
    return (
        links.select(F.col(child).alias("child"), F.col(parent).alias("parent"))
        .where("child is not null and parent is not null")
        .groupBy("child")
        .agg(F.min("parent").alias("parent"))
    )


def further_parents(links: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """(child, parent) of the links that a hierarchy leaves out because the child has a smaller parent too."""
    every = links.select(F.col(child).alias("child"), F.col(parent).alias("parent")).where("child is not null and parent is not null").distinct()
    first = every.groupBy("child").agg(F.min("parent").alias("first"))
    return every.join(first, "child").where("parent <> first").select("child", "parent")


def hierarchy(links: DataFrame, child: str = "child", parent: str = "parent", paths: bool = True) -> DataFrame:
    """One row per node on either side of a link: node, root, depth; with ``paths`` also path, subtree_size, place and around.

    A root has depth 0. A node on a loop, or whose way up ends in one, has depth -1 and the loop's
    smallest key as root. Links with a null end are dropped; repeated links count once; of several
    parents the smallest key stands (``further_parents`` has the rest); an empty table gives an
    empty result. ``path`` runs to the node from its root, or from the first node above it that is on
    a loop; a node on a loop is its whole path. So a chain of n nodes gives n^2/2 entries.
    ``subtree_size`` counts the node and all below it; of a node on a loop, all of the loop and all
    below that. ``around`` is the length of the node's loop and ``place`` its place there, each
    next one its parent; null elsewhere.
    """
    parts = int(links.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edges = cut(_edges(links, child, parent))
    nodes = edges.select(F.col("child").alias("node")).union(edges.select("parent")).distinct()
    # mid: nodes spliced out between child and parent, top first, with the size of what they hold beside the way down;
    # acc: size of what was peeled off below child; low: smallest key of child and mid
    residual = edges.select("child", "parent", F.lit(1).alias("w"), F.array().cast(_MID).alias("mid"), F.lit(0).cast("bigint").alias("acc"), F.col("child").alias("low"))
    done: list[DataFrame] = []
    sizes: list[DataFrame] = []
    sent: list[DataFrame] = []
    for k in range(MAX_ROUNDS):
        h = lambda c: F.xxhash64(F.col(c), F.lit(k))
        free = (F.col("n") == 1) & (F.col("child") != F.col("parent")) & (h("child") < h("parent")) & (h("child") < h("kid"))
        if paths:
            # a node whose only child is peeled in this round has to wait for what that sends
            own = residual.groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n"))
            seen = residual.join(own, residual["child"] == own["of"], "left").drop("of")
            kids = seen.groupBy(F.col("parent").alias("of")).agg(F.max("child").alias("kid"), F.max("n").alias("below"))
            seen = seen.join(kids, seen["child"] == kids["of"], "left")
            free = free & F.col("below").isNotNull()
        else:
            kids = residual.groupBy(F.col("parent").alias("of")).agg(F.count(F.lit(1)).alias("n"), F.max("child").alias("kid"))
            seen = residual.join(kids, residual["child"] == kids["of"], "left")
        # rake: nobody's parent; splice: one child, a parent of its own, smallest hash among these
        what = F.when(F.col("n").isNull(), F.lit("rake")).when(free, F.lit("splice")).otherwise(F.lit("keep"))
        marked = cut(seen.withColumn("what", what).select(*residual.columns, "what"))
        done.append(marked)
        kept = marked.where("what = 'keep'")
        up = marked.where("what = 'splice'").select(
            F.col("child").alias("parent"),
            F.col("parent").alias("up"),
            F.col("w").alias("up_w"),
            F.col("mid").alias("up_mid"),
            F.col("acc").alias("up_acc"),
            F.col("low").alias("up_low"),
        )
        spliced = F.struct(F.col("parent").alias("node"), (F.col("up_acc") + 1).alias("own"))
        mid = F.when(F.col("up").isNotNull(), F.concat("up_mid", F.array(spliced), "mid")).otherwise(F.col("mid"))
        residual = kept.join(up, "parent", "left").select(
            "child",
            F.coalesce("up", "parent").alias("parent"),
            (F.col("w") + F.coalesce("up_w", F.lit(0))).alias("w"),
            (mid if paths else F.col("mid")).alias("mid"),
            "acc",
            F.least("low", "up_low").alias("low"),
        )
        if paths:
            raked = marked.where("what = 'rake'").withColumn("below", _held("mid", F.col("acc") + 1))
            sizes.append(raked.select(F.explode(F.concat(F.array(F.struct(F.col("child").alias("node"), (F.col("acc") + 1).alias("own"))), "below")).alias("x")).select("x.node", F.col("x.own").alias("subtree_size")))
            up_sent = raked.groupBy("parent").agg(F.sum(F.col("acc") + 1 + _total("mid")).alias("more"))
            sent.append(up_sent)
            residual = residual.join(up_sent.withColumnRenamed("parent", "child"), "child", "left").withColumn("acc", F.col("acc") + F.coalesce("more", F.lit(0))).drop("more")
        if kept.where("child <> parent").isEmpty():
            break
    else:
        raise RuntimeError("peeling did not end")
    residual = cut(residual)
    # roots, and the loops that are left as nodes referring to themselves, the others in their mid
    none = F.lit(None)
    ways = lambda path: [path.cast("array<string>").alias("path")]
    roots = nodes.join(edges.select(F.col("child").alias("node")), "node", "left_anti").select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), *ways(F.array("node") if paths else none))
    members = residual.select(F.col("low").alias("root"), F.posexplode(F.concat(F.array("child"), F.reverse(F.transform("mid", lambda m: m["node"])))).alias("place", "node"), (F.size("mid") + 1).alias("around"), (F.col("acc") + 1 + _total("mid")).alias("subtree_size"))
    members = cut(members)
    loops = members.select("node", "root", F.lit(-1).alias("depth"), *ways(F.array("node") if paths else none))
    known = cut(roots.unionByName(loops).coalesce(parts))
    for r, marked in enumerate(reversed(done)):
        for step in ("splice", "rake"):
            above = known.select(F.col("node").alias("parent"), "root", F.col("depth").alias("d"), F.col("path").alias("p"))
            found = marked.where(F.col("what") == step).join(above, "parent").select(
                F.col("child").alias("node"),
                "root",
                F.when(F.col("d") < 0, F.lit(-1)).otherwise(F.col("d") + F.col("w")).alias("depth"),
                *ways(F.concat("p", F.transform("mid", lambda m: m["node"]), F.array("child")) if paths else none),
            )
            if paths and step == "splice":
                # those on a loop are known already
                found = found.join(members.select("node"), "node", "left_anti")
            known = known.unionByName(found)
        if r % 2:
            known = cut(known.coalesce(parts))
    if not paths:
        return known.drop("path")
    # every node that is no root and on no loop was peeled, or spliced and then counted with the one below it
    peeled = reduce(DataFrame.unionByName, sizes) if sizes else known.select("node", F.lit(1).cast("bigint").alias("subtree_size")).limit(0)
    tops = reduce(DataFrame.unionByName, sent).join(roots.select(F.col("node").alias("parent")), "parent", "left_semi")
    tops = tops.groupBy(F.col("parent").alias("node")).agg((F.sum("more") + 1).alias("subtree_size"))
    counted = peeled.unionByName(tops).unionByName(members.select("node", "subtree_size"))
    return known.join(counted, "node", "left").join(members.select("node", "place", "around"), "node", "left").select("node", "root", "depth", "path", "subtree_size", "place", "around")


def _total(mid: str):
    """What the spliced nodes of an edge hold, themselves included."""
    return F.aggregate(mid, F.lit(0).cast("bigint"), lambda acc, m: acc + m["own"])


def _held(mid: str, below):
    """(node, size) of the spliced nodes of an edge, ``below`` being what hangs at its lower end: sums from the bottom up."""
    start = F.struct(below.cast("bigint").alias("n"), F.array().cast(_MID).alias("out"))

    def step(acc, m):
        n = acc["n"] + m["own"]
        return F.struct(n.alias("n"), F.concat(acc["out"], F.array(F.struct(m["node"].alias("node"), n.alias("own")))).alias("out"))

    return F.aggregate(F.reverse(mid), start, step)["out"]


def descendants(tree: DataFrame) -> DataFrame:
    """Pairs (node, descendant, distance) of a ``hierarchy`` made with paths.

    Each path gives a pair for every node on it, as many rows as the result has. A node on a loop has
    the other nodes of the loop below it, and all that is below any of them.
    """
    own = tree.where("size(path) > 1").select(F.col("node").alias("descendant"), F.size("path").alias("n"), F.posexplode("path").alias("pos", "node")).where("pos < n - 1")
    own = own.select("node", "descendant", (F.col("n") - 1 - F.col("pos")).alias("distance"))
    loop = tree.where("around > 1")
    a = loop.select("root", F.col("node").alias("top"), F.col("place").alias("i"), "around")
    b = loop.select("root", "node", F.col("place").alias("j"))
    # members of one loop, whose size is that of the result
    round_ = a.join(b, "root").where("i <> j").select("top", "node", F.pmod(F.col("i") - F.col("j"), F.col("around")).alias("steps"))
    further = own.join(round_, "node").select(F.col("top").alias("node"), "descendant", (F.col("distance") + F.col("steps")).alias("distance"))
    return own.unionByName(further).unionByName(round_.select(F.col("top").alias("node"), F.col("node").alias("descendant"), F.col("steps").alias("distance")))


def subtree_sizes(tree: DataFrame) -> DataFrame:
    """(node, subtree_size): the node and all below it, as it was sent upwards while peeling."""
    return tree.select("node", "subtree_size")
