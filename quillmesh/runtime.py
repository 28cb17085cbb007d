"""Session helpers: durable lineage cuts, bounded broadcasts, table reading."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only after its row count was measured and is at most this.
BROADCAST_ROWS = 20_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stored tables.

    It is the cluster's ``spark.checkpoint.dir``. Where that is unset a temporary folder is made,
    but only on a local master (tests, a laptop): elsewhere it would lie on each machine's own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="quillmesh-ckpt-", dir=os.environ.get("TMPDIR"))
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    The copy is in the shared folder, so the loss of an executor does not lose it.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(df: DataFrame) -> None:
    """Delete the copy that ``cut`` made of ``df``; for states of a loop that a later one has replaced."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        if leaf.nodeName().startswith("LogicalRDD") or leaf.getClass().getSimpleName() == "LogicalRDD":
            file = leaf.rdd().getCheckpointFile()
            if file.isDefined():
                delete(df.sparkSession, file.get())


def stored(df: DataFrame, *sort: str) -> DataFrame:
    """``df`` written as a table in the shared folder, in ranges of ``sort`` and sorted by it, so that filters on it skip files and row groups."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    rows = df.repartitionByRange(*sort).sortWithinPartitions(*sort) if sort else df
    rows.write.option("parquet.block.size", 8 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes a core up to which an input is spread evenly before Python reads it.
SPREAD_BYTES = 2 << 20


def spread(df: DataFrame) -> DataFrame:
    """A small input, whose files may be fewer than the cores, evenly over the cores; a large one as it lies.

    Only where the work is: what Spark knows of the size decides, and rows are the same either way.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(2 * cores) if size <= SPREAD_BYTES * cores else df


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else unchanged (a shuffle join follows)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
