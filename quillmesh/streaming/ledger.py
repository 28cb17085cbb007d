"""The orphan ledger and record intake as streams over files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillmesh.operators.orphans import INDEX, REFERENCES, ROWS, OrphanLedger, parent_rows, reference_rows

_TABLES = {"rows": ROWS, "index": INDEX, "references": REFERENCES}


class LedgerStore:
    """The ledger's tables in a shared folder, one version a batch; a batch that comes again writes the same version.

    A version that is missing is an error, never an empty ledger. Two versions are kept: the last
    one, and the one before it that a repeated batch starts from.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def load(self, version: int) -> OrphanLedger:
        """The ledger after batch ``version``; -1 is the beginning."""
        if version < 0:
            return OrphanLedger.empty(self.spark)
        return OrphanLedger(*(self.spark.read.schema(s).parquet(f"{self.folder}/{version}/{t}") for t, s in _TABLES.items()))

    def save(self, ledger: OrphanLedger, version: int) -> None:
        for t in _TABLES:
            getattr(ledger, t).write.mode("overwrite").parquet(f"{self.folder}/{version}/{t}")
        if version > 1:
            self._drop(f"{self.folder}/{version - 2}")

    def _drop(self, path: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def follow_citations(spark: SparkSession, stream: DataFrame, docs: DataFrame, seeds: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Advances a ledger with every micro-batch of new citations (id, target_key, scanned_at).

    The parent tables are compared with the ledger at each batch; only numbers of rows that are new
    or changed since are probed again, so numbers that arrive later resolve what waits and deletions
    reopen it. State is versioned by batch: a batch repeated after a failure reads the version before it.
    """
    store = LedgerStore(spark, folder)

    def advance(batch: DataFrame, n: int) -> None:
        store.save(store.load(n - 1).advance(references=reference_rows(batch), parents=parent_rows(docs, seeds)), n)

    return stream.writeStream.foreachBatch(advance).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events per type and window of event time, closed by a watermark; works on streams and tables alike."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(
        F.col("w.start").alias("from_ts"), "event_type", "n", F.round("total", 4).alias("total")
    )
