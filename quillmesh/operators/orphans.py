"""References to records that do not exist: keyed state of parents and references, kept incrementally.

The ledger holds three keyed tables: ``rows`` (every parent row in its latest version), ``index``
(one row per number: the spans of time in which a parent is alive, and what is known of it) and
``references`` (one row per reference with its cause, null while it is resolved). ``advance`` takes
a slice of parent rows (new ones, and known ones again with what changed, such as a deletion) and
of references:

* of a parent row that comes again the later version stands; rows that come unchanged are passed over;
* only the numbers of rows that are new or changed are folded anew and re-probed: an arriving parent
  resolves the orphans that wait for it or changes their cause, a deletion reopens what was resolved;
* a new reference probes the index as of its own time; one that comes again takes its own place.

Advancing slice by slice gives the same state as one advance over the last versions of everything.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.numbers import plain_number
from quillmesh.runtime import cut

#: Parent rows of one number are merged in so many parts first, so that no task holds all rows of a hot number.
SALTS = 32

_SPANS = "array<struct<s: timestamp, e: timestamp>>"
ROWS = "row string, key string, seed boolean, real boolean, s timestamp, e timestamp"
INDEX = f"key string, seed boolean, any_row boolean, first_real timestamp, spans {_SPANS}"
REFERENCES = "id bigint, key string, tbl string, at timestamp, cause string"
_NEVER = "timestamp'9999-12-31 00:00:00'"


def _merged(spans: Column) -> Column:
    """Union of closed-open spans as disjoint sorted spans; an open end is the year 9999."""
    one = "struct<s: timestamp, e: timestamp>"
    start = F.array().cast(f"array<{one}>")

    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        joined = F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e")).cast(one)
        return F.when(
            (F.size(acc) > 0) & (x["s"] <= last["e"]),
            F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(joined)),
        ).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(spans), start, step)


def _fold(rows: DataFrame) -> DataFrame:
    """Parent rows to one row per number; in salted parts first."""
    end = F.coalesce("e", F.expr(_NEVER))
    alive = F.col("real") & F.col("s").isNotNull() & (F.col("s") < end)
    each = rows.select(
        "key",
        F.pmod(F.xxhash64("row"), F.lit(SALTS)).alias("salt"),
        "seed",
        (~F.col("seed")).alias("any_row"),
        F.when(F.col("real"), F.coalesce("s", F.expr(_NEVER))).alias("first_real"),
        F.when(alive, F.array(F.struct(F.col("s").alias("s"), end.alias("e")))).otherwise(F.array()).cast(_SPANS).alias("spans"),
    )

    def level(df: DataFrame, *by: str) -> DataFrame:
        sums = [F.max("seed").alias("seed"), F.max("any_row").alias("any_row"), F.min("first_real").alias("first_real"), F.flatten(F.collect_list("spans")).alias("spans")]
        return df.groupBy(*by).agg(*sums).withColumn("spans", _merged(F.col("spans")))

    return level(level(each, "key", "salt").drop("salt"), "key")


def parent_rows(docs: DataFrame | None, seeds: DataFrame | None) -> DataFrame:
    """Rows of ``docs`` (rec_id, doc_key, is_stub, crawled_at, deleted_at) and ``seeds`` (doc_key) as parent rows.

    A row without a number is no parent; a row that is no stub but has no ``crawled_at`` is never
    alive; one whose ``deleted_at`` is not after its ``crawled_at`` neither. ``rec_id`` tells the
    versions of a row; rows without one are told apart by what they hold. Of two versions in one
    slice the one deleted, else the one crawled later stands.
    """
    parts = []
    if docs is not None:
        real = F.coalesce(F.col("is_stub") == 0, F.lit(False))
        known = docs.select("rec_id", plain_number(F.col("doc_key")).alias("key"), real.alias("real"), F.col("crawled_at").cast("timestamp").alias("s"), F.col("deleted_at").cast("timestamp").alias("e"))
        name = F.coalesce(F.concat(F.lit("r"), F.col("rec_id").cast("string")), F.concat(F.lit("h"), F.xxhash64("key", "real", "s", "e").cast("string")))
        parts.append(known.select(name.alias("row"), "key", F.lit(False).alias("seed"), "real", "s", "e"))
    if seeds is not None:
        none = F.lit(None).cast("timestamp")
        parts.append(seeds.select(plain_number(F.col("doc_key")).alias("key")).select(F.concat(F.lit("s"), "key").alias("row"), "key", F.lit(True).alias("seed"), F.lit(False).alias("real"), none.alias("s"), none.alias("e")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    last = F.max_by(F.struct("key", "seed", "real", "s", "e"), F.struct(F.col("e").isNotNull(), F.col("s"), F.col("e"), F.col("key"), F.col("real")))
    return out.where("key is not null").groupBy("row").agg(last.alias("x")).select("row", "x.*")


def reference_rows(citations: DataFrame, name: str = "citations") -> DataFrame:
    """Rows (id, target_key, scanned_at) as references; blank or null targets refer to nothing."""
    return citations.select(
        F.col("id").cast("bigint").alias("id"),
        plain_number(F.col("target_key")).alias("key"),
        F.lit(name).alias("tbl"),
        F.col("scanned_at").cast("timestamp").alias("at"),
    ).where("key is not null").dropDuplicates(["tbl", "id"])


def _cause() -> Column:
    """The cause of a reference beside the index row of its number; null while it is resolved."""
    live = F.exists("spans", lambda x: (x["s"] <= F.col("at")) & (F.col("at") < x["e"]))
    cause = (
        F.when(F.coalesce("seed", F.lit(False)) | F.coalesce(live, F.lit(False)), F.lit(None))
        .when(~F.coalesce("any_row", F.lit(False)), F.lit("missing"))
        .when(F.col("first_real").isNull(), F.lit("stub"))
        .when(F.col("first_real") <= F.col("at"), F.lit("deleted"))
        .otherwise(F.lit("late"))
    )
    return cause.cast("string")


def probe(refs: DataFrame, index: DataFrame) -> DataFrame:
    """``refs`` with their cause as of ``at``.

    A left equi-join on the number: AQE splits a hot number's partition, the index has one row per
    number.
    """
    return refs.join(index, "key", "left").select("id", "key", "tbl", "at", _cause().alias("cause"))


@dataclass(frozen=True)
class OrphanLedger:
    """The state between slices; its frames can be written to and read from tables."""

    rows: DataFrame
    index: DataFrame
    references: DataFrame
    #: Nothing was taken in yet.
    fresh: bool = False

    @staticmethod
    def empty(spark: SparkSession) -> OrphanLedger:
        return OrphanLedger(*(spark.createDataFrame([], s) for s in (ROWS, INDEX, REFERENCES)), fresh=True)

    def advance(self, references: DataFrame | None = None, parents: DataFrame | None = None) -> OrphanLedger:
        """The ledger after a slice of ``reference_rows`` and ``parent_rows``, either of which may be left out."""
        rows, index, known = self.rows, self.index, self.references
        if self.fresh:
            # the first slice changes nothing, so all of it is new
            rows = rows if parents is None else cut(parents)
            index = index if parents is None else cut(_fold(rows))
            return OrphanLedger(rows, index, known if references is None else cut(probe(references, index)))
        if parents is not None:
            old = rows.select("row", F.struct("key", "seed", "real", "s", "e").alias("old"))
            now = F.struct("key", "seed", "real", "s", "e")
            changed = cut(parents.join(old, "row", "left").where(~now.eqNullSafe(F.col("old"))))
            touched = changed.select("key").union(changed.select("old.key")).where("key is not null").distinct()
            rows = cut(rows.join(changed.select("row"), "row", "left_anti").unionByName(changed.drop("old")))
            folded = touched.join(_fold(rows.join(touched, "key", "left_semi")), "key", "left")
            delta = cut(folded.withColumn("touched", F.lit(True)))
            index = cut(index.join(delta.select("key"), "key", "left_anti").unionByName(delta.where("any_row is not null").drop("touched")))
            cause = F.when(F.col("touched"), _cause()).otherwise(F.col("cause"))
            known = known.join(delta, "key", "left").select("id", "key", "tbl", "at", cause.alias("cause"))
        if references is not None:
            known = known.join(references.select("tbl", "id"), ["tbl", "id"], "left_anti").select("id", "key", "tbl", "at", "cause")
            known = known.unionByName(probe(references, index))
        return OrphanLedger(rows, index, cut(known))

    def orphans(self) -> DataFrame:
        """One row (id, cause) per orphan."""
        return self.references.where("cause is not null").select("id", "cause")

    def snapshot(self) -> DataFrame:
        """Orphans and references per table and month of the reference."""
        return self.references.groupBy("tbl", F.date_format("at", "yyyy-MM").alias("month")).agg(
            F.count(F.lit(1)).alias("n_references"),
            F.count("cause").alias("n_orphans"),
            F.count_if(F.col("cause") == "missing").alias("n_missing"),
            F.count_if(F.col("cause") == "stub").alias("n_stub"),
            F.count_if(F.col("cause") == "deleted").alias("n_deleted"),
            F.count_if(F.col("cause") == "late").alias("n_late"),
        )


#: Periods in which the feeds of a finished table are played to the ledger.
PERIODS = 3


def play(citations: DataFrame, docs: DataFrame, seeds: DataFrame, periods: int = PERIODS) -> OrphanLedger:
    """The ledger after the tables' history, period by period of ``ingested_at``.

    A citation comes in the period it was ingested in; a document row when it was crawled, without
    its deletion if that lies ahead, and again when it was deleted; seeds come first. The last
    period takes all that is later, rows without a time come in the first. Null or blank targets
    are no references; a null ``scanned_at`` meets only seeds as alive; repeated rows give one
    orphan; empty tables give an empty result; extra columns are not read.
    """
    first, last = citations.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    edges = [first + (last - first) * k / periods for k in range(1, periods)] if first else []
    ledger = OrphanLedger.empty(citations.sparkSession)
    for k in range(len(edges) + 1):
        lo, hi = (F.lit(edges[k - 1]) if k else None), (F.lit(edges[k]) if k < len(edges) else None)

        def within(c: str, lo=lo, hi=hi) -> Column:
            t = F.col(c)
            late = t.isNull() | (t < hi) if hi is not None else F.lit(True)
            return late if lo is None else late & t.isNotNull() & (t >= lo)

        gone = F.col("deleted_at").isNotNull() & within("deleted_at")
        seen = docs.where(within("crawled_at") | gone).select("rec_id", "doc_key", "is_stub", "crawled_at", F.when(F.lit(hi is None) | gone | (F.col("deleted_at") < (lo if lo is not None else F.lit(None))), F.col("deleted_at")).alias("deleted_at"))
        ledger = ledger.advance(reference_rows(citations.where(within("ingested_at"))), parent_rows(seen, None if k else seeds))
    return ledger


def find_orphans(citations: DataFrame, docs: DataFrame, seeds: DataFrame) -> OrphanLedger:
    """The ledger after one advance over everything; see ``play`` for the cases."""
    return OrphanLedger.empty(citations.sparkSession).advance(reference_rows(citations), parent_rows(docs, seeds))
