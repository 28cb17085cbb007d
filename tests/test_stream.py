import pytest

from quillmesh.operators.orphans import find_orphans
from quillmesh.streaming.ledger import LedgerStore, follow_citations, windowed_counts


def test_ledger_follows_files(spark, small, tmp_path):
    c, d, s = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("citations", "docs", "docs_seed"))
    c.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(c.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    q = follow_citations(spark, stream, d, s, str(tmp_path / "state"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert q.exception() is None
    last = q.lastProgress["batchId"]
    got = LedgerStore(spark, str(tmp_path / "state")).load(last).orphans()
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in find_orphans(c, d, s).orphans().collect()}
    with pytest.raises(Exception):
        LedgerStore(spark, str(tmp_path / "state")).load(last + 5)
    assert not (tmp_path / "state" / str(last - 2)).exists()


def test_windows(spark, small):
    e = spark.read.parquet(f"{small}/events.parquet")
    assert windowed_counts(e).agg({"n": "sum"}).first()[0] == e.count()
