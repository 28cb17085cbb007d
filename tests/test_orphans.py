import random
from datetime import datetime, timedelta

import pytest

from quillmesh.operators.orphans import OrphanLedger, find_orphans, parent_rows, play, reference_rows

DOCS = "rec_id long, doc_key string, is_stub int, crawled_at timestamp, deleted_at timestamp, key string, cause string"
CITES = "id long, target_key string, scanned_at timestamp, ingested_at timestamp, key string, at string, salt int, cause string"
DAY = datetime(2023, 1, 1)


def day(n):
    return None if n is None else DAY + timedelta(days=n)


def plain(s):
    s = (s or "").upper().replace(" ", "").replace("SỐ:", "").replace("–", "-").lstrip("0")
    return s or None


def brute(cites, docs, seeds):
    out = {}
    for i, target, at in cites:
        k = plain(target)
        if k is None or k in {plain(s) for s in seeds}:
            continue
        rows = [d for d in docs if plain(d[0]) == k]
        if any(s == 0 and c is not None and at is not None and c <= at and (x is None or x > at) for _, s, c, x in rows):
            continue
        real = [d for d in rows if d[1] == 0]
        if not rows:
            out[i] = "missing"
        elif not real:
            out[i] = "stub"
        elif any(c is not None and at is not None and c <= at for _, _, c, _ in real):
            out[i] = "deleted"
        else:
            out[i] = "late"
    return out


def frames(spark, cites, docs, seeds):
    c = spark.createDataFrame([(*r, r[2] and r[2] + timedelta(days=r[0] % 9), "x", "y", 1, "z") for r in cites], CITES)
    d = spark.createDataFrame([(*(r if len(r) == 5 else (i, *r)), "x", "y") for i, r in enumerate(docs)], DOCS)
    return c, d, spark.createDataFrame([(s,) for s in seeds], "doc_key string")


def made(seed, n=300):
    rng = random.Random(seed)
    keys = [f"{k}/QĐ-A" for k in range(12)]
    docs = [(rng.choice(keys), rng.choice([0, 0, 1]), day(a := rng.choice([None, *range(60)])), day(rng.choice([None, None, (a or 0) + rng.randint(0, 20)]))) for _ in range(40)]
    typed = lambda k: rng.choice([k, "Số: " + k, "00" + k, k.lower(), k.replace("-", "–")])
    cites = [(i, rng.choice([None, "", "  ", *map(typed, keys), "99/KH-B"]), day(rng.choice([None, *range(80)]))) for i in range(n)]
    cites += rng.sample(cites, 20)  # whole rows repeated
    cites += [(1000 + i, keys[0], day(i % 70)) for i in range(150)]  # one key holds a third
    return cites, docs, ["3/QĐ-A"]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    cites, docs, seeds = made(seed)
    tables = frames(spark, cites, docs, seeds)
    for ledger in (find_orphans(*tables), play(*tables)):
        got = ledger.orphans().collect()
        assert len(got) == len({r["id"] for r in got})
        assert {r["id"]: r["cause"] for r in got} == brute(cites, docs, seeds)


def test_slices_with_changed_rows_give_the_last_state(spark):
    """Rows are seen again: crawled, deleted, taken for a stub, given another number; citations come again too."""
    rng = random.Random(3)
    cites, docs, seeds = made(3, 90)
    docs = docs[:25]
    ledger, current = OrphanLedger.empty(spark), {}
    for part in range(4):
        some = {}
        for i in rng.sample(range(len(docs)), 12):
            k, stub, crawled, gone = current.get(i, docs[i])
            if i in current:
                change = rng.randrange(4)
                gone = [day(rng.randint(0, 70)), None, gone, gone][change]
                stub = 1 - stub if change == 2 else stub
                k = f"{rng.randrange(12)}/QĐ-A" if change == 3 else k
            some[i] = (k, stub, crawled, gone)
        current |= some
        mine = [c for c in cites if c[0] % 4 == part or c[0] % 7 == 0]
        ledger = ledger.advance(reference_rows(frames(spark, mine, [], [])[0]), parent_rows(frames(spark, [], [(i, *d) for i, d in some.items()], [])[1], frames(spark, [], [], seeds)[2] if part == 2 else None))
    got = {r["id"]: r["cause"] for r in ledger.orphans().collect()}
    assert got == brute(cites, list(current.values()), seeds)
    whole = find_orphans(*frames(spark, cites, [(i, *d) for i, d in current.items()], seeds))
    assert {tuple(r) for r in ledger.snapshot().collect()} == {tuple(r) for r in whole.snapshot().collect()}


def test_deletion_reopens(spark):
    c, d, s = frames(spark, [(1, "1/A-B", day(10)), (2, "1/A-B", day(3))], [(7, "1/A-B", 0, day(1), None)], [])
    ledger = OrphanLedger.empty(spark).advance(reference_rows(c), parent_rows(d, s))
    assert ledger.orphans().count() == 0
    gone = lambda *row: parent_rows(frames(spark, [], [row], [])[1], None)
    ledger = ledger.advance(parents=gone(7, "1/A-B", 0, day(1), day(5)))
    assert [tuple(r) for r in ledger.orphans().collect()] == [(1, "deleted")]
    ledger = ledger.advance(parents=gone(8, "2/A-B", 0, day(1), day(2)))
    assert [tuple(r) for r in ledger.orphans().collect()] == [(1, "deleted")]
    ledger = ledger.advance(parents=gone(9, "1/A-B", 0, day(8), None))
    assert ledger.orphans().count() == 0
    ledger = ledger.advance(parents=gone(9, "3/A-B", 0, day(8), None))
    assert [tuple(r) for r in ledger.orphans().collect()] == [(1, "deleted")]


def test_empty_tables(spark):
    c, d, s = frames(spark, [], [], [])
    assert find_orphans(c, d, s).orphans().count() == 0 and play(c, d, s).orphans().count() == 0
    c, _, _ = frames(spark, [(1, "1/A-B", None)], [], [])
    assert [tuple(r) for r in find_orphans(c, d, s).orphans().collect()] == [(1, "missing")]
    assert [tuple(r) for r in play(c, d, s).orphans().collect()] == [(1, "missing")]
