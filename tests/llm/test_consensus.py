import random
from collections import Counter
from datetime import datetime, timedelta

from quillmesh.llm.consensus import LABELS, agreement, consensus, estimate_labels, estimate_numbers, judgements, reliability

SCHEMA = "row_no long, id long, nguoi_gan string, nhan string, dich_dung string, so_hieu_duoc_nhac string, gan_luc timestamp, label string, annotator string"
T0 = datetime(2023, 1, 1)


def made(seed=1, items=150):
    rng = random.Random(seed)
    truth = {i: rng.choice(LABELS) for i in range(items)}
    number = {i: "" if rng.random() < 0.8 else f"{i}/QĐ-X" for i in truth}
    skill = {f"a{k}": 0.9 for k in range(3)} | {f"s{k}": 0.9 for k in range(2)} | {f"r{k}": 0.0 for k in range(4)}
    rows, n = [], 0
    for i in truth:
        for a, s in skill.items():
            right = truth[i]
            if a[0] == "s":  # takes two labels for each other, and is no less useful for that
                right = {"BASED_ON": "REFERENCES", "REFERENCES": "BASED_ON"}.get(right, right)
            said = right if rng.random() < s else rng.choice(LABELS)
            num = number[i] if rng.random() < (0.95 if s > 0.5 else 0.5) else rng.choice(["", f"{rng.randint(500, 900)}/KH-Y"])
            typed = rng.choice([said, said.lower().replace("_", " "), said + "."])
            rows.append((n, i, a, typed, rng.choice([num.lower(), "Số: " + num]) if num else rng.choice([None, "", "7/A-B"]), "7/A-B", T0 + timedelta(hours=n), "", ""))
            n += 1
    return rows, truth, number


def test_better_than_the_majority(spark):
    rows, truth, number = made()
    rows = [r if r[3] is None else r for r in rows]
    again = (10**6, 0, "a0", truth[0], number[0] or None, "7/A-B", T0 + timedelta(days=999), "", "")
    df = spark.createDataFrame([*rows, *rows[:20], again], SCHEMA)
    got = {r["id"]: (r["nhan"], r["dich_dung"]) for r in consensus(df).collect()}
    assert set(got) == set(truth)
    right = sum(got[i][0] == truth[i] for i in truth)
    votes = {i: Counter(r[3].upper().rstrip(".").replace(" ", "_") for r in rows if r[1] == i) for i in truth}
    plain = sum(v.most_common(1)[0][0] == truth[i] for i, v in votes.items())
    assert right > plain and right >= 0.95 * len(truth)
    assert sum(got[i][1] == number[i] for i in truth) >= 0.97 * len(truth)
    acc = {r["annotator"]: r["accuracy"] for r in reliability(df).collect()}
    assert min(acc[f"a{k}"] for k in range(3)) > max(x for a, x in acc.items() if a[0] != "a")


def test_agreement(spark):
    mk = lambda rows: spark.createDataFrame([(n, i, a, x, None, "1/A", T0, "", "") for n, (i, a, x) in enumerate(rows)], SCHEMA)
    of = lambda df: {r["field"]: r for r in agreement(df).collect()}["nhan"]
    full = of(mk([(1, "a", "AMENDS"), (1, "b", "AMENDS"), (2, "a", "REPEALS"), (2, "b", "REPEALS"), (3, "a", "KHONG")]))
    assert full["n_items"] == 2 and full["alpha"] == 1.0
    none = of(mk([]))
    assert none["n_items"] == 0 and none["alpha"] is None


def test_corner_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert consensus(empty).count() == 0
    odd = spark.createDataFrame(
        [(1, 1, "a", None, None, None, None, "", ""), (2, 2, "a", "?", "", None, T0, "", ""), (3, 3, "a", "Thay thế", " 5/A–B ", "05/A-B", T0, "", ""), (4, None, "a", "AMENDS", None, None, T0, "", ""), (5, 3, None, "AMENDS", None, None, T0, "", "")],
        SCHEMA,
    )
    assert {tuple(r) for r in consensus(odd).collect()} == {(1, "REPLACES", ""), (2, "REPLACES", ""), (3, "REPLACES", "")}


def test_joined_rounds_give_the_same(spark, monkeypatch):
    rows, *_ = made(2, 60)
    said = judgements(spark.createDataFrame(rows, SCHEMA))
    labels, numbers = said.where("label is not null").select("id", "annotator", "label"), said.select("id", "annotator", "number")
    both = []
    for most in (20_000, 1):
        monkeypatch.setattr("quillmesh.llm.consensus.ANNOTATORS", most)
        posts, counts = estimate_labels(labels)
        both.append(
            (
                {r["id"]: [round(x, 5) for x in r[1:]] for r in posts.collect()},
                {(r["annotator"], r["label"]): [round(x, 3) for x in r[2:]] for r in counts.collect()},
                {r["id"]: r["number"] for r in estimate_numbers(numbers).collect()},
            )
        )
    assert both[0] == both[1]


def test_agreement_of_numbers(spark):
    rows = [(n, i, a, "AMENDS", x, "1/A", T0, "", "") for n, (i, a, x) in enumerate([(1, "a", ""), (1, "b", "01/a"), (2, "a", "7/B"), (2, "b", "Số 7/B"), (3, "a", "8/C"), (3, "b", None)])]
    got = {r["field"]: r for r in agreement(spark.createDataFrame(rows, SCHEMA)).collect()}["dich_dung"]
    # pairs that agree: items 1 and 2 of 3; answers "" 3, 7/B 2, 8/C 1
    assert (got["n_items"], got["n_labels"], got["observed"], got["expected"]) == (3, 6, round(4 / 6, 6), round(8 / 30, 6))
    assert got["alpha"] == round((4 / 6 - 8 / 30) / (1 - 8 / 30), 6)
