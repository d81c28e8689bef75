from __future__ import annotations

import datetime as dt
import random

import pytest

from tabloom.operators import split


def walk(times, train, val):
    """Plain reading of the rule: whole timestamp groups, at most one step to the next split after each group."""
    n = len(times)
    goals = {"train": int(n * train), "val": int(n * (train + val))}
    out, seen, now = {}, 0, "train"
    for t in sorted(set(times)):
        out[t] = now
        seen += times.count(t)
        if now in goals and seen >= goals[now]:
            now = "val" if now == "train" else "test"
    return out


START = dt.datetime(2024, 1, 1)
CASES = [
    ("spread", [START + dt.timedelta(hours=i) for i in range(50)], (0.7, 0.15, 0.15)),
    ("hot first", [START] * 40 + [START + dt.timedelta(days=i) for i in range(1, 11)], (0.7, 0.15, 0.15)),
    ("one group", [START] * 5, (0.7, 0.15, 0.15)),
    ("one row", [START], (0.7, 0.15, 0.15)),
    ("no train", [START + dt.timedelta(seconds=i) for i in range(10)], (0.0, 0.5, 0.5)),
    ("no val", [START + dt.timedelta(microseconds=i) for i in range(10)], (0.8, 0.0, 0.2)),
    ("no test", [START + dt.timedelta(microseconds=3 * i) for i in range(10)], (0.5, 0.5, 0.0)),
    ("hot middle", [START] * 3 + [START + dt.timedelta(seconds=1)] * 30 + [START + dt.timedelta(seconds=2)] * 2, (0.7, 0.15, 0.15)),
]


def random_cases():
    rng = random.Random(5)
    for i in range(4):
        steps = [rng.choice([1, 1000, 1_000_000, 86_400_000_000]) for _ in range(30)]
        pool = [START + dt.timedelta(microseconds=sum(steps[:j])) for j in range(30)]
        yield (f"random {i}", [rng.choice(pool[: rng.randint(1, 30)]) for _ in range(60)], rng.choice([(0.7, 0.15, 0.15), (0.5, 0.25, 0.25), (0.2, 0.1, 0.7)]))


@pytest.mark.parametrize(("name", "times", "fractions"), [*CASES, *random_cases()], ids=lambda v: v if isinstance(v, str) else "")
def test_time_split_equals_the_walk(spark, name, times, fractions):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "row_id int, t timestamp_ntz")
    rows, cuts = split.time_split(df, time_col="t", train=fractions[0], val=fractions[1], test=fractions[2])
    want = walk(times, fractions[0], fractions[1])
    assert {(r["row_id"], r["split"]) for r in rows.collect()} == {(i, want[t]) for i, t in enumerate(times)}
    assert cuts.rows == len(times)


def test_time_split_checks(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "bad")], "row_id string, t string")
    with pytest.raises(ValueError, match="No chronological split"):
        split.time_split(df, time_col="t")
    with pytest.raises(KeyError):
        split.time_split(df, time_col="absent")
    with pytest.raises(ValueError):
        split.time_split(df, time_col="t", train=0.9)
    empty, cuts = split.time_split(df.limit(0), time_col="t")
    assert empty.count() == 0 and cuts.rows == 0


def test_quotas_match_published_supports():
    quotas = split.stratified_quotas({"DDoS": 13428, "Intrusion": 13265, "Malware": 13307}, 0.7, 0.15, 0.15)
    rest = {"DDoS": 13428, "Intrusion": 13265, "Malware": 13307}
    assert {c: rest[c] - sum(q) for c, q in quotas.items()} == {"DDoS": 2014, "Intrusion": 1990, "Malware": 1996}
    assert sum(q[0] for q in quotas.values()) == 28000 and sum(q[1] for q in quotas.values()) == 6000


def test_stratified_split_is_exact_with_a_hot_class(spark):
    rows = [(f"r{i}", "hot" if i % 3 else f"c{i % 5}") for i in range(900)]
    df = spark.createDataFrame([*rows, ("none", None)], "row_id string, y string")
    out = split.stratified_split(df, label_col="y").cache()
    counts = {}
    for _, y in rows:
        counts[y] = counts.get(y, 0) + 1
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    for y, (a, b) in split.stratified_quotas(counts, 0.7, 0.15, 0.15).items():
        assert (got.get((y, "train"), 0), got.get((y, "val"), 0), got.get((y, "test"), 0)) == (a, b, counts[y] - a - b)
    assert out.count() == 900
    again = split.stratified_split(df.repartition(5), label_col="y")
    assert again.exceptAll(out).isEmpty()
    assert not split.stratified_split(df, label_col="y", seed=7).exceptAll(out).isEmpty()


def test_split_join_checks(spark):
    clean = spark.createDataFrame([("row_000000", "DDoS", 1.0), ("row_000001", "Intrusion", 2.0), ("row_000002", "Malware", 3.0)], "row_id string, `Attack Type` string, `Feature A` double")
    marks = spark.createDataFrame([("row_000000", "DDoS", "train"), ("row_000001", "Intrusion", "val"), ("row_000002", "Malware", "test")], "row_id string, `Attack Type` string, split string")
    joined = split.join_split(clean, marks, label_col="Attack Type")
    assert {s: split.only_split(joined, s).count() for s in split.SPLITS} == {"train": 1, "val": 1, "test": 1}
    assert "Attack Type" in joined.columns and len(joined.columns) == 4
    wrong = marks.replace("DDoS", "Malware")
    with pytest.raises(ValueError, match="Target label mismatch"):
        split.join_split(clean, wrong, label_col="Attack Type")
    with pytest.raises(ValueError, match="0 rows in common"):
        split.join_split(clean, marks.filter("row_id = 'x'"), label_col="Attack Type")
    with pytest.raises(ValueError):
        split.join_split(clean, marks.drop("split"))
    unlabelled = split.join_split(clean, marks.drop("Attack Type"), label_col="Attack Type")
    assert unlabelled.count() == 3
    with pytest.raises(ValueError, match="1 rows have no split"):
        split.attach_split(clean, marks.filter("split <> 'val'"))


def test_fixed_sample(spark):
    df = spark.range(100)
    assert split.fixed_sample(df, 10, id_col="id").count() == 10
    assert split.fixed_sample(df, 1000, id_col="id").count() == 100


def test_instants_on_a_day_with_a_repeated_hour(spark):
    """Clocks went back in New York on 2024-11-03; the split follows the instants, not the local times."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        start = 1730610000  # 2024-11-03 05:00 UTC, inside the first pass of the repeated hour
        df = spark.range(8).selectExpr("id AS row_id", f"timestamp_seconds({start} + id * 1800) AS t")
        rows, _ = split.time_split(df, time_col="t", train=0.5, val=0.25, test=0.25)
        assert [r["split"] for r in rows.orderBy("row_id").collect()] == ["train"] * 4 + ["val"] * 2 + ["test"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_dates(spark):
    df = spark.range(10).selectExpr("id AS row_id", "date_add(date'2024-01-01', cast(id / 2 AS int)) AS d")
    rows, _ = split.time_split(df, time_col="d", train=0.6, val=0.2, test=0.2)
    assert [r["split"] for r in rows.orderBy("row_id").collect()] == ["train"] * 6 + ["val"] * 2 + ["test"] * 2
