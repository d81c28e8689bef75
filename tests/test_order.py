from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabloom.operators import ordered, profile, quantiles


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    n = 1200
    v = np.where(rng.random(n) < 0.34, 5.0, np.round(rng.normal(0, 3, n), 2))
    g = np.where(rng.random(n) < 0.5, "a", np.where(rng.random(n) < 0.9, "b", "c"))
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v, "w": rng.integers(0, 4, n).astype(float)})
    return pdf, spark.createDataFrame(pdf).repartition(5).cache()


def test_row_numbers(skewed):
    pdf, df = skewed
    got = ordered.number_rows(df, ["v", "id"], name="n", start=1).select("id", "n").toPandas().set_index("id")["n"]
    want = pdf.sort_values(["v", "id"]).reset_index(drop=True)["id"]
    assert [got[i] for i in want] == list(range(1, len(pdf) + 1))


def test_running_totals_and_next_values(skewed):
    pdf, df = skewed
    out = ordered.running_totals(df, [F.desc("v"), F.asc("id")], {"upto": "w"}, within=["g"], carry_next=("w",)).toPandas()
    want = pdf.sort_values(["g", "v", "id"], ascending=[True, False, True])
    want["upto"] = want.groupby("g")["w"].cumsum()
    want["next_w"] = want.groupby("g")["w"].shift(-1)
    merged = out.merge(want[["id", "upto", "next_w"]], on="id", suffixes=("", "_want"))
    assert np.allclose(merged["upto"], merged["upto_want"])
    assert merged["next_w"].fillna(-1).equals(merged["next_w_want"].fillna(-1))


@pytest.mark.parametrize("chunk", [200, 333, 100_000])
def test_rolling_mean_across_chunks(skewed, chunk):
    pdf, df = skewed
    out = ordered.rolling_mean(df, ["id"], "v", rows=200, min_rows=20, chunk=chunk).toPandas().sort_values("id")
    want = pdf.sort_values("id")["v"].rolling(200, min_periods=20).mean()
    assert len(out) == len(pdf)
    assert np.allclose(out["rolling_mean"].astype(float).to_numpy(), want.to_numpy(), equal_nan=True)


PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.95, 1.0]


@pytest.mark.parametrize("limit", [1, 2, 10_000])
def test_quantiles_with_a_hot_value(skewed, limit):
    pdf, df = skewed
    rows = quantiles.quantiles(df, ["v", "w"], PROBS, ["g"], radix_groups=limit).collect()
    assert len(rows) == 6
    for r in rows:
        values = pdf.loc[pdf["g"] == r["g"], r["column"]].to_numpy()
        assert r["n"] == len(values)
        assert np.allclose(r["q"], np.quantile(values, PROBS), atol=1e-9)


def test_quantiles_of_constant_null_and_empty_columns(spark):
    df = spark.createDataFrame([(2.0, None), (2.0, None), (2.0, None)], "a double, b double")
    for limit in (0, 100):
        rows = quantiles.quantiles(df, ["a", "b"], [0.1, 0.5], radix_groups=limit).collect()
        assert [(r["column"], r["q"]) for r in rows] == [("a", [2.0, 2.0])]
    assert quantiles.quantiles(df.limit(0), ["a"], [0.5]).count() == 0


def test_describe_uses_exact_quartiles(skewed):
    pdf, df = skewed
    small = {r["column"]: r for r in profile.describe_numeric(df, ["v"]).collect()}["v"]
    want = pdf["v"].describe()
    assert np.allclose([small[k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")], want.to_numpy())


def test_quantiles_of_odd_values_and_groups_with_nulls(spark):
    values = [0.0, -0.0, 1e-310, -1e308, 1e308, float("inf"), -2.5, 3.0, 3.0, float("nan"), None]
    rows = [(g, h, v) for g in ("a", None) for h in ("a", None) for k, v in enumerate(values * 3) if k % 2 or h]
    df = spark.createDataFrame(rows, "g string, h string, v double")
    for limit in (2, 100):
        got = {(r["g"], r["h"]): r for r in quantiles.quantiles(df, ["v"], [0.0, 0.3, 0.5, 1.0], ["g", "h"], radix_groups=limit).collect()}
        assert len(got) == 4
        for (g, h), r in got.items():
            own = sorted(v for a, b, v in rows if (a, b) == (g, h) and v is not None and v == v)
            assert r["n"] == len(own) and r["q"][0] == own[0] and r["q"][3] == own[-1] and r["q"][2] == np.quantile(own, 0.5)


def test_quantiles_take_at_most_six_passes_and_never_join_rows(skewed, monkeypatch):
    _, df = skewed
    cols = ["v", "w", *(f"c{k}" for k in range(8))]
    wide = df.select("g", "v", "w", *((F.col("v") * (k + 1) / 7).alias(f"c{k}") for k in range(8)))
    plans = []
    count = quantiles._digit_counts
    monkeypatch.setattr(quantiles, "_digit_counts", lambda *a: plans.append(count(*a)) or plans[-1])
    assert quantiles.quantiles(wide, cols, PROBS).count() == 10
    assert len(plans) <= 6
    for counts in plans:
        text = counts._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in text and "Sort" not in text


def test_a_hot_key_fills_many_ranges(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, F.lit(-7)).otherwise(F.col("id")).alias("t"))
    frozen = ordered.range_blocks(rows, ["t"], blocks=8)
    sizes = [r["count"] for r in frozen.groupBy("_block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
    number = lambda df: {r["id"]: r["n"] for r in ordered.number_rows(df, ["t"], name="n").collect()}
    once = number(rows)
    assert sorted(once.values()) == list(range(4000)) and once == number(rows.repartition(5))
    assert max(n for i, n in once.items() if i % 2 == 0) - min(n for i, n in once.items() if i % 2 == 0) == 1999
