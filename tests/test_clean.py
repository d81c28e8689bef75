from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabloom.operators import clean, features
from tabloom.operators.profile import audit_actions, audit_config, feature_audit, histogram
from tabloom.plans.prepare import TableSpec, clean_table


def test_cleaning_a_raw_table(spark):
    rows = [
        ("2024-01-06 10:00:00", " 80 ", "DDoS"),
        ("never", "http", " Malware"),
        (None, "1e3", "nan"),
        ("2024-01-07T00:00:00Z", "0x10", "Intrusion"),
        ("2024-01-08", "12d", ""),
    ]
    raw = spark.createDataFrame(rows, "` Timestamp` string, `Source Port ` string, `Attack Type` string")
    out = clean_table(raw, TableSpec())
    assert out.columns == ["Timestamp", "Source Port", "Attack Type"]
    shown = out.select(F.col("Timestamp").cast("string"), "Source Port", "Attack Type").collect()
    assert [tuple(r) for r in shown] == [("2024-01-06 10:00:00", 80.0, "DDoS"), (None, None, "Malware"), ("2024-01-07 00:00:00", None, "Intrusion")]


def test_empty_table_is_fine(spark):
    raw = spark.createDataFrame([], "Timestamp string, `Attack Type` string")
    out = clean.add_row_id(clean_table(raw, TableSpec()), ["Timestamp"])
    assert out.count() == 0 and out.columns[0] == "row_id"


def test_row_ids_follow_the_key(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "k int, v string").repartition(3)
    assert sorted(map(tuple, clean.add_row_id(df, ["k"]).collect())) == [("row_000000", 1, "a"), ("row_000001", 2, "b"), ("row_000002", 3, "c")]


def test_error_contract(spark):
    df = spark.createDataFrame([("x", None)], "a string, t timestamp")
    with pytest.raises(KeyError):
        clean.require_columns(df, ["a", "b"])
    with pytest.raises(ValueError, match="sum to 1"):
        clean.check_fractions(0.7, 0.2, 0.2)
    with pytest.raises(ValueError, match="t cannot be read in 1 rows"):
        clean.require_times(df, "t")
    assert clean.resolve_column(df, ["B", " A "]) == "a"
    assert clean.resolve_column(df, ["zzz"]) is None


def test_feature_config(spark):
    df = spark.createDataFrame([("r", "2024-01-06 01:00:00", 80, "x", 1.0, "y")], "row_id string, ts string, port int, junk string, v double, label string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    config = features.FeatureConfig("label", drop_cols=("junk", "absent"), timestamp_cols=("ts", "absent"), port_cols=("port",))
    out = features.feature_table(df, config)
    assert out.columns == ["port", "v", "ts_hour", "ts_dayofweek", "ts_month", "ts_is_weekend", "port_is_well_known", "port_is_registered", "port_is_dynamic"]
    assert "ts" in features.feature_table(df, config, drop_original_times=False).columns
    other = config.with_target("v")
    assert other.drop_cols == ("absent", "junk", "label") and "v" not in features.feature_table(df, other).columns
    with pytest.raises(KeyError):
        features.features_and_label(df, features.FeatureConfig("absent"))


def test_audit_order_and_ties(spark):
    stats = [
        (0, "row_id", "string", True, 0.0, 900, 10.0, 10.0, 10.0),
        (1, "IDS/IPS Alerts", "string", True, 0.5, 1, 9.0, 9.0, 9.0),
        (2, "User ID", "string", True, 0.0, 499, 5.0, 5.0, 5.0),
        (3, "Device ID", "string", True, 0.0, 500, 5.0, 5.0, 5.0),
        (4, "Timestamp", "timestamp", False, 0.0, 900, None, None, None),
        (5, "Source Port", "double", False, 0.0, 900, None, None, None),
        (6, "Payload", "string", True, 0.0, 900, 20.0, 30.0, 40.0),
        (7, "Note", "string", True, 0.0, 3, 20.0, 29.0, 120.0),
        (8, "Flag", "string", True, 0.4, 2, 3.0, 3.0, 3.0),
        (9, "Sparse", "double", False, 0.4, 2, None, None, None),
        (10, "Names", "string", True, 0.0, 500, 3.0, 3.0, 3.0),
        (11, "Amount", "double", False, 0.0, 900, None, None, None),
        (12, "Label", "string", True, 0.0, 3, 3.0, 3.0, 3.0),
        (13, "Again", "double", False, 0.0, 900, None, None, None),
    ]
    table = spark.createDataFrame(stats, "position int, feature string, dtype string, is_text boolean, missing_fraction double, n_unique bigint, avg_len double, p95_len double, max_len double")
    audit = audit_actions(table, target_col="Label")
    got = {r["feature"]: (r["suggested_action"], r["transform_kind"], r["reason"].split()[0]) for r in audit.collect()}
    assert got == {
        "Label": ("target", "", "label"),
        "row_id": ("drop", "", "surrogate"),
        "IDS/IPS Alerts": ("drop", "", "high-cardinality"),
        "User ID": ("keep", "", "ok"),
        "Device ID": ("drop", "", "identifier-like"),
        "Timestamp": ("transform", "timestamp", "extract"),
        "Source Port": ("transform", "port", "bucket/parse"),
        "Payload": ("drop", "", "free-text/log-like"),
        "Note": ("drop", "", "free-text/log-like"),
        "Flag": ("keep", "", "binary-ish;"),
        "Sparse": ("drop", "", "too"),
        "Names": ("drop", "", "high-cardinality"),
        "Amount": ("keep", "", "ok"),
        "Again": ("keep", "", "ok"),
    }
    config = audit_config(audit, target_col="Label").first()
    assert config["drop_cols"] == ["IDS/IPS Alerts", "Sparse", "row_id", "Payload", "Device ID", "Names", "Note"]
    assert (config["transform"]["timestamp_cols"], config["transform"]["port_cols"]) == (["Timestamp"], ["Source Port"])


def test_audit_of_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([("a", None), ("b", None)], "label string, gone string")
    rows = {r["feature"]: r for r in feature_audit(df, target_col="label").collect()}
    assert rows["gone"]["missing_pct"] == 100.0 and rows["gone"]["n_unique"] == 0 and rows["gone"]["max_len"] == 0.0
    assert feature_audit(df.limit(0), target_col="label").count() == 2


def test_histogram_of_one_value(spark):
    rows = histogram(spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double"), "v", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 2, 0] and rows[0]["left"] == 1.5 and rows[3]["right"] == 2.5


def test_histogram_of_groups_with_a_null_group(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 4.0), (None, 1.0), (None, 2.0), ("b", None)], "g string, v double")
    rows = histogram(df, "v", bins=2, by=["g"]).collect()
    assert sorted((str(r["g"]), r["bin"], r["left"], r["count"]) for r in rows) == [("None", 0, 1.0, 1), ("None", 1, 1.5, 1), ("a", 0, 0.0, 1), ("a", 1, 2.0, 1)]
    assert histogram(df.filter("v > 9"), "v", bins=2).count() == 0


def test_most_frequent_long_value_is_reported_as_it_is(spark):
    from tabloom.operators.profile import describe_all

    long = "y" * 80
    df = spark.createDataFrame([("x" * 90, 1), (long, 2), (long, 3), ("a", 4)], "t string, n int")
    row = describe_all(df).filter("column = 't'").first()
    assert (row["top"], row["freq"], row["unique"], row["count"]) == (long, 2, 3, 4)


def test_time_features_of_text_and_dropped_derived_columns(spark):
    from tabloom.operators.features import FeatureConfig, feature_table

    df = spark.createDataFrame([(1, "2024-01-06 10:00:00", "a"), (2, "never", "b")], "row_id int, ts string, y string")
    config = FeatureConfig(target_col="y", row_id_col="row_id", drop_cols=("ts_month",), timestamp_cols=("ts",))
    out = feature_table(df, config)
    assert "ts_month" not in out.columns
    assert [(r["ts_hour"], r["ts_is_weekend"]) for r in out.collect()] == [(10, 1), (None, 0)]


def test_histogram_leaves_out_what_has_no_place(spark):
    values = [(0.0,), (1.0,), (4.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)]
    rows = histogram(spark.createDataFrame(values, "v double"), "v", bins=2).orderBy("bin").collect()
    assert [(r["left"], r["right"], r["count"]) for r in rows] == [(0.0, 2.0, 2), (2.0, 4.0, 1)]
