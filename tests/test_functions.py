from __future__ import annotations

import datetime as dt

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabloom.functions import agents, calendar, labels, ports, text


def one(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(column).collect()]


def test_null_tokens_and_outer_whitespace(spark):
    values = ["", " x ", "nan", "None", "\t a b \n", None, "  ", "n/a", "Nan"]
    assert one(spark, text.null_if_token(F.col("x")), values) == [None, "x", None, None, "a b", None, None, None, "Nan"]


def test_port_flags_at_the_edges(spark):
    values = [None, "-1", "0", "1023", "1024", "49151", "49152", "65535", "70000", "http"]
    df = spark.createDataFrame([(v,) for v in values], "`Source Port` string")
    rows = [tuple(r) for r in df.select(*ports.port_features("Source Port")).collect()]
    well_known, registered, dynamic = (1, 0, 0), (0, 1, 0), (0, 0, 1)
    none = (0, 0, 0)
    assert rows == [none, none, well_known, well_known, registered, registered, dynamic, dynamic, none, none]


def test_weekend_flag_and_missing_time(spark):
    days = [dt.datetime(2024, 1, 6, 5), dt.datetime(2024, 1, 7), dt.datetime(2024, 1, 8), None]
    df = spark.createDataFrame([(d,) for d in days], "`Event Time` timestamp_ntz")
    rows = [tuple(r) for r in df.select(*calendar.timestamp_features("Event Time")).collect()]
    assert rows == [(5, 5, 1, 1), (0, 6, 1, 1), (0, 0, 1, 0), (None, None, None, 0)]
    assert df.select(*calendar.timestamp_features("Event Time")).columns == ["Event_Time_hour", "Event_Time_dayofweek", "Event_Time_month", "Event_Time_is_weekend"]


@pytest.mark.parametrize(
    ("agent", "browser", "system", "device"),
    [
        ("Mozilla Chrome/118 Safari/537 Edg/118 Windows NT 10.0", "Chrome", "Windows", "Windows"),
        ("Version/16 Safari/604 Macintosh", "Safari", "macOS", "Macintosh"),
        ("Linux; Android 13; Chrome/1", "Chrome", "Linux", "Linux"),
        ("iPad CriOS/5 Safari/6", "Chrome", "iOS", "iPad"),
        ("Opera/9.8 linux", "Opera", "Linux", "linux"),
        ("Edge/12", "Edge", "Other", "Unknown"),
        ("Trident/7.0 chrome", "Internet Explorer", "Other", "Unknown"),
        ("", "Other", "Other", "Unknown"),
        (None, "Other", "Other", "Unknown"),
    ],
)
def test_agents(spark, agent, browser, system, device):
    df = spark.createDataFrame([(agent,)], "x string")
    x = F.col("x")
    assert tuple(df.select(agents.browser_of(x), agents.os_of(x), agents.device_of(x)).first()) == (browser, system, device)


def test_labels_and_bounds(spark):
    classes = ["a", "b"]
    df = spark.createDataFrame([("a", -1), ("b", 1), ("z", 2), (None, None)], "y string, i int")
    rows = [tuple(r) for r in df.select(labels.encode_label(F.col("y"), classes), labels.decode_label(F.col("i"), classes), *labels.indicators(F.col("y"), classes)).collect()]
    assert rows == [(0, "", 1, 0), (1, "b", 0, 1), (None, "", 0, 0), (None, "", 0, 0)]


def test_top_probability_and_norms(spark):
    df = spark.createDataFrame([([3.0, -4.0],)], "v array<double>")
    v = F.col("v")
    assert tuple(df.select(labels.l2_norm(v), labels.mean_abs(v), labels.top_probability(array_to_vector(v))).first()) == (5.0, 3.5, 3.0)


def test_stamps(spark):
    values = ["20251229_173211", "latest", "20251329_000000", None]
    out = one(spark, calendar.format_iso(calendar.parse_stamp(F.col("x"))), values)
    assert out == ["2025-12-29T17:32:11+00:00", None, None, None]


def test_slugs_and_joined_labels(spark):
    assert one(spark, text.slug(F.col("x")), ["  L1 (lasso) + Ridge--Mix "]) == ["l1_plus_ridge_mix"]
    assert one(spark, text.folder_slug(F.col("x")), ["owner/some data"]) == ["owner_some_data"]
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(text.join_labels(F.col("x"), F.col("y"))).first()[0] == "a | Unknown"
    assert one(spark, text.text_length(F.col("x")), ["abc", None, ""]) == [3, 0, 0]


def test_json_defaults(spark):
    values = ['{"k": 5}', '{"k": "x"}', "broken", None]
    assert one(spark, labels.json_or(F.col("x"), "$.k", "int", -1), values) == [5, -1, -1, -1]
