import datetime as dt

from pyspark.sql import functions as F

from cohort_effects.functions import (
    band,
    clamp_nonneg,
    code_to_name,
    hex_id,
    parse_date,
    round_half_up,
    safe_int,
    trim_ws,
)


def test_scalar_cleaners(spark):
    df = spark.createDataFrame(
        [(bytearray(b"\x00\xff"), "1", " a\t", "2000-1-5"), (bytearray(b"5"), "1.5", "b", "2000-02-30"),
         (None, "x", None, "bad")],
        "k binary, n string, s string, d string",
    )
    rows = df.select(
        hex_id("k").alias("h"), safe_int("n").alias("i"), trim_ws("s").alias("t"), parse_date("d").alias("d")
    ).collect()
    assert rows[0] == ("00ff", 1, "a", dt.date(2000, 1, 5))
    assert rows[1] == ("35", None, "b", None)  # '1.5' is not an integer; Feb 30 does not exist
    assert rows[2] == (None, None, None, None)


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (2.0,)], "x double")
    assert [r[0] for r in df.select(clamp_nonneg("x")).collect()] == [None, 0.0, 2.0]


def test_band_edges_and_null(spark):
    cuts = [(">=", 0.3, "s+"), (">", 0.1, "m+"), (">=", -0.1, "i"), (">", -0.3, "m-")]
    df = spark.createDataFrame([(0.3,), (0.1,), (-0.1,), (-0.3,), (None,), (0.2,)], "x double")
    got = [r[0] for r in df.select(band("x", cuts, "s-")).collect()]
    assert got == ["s+", "i", "i", "s-", "s-", "m+"]


def test_code_map_and_round(spark):
    df = spark.createDataFrame([("a",), ("z",)], "c string")
    assert [r[0] for r in df.select(code_to_name("c", {"a": "A"})).collect()] == ["A", None]
    df = spark.createDataFrame([(0.0078125,), (-0.0000001,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(round_half_up("x", 6)).collect()]
    assert got[0] == 0.007813 and str(got[1]) == "0.0" and got[2] != got[2]
