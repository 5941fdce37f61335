import math

from pyspark.sql import functions as F

from skyflow.functions import columns as c


def one(df):
    return df.first()[0]


def test_epochs_stay_apart_when_clocks_go_back(spark):
    df = spark.createDataFrame([(1699162200,), (1699165800,)], "t BIGINT")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(c.epoch_to_ts(F.col("t"))).distinct().count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_epoch_out_of_range_is_null(spark):
    df = spark.createDataFrame([(10**18,), (None,)], "t BIGINT")
    assert [r[0] for r in df.select(c.epoch_to_ts(F.col("t"))).collect()] == [None, None]


def test_iso_text(spark):
    df = spark.createDataFrame([("2026-01-11T14:35:00.000Z",), ("bad",), (None,)], "t STRING")
    assert [r[0] for r in df.select(c.iso_to_epoch(F.col("t"))).collect()] == [1768142100, None, None]


def test_bucket_floors_below_zero(spark):
    df = spark.createDataFrame([(-1,), (0,), (59,), (60,)], "t BIGINT")
    assert [r[0] for r in df.select(c.bucket(F.col("t"), 60)).collect()] == [-60, 0, 0, 60]


def test_path_elements(spark):
    df = spark.createDataFrame([([["1", "2.5", "-3.25", None, "10", "true"], ["1", "2"]],)], "p ARRAY<ARRAY<STRING>>")
    full, short = one(df.select(c.path_to_structs(F.col("p"))))
    assert tuple(full) == (1, 2.5, -3.25, None, 10.0, True)
    assert tuple(short) == (1, 2.0, None, None, None, None)


def test_speed(spark):
    df = spark.createDataFrame([(None,), (0.0,), (10.0,)], "velocity DOUBLE")
    assert [r[1] for r in c.with_speed_kmh(df).collect()] == [None, None, 36.0]


def test_altitude_category(spark):
    heights = [None, -50.0, 2999.99, 3000.0, 9999.99, 10000.0]
    df = spark.createDataFrame([(h,) for h in heights], "baro_altitude DOUBLE")
    found = [r[1] for r in c.with_altitude_category(df).collect()]
    assert found == [None, "low", "low", "medium", "medium", "high"]


def test_trim_takes_all_white_space(spark):
    df = spark.createDataFrame([(" \t a b　\n", 1)], "s STRING, n INT")
    assert tuple(c.trim_strings(df).first()) == ("a b", 1)


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(12.5,), (math.nan,), (1e300,)], "t DOUBLE")
    assert one(df.select(c.rounded_int(F.col("t")))) == 13
    assert df.select(c.rounded_int(F.col("t"))).count() == 3
