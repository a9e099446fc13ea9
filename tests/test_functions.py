import datetime as dt
import hashlib

from pyspark.sql import functions as F

from fieldnotes.functions import (
    array_get,
    coordinates,
    day_of_week_name,
    day_of_week_sunday0,
    integer_delta,
    month_key,
    null_safe_ratio,
    parse_int_array,
    row_id,
    surrogate_key,
    week_start_sunday,
    zero_guarded_ratio,
)
from fieldnotes.functions.keys import SURROGATE_NULL_TOKEN


def one(spark, expr, schema="x int"):
    return spark.createDataFrame([(1,)], schema).select(expr.alias("v")).first()["v"]


def test_surrogate_key_matches_md5_of_joined_text_with_null_token(spark):
    df = spark.createDataFrame([(7, None), (7, "abc")], "a int, b string")
    got = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    want = [hashlib.md5(f"7-{SURROGATE_NULL_TOKEN}".encode()).hexdigest(), hashlib.md5(b"7-abc").hexdigest()]
    assert got == want


def test_surrogate_key_timestamp_and_decimal_text(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 10, 1),)], "t timestamp_ntz")
    got = df.select(surrogate_key(F.lit(3), "t", F.lit("-122.5").cast("decimal(12,2)")).alias("k")).first().k
    assert got == hashlib.md5(b"3-2001-10-01 00:00:00--122.50").hexdigest()


def test_row_id_whole_and_fractional_seconds_and_null_name(spark):
    rows = [
        (5, dt.datetime(2000, 4, 4), "Brand#2"),
        (5, dt.datetime(2000, 4, 4, 0, 0, 0, 250000), "Ensatina"),
        (6, dt.datetime(2000, 4, 4), None),
    ]
    df = spark.createDataFrame(rows, "inaturalist_id long, updated_at timestamp_ntz, name string")
    got = [r.i for r in df.select(row_id().alias("i")).collect()]
    epoch = int(dt.datetime(2000, 4, 4, tzinfo=dt.timezone.utc).timestamp())
    assert got == [f"5{epoch}.0Brad#2", f"5{epoch}.25Ensina", f"6{epoch}.0Nonone"]


def test_parse_int_array_and_coordinates(spark):
    df = spark.createDataFrame([("{1,20}", "45.504,-122.496"), ("{}", "45.5")], "p string, loc string")
    out = df.select(parse_int_array("p").alias("a"), coordinates("loc").alias("c")).collect()
    assert out[0].a == [1, 20] and out[1].a == []
    assert [str(x) for x in out[0].c] == ["45.504000", "-122.496000"]
    assert [str(x) for x in out[1].c] == ["45.500000"]


def test_array_get_is_one_based_and_null_out_of_range(spark):
    df = spark.createDataFrame([([10, 20],)], "a array<int>")
    r = df.select(array_get("a", 1).alias("x"), array_get("a", 2).alias("y"), array_get("a", 3).alias("z")).first()
    assert (r.x, r.y, r.z) == (10, 20, None)


def test_integer_delta_truncates_toward_zero_and_guards_zero(spark):
    df = spark.createDataFrame([(-7, 2), (7, 2), (-1, 3), (3, 2), (5, 0), (None, 1)], "a int, b int")
    got = [r.v for r in df.select(integer_delta("a", "b").alias("v")).collect()]
    assert got == [-3, 3, 0, 1, None, None]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 4), (1, 0), (None, 0)], "a long, b long")
    got = df.select(null_safe_ratio("a", "b").alias("r"), zero_guarded_ratio("a", "b").alias("z")).collect()
    assert [(r.r, r.z) for r in got] == [(0.25, 0.25), (None, 1.0), (None, None)]


def test_week_start_sunday_saturday_and_sunday(spark):
    df = spark.createDataFrame([(dt.date(2001, 10, 13),), (dt.date(2001, 10, 14),)], "d date")
    got = [r.w for r in df.select(week_start_sunday("d").alias("w")).collect()]
    assert got == [dt.datetime(2001, 10, 7), dt.datetime(2001, 10, 14)]


def test_day_of_week_sunday_zero_and_names(spark):
    df = spark.createDataFrame([(dt.date(2001, 10, 14),), (dt.date(2001, 10, 13),)], "d date")
    got = df.select(day_of_week_sunday0("d").alias("n"), day_of_week_name(day_of_week_sunday0("d")).alias("s")).collect()
    assert [(r.n, r.s) for r in got] == [(0, "Sunday"), (6, "Saturday")]
    assert one(spark, day_of_week_name(F.lit(7))) is None


def test_month_key_is_ntz_month_start(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 2, 28, 23, 59),)], "t timestamp_ntz")
    r = df.select(month_key("t").alias("m"))
    assert r.schema["m"].dataType.typeName() == "timestamp_ntz"
    assert r.first().m == dt.datetime(2001, 2, 1)


def test_round_half_away_from_zero_text(spark):
    df = spark.createDataFrame([("45.505",), ("-122.495",), ("45.496",)], "s string")
    got = [r.t for r in df.select(F.round(F.col("s").cast("decimal(12,6)"), 2).cast("decimal(12,2)")
                                  .cast("string").alias("t")).collect()]
    assert got == ["45.51", "-122.50", "45.50"]
