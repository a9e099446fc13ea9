"""Property checks of the scalar helpers against plain-Python definitions."""

import datetime as dt
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from fieldnotes.functions import integer_delta, surrogate_key, week_start_sunday
from fieldnotes.functions.keys import SURROGATE_NULL_TOKEN

ints = st.integers(min_value=-10_000, max_value=10_000)


def trunc_div(a, b):
    if a is None or b is None or b == 0:
        return None
    q = abs(a) // abs(b)
    return q if (a >= 0) == (b > 0) else -q


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), ints), st.one_of(st.none(), ints)), min_size=1, max_size=200))
def test_integer_delta_is_truncating_division(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r.v for r in df.select(integer_delta("a", "b").alias("v")).collect()]
    assert got == [trunc_div(a, b) for a, b in pairs]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)), min_size=1, max_size=200))
def test_week_start_is_the_sunday_on_or_before(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = [r.w.date() for r in df.select(week_start_sunday("d").alias("w")).collect()]
    assert got == [d - dt.timedelta(days=(d.weekday() + 1) % 7) for d in days]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), ints), st.one_of(st.none(), st.text(max_size=8))),
                min_size=1, max_size=100))
def test_surrogate_key_is_md5_of_joined_text(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    got = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]

    def text(v):
        return SURROGATE_NULL_TOKEN if v is None else str(v)

    assert got == [hashlib.md5(f"{text(a)}-{text(b)}".encode()).hexdigest() for a, b in rows]
