import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.functions.numbers import (
    epoch_micros, interval_millis, latency_ratio, per_second, round_half_even, speedup,
)

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def check_rounding(spark, values):
    frame = spark.createDataFrame([(float(v),) for v in values], "x double")
    rows = frame.select("x", *[round_half_even(F.col("x"), d).alias(f"r{d}") for d in (0, 1, 2)]).collect()
    assert [(r.x, d, r[f"r{d}"]) for r in rows for d in (0, 1, 2) if r[f"r{d}"] != round(r.x, d)] == []


def test_rounding_near_ties(spark):
    check_rounding(spark, [i / 20 for i in range(-500, 500)] + [i / 200 for i in range(3000)] + [2.675, 0.35, 3750.5, 0.125])
    check_rounding(spark, [2.0**e + k / 8 for e in range(40, 53) for k in range(-16, 17)])


@SLOW
@given(st.lists(st.one_of(st.floats(-1e9, 1e9), st.floats(-(2.0**60), 2.0**60)), min_size=1, max_size=200))
def test_rounding_like_python(spark, values):
    check_rounding(spark, values)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(-5, 10**6), st.integers(-1, 10**6)), min_size=1, max_size=100))
def test_ratios_like_python(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, n bigint, ms bigint, other bigint")
    c = F.col
    found = frame.select(
        "i", per_second(c("n"), c("ms"), 1), per_second(c("n"), c("ms"), 0),
        latency_ratio(c("ms"), c("other")), speedup(c("other"), c("ms")),
    ).orderBy("i").collect()
    for (n, ms, other), row in zip(rows, found):
        rate = n / (ms / 1000.0) if ms > 0 else 0
        assert tuple(row)[1:] == (
            round(rate, 1), round(rate), round(ms / max(other, 1), 1),
            round(other / ms, 2) if other > 0 and ms > 0 else 0,
        )


def test_time_does_not_depend_on_the_session_zone(spark):
    moments = [datetime.datetime(2024, 3, 10, 2, 30, 0, 123456), datetime.datetime(1969, 12, 31, 23, 59, 59, 999999)]
    frame = spark.createDataFrame([(m,) for m in moments], "ts timestamp_ntz")
    expected = [round((m - datetime.datetime(1970, 1, 1)) / datetime.timedelta(microseconds=1)) for m in moments]
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/New_York")
    for s in (spark, session):
        again = s.createDataFrame(frame.collect(), "ts timestamp_ntz")
        assert [r[0] for r in again.select(epoch_micros(F.col("ts"))).collect()] == expected


def test_interval_millis(spark):
    a, b = "timestamp_ntz'2024-01-01 00:00:00'", "timestamp_ntz'2024-01-03 01:02:03.999999'"
    assert spark.range(1).select(interval_millis(F.expr(b) - F.expr(a))).first()[0] == 176523999
