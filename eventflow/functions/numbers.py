"""Rounding, ratios and time arithmetic (MET-1 to MET-5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _exact_multiple(x: Column, powers: list[int]) -> tuple[Column, Column]:
    """x times the sum of powers of two as an unevaluated pair (sum, error) without loss."""
    total, error = x * F.lit(float(powers[0])), F.lit(0.0)
    for power in powers[1:]:
        part = x * F.lit(float(power))
        grown = total + part
        error = error + (part - (grown - total))
        total = grown
    top = total + error
    return top, error - (top - total)


def round_half_even(x: Column, digits: int) -> Column:
    """Round a double half to even on its exact binary value, for 0, 1 or 2 digits.

    ``bround`` decides ties on the shortest decimal form, so it takes 0.35 (a little less
    than 35/100 in binary) for a tie. Here twice the scaled value is held as a sum and its
    rounding error, which settles every tie exactly with plain double arithmetic.
    """
    scale = 10**digits
    x = x.cast("double")
    if digits == 0:
        return F.rint(x)
    # 20 and 200 as sums of powers of two.
    twice, error = _exact_multiple(x, {1: [16, 4], 2: [128, 64, 8]}[digits])
    low = F.floor(twice / 2).cast("double")
    over = twice - low * 2
    up = (over > 1) | ((over == 1) & ((error > 0) | ((error == 0) & (F.pmod(low, F.lit(2.0)) == 1))))
    exact = (low + F.when(up, 1.0).otherwise(0.0)) / F.lit(float(scale))
    # Doubles this large have fractions of at most nine bits, whose multiples are exact; they are
    # also so far apart that adding the quotient rounds as the exact sum would.
    part = x % F.lit(1.0)
    return F.when(F.abs(x) < 2.0**43, exact).otherwise(x - part + F.rint(part * scale) / F.lit(float(scale)))


def per_second(n: Column, millis: Column, digits: int) -> Column:
    """Throughput ``n / (millis / 1000)``, 0 where no time was measured (MET-2, MET-3)."""
    seconds = millis.cast("double") / F.lit(1000.0)
    rate = round_half_even(F.try_divide(n.cast("double"), seconds), digits)
    return F.when(millis > 0, rate).otherwise(F.lit(0.0))


def latency_ratio(batch_ms: Column, stream_ms: Column) -> Column:
    """How many times longer the batch took; a latency below 1 ms counts as 1 (MET-4)."""
    return round_half_even(batch_ms.cast("double") / F.greatest(stream_ms, F.lit(1)).cast("double"), 1)


def speedup(baseline_ms: Column, job_ms: Column) -> Column:
    """Baseline over measured time, 0 unless both were measured (MET-5)."""
    ratio = round_half_even(F.try_divide(baseline_ms.cast("double"), job_ms.cast("double")), 2)
    return F.when((baseline_ms > 0) & (job_ms > 0), ratio).otherwise(F.lit(0.0))


def interval_micros(interval: Column) -> Column:
    """Microseconds of a day-time interval, whatever the session time zone."""
    day, hour, minute, second = (
        F.extract(F.lit(unit), interval) for unit in ("DAY", "HOUR", "MINUTE", "SECOND")
    )
    minutes = (day.cast("bigint") * 24 + hour) * 60 + minute
    return minutes * F.lit(60_000_000) + (second * 1_000_000).cast("bigint")


def interval_millis(interval: Column) -> Column:
    """Whole milliseconds of a non-negative day-time interval."""
    return F.floor(interval_micros(interval) / F.lit(1000)).cast("bigint")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp without time zone."""
    return interval_micros(ts - F.expr("timestamp_ntz'1970-01-01 00:00:00'"))


def cents(amount: Column) -> Column:
    """Integer cents of an amount of whole cents held as a double.

    ``rint`` stays in double arithmetic where ``round`` makes a decimal of every value.
    """
    return F.rint(amount * 100).cast("bigint")
