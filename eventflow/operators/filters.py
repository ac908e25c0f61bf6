"""Row filters and input checks (FLT-1 to FLT-5)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventflow.functions.text import scenario_id, strip

# Fixed value: how the header line of an event or result file begins.
HEADER_START = "event_type,"


def data_lines(lines: DataFrame, header_start: str | None = HEADER_START) -> DataFrame:
    """Stripped lines of column ``value`` without blank and header lines (FLT-1)."""
    kept = lines.select(strip(F.col("value")).alias("value")).filter(F.col("value") != "")
    return kept.filter(~F.startswith("value", F.lit(header_start))) if header_start else kept


def two_fields(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """Lines with exactly two fields (FLT-2)."""
    return lines.filter(F.size(F.split("value", sep, -1)) == 2)


def bad_integers(on_bad: str, number: Column, text: Column) -> Column:
    """Sum of ``number``, which is null where ``text`` is no integer (FLT-3).

    ``skip`` leaves such rows out, ``zero`` makes the whole total 0, ``fail`` ends the job.
    An empty input sums to 0.
    """
    total = F.coalesce(F.sum(number), F.lit(0)).cast("bigint")
    if on_bad == "skip":
        return total
    if on_bad == "zero":
        return F.when(F.count_if(number.isNull()) > 0, F.lit(0)).otherwise(total).cast("bigint")
    if on_bad == "fail":
        problem = F.raise_error(F.concat(F.lit("not an integer: "), F.coalesce(text, F.lit("null"))))
        checked = F.when(number.isNull(), problem.cast("bigint")).otherwise(number)
        return F.coalesce(F.sum(checked), F.lit(0)).cast("bigint")
    raise ValueError("on_bad is 'skip', 'zero' or 'fail'")


def require_columns(found: Sequence[str], names: Iterable[str]) -> None:
    """Refuse an input that lacks a required column, before any job runs (FLT-4)."""
    missing = sorted(set(names) - set(found))
    if missing:
        raise ValueError(f"input is missing columns {missing}; found {list(found)}")


def select_runs(runs: DataFrame, ids: Iterable[str]) -> DataFrame:
    """Records of the requested ids, each id once however often it is asked for (FLT-5).

    A requested ``1`` means ``01``; an id that is not numeric has to match as it is.
    """
    wanted = sorted({str(i) for i in ids})
    literal = [F.lit(i) for i in wanted]
    return runs.filter(F.col("id").isin(*literal, *[scenario_id(i) for i in literal]))
