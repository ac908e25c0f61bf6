"""Inputs for the catalogue, derived row by row or by key from the given tables.

The tables hold clean events. The operators for messy text, run records and summary
documents get theirs from expressions over the same rows, so that their work grows with
the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow import schemas
from eventflow.functions.numbers import cents, epoch_micros, interval_millis

# Fixed value: start of the first measured run, the origin for latencies.
ORIGIN = "timestamp_ntz'2024-01-01 00:00:00'"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.EVENTS).parquet(f"{sf_dir}/events.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.LINEITEM).parquet(f"{sf_dir}/lineitem.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(schemas.ORDERS).parquet(f"{sf_dir}/orders.parquet")


def index(table: DataFrame, key: str = "event_id") -> DataFrame:
    """The row number column of a table as the index of a generator."""
    return table.select(F.col(key).alias("i"))


def spread(table: DataFrame) -> DataFrame:
    """The rows dealt evenly to several tasks a core: a row of few bytes may be much work, while files are cut by bytes."""
    return table.repartition(4 * table.sparkSession.sparkContext.defaultParallelism)


def table_size(table: DataFrame) -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias("n"))


def dirty_messages(table: DataFrame) -> DataFrame:
    """A clean message per event, and beside it one in another shape: blanks, no separator, no key, more fields, null."""
    kind, key, seq = F.col("event_id") % 8, F.col("event_type"), F.col("event_id").cast("string")
    other = (
        F.when(kind == 1, F.concat(F.lit(" "), key, F.lit(" :"), seq, F.lit(":x")))
        .when(kind == 2, key)
        .when(kind == 3, F.concat(F.lit(":"), seq))
        .when(kind == 4, F.lit("  "))
        .when(kind == 5, F.concat(key, F.lit("\t:"), seq))
        .when(kind == 6, F.concat(F.lit("\t"), key, F.lit("\r\n")))
    )
    return table.select(
        "event_id", F.posexplode(F.array(F.concat(key, F.lit(":"), seq), other)).alias("shape", "value")
    )


def snapshot_lines(table: DataFrame) -> DataFrame:
    """A snapshot line per event; beside some one with a third field, a missing one, a bad number or blanks."""
    kind, key, n = F.col("event_id") % 8, F.col("event_type"), F.col("event_id").cast("string")
    other = (
        F.when(kind == 1, F.concat(key, F.lit("\t"), n, F.lit("\t5")))
        .when(kind == 2, key)
        .when(kind == 3, F.concat(key, F.lit("\tx"), n))
        .when(kind == 4, F.lit("   "))
        .when(kind == 5, F.concat(F.lit("  "), key, F.lit("\t"), n, F.lit(" ")))
        .when(kind == 6, F.concat(key, F.lit("\t-"), n))
    )
    return _beside(table, F.concat(key, F.lit("\t"), n), other)


def csv_lines(table: DataFrame) -> DataFrame:
    """A CSV line ``event_type,value,timestamp`` per event; beside some a damaged one.

    That has a field too many or too few, no value, no integer as a value, or is blank or a header.
    """
    kind, key = F.col("event_id") % 10, F.col("event_type")
    time = (F.col("event_id") + 1_700_000_000).cast("string")
    clean = F.concat_ws(",", key, cents(F.col("value")).cast("string"), time)
    other = (
        F.when(kind == 1, F.concat(clean, F.lit(",more")))
        .when(kind == 2, F.concat_ws(",", key, F.lit("5")))
        .when(kind == 3, F.concat_ws(",", key, F.lit(""), time))
        .when(kind == 4, F.lit(" "))
        .when(kind == 5, F.lit("event_type,value,timestamp"))
        .when(kind == 7, F.concat_ws(",", key, F.concat(F.lit("n"), F.col("event_id").cast("string")), time))
    )
    return _beside(table, clean, other)


def csv_rows(table: DataFrame) -> DataFrame:
    """The event table's rows as texts; beside some one without a value or with one that is no integer."""
    kind = F.col("event_id") % 10
    key, value = F.col("event_type"), cents(F.col("value")).cast("string")
    time = (F.col("event_id") + 1_700_000_000).cast("string").alias("timestamp")
    other = F.when(kind == 3, F.array(value, F.lit(None))).when(
        kind == 7, F.array(value, F.concat(F.lit("n"), F.col("event_id").cast("string")))
    ).otherwise(F.array(value))
    return table.select(key, F.explode(other).alias("value"), time)


def lineitem_exact(table: DataFrame) -> DataFrame:
    """Keys and some columns as whole numbers and texts."""
    return table.select(
        "l_orderkey", "l_linenumber", cents(F.col("l_quantity")).alias("quantity"), cents(F.col("l_extendedprice")).alias("price"),
        F.col("l_linestatus").alias("line"), epoch_micros(F.col("l_shipdate")).alias("shipped"),
    )


def lineitem_changed(table: DataFrame) -> DataFrame:
    """``lineitem_exact`` rows with some prices raised, some rows gone and some there once more under a new number."""
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    copies = F.when((order % 101 == 0) & (line == 2), F.expr("array()").cast("array<int>")).when(
        (order % 103 == 0) & (line == 3), F.array(F.lit(0), F.lit(100))
    ).otherwise(F.array(F.lit(0)))
    raised = F.when((order % 97 == 0) & (line == 1), F.col("price") + 100).otherwise(F.col("price"))
    changed = table.withColumn("price", raised).withColumn("_more", F.explode(copies))
    return changed.withColumn("l_linenumber", line + F.col("_more")).drop("_more")


def _beside(table: DataFrame, clean: Column, other: Column) -> DataFrame:
    return table.select(F.explode(F.array_compact(F.array(clean, other))).alias("value"))


def runs(table: DataFrame) -> DataFrame:
    """One run per user and event type: what was processed, and how long it took.

    A run takes from its first to its last event, its latency is the time until its first
    event, the baseline runs from the origin; it passes if its mean value stays below 50.
    """
    first, last = F.min("ts"), F.max("ts")
    grouped = table.groupBy(F.col("user_id").alias("submission"), F.col("event_type").alias("name")).agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.sum(cents(F.col("value"))).alias("total_cents"),
        first.alias("first_ts"),
        last.alias("last_ts"),
    )
    c = F.col
    origin = F.expr(ORIGIN)
    return grouped.select(
        "submission",
        F.concat_ws("-", c("submission").cast("string"), c("name")).alias("id"),
        "name",
        (c("total_cents") < c("rows_processed") * 5000).alias("passed"),
        "rows_processed",
        interval_millis(c("last_ts") - c("first_ts")).alias("elapsed_ms"),
        interval_millis(c("last_ts") - c("first_ts")).alias("job_time_ms"),
        interval_millis(c("first_ts") - origin).alias("latency_ms"),
        interval_millis(c("last_ts") - origin).alias("baseline_time_ms"),
        (c("rows_processed") % 16).alias("shuffle_partitions_used"),
    )


def run_texts(table: DataFrame) -> DataFrame:
    """A run record as a JSON text per event; beside some one that is cut off in the middle."""
    record = F.concat(
        F.lit('{"id":"'), F.col("event_id").cast("string"),
        F.lit('","name":"'), F.col("event_type"),
        F.lit('","passed":'), F.when(F.col("event_type") == "error", F.lit("false")).otherwise(F.lit("true")),
        F.lit(',"elapsed_ms":'), cents(F.col("value")).cast("string"), F.lit("}"),
    )
    broken = F.when(F.col("event_id") % 9 == 0, F.substr(record, F.lit(1), F.length(record) - 1))
    return table.select(
        F.col("event_id").cast("string").alias("id"), F.explode(F.array_compact(F.array(record, broken))).alias("text")
    )


def large_document(table: DataFrame) -> DataFrame:
    """Lines of one summary document with a run per event, in the order ``section``, ``event_id``.

    Of five hundred runs one has a number as its id, one a text as ``passed``, one a fraction as
    its time, one is a number itself, and one has the id of others; both totals are 0.
    """
    kind, id_ = F.col("event_id") % 500, F.col("event_id").cast("string")
    quoted = F.concat(F.lit('"'), id_, F.lit('"'))
    run = F.concat(
        F.lit(',{"id":'), F.when(kind == 7, id_).when(kind == 11, F.lit('"x"')).otherwise(quoted),
        F.lit(',"name":"'), F.col("event_type"),
        F.lit('","passed":'), F.when(kind == 8, F.lit('"yes"')).otherwise((F.col("event_type") != "error").cast("string")),
        F.lit(',"elapsed_ms":'), F.when(kind == 9, F.lit("1.5")).otherwise(cents(F.col("value")).cast("string")),
        F.lit(',"more":{"a":["}",{}]}}'),
    )
    opening = '{"scenarios_passed":0,"scenarios_total":0,"penalty_ms":0,"scenarios":[{"id":"first","passed":true,"elapsed_ms":0}'
    ends = F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(None).cast("bigint").alias("event_id"), F.lit(text).alias("line"))
        for section, text in ((0, opening), (2, "]}"))
    ])
    runs = table.select(F.lit(1).alias("section"), "event_id", F.when(kind == 10, F.lit(",5")).otherwise(run).alias("line"))
    return runs.unionByName(table.sparkSession.range(1).select(F.inline(ends)))


def documents(table: DataFrame) -> DataFrame:
    """One summary document of three runs per event, each seventeenth kind breaking another rule."""
    kind, ms = F.col("event_id") % 17, cents(F.col("value"))

    def element(run_id: Column, passed: Column, elapsed: Column) -> Column:
        return F.concat(
            F.lit('{"id":'), run_id, F.lit(',"name":"'), F.col("event_type"),
            F.lit('","passed":'), passed, F.lit(',"elapsed_ms":'), elapsed, F.lit("}"),
        )

    def pick(default: str | Column, *other: tuple[int, str | Column]) -> Column:
        chosen = default if isinstance(default, Column) else F.lit(default)
        for k, value in other:
            chosen = F.when(kind == k, value if isinstance(value, Column) else F.lit(value)).otherwise(chosen)
        return chosen

    scenarios = F.concat(
        F.lit("["),
        element(pick('"01"', (7, "1"), (8, "null")), pick("true", (10, '"yes"')), ms.cast("string")),
        F.lit(","),
        pick(element(pick('"02"', (9, '"01"')), F.lit("false"), pick(ms.cast("string"), (11, "1.5"), (12, "true"))), (6, "5")),
        F.lit(","),
        element(F.lit('"03"'), F.lit("false"), F.lit("7")),
        F.lit("]"),
    )
    body = F.concat(
        F.lit('{"scenarios_passed":'), pick("1", (13, "2"), (14, "true")),
        pick(',"scenarios_total":3', (4, "")),
        F.lit(',"penalty_ms":'), pick((ms + 7).cast("string"), (15, (ms + 8).cast("string")), (16, '"none"')),
        F.lit(',"scenarios":'), pick(scenarios, (5, '{"01":true}')), F.lit("}"),
    )
    text = F.when(kind == 1, F.lit(None)).when(kind == 2, F.concat(body, F.lit("]"))).when(
        kind == 3, F.concat(F.lit("["), body, F.lit("]"))
    ).otherwise(body)
    return table.select(F.col("event_id").alias("submission"), text.alias("text"))
