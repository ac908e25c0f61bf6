"""Declared schemas of the data model (D1-D13); nothing is inferred on the main path."""

from pyspark.sql import types as T

MESSAGE = T.StructType([T.StructField("value", T.StringType())])

COUNTS = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("event_count", T.LongType()),
])

EVENT_TABLE = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.IntegerType()),
    T.StructField("timestamp", T.IntegerType()),
])

# The same columns before they have types.
EVENT_TEXTS = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT_TABLE.fields])

NARROW_EVENT_TABLE = T.StructType(EVENT_TABLE.fields[:2])

SUMMARY = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("total_value", T.LongType()),
    T.StructField("event_count", T.LongType()),
    T.StructField("max_timestamp", T.IntegerType()),
])

NARROW_SUMMARY = T.StructType(SUMMARY.fields[:3])

# The fields every run record has; the rest differs by kind of run and is kept as a variant.
RUN_RECORD = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("elapsed_ms", T.LongType()),
    T.StructField("error", T.StringType()),
])

# Parquet tables the catalogue reads.
EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])
