"""Delimited text: event CSV (SRC-4) and count snapshots (SRC-5)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow import files, schemas
from eventflow.functions.text import strip, to_integer
from eventflow.operators.filters import require_columns, two_fields


# Stands for the whole line in ``bad_fields``: it has more or fewer fields than the header.
LINE = "<line>"
CORRUPT = "_line"
# The text of a line, if it is known, and the file that it comes from.
TEXT, FILE = "_text", "_file"


def read_event_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = schemas.EVENT_TABLE,
    infer: bool = False,
    header: bool = True,
    mixed_headers: bool = False,
) -> DataFrame:
    """Event CSV, columns found by name.

    Everything is read as text and typed by ``type_rows``: a malformed number then marks
    its row instead of changing the type of a whole column. ``infer=True`` leaves the
    types to Spark, at the price of one more pass over the data.

    All files have the header of the first one; one that has not ends the job with an
    error. With ``mixed_headers`` the first lines of all files are read first, one small read
    a file, and files of equal headers are read together by their own names. Without
    ``header`` the columns are those of ``schema``, in its order.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if mixed_headers:
        groups: dict[str, list[str]] = {}
        for name, line in files.first_lines(spark, paths).items():
            groups.setdefault(line, []).append(name)
        if groups:
            parts = [read_event_csv(spark, group, schema, infer) for group in groups.values()]
            return reduce(DataFrame.unionByName, parts)
    if header:
        names = spark.read.option("header", True).csv(paths).columns
        require_columns(names, schema.fieldNames())
    else:
        names = schema.fieldNames()
    if infer:
        return spark.read.option("header", header).option("inferSchema", True).option("enforceSchema", False).csv(paths)
    fields = ", ".join(f"`{name}` string" for name in [*names, CORRUPT])
    reader = spark.read.schema(fields).option("header", header).option("enforceSchema", False)
    # Without pruning every line is split whole, so that its fields can be counted.
    raw = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    return type_rows(raw.withColumn(FILE, F.col("_metadata.file_path")), schema)


def parse_event_lines(lines: DataFrame, schema: T.StructType = schemas.EVENT_TABLE) -> DataFrame:
    """CSV lines in a column ``value`` to typed rows; the same rules as ``read_event_csv``."""
    fields = ", ".join(f"`{name}` string" for name in [*schema.fieldNames(), CORRUPT])
    parsed = F.from_csv(F.col("value"), fields, {"columnNameOfCorruptRecord": CORRUPT})
    return type_rows(lines.select(parsed.alias("f"), F.col("value").alias(TEXT)).select("f.*", TEXT), schema)


def type_rows(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed columns plus ``bad_fields``, the names of the fields that hold no valid value.

    An empty field is a null, which is no fault. A line whose number of fields is not the
    header's has ``LINE`` among its ``bad_fields``. ``line`` is the text that was read, so that
    a rejected row is kept as it was, and ``file`` where it was read, null for lines of a
    table. The text of a line of the right number of fields is put together from them again,
    with the quotes that a writer would set.
    """
    typed, bad = [], []
    fields = [c for c in raw.columns if c not in (CORRUPT, TEXT, FILE)]
    again = F.to_csv(F.struct(*fields), {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    line = [F.col(c) for c in (TEXT, CORRUPT) if c in raw.columns]
    file = F.col(FILE) if FILE in raw.columns else F.lit(None).cast("string")
    if CORRUPT in raw.columns:
        bad.append(F.when(F.col(CORRUPT).isNotNull(), F.lit(LINE)))
    for field in schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            typed.append(column)
            continue
        value = column.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        bad.append(F.when(value.isNull() & (column != ""), F.lit(field.name)))
    return raw.select(
        *typed, F.array_compact(F.array(*bad)).alias("bad_fields"), F.coalesce(*line, again).alias("line"), file.alias("file")
    )


def good_rows(typed: DataFrame) -> DataFrame:
    return typed.filter(F.size("bad_fields") == 0).drop("bad_fields", "line", "file")


def bad_rows(typed: DataFrame) -> DataFrame:
    """Rows for the quarantine table, with their text and file."""
    return typed.filter(F.size("bad_fields") > 0)


def accounting(typed: DataFrame, keys: str = "event_type", value: str = "value") -> DataFrame:
    """What became of the rows read, by key: summed, without a value, or rejected."""
    good = F.size("bad_fields") == 0
    return typed.groupBy(keys).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(good & F.col(value).isNotNull()).alias("rows_summed"),
        F.count_if(good & F.col(value).isNull()).alias("rows_without_value"),
        F.count_if(~good).alias("rows_rejected"),
    )


def read_snapshot_text(spark: SparkSession, path: str) -> DataFrame:
    return parse_snapshot_lines(spark.read.text(path))


def parse_snapshot_lines(lines: DataFrame, exact: bool = True) -> DataFrame:
    """Snapshot lines ``key<TAB>count`` in a column ``value`` (SRC-5, FLT-2).

    Lines without exactly two fields are dropped; with ``exact=False``, only those without a
    tab, nothing is stripped, and the second field counts. ``event_count`` is null where it
    is not an integer; what then happens is the caller's policy (``bad_integers``).
    """
    if exact:
        kept = two_fields(lines.select(strip(F.col("value")).alias("value")))
    else:
        kept = lines.select("value").filter(F.contains("value", F.lit("\t")))
    fields = F.split("value", "\t", -1)
    return kept.select(
        fields[0].alias("event_type"),
        fields[1].alias("count_text"),
        to_integer(fields[1]).alias("event_count"),
    )
