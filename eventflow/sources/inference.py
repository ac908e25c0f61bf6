"""Types of text columns, found in one pass (SRC-4).

Every value has a narrowest type. Types are ordered: a whole number is a number of any kind, a
day is a time, and everything is a text. How many values are of each narrowest type is counted
on the map side, for all columns and groups at once; a column's type then follows from its
counts. A few malformed values need not make a column of numbers a text: up to a given share
of them are misfits, and their rows go to quarantine when the column is typed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventflow.sources.delimited import CORRUPT, FILE, type_rows

# The forms of values, and of each type the narrowest types that it takes, in the
# order in which types are tried.
FORMS = {
    "boolean": r"^(?i:true|false)\z",
    "bigint": r"^[+-]?[0-9]{1,18}\z",
    "decimal(38,9)": r"^[+-]?[0-9]{1,29}(\.[0-9]{1,9})?\z",
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z",
}
TAKES = {
    "boolean": ["boolean"],
    "bigint": ["bigint"],
    "decimal(38,9)": ["bigint", "decimal(38,9)"],
    "double": ["bigint", "decimal(38,9)", "double"],
    "date": ["date"],
    "timestamp": ["date", "timestamp"],
    "string": [*FORMS, "string"],
}


def narrowest(value: Column) -> Column:
    """The narrowest type of a text, null if it is null or empty."""
    found = F.lit("string")
    for kind, form in reversed(FORMS.items()):
        fits = value.rlike(form)
        if kind in ("date", "timestamp"):
            # There is no 30th of February.
            fits = fits & value.try_cast(kind).isNotNull()
        found = F.when(fits, F.lit(kind)).otherwise(found)
    return F.when(value.isNotNull() & (value != ""), found)


def infer_types(raw: DataFrame, columns: Sequence[str], by: Sequence[str] = (), tolerance: float = 0.0) -> DataFrame:
    """The type of each text column, a row per group of ``by`` and column.

    Returns the groups, ``position``, ``column``, ``type``, ``values``, ``empty`` (nulls and empty texts),
    ``misfits`` (values that the type does not take, at most ``tolerance`` of all) and ``misfit``, the
    least of them. A column without values is a text.
    """
    kinds = list(FORMS) + ["string"]
    held = []
    for position, name in enumerate(columns):
        held.append(F.struct(
            F.lit(position).alias("position"), F.lit(name).alias("column"), F.col(name).alias("value"), narrowest(F.col(name)).alias("kind")
        ))
    values = raw.select(*by, F.explode(F.array(*held)).alias("v")).select(*by, "v.*")
    counts = [F.count_if(F.col("kind") == kind).alias(f"_n_{kind}") for kind in kinds]
    least = [F.min(F.when(F.col("kind") == kind, F.col("value"))).alias(f"_m_{kind}") for kind in kinds]
    counted = values.groupBy(*by, "position", "column").agg(
        F.count("kind").alias("values"), F.count_if(F.col("kind").isNull()).alias("empty"), *counts, *least
    )
    chosen = misfits = misfit = None
    for kind, takes in reversed(TAKES.items()):
        others = [k for k in kinds if k not in takes]
        left = sum((F.col(f"`_n_{k}`") for k in others), F.lit(0).cast("bigint"))
        first = F.array_min(F.array(*[F.col(f"`_m_{k}`") for k in others])) if others else F.lit(None).cast("string")
        if chosen is None:
            chosen, misfits, misfit = F.lit(kind), left, first
            continue
        fits = (F.col("values") > 0) & (left <= F.col("values") * tolerance) & (left < F.col("values"))
        chosen = F.when(fits, F.lit(kind)).otherwise(chosen)
        misfits, misfit = F.when(fits, left).otherwise(misfits), F.when(fits, first).otherwise(misfit)
    return counted.select(
        *by, "position", "column", chosen.alias("type"), "values", "empty", misfits.alias("misfits"), misfit.alias("misfit")
    )


def schema_of(types: DataFrame) -> T.StructType:
    """The rows of one group as a schema; a row per column comes to the driver."""
    rows = types.orderBy("position").select("column", "type").collect()
    return T.StructType([T.StructField(r.column, T.StructType.fromDDL(f"v {r.type}")["v"].dataType) for r in rows])


def read_inferred_csv(spark: SparkSession, path: str | Sequence[str], tolerance: float = 0.0) -> DataFrame:
    """CSV with a header whose types follow from its values, as rows of ``type_rows``.

    Two passes: one for the types, one for the rows. Lines of another number of fields have no
    say in the types and are rejected.
    """
    paths = [path] if isinstance(path, str) else list(path)
    names = spark.read.option("header", True).csv(paths).columns
    fields = ", ".join(f"`{name}` string" for name in [*names, CORRUPT])
    reader = spark.read.schema(fields).option("header", True).option("enforceSchema", False)
    raw = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(paths)
    schema = schema_of(infer_types(raw.where(F.col(CORRUPT).isNull()), names, tolerance=tolerance))
    return type_rows(raw.withColumn(FILE, F.col("_metadata.file_path")), schema)
