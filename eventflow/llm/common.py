"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.session import work_dir

# White space of the text contracts: space and the controls 9 to 13.
BLANKS = r"[\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(table: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back.

    What is read twice is computed once, and a lost executor costs no recomputation. The
    folder lives below ``spark.checkpoint.dir`` and is as durable as that folder is.
    """
    spark = table.sparkSession
    path = work_dir(spark, purpose)
    table.write.parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(column: str, modulus: int) -> Column:
    """crc32 of the id's text modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def small_side(table: DataFrame, most_rows: int) -> DataFrame:
    """The table marked for broadcasting if a count shows that it has at most ``most_rows``.

    Beyond that it is left as it is: the join shuffles, and adaptive execution splits
    skewed partitions.
    """
    rows = table.limit(most_rows + 1).count()
    return F.broadcast(table) if rows <= most_rows else table


def single_threaded() -> None:
    """Numeric libraries of a Python worker keep to the one core of their task."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ.setdefault(name, "1")


def rows_of(batches: Iterator, columns: list[str]) -> Iterator[tuple]:
    """Python rows of Arrow batches, a few hundred at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in columns))
