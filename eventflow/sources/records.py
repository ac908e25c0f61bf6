"""Run records and summary documents, one JSON file each (SRC-6, SRC-7)."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from itertools import batched

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow.files import qualified
from eventflow.functions.json import parse_document
from eventflow.session import setting, work_dir

# Functions that tasks run travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A task passes texts on when it holds as many bytes of them.
BLOCK_BYTES = 8 << 20
# Characters that Hadoop takes for patterns of paths.
WILDCARDS = frozenset("*?[]{}\\")

Batches = Iterator[pa.RecordBatch]


def read_run_records(spark: SparkSession, glob: str) -> DataFrame:
    """Files ``scenario_<id>.json`` as typed common fields plus the whole ``record``."""
    files = spark.read.text(glob, wholetext=True)
    name = F.regexp_extract(F.col("_metadata.file_name"), r"([^/]*?)\.json$", 1)
    return parse_run_records(
        files.select(F.regexp_replace(name, "^scenario_", "").alias("id"), F.col("value").alias("text"))
    )


def parse_run_records(texts: DataFrame) -> DataFrame:
    """Columns ``id`` (of the file) and ``text`` to run records.

    A text that is no JSON object becomes a failed record with an error instead of being
    lost. A field counts only if its value is of the right kind; those that are not are
    named in ``error``, next to the record's own, and the run has not passed.
    """
    record = texts.select("id", parse_document(F.col("text")).alias("record"))
    is_object = F.coalesce(F.schema_of_variant("record").startswith("OBJECT"), F.lit(False))
    kinds = {"id": "STRING", "name": "STRING", "passed": "BOOLEAN", "elapsed_ms": "BIGINT", "error": "STRING"}
    wrong = F.array_compact(F.array(*[
        F.when(F.schema_of_variant(_get(field, "variant")) != kind, F.lit(field)) for field, kind in kinds.items()
    ]))
    checked = record.withColumns({"wrong": F.when(is_object, wrong), "readable": is_object})

    def value(field: str, kind: str) -> Column:
        return F.when(F.col("readable") & ~F.array_contains("wrong", field), _get(field, kind))

    unusable = F.when(F.size("wrong") > 0, F.concat(F.lit("wrong type: "), F.array_join("wrong", ", ")))
    return checked.select(
        F.coalesce(value("id", "string"), F.col("id")).alias("id"),
        value("name", "string").alias("name"),
        (F.coalesce(value("passed", "boolean"), F.lit(False)) & F.coalesce(F.size("wrong") == 0, F.lit(False))).alias("passed"),
        F.coalesce(value("elapsed_ms", "bigint"), F.lit(0)).cast("bigint").alias("elapsed_ms"),
        F.when(~F.col("readable"), F.lit("unreadable")).otherwise(
            F.nullif(F.concat_ws("; ", value("error", "string"), unusable), F.lit(""))
        ).alias("error"),
        "record",
    )


def read_submissions(
    spark: SparkSession, root: str, expected: DataFrame | None = None
) -> DataFrame:
    """``<root>/<submission>/result.json`` for all submissions in one job.

    ``expected`` (column ``submission``) adds those without a file, with a null text; only
    names are compared, the texts are not shuffled. An empty file counts as none. In a local or
    mounted folder one task lists the names and tasks read the files that they are dealt, so that
    neither the driver nor the plan holds anything of a file; texts are put into a working folder,
    and a file is opened once however often the rows are used. Other storage, and patterns of
    folders, are listed by the driver.
    """
    folder = _mounted(spark, root)
    if folder is None:
        return _listed_by_driver(spark, root, expected)
    names = spark.range(0, 1, 1, 1).mapInArrow(_names_in(folder), "name binary").select(
        "name", F.lit(True).alias("listed"), F.lit(False).alias("expected")
    )
    if expected is not None:
        name = F.col("submission").cast("string").cast("binary").alias("name")
        asked = expected.select(name, F.lit(False).alias("listed"), F.lit(True).alias("expected"))
        names = names.unionByName(asked).groupBy("name").agg(F.bool_or("listed").alias("listed"), F.bool_or("expected").alias("expected"))
    # A name of few bytes is a file to open, so they are dealt by number and not by bytes.
    dealt = names.repartition(4 * spark.sparkContext.defaultParallelism)
    read = dealt.mapInArrow(_texts_in(folder), "name binary, text binary")
    path = work_dir(spark, "submission-texts")
    read.select(F.col("name").cast("string").alias("submission"), F.col("text").cast("string").alias("text")).write.parquet(path)
    return spark.read.schema("submission string, text string").parquet(path)


def _mounted(spark: SparkSession, root: str) -> str | None:
    """The local folder that a path names, if it does and a result file is in it."""
    if WILDCARDS & set(root):
        return None
    place = qualified(spark, root.rstrip("/") or "/")
    if not place.startswith("file:"):
        return None
    _, folder = fs.FileSystem.from_uri(place)
    try:
        with os.scandir(folder) as entries:
            return folder if any(os.path.isfile(f"{entry.path}/result.json") for entry in entries) else None
    except (FileNotFoundError, NotADirectoryError):
        return None


def _names_in(folder: str) -> Callable[[Batches], Batches]:
    """Tasks' function that lists a folder. Names are bytes, which need not be a text."""

    def names(batches: Batches) -> Batches:
        for _ in batches:
            with os.scandir(os.fsencode(folder)) as entries:
                for block in batched((entry.name for entry in entries), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(block, pa.binary())], ["name"])

    return names


def _texts_in(folder: str) -> Callable[[Batches], Batches]:
    """Tasks' function from names to texts; only those that were listed are looked for."""

    def block(names: list[bytes | None], texts: list[bytes | None]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(texts, pa.binary())], ["name", "text"])

    def texts(batches: Batches) -> Batches:
        start = os.fsencode(folder.rstrip("/"))
        for batch in batches:
            names, found, held = [], [], 0
            for name, listed, expected in zip(*(column.to_pylist() for column in batch.columns)):
                text = _content(b"%b/%b/result.json" % (start, name)) if listed else None
                if text or expected:
                    names.append(name)
                    found.append(text or None)
                    held += len(text or b"")
                if held >= BLOCK_BYTES:
                    yield block(names, found)
                    names, found, held = [], [], 0
            yield block(names, found)

    return texts


def _content(path: bytes) -> bytes | None:
    try:
        with open(path, "rb", 0) as file:
            return file.readall()
    except (FileNotFoundError, NotADirectoryError, IsADirectoryError):
        return None


def _listed_by_driver(spark: SparkSession, root: str, expected: DataFrame | None) -> DataFrame:
    # By default files are listed by up to 10,000 tasks, which cost more than the listing.
    listing = str(4 * spark.sparkContext.defaultParallelism)
    with setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", listing):
        files = spark.read.text(f"{root.rstrip('/')}/*/result.json", wholetext=True)
    found = files.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/result\.json$", 1).alias("submission"),
        F.col("value").alias("text"),
    )
    if expected is None:
        return found
    missing = expected.select("submission").distinct().join(found.select("submission"), "submission", "left_anti")
    return found.unionByName(missing.withColumn("text", F.lit(None).cast("string")))


def _get(field: str, kind: str) -> Column:
    return F.try_variant_get(F.col("record"), f"$.{field}", kind)
