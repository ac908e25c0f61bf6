"""Run records and summary documents (SNK-6, SNK-7)."""

from __future__ import annotations

import errno
import json
import os
import shutil
import sys
import uuid
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventflow import files
from eventflow.operators.runs import summary_lines

# Functions that tasks run travel with the task, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Folder of submissions that have no name, as Spark calls it.
NO_NAME = "__HIVE_DEFAULT_PARTITION__"


def append_run(spark: SparkSession, path: str, record: dict[str, Any]) -> None:
    """Add one run record, a JSON line, to a folder of records."""
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("append").text(path)


def write_run(spark: SparkSession, folder: str, record: dict[str, Any]) -> str:
    """One record as ``scenario_<id>.json``, replacing an older one of the same id."""
    target = f"{folder.rstrip('/')}/scenario_{record['id']}.json"
    spark.createDataFrame([(json.dumps(record),)], "value string").coalesce(1).write.mode("overwrite").text(f"{target}_parts")
    _single_part(spark, f"{target}_parts", target)
    return target


def write_summary(runs: DataFrame, path: str, single_file: bool = False) -> None:
    """The summary document of ``read_run_records`` rows.

    It is a folder whose parts, written by many tasks, are the document if put together by name.
    With ``single_file``, as some of its readers expect it, lines are ordered by all tasks and
    written by one, which holds none of them.
    """
    record = F.coalesce(F.to_json("record"), F.to_json(F.struct("id", "error", "passed")))
    lines = summary_lines(runs.withColumn("record_json", record))
    text = lines.orderBy("section", "id", "place").select(F.col("line").alias("value"))
    if single_file:
        write_single_text(text, path)
    else:
        text.write.mode("overwrite").text(path)


def write_submissions(texts: DataFrame, root: str) -> None:
    """``submission, text`` rows as ``<root>/<submission>/result.json``, a file each.

    Tasks write the files in place, under a name of their own first, so a task that runs again
    does no harm; nothing is left to do a file for the driver. ``root`` is on storage that Arrow
    reaches: mounted or local folders, HDFS, S3 and the like.
    """
    place = files.qualified(texts.sparkSession, root)
    name = F.coalesce(F.nullif(F.col("submission").cast("string"), F.lit("")), F.lit(NO_NAME))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(place)
        own = f"{folder}/_{uuid.uuid4().hex}"
        try:
            for batch in batches:
                if store.type_name == "local":
                    os.makedirs(own, exist_ok=True)
                for submission, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    content = b"" if text is None else text.encode() + b"\n"
                    if store.type_name != "local" or "/" in submission or submission in (".", ".."):
                        _put_file(store, f"{folder}/{submission}", content)
                    elif not _put_folder(own, folder, submission, content):
                        _put_file(store, f"{folder}/{submission}", content)
                yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]}, pa.schema([("n", pa.int64())]))
        finally:
            shutil.rmtree(own, ignore_errors=True)

    rows = texts.select(name.alias("submission"), F.col("text").alias("value"))
    rows.mapInArrow(write, "n long").agg(F.sum("n")).collect()


def _put_folder(own: str, folder: str, submission: str, content: bytes) -> bool:
    """A submission that is not there yet, made in the task's ``own`` folder and moved in as a whole.

    Tasks that make folders in one and the same wait for each other; to move one there takes less.
    """
    made, target = f"{own}/{submission}", f"{folder}/{submission}"
    os.mkdir(made)
    with open(f"{made}/result.json", "wb", 0) as out:
        out.write(content)
    try:
        os.rename(made, target)
    except OSError as error:
        if error.errno not in (errno.EEXIST, errno.ENOTEMPTY):
            raise
        shutil.rmtree(made)
        return False
    return True


def _put_file(store: fs.FileSystem, folder: str, content: bytes) -> None:
    """The file of a submission that may be there, whose folder keeps what else it holds."""
    store.create_dir(folder, recursive=True)
    own = f"{folder}/_{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(content)
    # Hadoop's checksum of an older file, which would no longer hold.
    checksum = f"{folder}/.result.json.crc"
    if store.type_name == "local" and store.get_file_info(checksum).type == fs.FileType.File:
        store.delete_file(checksum)
    store.move(own, f"{folder}/result.json")


def write_single_text(lines: DataFrame, path: str) -> None:
    """Ordered lines as one file."""
    lines.coalesce(1).write.mode("overwrite").text(f"{path}_parts")
    _single_part(lines.sparkSession, f"{path}_parts", path)


def _single_part(spark: SparkSession, folder: str, target: str) -> None:
    part = next(name for name in files.children(spark, folder) if name.startswith("part-"))
    files.move(spark, f"{folder}/{part}", target)
    files.remove(spark, folder)
