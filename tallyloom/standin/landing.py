"""Tables written once per application into the shared folder and scanned by many queries."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.plans.silver import read_silver, refresh_silver
from tallyloom.session import shared_dir
from tallyloom.sources.survey_csv import write_survey_csv
from tallyloom.sources.tables import drop_folder
from tallyloom.standin.answers import mapped_answers, raw_editions, table

_landed: dict[tuple, str] = {}
_scratch: dict[tuple[str, str], str] = {}
_lock = threading.Lock()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one write, so no reader ever sees it replaced."""
    return f"{shared_dir(spark)}/tallyloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder for a query's own copy; the one of the query's last call is dropped."""
    key = (spark.sparkContext.applicationId, name)
    folder = fresh_folder(spark, name)
    with _lock:
        before, _scratch[key] = _scratch.get(key), folder
    if before:
        drop_folder(spark, before)
    return folder


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """What lies below a folder: names, sizes and times of change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for status in fs.listStatus(path):
        inner = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in inner]
    return tuple(sorted(found))


def _once(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """The folder a table was landed in; landed anew when the files it comes from have changed."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir), name)
    with _lock:
        if key not in _landed:
            folder = fresh_folder(spark, name)
            write(folder)
            _landed[key] = folder
        return _landed[key]


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified table of the stand-in survey."""
    folder = _once(spark, sf_dir, "silver", lambda to: refresh_silver(raw_editions(spark, sf_dir), to))
    return read_silver(spark, folder)


def answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All editions' answers as they were given, under unified names."""
    rows = mapped_answers(spark, sf_dir)
    folder = _once(spark, sf_dir, "answers", rows.write.parquet)
    return spark.read.schema(rows.schema).parquet(folder)


def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """Folder of CSV files whose fields hold quotes and line breaks."""

    def write(folder: str) -> None:
        write_survey_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), folder, rows_per_file=50_000)

    return _once(spark, sf_dir, "documents-csv", write)


def drifting_csv(spark: SparkSession, sf_dir: str) -> str:
    """The documents in files that order their columns differently, lack one or have one more."""
    layouts = (["doc_id", "text", "lang"], ["lang", "text", "source", "doc_id"], ["text", "doc_id"])

    def write(folder: str) -> None:
        documents = table(spark, sf_dir, "documents")
        # Every row goes to a file: negative remainders to the first layout, missing ids to the last.
        layout = F.coalesce(F.col("doc_id") % len(layouts), F.lit(len(layouts) - 1))
        for number, columns in enumerate(layouts):
            part = documents.where(F.greatest(layout, F.lit(0)) == number)
            write_survey_csv(part.select(*columns), f"{folder}/{number}", rows_per_file=50_000)

    return _once(spark, sf_dir, "drifting-csv", write)


def one_line_csv(spark: SparkSession, sf_dir: str) -> str:
    """The documents with their line breaks written as a sign, so that files can be split."""

    def write(folder: str) -> None:
        text = reduce(lambda t, mark: F.replace(t, F.lit(mark), F.lit("\u00b6")), ("\n", "\r"), F.col("text"))
        write_survey_csv(table(spark, sf_dir, "documents").select("doc_id", text.alias("text")), folder)

    return _once(spark, sf_dir, "one-line-csv", write)
