"""Helpers shared by the corpus operators: reading, stored intermediates, small expressions."""

from __future__ import annotations

import contextlib
import ctypes
import io
import os
import string
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

import tallyloom
from tallyloom.session import shared_dir

_shipped: set[str] = set()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own below the one that ``spark.checkpoint.dir`` names."""
    return f"{shared_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cut lineage that outlives executors."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def mapped(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with a function of this package; workers give back the memory they needed when a task ends."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Returns freed memory to the system: an idle worker would keep it beside those that work."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it keeps its memory
        ctypes.CDLL(None).malloc_trim(0)


def ship(spark: SparkSession) -> None:
    """Lets the executors' Python import this package, also where it is not installed on them.

    The code goes into the shared folder once per application, and from there to the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(tallyloom.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in (n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(top)))
    target = f"{scratch(spark, 'code')}/tallyloom-code.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    stream.write(packed.getvalue())
    stream.close()
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that ``df`` does not have."""
    taken = {column.lower() for column in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 1 modulo 3, or the id is missing."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))
