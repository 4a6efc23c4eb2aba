"""Silver: the unified survey table, one Parquet partition per edition."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.catalog.editions import EDITION_COLUMN, EDITIONS
from tallyloom.operators.conform import SILVER_SCHEMA, conform_edition
from tallyloom.session import run_together
from tallyloom.sources.tables import (
    Outrun,
    Version,
    drop_folder,
    new_build,
    overwrite_partition,
    partition_folder,
    present,
    publish,
    register_partitions,
)


def refresh_edition(raw: DataFrame, edition: str, location: str) -> None:
    """Replace one edition of a Silver folder. Scan, project, write: nothing is shuffled or sorted."""
    overwrite_partition(conform_edition(raw, edition), location, EDITION_COLUMN, edition)


def refresh_silver(raw_editions: Mapping[str, DataFrame], location: str) -> None:
    """Replace the given editions of a Silver folder; doing so again doubles nothing."""
    spark = next(iter(raw_editions.values())).sparkSession
    jobs = (partial(refresh_edition, raw, edition, location) for edition, raw in raw_editions.items())
    run_together(spark, jobs, concurrency=len(raw_editions))


def create_silver(raw_editions: Mapping[str, DataFrame], table: str, location: str) -> DataFrame:
    """Build the table of exactly the given editions, replacing any earlier one as a whole.

    The editions are written into a folder of their own. Only when all are there is the version published and does the
    table point to it: no reader meets half a build, and an edition that is no longer given is in neither.
    """
    spark = next(iter(raw_editions.values())).sparkSession
    build = new_build(location)
    refresh_silver(raw_editions, build)
    return _publish(spark, table, location, build, {edition: _part(build, edition) for edition in raw_editions})


def replace_edition(raw: DataFrame, edition: str, table: str, location: str) -> DataFrame:
    """Replace, or add, one edition of a published table; the others are neither read nor written.

    The edition is written aside; then a version is published in which it takes the place of the earlier one, and the
    table's partition points to it. A reader sees the old rows of the edition or the new ones, never fewer. Of
    two writers who began with one version the second raises ``Outrun`` and leaves the table as it is.
    """
    spark = raw.sparkSession
    version = present(spark, location)
    if version is None:
        raise FileNotFoundError(f"no Silver table was built below {location}")
    build = new_build(location)
    refresh_edition(raw, edition, build)
    try:
        return _publish(spark, table, location, build, {**version.parts, edition: _part(build, edition)}, version.number)
    except Outrun:
        drop_folder(spark, build)
        raise


def _part(build: str, edition: str) -> str:
    return partition_folder(build.rsplit("/", 1)[1], EDITION_COLUMN, edition)


def _publish(spark: SparkSession, table: str, location: str, build: str, parts: Mapping[str, str], after: int | None = None) -> DataFrame:
    publish(spark, location, build, parts, after)
    return open_silver(spark, table, location)


def open_silver(spark: SparkSession, table: str, location: str) -> DataFrame:
    """The table as it was last published below ``location``, put into this session's catalog if need be."""
    version = present(spark, location)
    if version is None:
        raise FileNotFoundError(f"no Silver table was built below {location}")
    folders = {edition: f"{location}/{folder}" for edition, folder in version.parts.items()}
    return register_partitions(spark, table, location, SILVER_SCHEMA, EDITION_COLUMN, folders)


def read_version(spark: SparkSession, location: str, version: Version) -> DataFrame:
    """The rows of a version that is still kept, whatever was published after it."""
    schema = T.StructType([field for field in SILVER_SCHEMA if field.name != EDITION_COLUMN])
    frames = [
        spark.read.schema(schema).parquet(f"{location}/{folder}").withColumn(EDITION_COLUMN, F.lit(edition))
        for edition, folder in version.parts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


def read_silver(spark: SparkSession, location: str, editions: Iterable[str] = EDITIONS) -> DataFrame:
    """Scan exactly these editions of a folder with the fixed schema, so no file is opened to infer one."""
    folders = [partition_folder(location, EDITION_COLUMN, edition) for edition in editions]
    return spark.read.schema(SILVER_SCHEMA).option("basePath", location).parquet(*folders)
