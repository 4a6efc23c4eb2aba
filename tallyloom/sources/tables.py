"""Parquet tables in the catalog."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyloom.functions import quoted, text


def save_table(df: DataFrame, table: str, location: str | None = None) -> DataFrame:
    """Create or fully replace a Snappy Parquet table and return a scan of it.

    Column names may hold quotes, commas or dots. With ``location`` the table is external:
    its data lie in that folder and its catalog entry points there.
    """
    writer = df.write.format("parquet").mode("overwrite").option("compression", "snappy")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def partition_folder(location: str, column: str, value: str) -> str:
    return f"{location}/{column}={value}"


def overwrite_partition(df: DataFrame, location: str, column: str, value: str) -> None:
    """Replace one partition of a folder and leave the others alone.

    Rows go straight into the partition they all belong to. A write that had to work out the
    partition of each row would first sort every task's rows by it.
    """
    writer = df.drop(column).write.mode("overwrite").option("compression", "snappy")
    writer.parquet(partition_folder(location, column, value))


def register_partitions(spark: SparkSession, table: str, root: str, schema: T.StructType, column: str, folders: Mapping[str, str]) -> DataFrame:
    """Point a partitioned external table to the folder of each value of ``column``; readers find the table throughout.

    A table that exists with these columns stays: the folders of its partitions are set one by one, and values no
    longer given are dropped. Otherwise it is created anew.
    """
    own = [(field.name, field.dataType) for field in schema if field.name != column] + [(column, T.StringType())]
    if spark.catalog.tableExists(table) and [(field.name, field.dataType) for field in spark.table(table).schema] == own:
        present = {row[0].split("=", 1)[1] for row in spark.sql(f"show partitions {table}").collect()}
        for value, folder in folders.items():
            if value in present:
                spark.sql(f"alter table {table} partition ({column} = {text(value)}) set location {text(folder)}")
            else:
                spark.sql(f"alter table {table} add partition ({column} = {text(value)}) location {text(folder)}")
        for value in sorted(present.difference(folders)):
            spark.sql(f"alter table {table} drop partition ({column} = {text(value)})")
    else:
        columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in schema)
        spark.sql(f"drop table if exists {table}")
        spark.sql(f"create table {table} ({columns}) using parquet partitioned by ({column}) location {text(root)}")
        for value, folder in folders.items():
            spark.sql(f"alter table {table} add partition ({column} = {text(value)}) location {text(folder)}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def register_folder(spark: SparkSession, table: str, build: str) -> DataFrame:
    """Point an external table to a folder of Parquet files; one that exists with the same columns stays."""
    schema = spark.read.parquet(build).schema
    if spark.catalog.tableExists(table) and spark.table(table).schema == schema:
        spark.sql(f"alter table {table} set location {text(build)}")
    else:
        spark.sql(f"drop table if exists {table}")
        spark.catalog.createTable(table, path=build, source="parquet")
    spark.catalog.refreshTable(table)
    return spark.table(table)


# Versions: a table's files are written into new folders below its root and published when they are whole. A
# version is a small file that names the folders; it appears at once, by a rename, and never changes. The one with the
# largest number is the present one, so a later session finds it, and a reader that began with an earlier one goes on.

VERSIONS = "versions"
KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Version:
    """What a table consisted of: one folder, or one for each partition; all below the root."""

    number: int
    build: str
    parts: dict[str, str]

    def folders(self) -> set[str]:
        return {folder.split("/")[0] for folder in (self.build, *self.parts.values())}


class Outrun(RuntimeError):
    """Another writer published first."""


def new_build(root: str) -> str:
    return f"{root}/build-{uuid.uuid4().hex[:12]}"


def versions(spark: SparkSession, root: str) -> list[Version]:
    """The versions of ``root`` that are still there, the oldest first."""
    fs, path = _file_system(spark, f"{root}/{VERSIONS}")
    if not fs.exists(path):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(path)]
    return [_version(spark, f"{root}/{VERSIONS}/{name}") for name in sorted(name for name in names if re.fullmatch(r"v\d{10}\.json", name))]


def _version(spark: SparkSession, file: str) -> Version:
    fs, path = _file_system(spark, file)
    stream = fs.open(path)
    try:
        content = bytes(stream.readAllBytes())
    finally:
        stream.close()
    return Version(**json.loads(content))


def publish(spark: SparkSession, root: str, build: str, parts: Mapping[str, str] | Sequence[str] = (), after: int | None = None, keep: int = KEPT_VERSIONS) -> Version:
    """Make ``build`` the present version of ``root``: all of it or nothing.

    ``parts`` names partitions below the build, or maps each to its folder below the root. ``after`` is the number of the version
    that the new one was made from: if another was published since, nothing happens and ``Outrun`` is raised. The last ``keep``
    versions and their folders stay for the readers that are on them; what only older ones name is removed.
    """
    name = build.rsplit("/", 1)[1]
    folders = dict(parts) if isinstance(parts, Mapping) else {part: f"{name}/{part}" for part in parts}
    earlier = versions(spark, root)
    last = earlier[-1].number if earlier else 0
    if after is not None and after != last:
        raise Outrun(f"version {last} of {root} was published after {after}")
    version = Version(last + 1, name, folders)
    aside, target = (f"{root}/{VERSIONS}/{file}" for file in (f".{uuid.uuid4().hex}", f"v{version.number:010d}.json"))
    fs, path = _file_system(spark, aside)
    stream = fs.create(path)
    stream.write(json.dumps(asdict(version)).encode())
    stream.close()
    _rename(spark, aside, target)
    old, kept = [*earlier, version][:-keep], [*earlier, version][-keep:]
    needed = set().union(*(one.folders() for one in kept))
    for one in old:  # the version goes first: what is not named any more may lie about, but nothing named is missing
        drop_folder(spark, f"{root}/{VERSIONS}/v{one.number:010d}.json")
    for folder in set().union(*(one.folders() for one in old)) - needed if old else ():
        drop_folder(spark, f"{root}/{folder}")
    return version


def _rename(spark: SparkSession, source: str, target: str) -> None:
    """A rename that never replaces: of two writers of one version the second fails."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(source), hadoop.Path(target)
    files = hadoop.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()) if target.toUri().getScheme() else hadoop.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(source, target, options)
    except Exception as error:
        files.delete(source, False)
        if "FileAlreadyExists" in str(error):
            raise Outrun(f"{target.getName()} was published by another writer") from None
        raise


def present(spark: SparkSession, root: str) -> Version | None:
    """The present version of ``root``, if one was published."""
    found = versions(spark, root)
    return found[-1] if found else None


def published(spark: SparkSession, root: str) -> tuple[str, list[str]] | None:
    """The folder of the present build of ``root`` and the names of its partitions, if one was published."""
    version = present(spark, root)
    return (f"{root}/{version.build}", list(version.parts)) if version else None


def drop_folder(spark: SparkSession, folder: str) -> None:
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path
