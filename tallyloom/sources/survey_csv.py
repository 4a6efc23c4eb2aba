"""Raw survey exports: CSV folders whose quoted answers may span lines."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.session import shared_dir
from tallyloom.sources.split_csv import read_records, record_fields, scan_ranges
from tallyloom.sources.split_csv import parsed as parsed_records

# One dialect for reading and writing: a quote inside a field is doubled, blanks around answers are kept.
DIALECT = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# A record with more or fewer fields than its header fails. That needs every column of every record to
# be looked at, whatever is selected.
STRICT = {"mode": "FAILFAST", "columnPruning": "false"}


@dataclass(frozen=True)
class Export:
    """A file of an edition: its own header and the line break that ends its records."""

    path: str
    header: tuple[str, ...]
    record_end: str


def scanned(spark: SparkSession, folder: str) -> DataFrame:
    """What one scan tells of all files below ``folder``: their byte ranges, quotes and headers, written down."""
    ranges = scan_ranges(spark, folder)
    written = f"{shared_dir(spark)}/csv-ranges/{uuid.uuid4().hex}"
    ranges.write.parquet(written)
    return spark.read.schema(ranges.schema).parquet(written)


def survey_files(spark: SparkSession, folder: str, ranges: DataFrame | None = None) -> list[Export]:
    """Every file below ``folder`` that has a header, from one job however many files there are."""
    ranges = scanned(spark, folder) if ranges is None else ranges
    _require_headers(ranges)
    found = ranges.where("header is not null").select("path", "header").collect()
    exports = [Export(unquote(row["path"]), *_layout(row["header"])) for row in sorted(found)]
    return [export for export in exports if export.header]


def _require_headers(ranges: DataFrame) -> None:
    cut = [row["path"] for row in ranges.where("start = 0 and header is null").select("path").limit(5).collect()]
    if cut:
        raise ValueError(f"headers whose quotes stay open: {', '.join(cut)}")


def _layout(header: str) -> tuple[tuple[str, ...], str]:
    """The names in a header as it is written, and the line break that ends the records."""
    record_end = "\r\n" if header.endswith("\r") else "\n"
    return record_fields(header.removesuffix("\r").removeprefix("\ufeff")), record_end


def header_drift(exports: Iterable[Export]) -> dict[str, list[str]]:
    """For each file the columns of the others that it lacks; its rows have NULL there."""
    exports = list(exports)
    names = list(dict.fromkeys(name for export in exports for name in export.header))
    return {export.path: [name for name in names if name not in export.header] for export in exports}


def read_survey_csv(spark: SparkSession, folder: str, record_end: str | None = None, ranges: DataFrame | None = None) -> DataFrame:
    """Every file below ``folder``, all columns as strings, each file under its own header.

    Files of one edition may order their columns differently, lack some and have others: columns
    meet by name, and what a file lacks is NULL. A record with a field too many or too few
    fails. So do names that occur twice, or not at all, where headers differ: nothing says which
    column is meant. Records end as the header does, so that a carriage return in an answer stays.

    By default a quoted answer may hold any line break, and files are divided and read by many tasks
    nevertheless; that takes two scans, and a third where a record crosses a border (``split_csv``).

    ``record_end`` names the line break that ends a record and occurs in no answer: often
    ``\\r\\n``, with bare ``\\n`` inside answers. Spark's own reader then divides the files. An export that breaks
    the promise fails, since a cut record lacks columns. ``ranges`` is what ``scanned`` found, if that is known.
    """
    ranges = scanned(spark, folder) if ranges is None else ranges
    if record_end is None:
        return _read_divided(spark, folder, ranges)
    exports = survey_files(spark, folder, ranges)
    if not exports:
        raise ValueError(f"no file with a header below {folder}")
    others = sorted(export.path for export in exports if export.record_end != record_end)
    if others:
        raise ValueError(f"records do not end in {record_end!r} in {', '.join(others[:5])}")
    layouts: dict[tuple[str, ...], list[str]] = {}
    for export in exports:
        layouts.setdefault(export.header, []).append(export.path)
    _require_clear(list(layouts))
    frames = [_read(spark, paths, record_end) for paths in layouts.values()]
    return reduce(partial(DataFrame.unionByName, allowMissingColumns=True), frames)


def header_layouts(ranges: DataFrame) -> dict[str, tuple[tuple[str, ...], str]]:
    """Every header as it is written, with its names and record end; files that begin with an empty line have none."""
    _require_headers(ranges)
    texts = sorted(row["header"] for row in ranges.where("header is not null").select("header").distinct().collect())
    return {text: layout for text in texts if (layout := _layout(text))[0]}


def _read_divided(spark: SparkSession, folder: str, ranges: DataFrame) -> DataFrame:
    layouts = header_layouts(ranges)
    if not layouts:
        raise ValueError(f"no file with a header below {folder}")
    headers = list(dict.fromkeys(header for header, _ in layouts.values()))
    _require_clear(headers)
    # Files that differ only in their record end are one layout for the columns, and two for the scan.
    numbers = {text: number for number, text in enumerate(layouts)}
    ends = {numbers[text]: end for text, (_, end) in layouts.items()}
    columns = {numbers[text]: own_names(header) for text, (header, _) in layouts.items()}
    records = read_records(spark, folder, ranges, numbers)
    returned = F.col("layout").isin([number for number, end in ends.items() if end == "\r\n"])
    # Records end as the header does: a line break of another kind is no end, and must not pass for one.
    broken = F.raise_error(F.concat(F.lit("MALFORMED_RECORD: its line break is not that of the header: "), F.substring("text", 1, 200)))
    text = F.when(returned & F.col("ended") & ~F.endswith("text", F.lit("\r")), broken.cast("string"))
    text = text.when(returned, F.regexp_replace("text", r"\r\z", "")).otherwise(F.col("text"))
    rows = records.select("layout", text.alias("text")).where("layout is not null and text != ''")
    options = {"mode": "FAILFAST", **{key: value for key, value in DIALECT.items() if key != "header"}}
    return parsed_records(rows, columns, dict.fromkeys(columns, options))


def own_names(header: Sequence[str]) -> list[str]:
    """Column names as Spark's reader gives them: repeated ones with their position, empty ones by it."""
    lowered = [name.lower() for name in header]
    return [f"_c{i}" if not name else f"{name}{i}" if lowered.count(name.lower()) > 1 else name for i, name in enumerate(header)]


def _read(spark: SparkSession, paths: Sequence[str], record_end: str) -> DataFrame:
    return spark.read.options(**DIALECT).options(**STRICT).options(lineSep=record_end).csv(list(paths))


def _require_clear(headers: list[tuple[str, ...]]) -> None:
    if len(headers) > 1:
        for header in headers:
            _require_names(header)


def _require_names(header: Sequence[str]) -> None:
    lowered = [name.lower() for name in header]
    unclear = sorted({name for name in header if not name or lowered.count(name.lower()) > 1})
    if unclear:
        raise ValueError(f"headers differ and one has names that are not its own: {unclear}")


def write_survey_csv(df: DataFrame, folder: str, rows_per_file: int = 1_000_000) -> None:
    """Write rows as such an export, in files small enough for one read task each."""
    writer = df.write.mode("overwrite").options(**DIALECT)
    writer.option("quoteAll", True).option("maxRecordsPerFile", rows_per_file).csv(folder)
