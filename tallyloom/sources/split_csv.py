"""Quoted CSV of any size read by many tasks, whatever line breaks its answers hold.

Spark's line reader divides files at byte ranges and gives every line to the range that it begins in. Whether a line begins a
record depends on the quotes before it: a record begins where their number is even. One scan therefore counts the
quotes of every range, and takes the header of every file on the way; sums of these counts over the ranges of a file,
a few numbers for each, tell how every range begins. A second scan puts the lines of each range together to records.
A record that crosses a border leaves a part in either range; such parts, two for a border at most, are
sorted and put together apart, in a scan of their own that is left out where no record crosses a border.

Both scans see the same ranges, since Spark divides the same files alike; a range that was not counted is an error.
Fields are then parsed by Spark from each record, under the header of the record's file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGES = "path string, start bigint, odd boolean, header string"
PIECES = "path string, start bigint, layout int, place int, text string"
#: Ranges up to this number, some hundred bytes each, are broadcast; more are joined by a shuffle.
BROADCAST_RANGES = 100_000

# Where a piece of a record stands in its range: it is whole, it began before, or it ends behind.
# LAST is a whole record that may end with its file, and without a line break.
WHOLE, LAST, HEAD, TAIL, HEADER_TAIL = range(5)


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True).text(folder)
    start, length, size = (F.col(f"_metadata.{name}") for name in ("file_block_start", "file_block_length", "file_size"))
    return text.select(F.col("_metadata.file_path").alias("path"), start.alias("start"), "value", (start + length >= size).alias("last"))


def scan_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """``path``, ``start``, whether the range has an odd number of quotes, and in a file's first range its header.

    One job over all files below ``folder``, however many there are. A header whose quotes are still open
    at the end of its range is missing there.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        at, quotes, header, closed = None, 0, [], False

        def row() -> pa.RecordBatch:
            text = "\n".join(header) if at[1] == 0 and closed else None
            columns = [[at[0]], [at[1]], [quotes % 2 == 1], [text]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "start", "odd", "header"])

        for batch in batches:
            if not batch.num_rows:
                continue
            path, start, lines = batch.column(0), batch.column(1), batch.column(2)
            counts = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)
            new = np.ones(len(lines), dtype=bool)
            new[1:] = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
            bounds = [*np.flatnonzero(new).tolist(), len(lines)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                own = (path[low].as_py(), start[low].as_py())
                if own != at:
                    if at is not None:
                        yield row()
                    at, quotes, header, closed = own, 0, [], False
                if own[1] == 0 and not closed:
                    open_quotes = quotes
                    for i in range(low, high):
                        header.append(lines[i].as_py())
                        open_quotes += int(counts[i])
                        if open_quotes % 2 == 0:
                            closed = True
                            break
                quotes += int(counts[low:high].sum())
        if at is not None:
            yield row()

    return _lines(spark, folder).mapInArrow(scan, RANGES)


def with_beginnings(ranges: DataFrame) -> DataFrame:
    """Ranges with ``inside``: whether a record that began before is still open where the range begins."""
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    quotes = F.coalesce(F.sum(F.col("odd").cast("int")).over(before), F.lit(0))
    return ranges.withColumn("inside", quotes % 2 == 1)


def _pieces(spark: SparkSession, folder: str, beginnings: DataFrame, broadcast: bool) -> DataFrame:
    """Records that lie in one range, and the parts of those that do not, in the order they stand there."""
    known = beginnings.select(F.col("path").alias("__path"), F.col("start").alias("__start"), "inside", "layout")
    same = (F.col("path") == F.col("__path")) & (F.col("start") == F.col("__start"))
    lines = _lines(spark, folder)
    if broadcast:
        met = lines.join(F.broadcast(known), same, "left")
    else:  # dealt out by range, as repartition() does and no skewed join may do anew, and put in order again
        dealt = lines.withColumn("at", F.monotonically_increasing_id()).repartition("path", "start")
        met = dealt.join(known.hint("merge"), same, "left").sortWithinPartitions("path", "start", "at")
    unknown = F.raise_error(F.lit("a file changed while it was read")).cast("boolean")
    met = met.select("path", "start", F.when(F.col("inside").isNull(), unknown).otherwise(F.col("inside")).alias("inside"), "layout", "value", "last")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        at, layout, pending, is_head, is_header, is_last = None, None, [], False, False, False
        held: str | None = None  # the last record found: whether others follow is not known yet

        def release(place: int = WHOLE) -> Iterator[pa.RecordBatch]:
            nonlocal held
            if held is not None:
                yield rows(pa.array([held], pa.string()), place)
                held = None

        def rows(texts: pa.Array, place: int) -> pa.RecordBatch:
            n = len(texts)
            columns = [pa.array([at[0]] * n, pa.string()), pa.array([at[1]] * n, pa.int64()), pa.array([layout] * n, pa.int32()), pa.array([place] * n, pa.int32()), texts]
            return pa.RecordBatch.from_arrays(columns, ["path", "start", "layout", "place", "text"])

        def unfinished() -> Iterator[pa.RecordBatch]:
            """What a range leaves: the last record, and a part whose record goes on behind the range."""
            yield from release(LAST if is_last and not pending else WHOLE)
            if pending:
                yield rows(pa.array(["\n".join(pending)], pa.string()), HEAD if is_head else HEADER_TAIL if is_header else TAIL)

        for batch in batches:
            if not batch.num_rows:
                continue
            path, start, lines = batch.column(0), batch.column(1), batch.column(4)
            odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2
            new = np.ones(len(lines), dtype=bool)
            new[1:] = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(start[1:], start[:-1])).to_numpy(zero_copy_only=False)
            bounds = [*np.flatnonzero(new).tolist(), len(lines)]
            for low, high in zip(bounds, bounds[1:], strict=False):
                own = (path[low].as_py(), start[low].as_py())
                if own != at:
                    yield from unfinished()
                    at, layout, pending = own, batch.column(3)[low].as_py(), []
                    is_head, is_header, is_last = batch.column(2)[low].as_py(), own[1] == 0, batch.column(5)[low].as_py()
                    inside = int(is_head)
                else:
                    inside = int(bool(pending))
                after = (inside + np.cumsum(odd[low:high])) % 2
                firsts = np.flatnonzero(np.append(inside, after[:-1]) == 0)
                open_lines = int(firsts[0]) if len(firsts) else high - low
                if open_lines:  # of the record that is pending
                    pending.extend(lines[low : low + open_lines].to_pylist())
                    if after[open_lines - 1] == 0:
                        if is_head:
                            yield rows(pa.array(["\n".join(pending)], pa.string()), HEAD)
                        elif not is_header:
                            yield from release()
                            held = "\n".join(pending)
                        pending, is_head, is_header = [], False, False
                if not len(firsts):
                    continue
                ends = np.append(firsts[1:], high - low)
                if is_header:  # the first record of the file
                    pending = lines[low + int(firsts[0]) : low + int(ends[0])].to_pylist()
                    if after[ends[0] - 1] == 0:
                        pending, is_header = [], False
                    firsts, ends = firsts[1:], ends[1:]
                    if not len(firsts):
                        continue
                if after[-1]:
                    pending = lines[low + int(firsts[-1]) : high].to_pylist()
                    firsts, ends = firsts[:-1], ends[:-1]
                if not len(firsts):
                    continue
                yield from release()
                texts = lines[low + int(firsts[0]) : low + int(ends[-1])]
                if len(texts) > len(firsts):
                    offsets = pa.array(np.append(firsts, ends[-1]).astype(np.int32) - np.int32(firsts[0]))
                    texts = pc.binary_join(pa.ListArray.from_arrays(offsets, texts), "\n")
                held = texts[len(texts) - 1].as_py()
                yield rows(texts[: len(texts) - 1], WHOLE)
        yield from unfinished()

    return met.mapInArrow(cut, PIECES)


def _mended(parts: DataFrame) -> DataFrame:
    """Records out of the parts that borders cut: a tail, and the heads behind it up to the next tail."""
    tail = F.col("place").isin(TAIL, HEADER_TAIL)
    order = Window.partitionBy("path").orderBy("start", tail.cast("int"))
    numbered = parts.withColumn("record", F.sum(tail.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = F.sort_array(F.collect_list(F.struct("start", tail.cast("int").alias("tail"), "text")))
    whole = numbered.groupBy("path", "layout", "record").agg(pieces.alias("pieces"), F.max(F.col("place") == HEADER_TAIL).alias("header"))
    return whole.where(~F.col("header")).select("layout", F.array_join(F.transform("pieces", lambda piece: piece["text"]), "\n").alias("text"), F.lit(False).alias("ended"))


def record_fields(text: str) -> tuple[str, ...]:
    """The fields of one record."""
    return tuple(next(csv.reader(io.StringIO(text, newline="")), ()))


def read_records(spark: SparkSession, folder: str, ranges: DataFrame, layouts: dict[str, int], most: int = BROADCAST_RANGES) -> DataFrame:
    """``layout`` and ``text`` of every record but the headers, and whether a line break must have ``ended`` it.

    ``layouts`` numbers the headers as they are written, ``ranges`` is what ``scan_ranges`` found, written down. Up to ``most`` ranges are broadcast.
    """
    headers = ranges.where("header is not null").select(F.col("path").alias("__path"), _number(layouts, F.col("header")).alias("layout"))
    beginnings = with_beginnings(ranges).join(headers, F.col("path") == F.col("__path"), "left").select("path", "start", "inside", "layout")
    pieces = _pieces(spark, folder, beginnings, ranges.count() <= most)
    records = pieces.where(F.col("place").isin(WHOLE, LAST)).select("layout", "text", (F.col("place") == WHOLE).alias("ended"))
    if beginnings.where("inside").isEmpty():
        return records
    return records.unionByName(_mended(pieces.where(F.col("place").isin(HEAD, TAIL, HEADER_TAIL))))


def _number(layouts: dict[str, int], header: Column) -> Column:
    pairs = [part for text, number in layouts.items() for part in (F.lit(text), F.lit(number))]
    return F.create_map(*pairs)[header]


def parsed(records: DataFrame, columns: dict[int, list[str]], options: dict[int, dict[str, str]]) -> DataFrame:
    """Records parsed in one scan under the column names of their layout; what a layout lacks is NULL."""
    names = list(dict.fromkeys(name for own in columns.values() for name in own))
    at = {}
    structs = []
    for number, own in columns.items():
        schema = ", ".join(f"f{i} string" for i in range(len(own)))
        structs.append(F.when(F.col("layout") == number, F.from_csv("text", schema, options[number])).alias(f"layout{number}"))
        for i, name in enumerate(own):
            at.setdefault(name, []).append(F.col(f"layout{number}.f{i}"))
    rows = records.select(*structs)
    return rows.select(*(reduce(lambda a, b: F.coalesce(a, b), at[name]).alias(name) for name in names))
