"""Best-fit packing of documents into sequences, bulk-synchronous.

Documents are cut into pieces of at most ``capacity`` tokens and range-sorted by length; a piece is known
by its length and its rank among the pieces of that length. Gaps, the free ends of sequences, are
sorted by size likewise. Pieces of one length are interchangeable, and so are gaps of one size: both are
held as runs of equal sizes, at most ``capacity`` runs of pieces, whatever the number of pieces in them.

A round is a Spark job over ranges of sizes. Each task sweeps its range from small to large: a gap takes the largest
piece that fits and that no smaller gap took. Gaps of a range that found no piece take from the nearest range
below that has pieces left, which are the largest that fit; pieces that several ranges want are parted by rank. Then
the gaps shrink and the next round begins. When nothing fits any more, as many sequences are opened as
the rest needs at least.

What the driver holds are the runs and stretches of ranks. A round adds at most one stretch for each run of pieces or of
gaps, however many pieces a run has. The pieces stay in range-partitioned tasks, which look up their own places batch by batch.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import mapped, read, ship, stored, text_or_empty
from tallyloom.llm.tokens import encoder
from tallyloom.llm.words import column_bytes

CAPACITY = 4096
END_ID = 1
#: Ranges of sizes, each swept by a task of its own.
RANGES = 4
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and the end id, cut only where they exceed ``capacity``.

    ``with_ids`` adds the ids themselves, as the bytes of little-endian unsigned 32-bit numbers. A
    missing text is an empty one and gives the end id alone.
    """
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * capacity

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode_all
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(column_bytes(batch.column(1))), strict=True):
                ids += end
                for k, low in enumerate(range(0, len(ids), step)):
                    part = ids[low : low + step]
                    row = (doc_id, k, low // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            columns = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=False)]
            if columns:
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = PIECES + (", ids binary" if with_ids else "")
    names = [column.split()[0] for column in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text"))
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return mapped(rows, cut, schema)


Run = tuple[int, int, int]


def sweep(left: dict[int, int], used: dict[int, int], gaps: list[Run]) -> tuple[list[tuple], list[Run]]:
    """From small to large, every gap takes the largest piece that fits and is left.

    ``gaps`` are (size, first sequence, how many) in order, ``left`` and ``used`` the pieces of each length. Returns
    what was taken as (length, first rank, pieces, first sequence, size) and the gaps that found nothing.
    """
    lengths = sorted(left)
    at, stack, taken, without = 0, [], [], []
    for size, first, n in gaps:
        while at < len(lengths) and lengths[at] <= size:
            stack.append(lengths[at])
            at += 1
        while n and stack:
            length, rank, take = give(left, used, stack[-1], n)
            taken.append((length, rank, take, first, size))
            if length not in left:
                stack.pop()
            first, n = first + take, n - take
        if n:
            without.append((size, first, n))
    return taken, without


def give(left: dict[int, int], used: dict[int, int], length: int, most: int) -> Run:
    """Takes at most so many pieces of a length away: length, first rank, how many."""
    take, rank = min(most, left[length]), used.get(length, 0)
    used[length] = rank + take
    left[length] -= take
    if not left[length]:
        del left[length]
    return length, rank, take


def deals(counts: list[tuple[int, int]]) -> list[Run]:
    """Which range serves which, from what each has left over: (giver, taker, how many), in order of rank.

    ``counts`` are gaps without a piece and pieces without a gap. A gap takes from the nearest range below that has
    pieces left: they are larger than those of all ranges further down. The gaps of a range come before its own
    pieces, which are too large for them.
    """
    stack, found = [], []
    for taker, (wanted, had) in enumerate(counts):
        while wanted and stack:
            giver, n = stack.pop()
            take = min(wanted, n)
            found.append((giver, taker, take))
            wanted -= take
            if n > take:
                stack.append((giver, n - take))
        if had:
            stack.append((taker, had))
    return found


def pair(runs: list[Run], gaps: list[Run]) -> tuple[list[tuple], list[Run]]:
    """Runs of pieces and gaps matched one by one, as ``sweep`` tells it; there are no fewer gaps than pieces."""
    waiting, taken = gaps[::-1], []
    for length, rank, n in runs:
        while n:
            size, first, m = waiting.pop()
            take = min(n, m)
            taken.append((length, rank, take, first, size))
            rank, n = rank + take, n - take
            if m > take:
                waiting.append((size, first + take, m - take))
    return taken, waiting[::-1]


Sweeps = Callable[[list[tuple[list[Run], list[Run]]]], list[tuple[list[tuple], list[Run]]]]


def sweep_range(pieces: list[Run], gaps: list[Run]) -> tuple[list[tuple], list[Run]]:
    """One range of a round: ``pieces`` are (length, how many are left, how many are placed)."""
    return sweep({length: n for length, n, _ in pieces}, {length: rank for length, _, rank in pieces}, [tuple(gap) for gap in gaps])


def in_tasks(spark: SparkSession) -> Sweeps:
    """Sweeps every range in a task."""
    ship(spark)

    def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [json.dumps(sweep_range(*json.loads(runs))) for runs in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(told, pa.string())], ["number", "told"])

    def sweeps(ranges: list[tuple[list[Run], list[Run]]]) -> list[tuple[list[tuple], list[Run]]]:
        table = pa.table({"number": list(range(len(ranges))), "runs": [json.dumps(runs) for runs in ranges]})
        rows = spark.createDataFrame(table).mapInArrow(swept, "number bigint, told string").collect()
        return [json.loads(row["told"]) for row in sorted(rows)]

    return sweeps


def best_fit(counts: dict[int, int], sweeps: Sweeps, capacity: int = CAPACITY, ranges: int = RANGES) -> np.ndarray:
    """Where the pieces of each length go: rows of (length, first rank, pieces, first sequence, offset).

    The pieces of a row go, by rank, one into each of the sequences from the first one on. Ranges in which
    there are no pieces or no gaps have nothing to sweep.
    """
    left = {length: n for length, n in counts.items() if n}
    used: dict[int, int] = {}
    gaps: list[Run] = []
    found: list[tuple] = []
    opened = matched = 0
    while left:
        if not matched:
            new = -(-sum(length * n for length, n in left.items()) // capacity)
            gaps.append((capacity, opened, new))
            opened += new
        smallest = min(left)
        runs: list[tuple[list[Run], list[Run]]] = [([], []) for _ in range(ranges)]
        for length in left:
            runs[(length - 1) * ranges // capacity][0].append((length, left[length], used.get(length, 0)))
        for gap in sorted(gaps):
            if gap[0] >= smallest:
                runs[(gap[0] - 1) * ranges // capacity][1].append(gap)
        told: list[tuple[list[tuple], list[Run]]] = [([], own) for _, own in runs]
        busy = [k for k, (pieces, own) in enumerate(runs) if pieces and own]
        for k, (own, without) in zip(busy, sweeps([runs[k] for k in busy]) if busy else [], strict=True):
            told[k] = ([tuple(row) for row in own], [tuple(gap) for gap in without])
        taken = [row for own, _ in told for row in own]
        for length, _, n, _, _ in taken:
            give(left, used, length, n)

        # What the ranges have left over meets by rank: the largest pieces below go to the gaps above.
        of: list[list[int]] = [[] for _ in range(ranges)]
        for length in sorted(left):
            of[(length - 1) * ranges // capacity].append(length)
        parcels: list[list[Run]] = [[] for _ in range(ranges)]
        for giver, taker, n in deals([(sum(n for _, _, n in without), sum(left[length] for length in of[k])) for k, (_, without) in enumerate(told)]):
            while n:
                parcels[taker].append(give(left, used, of[giver][-1], n))
                n -= parcels[taker][-1][2]
                if of[giver][-1] not in left:
                    of[giver].pop()
        gaps = []
        for parcel, (_, without) in zip(parcels, told, strict=True):
            more, without = pair(parcel, without)
            taken += more
            gaps += without
        gaps += [(size - length, first, n) for length, _, n, first, size in taken if size > length]
        found += [(length, rank, n, first, capacity - size) for length, rank, n, first, size in taken]
        matched = len(taken)
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 5)


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` with ``sequence_id`` and ``offset``; ``length`` must be 1 to ``capacity``. No rows give no rows."""
    names = cut.columns
    order = [c for c in ("length", "doc_id", "piece") if c in names]
    table = stored(cut, "pieces")
    placed = stored(
        table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()),
        "sorted-pieces",
    )

    # A length lies in consecutive tasks, so there are at most as many rows as tasks and lengths together.
    part = F.shiftright("__at", 33).alias("part")
    runs = placed.groupBy(part, "length").agg(F.count("*").alias("n"), F.min("__at").alias("at"))
    runs = runs.toPandas().sort_values(["length", "part"], ignore_index=True)
    runs["rank"] = runs.groupby("length")["n"].cumsum() - runs["n"]
    counts = {int(length): int(n) for length, n in runs.groupby("length")["n"].sum().items()}
    goes = best_fit(counts, in_tasks(cut.sparkSession), capacity)

    # Stretches begin anew where a task begins: (first position of a piece, sequence, offset) of each.
    met = []
    for length, n, at, rank in runs[["length", "n", "at", "rank"]].itertuples(index=False):
        low, high = np.searchsorted(goes[:, 0], [length, length + 1])
        own = goes[low:high]
        own = own[np.searchsorted(own[:, 1], rank, "right") - 1 : np.searchsorted(own[:, 1], rank + n, "left")]
        ahead = np.maximum(rank - own[:, 1], 0)  # of a stretch that began in an earlier task
        met.append(np.column_stack([own[:, 1] + ahead - rank + at, own[:, 3] + ahead, own[:, 4]]))
    met = np.concatenate(met) if met else np.empty((0, 3), np.int64)
    starts, sequences, offsets = (np.ascontiguousarray(column) for column in met[np.argsort(met[:, 0])].T)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("__at").to_numpy()
            k = np.searchsorted(starts, at, "right") - 1
            columns = [*(batch.column(name) for name in names), pa.array(sequences[k] + at - starts[k]), pa.array(offsets[k])]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", sequence_id bigint, offset bigint"
    return mapped(placed, place, schema)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every document's pieces with the sequence and the offset they go to.

    Every row is packed, repeated ids and texts too. Columns other than ``doc_id`` and ``text`` are ignored.
    """
    return pack(pieces(docs, path or tokenizer_path(), capacity, with_ids), capacity)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack_documents(read(spark, sf_dir, "documents"))
