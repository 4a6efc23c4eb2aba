"""Removal of repeated passages by a hash-compared suffix sort.

A byte goes when a string of ``LENGTH`` bytes covers it that also starts in a document with a smaller id.
Two suffixes are compared by prefix polynomial hashes: a binary search over the length finds how far
they agree, and the next byte decides. A mergesort with that comparison orders them, so suffixes that
share a passage stand together; what the hashes call equal is verified byte by byte.

Not every suffix has to be sorted in one place. Every string of ``LENGTH`` bytes has an anchor, the
least of the hashes of its ``GRAM``-byte parts, and equal strings have equal anchors at equal distances:

1. Documents are laid in blocks (a long one in several), written once as a table whose buckets hold neighbouring blocks, so that what is told
   to a block later reaches it without the texts being dealt out again.
2. Every block tells the anchors it holds; an anchor that only one document holds in the whole corpus is done with.
3. For the others a block sends the text around the anchor, once for each different text. Texts of one
   anchor meet in one task, which sorts them, merges equal ones, and sorts the suffixes within those
   that differ. An anchor with very many different texts around it (a common line has one at either end) is
   dealt out by its strings instead, so that none of these tasks has to take them all.
4. Every block learns the smallest document of its strings and marks the bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import mapped, read, scratch, ship, stored

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 1_000_000
#: Consecutive blocks of a task that are kept together, in one bucket of the table, so that a task writes few files.
SHELF_BLOCKS = 32
SHELF_BITS = 16
#: Different texts around one anchor from which its strings are dealt out one by one.
HOT = 1_024
#: An aim for the text that one sorting task gets, and the least number of such tasks.
BUCKET_BYTES = 8_000_000
LEAST_BUCKETS = 64
BUCKETS_A_TASK = 4
#: Spark keeps no table in more buckets unless told to, and more tasks than that help nobody.
MOST_TASKS = 100_000
ROWS_AT_ONCE = 1 << 14
#: Texts that are sorted at once, but for those of one anchor.
TEXTS_AT_ONCE = 1 << 14
#: Stands for a missing id: larger than any, so such a document removes nothing.
NO_ID = np.iinfo(np.int64).max

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
#: Of the 64 bits that decide an anchor these hold its place, the others lead its hash: as many in a block of any size,
#: so that equal strings have one anchor in all of them.
PLACE_BITS = 32
KEY_SHIFT = np.uint64(16)  # anchors are told by their 48 leading bits


def _mix(h: np.ndarray) -> np.ndarray:
    """Hashes whose leading bits depend on all of theirs, in place."""
    other = h >> np.uint64(32)
    h ^= other
    h *= np.uint64(0xFF51AFD7ED558CCD)
    np.right_shift(h, np.uint64(29), out=other)
    h ^= other
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h


@lru_cache(maxsize=1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(BLOCK_BYTES * 3 // 2)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse, from 0 to ``n``."""
    out = []
    for base in (_BASE, _INVERSE):
        powers = np.full(n + 1, base)
        powers[0] = 1
        out.append(np.multiply.accumulate(powers, out=powers))
    return out[0], out[1]


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    """A part of the keys' range, for less than 2 ** 32 parts; keys in order have buckets in order."""
    return ((key >> np.uint64(16)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    if not len(values):
        return []
    bounds = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(bounds[:-1], bounds[1:], strict=True))


class Hashes:
    """Polynomial hashes of every prefix of a text, and so of every part of it in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        powers, back = _kept_powers() if n <= BLOCK_BYTES * 3 // 2 else _powers(n)
        terms = data.astype(np.uint64)
        terms += np.uint64(1)
        terms *= powers[:n]
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(terms, out=self.prefix[1:])
        self.back = back[: n + 1]

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.back[start]

    def grams(self, size: int) -> np.ndarray:
        out = self.prefix[size:] - self.prefix[:-size]
        out *= self.back[: len(out)]
        return out


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the parts from ``a`` and from ``b`` agree, byte by byte."""
    out = np.ones(len(a), dtype=bool)
    for low in range(0, len(a), ROWS_AT_ONCE):
        part = slice(low, low + ROWS_AT_ONCE)
        n = length[part]
        steps = np.arange(n.max(initial=0))
        inside = steps < n[:, None]
        last = len(data) - 1
        left = data[np.minimum(a[part, None] + steps, last)]
        right = data[np.minimum(b[part, None] + steps, last)]
        out[part] = ((left == right) | ~inside).all(axis=1)
    return out


@dataclass
class Suffixes:
    """Parts of one text that are sorted as suffixes, each with an end of its own."""

    data: np.ndarray
    hashes: Hashes
    start: np.ndarray
    length: np.ndarray

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many leading bytes parts ``i`` and ``j`` share, by binary search over their hashes."""
        shared = np.minimum(self.length[i], self.length[j])
        a, b = self.start[i], self.start[j]
        # Most pairs are equal as far as they go; the others are searched for where they part.
        apart = np.flatnonzero(self.hashes.of(a, shared) != self.hashes.of(b, shared))
        if not len(apart):
            return shared
        a, b = a[apart], b[apart]
        prefix, back = self.hashes.prefix, self.hashes.back
        before_a, before_b, back_a, back_b = prefix[a], prefix[b], back[a], back[b]
        low, high = np.zeros(len(apart), dtype=np.int64), shared[apart] - 1
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            agree = (prefix[a + middle] - before_a) * back_a == (prefix[b + middle] - before_b) * back_b
            low = np.where(agree, middle, low)
            high = np.where(agree, high, np.maximum(middle - 1, low))
        shared[apart] = low
        return shared

    def before(self, i: np.ndarray, j: np.ndarray, ties: bool | np.ndarray) -> np.ndarray:
        """Whether part ``i`` stands before part ``j``; ``ties`` answers for equal ones."""
        shared = self.common(i, j)
        left_end, right_end = shared >= self.length[i], shared >= self.length[j]
        last = len(self.data) - 1
        less = self.data[np.minimum(self.start[i] + shared, last)] < self.data[np.minimum(self.start[j] + shared, last)]
        return np.where(left_end, np.where(right_end, ties, True), np.where(right_end, False, less))

    def leading(self, count: int = 8) -> np.ndarray:
        """The first bytes of every part as a number that sorts as they do."""
        out, last = np.zeros(len(self.start), dtype=np.uint64), len(self.data) - 1
        for k in range(count):
            byte = self.data[np.minimum(self.start + k, last)].astype(np.uint64)
            out = out << np.uint64(8) | np.where(k < self.length, byte, np.uint64(0))
        return out

    def sort(self, group: np.ndarray) -> np.ndarray:
        """The order of all parts by group and suffix: a mergesort of all groups at once.

        ``group`` is ascending. Leading bytes that fit a number divide the groups first; what they do not
        decide is merged: runs double in each round, and a part finds its place in the neighbouring
        run by binary search, a logarithmic number of comparisons.
        """
        n = len(group)
        if not n:
            return np.arange(0)
        lead = self.leading()
        order = np.lexsort((lead, group))
        opens = np.flatnonzero(np.concatenate([[True], (group[order][1:] != group[order][:-1]) | (lead[order][1:] != lead[order][:-1])]))
        sizes = np.diff(np.append(opens, n))
        several = np.flatnonzero(sizes > 1)
        run = 1
        while len(several):
            # Places of the groups that still consist of more than one run.
            at = _ranges(opens[several], sizes[several])
            g_open = np.repeat(opens[several], sizes[several])
            g_end = g_open + np.repeat(sizes[several], sizes[several])
            number = (at - g_open) // run
            mine = g_open + number * run
            pair = g_open + (number & ~1) * run
            other = np.minimum(g_open + (number ^ 1) * run, g_end)
            other_end = np.minimum(other + run, g_end)
            low, high = other.copy(), other_end.copy()
            right = (number & 1).astype(bool)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                # Parts of the left run go before their equals in the right run, so the sort is stable.
                ahead = self.before(order[middle], order[at[open_]], right[open_])
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
            place = pair + (at - mine) + (low - other)
            moved = order.copy()
            moved[place] = order[at]
            order = moved
            run *= 2
            several = several[sizes[several] > run]
        return order

    def equal_neighbours(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """For each place in the order, whether its part equals the one before, in the same group.

        What the hashes call equal is verified; a collision is an error rather than a wrong removal.
        """
        out = np.zeros(len(order), dtype=bool)
        if len(order) < 2:
            return out
        i, j = order[:-1], order[1:]
        out[1:] = (group[i] == group[j]) & (self.length[i] == self.length[j])
        at = np.flatnonzero(out)
        i, j = order[at - 1], order[at]
        out[at] = self.common(i, j) == self.length[j]
        at = at[out[at]]
        if not same_bytes(self.data, self.start[order[at - 1]], self.start[order[at]], self.length[order[at]]).all():
            raise RuntimeError("a hash collision: other bases are needed")
        return out


def _ranges(low: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``low`` on, ``size`` of them, end to end."""
    ahead = np.concatenate([[0], np.cumsum(size)[:-1]])
    return np.repeat(low - ahead, size) + np.arange(size.sum())


# Blocks


def _pack(array: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(array).tobytes())


def _unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=dtype)


def to_blocks(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of whole documents laid end to end: their ids, their ends, their bytes (compressed).

    A document longer than a block fills blocks of its own, ``more`` of which follow. Each holds the strings that
    begin in its ``block_bytes`` bytes, so it also has the bytes in which the last of them end.
    """

    def laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shelf, number = TaskContext.get().partitionId(), 0, 0
        ids, missing, texts, size = [], [], [], 0

        def block(more: bool = False) -> pa.RecordBatch:
            nonlocal ids, missing, texts, size, number
            ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
            raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
            on = (part << 24) + shelf
            row = [on, (on << SHELF_BITS) + number, more, np.array(ids, dtype=np.int64).tobytes(), np.array(missing, dtype=bool).tobytes(), ends.tobytes(), _pack(raw), size]
            kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64())
            ids, missing, texts, size, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(row, kinds, strict=True)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = (text.as_py() or "").encode("utf-8", "replace")
                if texts and (size >= block_bytes or len(data) > block_bytes):
                    yield block()
                if number >= SHELF_BLOCKS and not texts:  # a document is on one shelf
                    shelf, number = shelf + 1, 0
                step = max(block_bytes, LENGTH)
                alone = len(data) > block_bytes
                for low in range(0, len(data), step) if alone else [0]:
                    piece = data[low : low + step + LENGTH - 1] if alone else data
                    ids.append(0 if doc_id is None else doc_id)
                    missing.append(doc_id is None)
                    texts.append(piece)
                    size += len(piece)
                    if alone:
                        yield block(more=low + step < len(data))
        if texts:
            yield block()

    schema = "shelf bigint, block bigint, more boolean, ids binary, missing binary, ends binary, data binary, size bigint"
    names = [column.split()[0] for column in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, laid, schema)


@dataclass
class Block:
    """A block in memory with the anchors of all its strings."""

    ids: np.ndarray
    missing: np.ndarray
    ends: np.ndarray
    data: np.ndarray
    hashes: Hashes
    first: np.ndarray  # of each run of strings with one anchor
    strings: np.ndarray  # how many
    doc: np.ndarray  # number of the run's document
    key: np.ndarray  # 48 bits of the anchor's hash

    @classmethod
    def of(cls, ids: bytes, missing: bytes, ends: bytes, data: bytes) -> Block:
        text = _unpack(data, np.uint8)
        stops = np.frombuffer(ends, dtype=np.int64)
        hashes = Hashes(text)
        empty = np.empty(0, dtype=np.int64)
        first, strings, doc, key = empty, empty, empty, np.empty(0, np.uint64)
        if len(text) >= LENGTH:
            grams = _mix(hashes.grams(GRAM))
            bits = np.uint64(PLACE_BITS)
            # The least hash of a window with its place; of equal hashes the leftmost.
            least = grams >> bits
            least <<= bits
            least |= np.arange(len(grams), dtype=np.uint64)
            window, width = LENGTH - GRAM + 1, 1
            while width < window:
                step = min(width, window - width)
                least = np.minimum(least[:-step], least[step:])
                width += step
            # Strings must end in their document: its last LENGTH - 1 bytes begin none.
            n = len(least)
            begins = np.concatenate([[0], stops[:-1]])
            over = np.maximum(begins, stops - LENGTH + 1)
            edge = np.bincount(np.minimum(over, n), minlength=n + 1) - np.bincount(np.minimum(stops, n), minlength=n + 1)
            whole = np.cumsum(edge[:n]) == 0
            bound = np.empty(n + 1, dtype=bool)
            bound[0] = bound[n] = True
            np.not_equal(least[1:], least[:-1], out=bound[1:n])
            bound[begins[begins < n]] = True
            bound[over[over < n]] = True
            bounds = np.flatnonzero(bound)
            inside = whole[bounds[:-1]]
            first = bounds[:-1][inside]
            strings = np.diff(bounds)[inside]
            doc = np.searchsorted(stops, first, "right")
            # Least hashes are small ones; mixed again they are spread over all buckets.
            key = _mix(grams[(least[first] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)]) >> KEY_SHIFT
        numbers = np.frombuffer(ids, dtype=np.int64)
        gone = np.frombuffer(missing, dtype=bool)
        return cls(np.where(gone, NO_ID, numbers), gone, stops, text, hashes, first, strings, doc, key)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different keys in order, how many different texts surround each, and whether several documents hold it."""
        order = np.lexsort((self.hashes.of(self.first, self.strings + LENGTH - 1), self.key))
        key, text, ids = self.key[order], self.hashes.of(self.first, self.strings + LENGTH - 1)[order], self.ids[self.doc[order]]
        if not len(key):
            return key, np.empty(0, np.int64), np.empty(0, bool)
        opens = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        other = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1])])
        texts = np.add.reduceat(other.astype(np.int64), opens)
        several = np.minimum.reduceat(ids, opens) != np.maximum.reduceat(ids, opens)
        return key[opens], texts, several

    def items(self, codes: np.ndarray) -> Items:
        """What this block sends of the anchors with a code: 1 by the anchor, 2 by each of its strings."""
        keys = np.unique(self.key)
        code = codes[np.searchsorted(keys, self.key)] if len(keys) else np.empty(0, np.uint8)
        one, each = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        start = np.concatenate([self.first[one], _ranges(self.first[each], self.strings[each])]) if len(each) else self.first[one]
        strings = np.concatenate([self.strings[one], np.ones(len(start) - len(one), dtype=np.int64)])
        doc = np.concatenate([self.doc[one], np.repeat(self.doc[each], self.strings[each])])
        text = self.hashes.of(start, strings + LENGTH - 1)
        key = np.concatenate([self.key[one], _mix(text[len(one) :]) >> KEY_SHIFT])
        order = np.lexsort((self.ids[doc], text, strings, key))
        start, strings, doc, text, key = (x[order] for x in (start, strings, doc, text, key))
        if not len(start):
            return Items(start, strings, doc, key, np.empty(0, np.int64), np.empty(0, np.int64))
        opens = np.concatenate([[True], (key[1:] != key[:-1]) | (text[1:] != text[:-1]) | (strings[1:] != strings[:-1])])
        number = np.cumsum(opens) - 1
        opens = np.flatnonzero(opens)
        if not same_bytes(self.data, start, start[opens][number], strings + LENGTH - 1).all():
            raise RuntimeError("a hash collision: other bases are needed")
        return Items(start, strings, doc, key, number, opens)


@dataclass
class Items:
    """Runs of strings in a block, ordered by text; ``opens`` are the first of each text, whose id is the smallest."""

    start: np.ndarray
    strings: np.ndarray
    doc: np.ndarray
    key: np.ndarray
    number: np.ndarray
    opens: np.ndarray


# Steps


def _column(table: pa.Table, name: str) -> list:
    return table.column(name).to_pylist()


def _blocks_of(table: pa.Table | pa.RecordBatch) -> Iterator[tuple[int, Block]]:
    rows = zip(*(table.column(c).to_pylist() for c in ("block", "ids", "missing", "ends", "data")), strict=True)
    for block, *parts in rows:
        yield block, Block.of(*parts)


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows dealt out by bucket to as many tasks as their number asks for, at most ``MOST_TASKS``."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(least, min(-(-buckets // BUCKETS_A_TASK), MOST_TASKS)), "bucket")


def tell_anchors(blocks: DataFrame, buckets: int) -> DataFrame:
    """The different anchors of each block, by bucket of their leading bits."""

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in _blocks_of(batch):
                key, texts, several = block.anchors()
                bucket = _bucket(key, buckets)
                # Six planes of a byte: in order, the leading ones are almost constant.
                planes = key.view(np.uint8).reshape(-1, 8)[:, :6]
                texts = np.minimum(texts, 0xFFFF).astype(np.uint16)
                rows = [
                    (number, int(bucket[a]), _pack(planes[a:b].T), texts[a:b].tobytes(), np.packbits(several[a:b]).tobytes())
                    for a, b in _runs(bucket)
                ]
                if rows:
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["block", "bucket", "keys", "texts", "several"])

    return mapped(blocks, told, "block bigint, bucket bigint, keys binary, texts binary, several binary")


def meet_anchors(told: DataFrame, buckets: int = LEAST_BUCKETS, hot: int = HOT) -> DataFrame:
    """For each block and bucket a code per anchor: 0 held by one document, 1 by several, 2 by very many texts."""

    def met(table: pa.Table) -> pa.Table:
        blocks, keys, texts, several, owner = _column(table, "block"), [], [], [], []
        for k, (planes, counts, flags) in enumerate(zip(_column(table, "keys"), _column(table, "texts"), _column(table, "several"), strict=True)):
            n = len(counts) // 2
            wide = np.zeros((n, 8), dtype=np.uint8)
            wide[:, :6] = _unpack(planes, np.uint8).reshape(6, n).T
            keys.append(wide.view("<u8").ravel())
            texts.append(np.frombuffer(counts, dtype=np.uint16).astype(np.int64))
            several.append(np.unpackbits(np.frombuffer(flags, dtype=np.uint8), count=n).astype(bool))
            owner.append(np.full(n, k))
        key, owners = np.concatenate(keys), np.concatenate(owner)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        opens = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        count = np.diff(np.append(opens, len(ordered)))
        total = np.add.reduceat(np.concatenate(texts)[order], opens)
        shared = (count > 1) | np.logical_or.reduceat(np.concatenate(several)[order], opens)
        code = np.where(shared, np.where(total > hot, 2, 1), 0).astype(np.uint8)
        back = np.empty(len(key), dtype=np.uint8)
        back[order] = np.repeat(code, count)
        out = [_pack(back[a:b]) for a, b in _runs(owners)]
        return pa.table({"block": pa.array(blocks, pa.int64()), "bucket": pa.array(_column(table, "bucket"), pa.int64()), "codes": pa.array(out, pa.binary())})

    return _dealt(told, buckets).groupBy("bucket").applyInArrow(met, "block bigint, bucket bigint, codes binary")


def _on_shelf(rows: DataFrame):
    """Rows about blocks, grouped as the table of blocks is."""
    return rows.withColumn("shelf", F.shiftright("block", SHELF_BITS)).groupBy("shelf")


def _codes_of(table: pa.Table, block: int) -> np.ndarray:
    """The codes of a block's anchors, in the order of their keys."""
    own = table.filter(pc.and_(pc.equal(table["block"], block), pc.is_valid(table["codes"])))
    rows = sorted(zip(_column(own, "bucket"), _column(own, "codes"), strict=True))
    return np.concatenate([_unpack(data, np.uint8) for _, data in rows]) if rows else np.empty(0, np.uint8)


def send_texts(blocks: DataFrame, codes: DataFrame, buckets: int) -> DataFrame:
    """The different texts around shared anchors, by bucket: smallest id, length and bytes of each."""

    def sent(own: pa.Table, codes: pa.Table) -> pa.Table:
        rows = []
        for number, block in _blocks_of(own):
            items = block.items(_codes_of(codes, number))
            start, strings, key = items.start[items.opens], items.strings[items.opens], items.key[items.opens]
            ids, length = block.ids[items.doc[items.opens]], strings + LENGTH - 1
            bucket = _bucket(key, buckets)
            for a, b in _runs(bucket):
                data = block.data[_ranges(start[a:b], length[a:b])]
                rows.append((number, int(bucket[a]), int(a), _pack(key[a:b]), _pack(ids[a:b]), length[a:b].astype(np.uint8).tobytes(), _pack(data)))
        columns = list(zip(*rows, strict=True)) or [[]] * 7
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "bucket", "first", "keys", "ids", "lengths", "data"), columns, kinds, strict=True)})

    schema = "block bigint, bucket bigint, first bigint, keys binary, ids binary, lengths binary, data binary"
    return blocks.groupBy("shelf").cogroup(_on_shelf(codes)).applyInArrow(sent, schema)


def smallest(key: np.ndarray, ids: np.ndarray, length: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The smallest id that has each string, text by text; keys are ascending, texts lie end to end."""
    strings = length - LENGTH + 1
    offset = np.concatenate([[0], np.cumsum(strings)])
    out = np.empty(offset[-1], dtype=np.int64)
    start = np.cumsum(length) - length
    hashes = Hashes(data)
    texts = Suffixes(data, hashes, start, length)
    member = texts.sort(key)
    same = texts.equal_neighbours(member, key)
    opens = np.flatnonzero(~same)
    least = np.minimum.reduceat(ids[member], opens)
    class_of = np.cumsum(~same) - 1
    class_key = key[member[opens]]
    out[_ranges(offset[member], strings[member])] = np.repeat(least[class_of], strings[member])

    # Anchors with more than one text: the suffixes within them, from string to string.
    alone = np.concatenate([[True], class_key[1:] != class_key[:-1]]) & np.concatenate([class_key[1:] != class_key[:-1], [True]])
    mixed = np.flatnonzero(~alone)
    if len(mixed):
        head = member[opens[mixed]]
        n = strings[head]
        suffixes = Suffixes(data, hashes, _ranges(start[head], n), np.full(n.sum(), LENGTH))
        group = np.repeat(class_key[mixed], n)
        order2 = suffixes.sort(group)
        same2 = suffixes.equal_neighbours(order2, group)
        opens2 = np.flatnonzero(~same2)
        found = np.minimum.reduceat(np.repeat(least[mixed], n)[order2], opens2)
        per = np.empty(len(group), dtype=np.int64)
        per[order2] = found[np.cumsum(~same2) - 1]
        # Back to every text of these classes.
        place = np.full(len(opens), -1, dtype=np.int64)
        place[mixed] = np.concatenate([[0], np.cumsum(n)[:-1]])
        rows = np.flatnonzero(place[class_of] >= 0)
        texts_at = member[rows]
        out[_ranges(offset[texts_at], strings[texts_at])] = per[_ranges(place[class_of[rows]], strings[texts_at])]
    return out


def meet_texts(sent: DataFrame, buckets: int = LEAST_BUCKETS) -> DataFrame:
    """For each block the texts of which another document with a smaller id has strings, and those ids."""

    def met(table: pa.Table) -> pa.Table:
        blocks, firsts = _column(table, "block"), _column(table, "first")
        keys = [_unpack(x, np.uint64) for x in _column(table, "keys")]
        ids = [_unpack(x, np.int64) for x in _column(table, "ids")]
        lengths = [np.frombuffer(x, dtype=np.uint8).astype(np.int64) for x in _column(table, "lengths")]
        data = np.concatenate([_unpack(x, np.uint8) for x in _column(table, "data")])
        sizes = np.array([len(x) for x in keys])
        key, own, length = np.concatenate(keys), np.concatenate(ids), np.concatenate(lengths)
        start = np.cumsum(length) - length
        strings = length - LENGTH + 1
        offset = np.concatenate([[0], np.cumsum(strings)])
        least = np.empty(offset[-1], dtype=np.int64)
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        a = 0
        while a < len(order):
            b = min(a + TEXTS_AT_ONCE, len(order))
            b = int(np.searchsorted(ordered, ordered[b - 1], "right"))
            part, a = order[a:b], b
            least[_ranges(offset[part], strings[part])] = smallest(key[part], own[part], length[part], data[_ranges(start[part], length[part])])
        better = np.logical_or.reduceat(least < np.repeat(own, strings), offset[:-1])
        rows, low = [], 0
        for block, first, n in zip(blocks, firsts, sizes, strict=True):
            hits = low + np.flatnonzero(better[low : low + n])
            if len(hits):
                rows.append((block, _pack(hits - low + first), _pack(least[_ranges(offset[hits], strings[hits])])))
            low += n
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("block", "items", "least"), columns, (pa.int64(), pa.binary(), pa.binary()), strict=True)})

    return _dealt(sent, buckets).groupBy("bucket").applyInArrow(met, "block bigint, items binary, least binary")


def cut_texts(blocks: DataFrame, told: DataFrame, block_bytes: int) -> DataFrame:
    """Every document of every block without its repeated passages; ``told`` holds codes and smaller ids per block."""

    def cut(own: pa.Table, told: pa.Table) -> pa.Table:
        rows, begun, tail = [], [], np.empty(0, dtype=bool)
        own = own.sort_by("block")
        for more, (number, block) in zip(_column(own, "more"), _blocks_of(own), strict=True):
            items = block.items(_codes_of(told, number))
            better = told.filter(pc.and_(pc.equal(told["block"], number), pc.is_valid(told["items"])))
            strings = items.strings[items.opens]
            offset = np.concatenate([[0], np.cumsum(strings)])
            least = np.repeat(block.ids[items.doc[items.opens]], strings)
            for at, ids in zip(_column(better, "items"), _column(better, "least"), strict=True):
                at = _unpack(at, np.int64)
                least[_ranges(offset[at], strings[at])] = _unpack(ids, np.int64)
            string = _ranges(items.start, items.strings)
            gone = string[least[_ranges(offset[items.number], items.strings)] < np.repeat(block.ids[items.doc], items.strings)]
            steps = np.bincount(gone, minlength=len(block.data) + 1) - np.bincount(gone + LENGTH, minlength=len(block.data) + 1)[: len(block.data) + 1]
            covered = np.cumsum(steps)[: len(block.data)] > 0
            covered[: len(tail)] |= tail
            data, ends, tail = block.data, block.ends, np.empty(0, dtype=bool)
            if more:
                size = max(block_bytes, LENGTH)
                begun.append((covered[:size], data[:size]))
                tail = covered[size:]
                continue
            if begun:  # the last block of a document
                covered = np.concatenate([*(mask for mask, _ in begun), covered])
                data = np.concatenate([*(part for _, part in begun), data])
                ends, begun = np.array([len(data)]), []
            low = 0
            for doc_id, absent, high in zip(block.ids.tolist(), block.missing.tolist(), ends.tolist(), strict=True):
                mask = covered[low:high]
                kept = data[low:high][~mask].tobytes()
                spans = int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum())
                rows.append((None if absent else doc_id, high - low, int(mask.sum()), spans, kept))
                low = high
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("doc_id", "n_bytes", "n_removed", "n_spans", "kept"), columns, kinds, strict=True)})

    return blocks.groupBy("shelf").cogroup(_on_shelf(told)).applyInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def without_repeats(docs: DataFrame, hot: int = HOT, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """One row per input row: bytes, removed bytes, removed runs and ``kept``, the bytes that are left.

    Workers need some hundred times ``block_bytes`` and some ten times ``bucket_bytes`` of memory. A block
    sends at most one row to each bucket, so both should grow with the corpus: the defaults suit up to
    some hundred gigabytes and small executors, blocks and buckets of 64 MB a hundred terabytes.

    A missing text is an empty one. A document without an id removes nothing from others and loses what
    any other document has. Rows that share an id remove nothing from each other. Other columns are ignored.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch(spark, "blocks")
    name = f"llm_blocks_{folder.rsplit('-', 1)[1]}"
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0)).alias("n")).first()["n"]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))  # with fewer, Spark would deal the blocks out again
    shelves = max(least, min(-(-2 * size // (SHELF_BLOCKS * block_bytes)), MOST_TASKS))
    to_blocks(docs, block_bytes).write.bucketBy(shelves, "shelf").option("path", folder).option("compression", "uncompressed").saveAsTable(name)
    blocks = spark.table(name)
    buckets = max(LEAST_BUCKETS, -(-size // bucket_bytes))
    codes = stored(meet_anchors(tell_anchors(blocks, buckets), buckets, hot), "anchor-codes")
    better = stored(meet_texts(send_texts(blocks, codes, buckets), buckets), "smaller-ids")
    both = codes.select("block", "bucket", "codes").unionByName(better, allowMissingColumns=True)
    return cut_texts(blocks, both, block_bytes)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages of 50 bytes in all documents."""
    found = without_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


# Every string of every document as two hexadecimal digits a byte, the smallest id of equal ones, and runs of what they cover.
OP5_SQL = f"""
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as x from documents),
s as (
    select r, doc_id, i, substr(x, 2 * i + 1, {2 * LENGTH}) as w
    from (select r, doc_id, x, unnest(range(0, length(x) // 2 - {LENGTH - 1})) as i from d)
),
gone as (select r, i from (select r, i, doc_id, min(doc_id) over (partition by w) as first from s) where first < doc_id),
steps as (select r, i, lag(i) over (partition by r order by i) as before from gone),
runs as (select r, i, sum(case when i <= before + {LENGTH} then 0 else 1 end) over (partition by r order by i) as run from steps),
spans as (select r, min(i) as a, max(i) + {LENGTH} as b from runs group by r, run),
counts as (select r, sum(b - a) as n_removed, count(*) as n_spans from spans group by r),
parts as (
    select r, coalesce(lag(b) over (partition by r order by a), 0) as p, a as q from spans
    union all select r, max(b), null from spans group by r
),
kept as (
    select r, string_agg(substr(x, 2 * p + 1, 2 * (coalesce(q, length(x) // 2) - p)), '' order by p) as x from parts join d using (r) group by r
)
select doc_id, cast(length(d.x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
       cast(coalesce(n_spans, 0) as bigint) as n_spans, sha256(unhex(coalesce(kept.x, d.x))) as kept_sha256
from d left join counts using (r) left join kept using (r)
"""
