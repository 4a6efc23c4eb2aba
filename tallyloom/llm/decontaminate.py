"""Benchmark decontamination by q-gram lemma filtering.

Benchmark items are cut into segments of about equal length. A place of a document that is within
``k`` edits of a segment of ``m`` characters shares at least ``m + 1 - q (k + 1)`` q-grams with it, all of them on
diagonals (position in the text minus position in the segment) at most ``k`` off. Shared q-grams are
counted in diagonal bands twice as wide as that and half overlapping, so the place's q-grams
lie in one band whole. Regions whose count meets the bound are aligned with the segment in a band, and
kept if the alignment needs at most ``k`` edits.

An excerpt may begin and end inside segments. So items are also cut into windows that overlap by half or
more, and in each the longest part within its edits is sought, of at least half a segment or
``share`` of the item's characters, whichever is less. Every stretch of that many characters lies in a window whole.
The bound of a window is the least of all such parts. An item is found in a document when
segments and parts together cover at least ``share`` of its characters, each counted once.

Characters are compared after lower-casing A-Z and with every run of white space as one blank. Items of
fewer characters than a q-gram must stand whole, without edits, and neither begin nor end inside a word. Where a tenth of
a length asks for no q-gram (10 to 15, 20 to 23, 30 and 31 characters) one edit less is allowed. The
items are taken in blocks of bounded size, each of which passes over all documents; the driver holds two at most.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import mapped, read, stored
from tallyloom.operators.positions import positioned, running_total

Q = 8
SEGMENT = 96
EDIT_RATE = 0.1
SHARE = 0.5
BLOCK_CHARS = 1_000_000
CHARS_AT_ONCE = 1_000_000
CELLS_AT_ONCE = 4_000_000
#: Between documents; no character has this number.
GAP = np.uint32(0xFFFFFFFF)
#: Edits to go over a gap: no place lies in two documents.
APART = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_BASES = tuple(np.uint64(pow(_BASE, 2**i, 2**64)) for i in range(6))


#: White space beyond ASCII, and its separators, which Python takes for white space too.
BLANKS = np.array([code for code in (*range(28, 32), 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)], dtype=np.uint32)


_LOWERED = bytes(byte + 32 if 65 <= byte <= 90 else 32 if byte in (*range(9, 14), *range(28, 32)) else byte for byte in range(256))
_ODD_BLANK = re.compile("[%s]" % "".join(map(chr, BLANKS[BLANKS > 126])))
_MAYBE_ODD = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")


def characters(text: str | None) -> np.ndarray:
    """The code points that are compared: A-Z in lower case, every run of white space as one blank."""
    data = (text or "").encode("utf-8", "replace").translate(_LOWERED)
    if _MAYBE_ODD.search(data):
        data = _ODD_BLANK.sub(" ", data.decode()).encode()
    if b"  " in data:
        data = re.sub(b"  +", b" ", data)
    return np.frombuffer(data.decode().encode("utf-32-le"), dtype="<u4")


def _placed(text: str | None) -> tuple[np.ndarray, np.ndarray | None]:
    """The same, and the place of each in the text where that differs; for the few texts in which something was found."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "replace"), dtype="<u4").copy()
    codes += np.uint32(32) * ((codes >= 65) & (codes <= 90)).astype(np.uint32)
    blank = ((codes >= 9) & (codes <= 13)) | (codes == 32)
    odd = np.flatnonzero((codes > 126) | ((codes > 27) & (codes < 32)))
    blank[odd[np.isin(codes[odd], BLANKS)]] = True
    codes[blank] = 32
    again = blank[1:] & blank[:-1]
    if not again.any():
        return codes, None
    kept = np.flatnonzero(np.append(True, ~again))
    return codes[kept], kept


def words_apart(codes: np.ndarray, first: int, last: int) -> bool:
    """Whether a place does not begin or end inside a word."""

    def joined(left: int, right: int) -> bool:
        return left >= 0 and right < len(codes) and chr(codes[left]).isalnum() and chr(codes[right]).isalnum()

    return not joined(first - 1, first) and not joined(last - 1, last)


def short_places(codes: np.ndarray, short: dict[int, dict[bytes, list[int]]]) -> Iterator[tuple[int, int, int]]:
    """Items too short for a q-gram, by their length and characters, where they stand whole and apart: item, first, behind the last."""
    for length, wanted in short.items():
        if len(codes) < length:
            continue
        windows = np.lib.stride_tricks.sliding_window_view(codes, length)
        likely = np.isin(codes[: len(windows)], np.array([np.frombuffer(item, "<u4")[0] for item in wanted], dtype=np.uint32))
        for at in np.flatnonzero(likely).tolist():
            for item in wanted.get(windows[at].tobytes(), ()):
                if words_apart(codes, at, at + length):
                    yield item, at, at + length


def grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of every q-gram, by doubling; ``q`` is a power of two."""
    h, size, power = codes.astype(np.uint64), 1, 0
    while size < q:
        h = h[:-size] * _BASES[power] + h[size:]
        size, power = 2 * size, power + 1
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def budget(m: int, rate: float = EDIT_RATE, q: int = Q) -> tuple[int, int]:
    """The most edits of a segment of ``m`` characters, lowered until the lemma asks for a q-gram, and that bound."""
    k = int(rate * m)
    while k and m + 1 - q * (k + 1) < 1:
        k -= 1
    return k, max(1, m + 1 - q * (k + 1))


@dataclass
class Index:
    """The segments and windows of a block of items and where their q-grams stand; windows count as segments."""

    items: np.ndarray  # item of a segment
    sizes: np.ndarray  # characters of an item
    starts: np.ndarray  # of a segment in codes, with its end behind the last
    lows: np.ndarray  # where a segment starts in its item
    cuts: np.ndarray  # true for segments, which do not overlap
    parts: np.ndarray  # characters a part must have, 0 where only the whole segment counts
    edits: np.ndarray
    least: np.ndarray
    codes: np.ndarray
    keys: np.ndarray  # hashes, sorted
    segment: np.ndarray
    at: np.ndarray
    sieve: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int, str]], q: int = Q, segment: int = SEGMENT, rate: float = EDIT_RATE, share: float = SHARE) -> Index:
        parts, owner, sizes, lows, cuts, needed = [], [], [], [], [], []
        for number, (_, text) in enumerate(items):
            codes = characters(text.strip())
            sizes.append(len(codes))
            n = max(1, -(-len(codes) // segment))
            bounds = np.linspace(0, len(codes), n + 1).astype(int).tolist()
            whole = list(zip(bounds[:-1], bounds[1:], strict=True))
            last = max(0, len(codes) - segment)
            windows = [(low, min(low + segment, len(codes))) for low in [*range(0, last, segment // 2), last]]
            need = max(1, min(ceil(share * len(codes) - 1e-9), segment // 2))
            for low, high in dict.fromkeys(whole + windows):
                if high - low >= q:  # shorter ones have no q-gram
                    parts.append(codes[low:high])
                    owner.append(number)
                    lows.append(low)
                    cuts.append((low, high) in whole)
                    needed.append(max(q, need) if (low, high) in windows else 0)
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        limits = [budget(int(m), rate, q) for m in lengths]
        bounds = [budget(m, rate, q)[1] for m in range(int(lengths.max(initial=0)) + 1)]
        least = [min(bounds[part or m : m + 1]) for m, part in zip(lengths.tolist(), needed, strict=True)]
        hashes = [grams(p, q) for p in parts]
        keys = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        number = np.repeat(np.arange(len(parts)), [len(h) for h in hashes]) if hashes else np.empty(0, np.int64)
        at = np.concatenate([np.arange(len(h)) for h in hashes]) if hashes else np.empty(0, np.int64)
        order = np.argsort(keys, kind="stable")
        bits = max(16, int(np.ceil(np.log2(max(len(keys), 1)))) + 6)
        sieve = np.zeros(1 << bits, dtype=bool)
        sieve[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
        return cls(
            np.array(owner, dtype=np.int64),
            np.array(sizes, dtype=np.int64),
            starts,
            np.array(lows, dtype=np.int64),
            np.array(cuts, dtype=bool),
            np.array(needed, dtype=np.int64),
            np.array([k for k, _ in limits], dtype=np.int64),
            np.array(least, dtype=np.int64),
            np.concatenate(parts) if parts else np.empty(0, np.uint32),
            keys[order],
            number[order].astype(np.int64),
            at[order].astype(np.int64),
            sieve,
        )


@lru_cache(maxsize=1)
def index_of(items: tuple[tuple[int, str], ...], q: int, share: float) -> Index:
    """The index of a block, once per worker."""
    return Index.of(list(items), q, share=share)


def regions(codes: np.ndarray, index: Index, q: int = Q) -> tuple[np.ndarray, np.ndarray]:
    """Segments and first diagonals of the bands that hold enough shared q-grams."""
    none = np.empty(0, dtype=np.int64)
    if len(codes) < q or not len(index.keys):
        return none, none
    hashes = grams(codes, q)
    shift = np.uint64(64 - int(np.log2(len(index.sieve))))
    where = np.flatnonzero(index.sieve[(hashes >> shift).astype(np.int64)])
    low = np.searchsorted(index.keys, hashes[where], "left")
    count = np.searchsorted(index.keys, hashes[where], "right") - low
    where, low, count = where[count > 0], low[count > 0], count[count > 0]
    if not len(where):
        return none, none
    entry = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    segment = index.segment[entry]
    width = 2 * index.edits[segment] + 1
    band = (np.repeat(where, count) - index.at[entry] + index.starts[-1]) // width + 1  # moved up: a diagonal may be negative
    span = len(codes) + index.starts[-1] + 3
    code = np.concatenate([segment * span + band, segment * span + band - 1])  # band b holds the diagonals of b and b + 1
    code.sort()
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    seen = np.diff(np.append(first, len(code)))
    code = code[first]
    segment = code // span
    enough = seen >= index.least[segment]
    segment, band = segment[enough], code[enough] % span
    return segment, (band - 1) * (2 * index.edits[segment] + 1) - index.starts[-1]


def align(codes: np.ndarray, index: Index, segment: np.ndarray, diagonal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least edits of each segment in its region, and where the best place ends.

    The region is the band of diagonals and the edits on either side; the segment is used whole, the text
    around it costs nothing. Equal lengths are aligned together.
    """
    edits = np.full(len(segment), np.iinfo(np.int64).max)
    ends = np.zeros(len(segment), dtype=np.int64)
    m_of = np.diff(index.starts)[segment]
    for m in np.unique(m_of):
        own = np.flatnonzero(m_of == m)
        k = int(index.edits[segment[own[0]]])
        width = 2 * (2 * k + 1) + 2 * k + 1
        step = max(1, CELLS_AT_ONCE // (width * 8))
        for low in range(0, len(own), step):
            part = own[low : low + step]
            first = diagonal[part] - k
            text = index.codes[index.starts[segment[part], None] + np.arange(m)]
            at = first[:, None] + np.arange(width + m)
            inside = (at >= 0) & (at < len(codes))
            around = np.where(inside, codes[np.clip(at, 0, len(codes) - 1)], GAP)
            price = np.where(around == GAP, np.int32(APART), np.int32(1))
            slopes = np.cumsum(price, axis=1, dtype=np.int32)
            row = np.zeros((len(part), width), dtype=np.int32)
            for j in range(m):
                here = row + price[:, j : j + width] * (around[:, j : j + width] != text[:, j, None])
                here[:, :-1] = np.minimum(here[:, :-1], row[:, 1:] + 1)
                # An extra character moves one column on, at one edit each.
                slope = slopes[:, j : j + width]
                row = np.minimum.accumulate(here - slope, axis=1) + slope
            best = row.argmin(axis=1)
            edits[part] = row[np.arange(len(part)), best]
            ends[part] = first + m + best
    return edits, ends


def promising(codes: np.ndarray, index: Index, segment: np.ndarray, diagonal: np.ndarray, rate: float = EDIT_RATE) -> np.ndarray:
    """Whether a region may hold the segment or a part within its edits, by the same lemma over shorter grams.

    A part of ``p`` characters shares at least ``p - 3 - 4 rate p`` of its 4-grams with diagonals of the band. So the
    shared ones less ``1 - 4 rate`` of all come to at least ``-12 rate`` over some stretch of that length.
    """
    held = np.zeros(len(segment), dtype=bool)
    if not len(segment):
        return held
    # Numbers of 16 bits may be equal for unequal grams, which only retains more.
    shown, asked = ((grams(c, 4) >> np.uint64(48)).astype(np.uint16) for c in (codes, index.codes))
    m_of = np.diff(index.starts)[segment]
    due = np.float32(1 - 4 * rate)
    for m in np.unique(m_of):
        own = np.flatnonzero(m_of == m)
        width = 2 * (2 * int(index.edits[segment[own[0]]]) + 1)
        n = int(m) - 3
        for low in range(0, len(own), 1024):
            part = own[low : low + 1024]
            at = diagonal[part, None] + np.arange(width + n)
            around = shown[np.clip(at, 0, len(shown) - 1)]
            text = asked[index.starts[segment[part], None] + np.arange(n)]
            shared = np.zeros(text.shape, dtype=bool)
            for d in range(width):
                shared |= around[:, d : d + n] == text
            sums = np.zeros((len(part), n + 1), dtype=np.float32)
            np.cumsum(shared - due, axis=1, out=sums[:, 1:])
            fewest = np.minimum.accumulate(sums, axis=1)
            need = np.where(index.parts[segment[part]] > 0, index.parts[segment[part]], m) - 3
            for k in np.unique(need).tolist():
                same = need == k
                held[part[same]] = (sums[same, k:] - fewest[same, : n + 1 - k]).max(axis=1) >= -12 * rate - 0.01
    return held


def longest(codes: np.ndarray, index: Index, segment: np.ndarray, diagonal: np.ndarray, q: int = Q, rate: float = EDIT_RATE) -> tuple[np.ndarray, ...]:
    """The longest part of each segment within its edits in its region: length (0 if none is long enough), edits,
    first character in the segment and where the place ends. Every first character is tried."""
    lengths, edits, lows, ends = (np.zeros(len(segment), dtype=np.int64) for _ in range(4))
    m_of = np.diff(index.starts)[segment]
    for i in range(len(segment)):
        s, m, need = int(segment[i]), int(m_of[i]), int(index.parts[segment[i]])
        k = int(index.edits[s])
        width = 2 * (2 * k + 1) + 2 * k + 1
        tried = np.arange(m - need + 1)
        # Behind the end of the segment nothing matches, and no part reaches there.
        text = np.append(index.codes[index.starts[s] : index.starts[s + 1]], np.full(m, GAP - 1))
        at = diagonal[i] - k + np.arange(width + 2 * m)
        around = np.where((at >= 0) & (at < len(codes)), codes[np.clip(at, 0, len(codes) - 1)], GAP)
        price = np.where(around == GAP, np.int32(APART), np.int32(1))
        windows, prices, slopes = (np.lib.stride_tricks.sliding_window_view(x, width) for x in (around, price, np.cumsum(price, dtype=np.int32)))
        row = np.zeros((len(tried), width), dtype=np.int32)
        best = (0, 0, 0, 0)
        for j in range(m):
            here = row + prices[tried + j] * (windows[tried + j] != text[tried + j, None])
            here[:, :-1] = np.minimum(here[:, :-1], row[:, 1:] + 1)
            slope = slopes[tried + j]
            row = np.minimum.accumulate(here - slope, axis=1) + slope
            if j + 1 >= need:
                fewest = row.min(axis=1)
                fits = np.flatnonzero((fewest <= budget(j + 1, rate, q)[0]) & (tried + j < m))
                if len(fits):
                    low = int(fits[fewest[fits].argmin()])
                    best = (j + 1, int(fewest[low]), low, int(diagonal[i] - k + low + j + 1 + row[low].argmin()))
        lengths[i], edits[i], lows[i], ends[i] = best
    return lengths, edits, lows, ends


def searcher(items: list[tuple[int, str]], share: float = SHARE, q: int = Q, chars_at_once: int = CHARS_AT_ONCE) -> Callable[[pa.Array], list[tuple]]:
    """Finds in a column of texts every row and item of a block that meet: row, item's id, part of its characters, edits, place."""
    ids, block = [item_id for item_id, _ in items], tuple(items)
    short: dict[int, dict[bytes, list[int]]] = {}
    for number, (_, text) in enumerate(items):
        own = characters(text.strip())
        if 0 < len(own) < q:
            short.setdefault(len(own), {}).setdefault(own.tobytes(), []).append(number)

    def search(pieces: list[tuple[int, int, np.ndarray]], index: Index, best: dict) -> None:
        """Adds the best place of each segment in each document; pieces are (document, its characters before, characters)."""
        laid = np.concatenate([part for _, _, codes in pieces for part in (codes, np.array([GAP]))])
        ends = np.cumsum([len(codes) + 1 for _, _, codes in pieces])
        segment, diagonal = regions(laid, index, q)
        held = promising(laid, index, segment, diagonal)
        segment, diagonal = segment[held], diagonal[held]
        edits, stop = align(laid, index, segment, diagonal)
        whole = edits <= index.edits[segment]
        length, low = np.diff(index.starts)[segment], np.zeros(len(segment), dtype=np.int64)
        rest = np.flatnonzero(~whole & (index.parts[segment] > 0))
        length[rest], edits[rest], low[rest], stop[rest] = longest(laid, index, segment[rest], diagonal[rest], q)
        whole[rest] = length[rest] > 0
        for i in np.flatnonzero(whole).tolist():
            k = int(np.searchsorted(ends, stop[i] - 1, "right"))
            doc, before, codes = pieces[k]
            own = best.setdefault((doc, int(index.items[segment[i]])), {})
            place = (-int(length[i]), int(edits[i]), int(low[i]), before + int(stop[i]) - int(ends[k]) + len(codes) + 1)
            own[int(segment[i])] = min(own.get(int(segment[i]), place), place)

    def rows_of(best: dict, index: Index) -> Iterator[tuple]:
        sizes = np.diff(index.starts)
        for (doc, item), own in best.items():
            covered = np.zeros(index.sizes[item], dtype=bool)
            used = []
            # Whole segments first: they do not overlap. Of the others those that cover more.
            for _, length, e, low, stop in sorted((not (index.cuts[s] and -p[0] == sizes[s]), p[0], p[1], int(index.lows[s]) + p[2], p[3]) for s, p in own.items()):
                if not covered[low : low - length].all():
                    covered[low : low - length] = True
                    used.append((e, stop + length, stop))
            found = float(covered.mean())
            if found >= share - 1e-9:
                yield doc, ids[item], found, sum(u[0] for u in used), max(min(u[1] for u in used), 0), max(u[2] for u in used)

    def in_text(text: str, first: int, last: int) -> tuple[int, int]:
        """A place among the characters compared as one in the text."""
        codes, at = _placed(text)
        return (first, last) if at is None else (int(at[min(first, len(codes) - 1)]), int(at[min(last, len(codes)) - 1]) + 1)

    def found_in(texts: pa.Array) -> list[tuple]:
        index = index_of(block, q, share)  # tasks get the items, not the index, which is many times as large
        best: dict[tuple[int, int], dict[int, tuple[int, int, int, int]]] = {}
        whole: dict[tuple[int, int], tuple[int, int]] = {}
        held, size = [], 0
        for i, text in enumerate(texts):
            codes = characters(text.as_py())
            for item, first, last in short_places(codes, short) if short else ():
                whole.setdefault((i, item), (first, last))
            # A very long text is searched in parts that overlap by more than any place is long.
            for low in range(0, max(len(codes), 1), chars_at_once):
                held.append((i, low, codes[low : low + chars_at_once + 4 * SEGMENT]))
                size += len(held[-1][2]) + 1
                if size >= chars_at_once:
                    search(held, index, best)
                    held, size = [], 0
        if held:
            search(held, index, best)
        found = [*rows_of(best, index), *((i, ids[item], 1.0, 0, *place) for (i, item), place in whole.items())]
        return [(i, item, part, edits, *in_text(texts[i].as_py(), first, last)) for i, item, part, edits, first, last in sorted(found, key=lambda row: (row[0], repr(row[1])))]

    return found_in


def contaminations(docs: DataFrame, items: list[tuple[int, str]], share: float = SHARE, q: int = Q, chars_at_once: int = CHARS_AT_ONCE) -> DataFrame:
    """``doc_id``, ``item_id``, ``found`` (part of the item's characters), ``edits`` and the place in characters,
    for every document and item of a block that meet."""
    found_in = searcher(items, share, q, chars_at_once)

    def batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if rows := found_in(batch.column(1)):
                columns = list(zip(*rows, strict=True))
                doc_ids = batch.column(0).take(pa.array(columns[0], pa.int64()))
                kinds = (pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([doc_ids, *(pa.array(c, t) for c, t in zip(columns[1:], kinds, strict=True))], names)

    schema = "doc_id bigint, item_id bigint, found double, edits bigint, first bigint, last bigint"
    names = [column.split()[0] for column in schema.split(", ")]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("text is not null")
    return mapped(rows, batches, schema)


def blocks(benchmark: DataFrame, chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items with a text, in blocks of at most ``chars`` characters and an item more; no order of items is kept.

    The driver gets a block when it is asked for. A benchmark of more than one is numbered in Spark by the characters
    that come before an item, and written to the shared folder.
    """
    text = F.col("text").cast("string")
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text.alias("text"), F.length(text).cast("bigint").alias("size")).filter("size > 0")
    size = items.agg(F.sum("size").alias("n")).first()["n"] or 0
    if size <= chars:
        if rows := items.select("item_id", "text").collect():
            yield [tuple(row) for row in rows]
        return
    summed = running_total(positioned(items, "item_id", "text"), "size", "up_to")
    numbered = stored(summed.select(F.floor((F.col("up_to") - 1) / chars).cast("bigint").alias("block"), "item_id", "text"), "benchmark-blocks")
    for block in range(-(-size // chars)):
        if rows := numbered.filter(F.col("block") == block).select("item_id", "text").collect():
            yield [tuple(row) for row in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, q: int = Q, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Every document and benchmark item of which it holds at least ``share``, one row each.

    Parts of the item count where they hold half a segment or ``share`` of it (see above), whichever is less, with a tenth of edits.
    Missing and empty texts hold and are nothing; items shorter than ``q`` characters count only whole (see above).
    Places are in characters of the text as it is.
    Repeated documents are reported each; a repeated item's rows are reported each. Other columns
    are ignored. What a block of items found is written before the next one is taken.
    """
    found: list[DataFrame] = []
    for items in blocks(benchmark, block_chars):
        if found:
            found[-1] = stored(found[-1], "leaks")
        found.append(contaminations(docs, items, share, q))
    return reduce(DataFrame.unionByName, found or [contaminations(docs, [], share, q)])


def without_leaks(docs: DataFrame, benchmark: DataFrame, share: float = SHARE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns; each is decided by its own text, whatever its id."""
    out = docs
    for number, items in enumerate(blocks(benchmark, block_chars)):
        out = _without(stored(out, "clean") if number else out, items, share)
    return out


def _without(docs: DataFrame, items: list[tuple[int, str]], share: float) -> DataFrame:
    found_in = searcher(items, share)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stays = np.ones(batch.num_rows, dtype=bool)
            stays[[row[0] for row in found_in(batch.column(0))]] = False
            yield pa.RecordBatch.from_arrays(batch.columns[1:], names).filter(pa.array(stays))

    names = docs.columns
    return mapped(docs.select(F.col("text").cast("string").alias("__searched"), "*"), clean, docs.schema)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in all documents."""
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
