"""Words of many texts at once, as codes into a dictionary: bytes in, numpy and Arrow arrays out.

Texts are translated byte by byte: ``GAP`` parts words and is dropped, ``BREAK`` is a token of its own that ends
a piece of text. Bytes beyond ASCII are never translated, so words of valid UTF-8 are valid UTF-8.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GAP, BREAK = 0x20, 0x0A
_AFTER = re.compile(rb"[\x20\x09-\x0D]")


def translation(gaps: Iterable[int], breaks: Iterable[int] = ()) -> bytes:
    """A table for ``bytes.translate``: A-Z to a-z, ``gaps`` to the gap, ``breaks`` to the break."""
    table = bytearray(range(256))
    for upper in range(ord("A"), ord("Z") + 1):
        table[upper] = upper + 32
    for byte in gaps:
        table[byte] = GAP
    for byte in breaks:
        table[byte] = BREAK
    return bytes(table)


@dataclass
class Tokens:
    """Tokens in their order: ``codes`` into ``words``, and where a token is a break rather than a word."""

    codes: np.ndarray
    words: pa.Array
    breaks: np.ndarray


def tokens(data: bytes) -> Tokens:
    """The tokens of bytes that were translated."""
    raw = np.frombuffer(data, dtype=np.uint8)
    gap, brk = raw == GAP, raw == BREAK
    first = brk.copy()
    if len(raw):
        first[0] |= True
        first[1:] |= gap[:-1]
        first[1:] |= brk[:-1]
    first &= ~gap
    kept = raw[~gap]
    starts = np.flatnonzero(first[~gap])
    offsets = np.append(starts, len(kept)).astype(np.int32)
    values = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])
    coded = values.dictionary_encode()
    return Tokens(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, kept[starts] == BREAK)


def cut_points(data: bytes, size: int) -> list[int]:
    """Bounds of parts of a text of at least ``size`` bytes each, that begin where words are parted."""
    bounds = [0]
    while len(data) - bounds[-1] > size:
        found = _AFTER.search(data, bounds[-1] + size)
        if not found or found.start() >= len(data) - 1:
            break
        bounds.append(found.start())
    return [*bounds, len(data)]


def column_bytes(column: pa.Array) -> Iterator[memoryview | None]:
    """The values of a binary column without copies."""
    for value in column:
        yield memoryview(value.as_buffer()) if value.is_valid else None
