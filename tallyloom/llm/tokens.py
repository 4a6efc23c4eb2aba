"""Token ids of texts, by a public word BPE, many texts at a time.

The tokenizer drops white space, knows no capitals and never joins what white space divides, so the ids of a text are the
ids of its words in order; a word is in turn one or more of the tokenizer's own words, such as letters and the
comma behind them. Some megabytes of text are cut into words at once, every different word is encoded once, and the
ids are put together as arrays. Parts of words repeat from text to text: each worker keeps their ids in a bounded
cache that forgets by generations, and asks the tokenizer for all new ones in one call.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tallyloom.llm.words import cut_points, tokens, translation

CHUNK_BYTES = 4 << 20
CACHED_PARTS = 400_000
CACHED_CHARS = 48
WORD_END = "</w>"

_TABLE = translation(b"\x20\x09\x0a\x0b\x0c\x0d")
_BREAK = b"\n"
# Words of small letters, plain or with a mark above, and what may stand behind them; as bytes of UTF-8.
_PLAIN = "^(?:[a-z]|\\xc3[\\x9f-\\xb6\\xb8-\\xbf])+[.,!]?$"
_TAILS = (b".", b",", b"!")
# Python takes these for white space, the tokenizer does not.
_ODD = re.compile("[\x1c-\x1f]")
# In words of these characters Python's classes part words as the tokenizer's do; others go to the tokenizer whole.
_KNOWN = re.compile("[!-~À-ÖØ-öø-įı-ňŊ-ž]*")
_PARTS = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_]+|\d|(?:[^\w\s]|_)+")


class WordEncoder:
    """Encodes texts to bytes: little-endian unsigned 32-bit ids, no special tokens added."""

    def __init__(self, path: str, cached_parts: int = CACHED_PARTS, chunk_bytes: int = CHUNK_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._special = [token.content.encode() for token in self._tokenizer.get_added_tokens_decoder().values()]
        self._parts = Generations(cached_parts)
        self._chunk_bytes = chunk_bytes
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self._ends[[number for token, number in vocabulary.items() if token.endswith(WORD_END)]] = True

    def _plain(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text.encode("utf-8", "replace")])[0]

    def encode_all(self, texts: Iterable[bytes | memoryview]) -> list[bytes]:
        """The ids of every text."""
        out: list[list[bytes]] = []
        held: list[bytes] = []
        owners: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            data = bytes(text)
            out.append([])
            if any(token in data for token in self._special):
                out[i].append(self._plain(data.decode("utf-8", "replace")))
                continue
            bounds = cut_points(data, self._chunk_bytes)
            for low, high in zip(bounds, bounds[1:], strict=False):
                held.append(data[low:high].translate(_TABLE))
                owners.append(i)
                size += high - low
                if size >= self._chunk_bytes:
                    self._settle(held, owners, out)
                    held, owners, size = [], [], 0
        self._settle(held, owners, out)
        return [parts[0] if len(parts) == 1 else b"".join(parts) for parts in out]

    def _settle(self, held: list[bytes], owners: list[int], out: list[list[bytes]]) -> None:
        """Encodes pieces of texts and adds the ids to those of the texts that own them."""
        if not held:
            return
        found = tokens(_BREAK.join([*held, b""]))
        ids, sizes = self._of_words(found.words)
        cuts = np.cumsum(sizes[found.codes])[found.breaks].tolist()
        data = _gathered(ids, sizes, found.codes).tobytes()
        for owner, low, high in zip(owners, [0, *cuts], cuts, strict=False):
            out[owner].append(data[4 * low : 4 * high])

    def _of_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words one after the other, and how many each has; a break has none.

        Most words are letters with a comma or a full stop behind them at most: these are told apart and stripped
        all at once, and only their different stems are looked up one by one.
        """
        spelt = pc.cast(words, pa.binary())
        plain = pc.and_(pc.match_substring_regex(spelt, _PLAIN), pc.less_equal(pc.binary_length(spelt), CACHED_CHARS))
        simple = np.flatnonzero(plain.to_numpy(zero_copy_only=False))
        others = np.flatnonzero(~plain.to_numpy(zero_copy_only=False))
        own = spelt.take(pa.array(simple))
        tails = np.zeros(len(simple), dtype=np.int64)
        for i, tail in enumerate(_TAILS, 1):
            tails[pc.ends_with(own, tail).to_numpy(zero_copy_only=False)] = i
        stems = pc.replace_substring_regex(own, "[.,!]$", "")
        coded = stems.dictionary_encode()
        names = [name.decode() for name in coded.dictionary.to_pylist()]
        slow = [self._parted(word.decode("utf-8", "replace")) for word in spelt.take(pa.array(others)).to_pylist()]
        ids = self._of_parts({*names, *(tail.decode() for tail in _TAILS), *chain.from_iterable(part for part in slow if isinstance(part, list))})
        # Pieces: nothing, the tails, the stems, then the other words; a word is one of these and a tail or nothing.
        pieces = [b"", *(ids[tail.decode()] for tail in _TAILS), *map(ids.__getitem__, names)]
        pieces.extend(part if isinstance(part, bytes) else b"".join([ids[one] for one in part]) for part in slow)
        pairs = np.zeros((len(words), 2), dtype=np.int64)
        pairs[simple, 0] = coded.indices.to_numpy(zero_copy_only=False) + 1 + len(_TAILS)
        pairs[simple, 1] = tails
        pairs[others, 0] = np.arange(len(others)) + 1 + len(_TAILS) + len(names)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) >> 2
        flat = np.frombuffer(b"".join(pieces), dtype="<u4")
        return _gathered(flat, sizes, pairs.ravel()), sizes[pairs].sum(axis=1)

    def _parted(self, word: str) -> bytes | list[str]:
        """The parts of a word whose ids may be cached, or the ids themselves."""
        low = word.lower()
        if word == "\n":
            return b""
        if len(low) > CACHED_CHARS or not (low.isascii() or _KNOWN.fullmatch(low)) or _ODD.search(low):
            return self._plain(word)
        return _PARTS.findall(low)

    def _of_parts(self, parts: set[str]) -> dict[str, bytes]:
        """The ids of parts; a part's last id, and no other, ends a word."""
        known, new = self._parts.known(parts)
        if new:
            ids = np.array(self._tokenizer.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = (4 * np.flatnonzero(self._ends[ids]) + 4).tolist()
            if len(cuts) != len(new):
                raise RuntimeError("the tokenizer parts words in an unknown way")
            data = ids.tobytes()
            learnt = {part: data[low:high] for part, low, high in zip(new, [0, *cuts], cuts, strict=False)}
            self._parts.learn(learnt)
            known.update(learnt)
        return known


def _gathered(flat: np.ndarray, sizes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat``, as long as ``sizes`` say, that ``codes`` name, one after the other."""
    starts = np.cumsum(sizes) - sizes
    lengths = sizes[codes]
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if max(total, len(flat)) < 2**31 else np.int64
    at = np.repeat((starts[codes] - (ends - lengths)).astype(kind), lengths)
    at += np.arange(total, dtype=kind)
    return flat[at]


class Generations:
    """A bounded cache that forgets what was not asked for lately: half of it is young, half what was young before."""

    def __init__(self, most: int):
        self._half = max(1, most // 2)
        self._young: dict[str, bytes] = {}
        self._old: dict[str, bytes] = {}

    def __len__(self) -> int:
        return len(self._young) + len(self._old)

    def known(self, wanted: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """What is known of the wanted, and what is not; what was old is young again."""
        young, old = self._young.get, self._old.get
        out, again, new = {}, {}, []
        for one in wanted:
            value = young(one)
            if value is None:
                value = old(one)
                if value is None:
                    new.append(one)
                    continue
                again[one] = value
            out[one] = value
        self.learn(again)
        return out, new

    def learn(self, new: dict[str, bytes]) -> None:
        self._young.update(new)
        if len(self._young) > self._half:
            self._young, self._old = {}, self._young


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    return WordEncoder(path)
