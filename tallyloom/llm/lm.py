"""Scores of whole documents by a gated recurrent language model with a class-factored output.

Words are counted over all documents that may be learnt from. The most frequent ones are the head: each is an input of its
own, and classes of equal size share them out, so that a word's probability is that of its class given the state times
that of the word given class and state. The other frequent words form bands by their rank and all else, unseen
words too, the rest: the state gives the probability of the band or of the rest, and the counts, with one added
in the rest, give the word within. All words thus have a share of one distribution.

The network learns by truncated backpropagation through time, in numpy, in the tasks that hold the documents: in each
round every task trains a replica from the common weights on its share of the documents, and the weighted mean of the
replicas is the next round's start. The rounds share out the documents: when they end, the network has learnt from every
word of every document that may be learnt from.

Scoring reads a document from its first word to its end in windows and carries the state over, so that a score is the
whole document's. Documents of a task advance together, one column each, the longest last alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import free_names, mapped, read, ship, stored
from tallyloom.llm.words import column_bytes, cut_points, tokens, translation

HIDDEN = 16
CLASS_WORDS = 64
HEAD_WORDS = 2_048
#: Words whose counts every task has at hand: at most so many, none longer, each seen twice at least.
DICTIONARY_WORDS = 200_000
DICTIONARY_BYTES = 64
#: A round learns from one in SHARE of the documents, another one each time; a pass is the rounds that together take all.
SHARE = 4
PASSES = 1
LANES = 256
WINDOW = 16
RATE = 0.02
CHUNK_BYTES = 4 << 20
TOKENS_AT_ONCE = 3 << 19
SCORED_AT_ONCE = 1 << 14
SLICE = 8_192
SALTS = 32

END = b"\n"
_TABLE = translation(b"\x20\x09\x0a\x0b\x0c\x0d")
_LN10 = np.log(10.0)


def set_apart(doc_id: str = "doc_id") -> Column:
    """Rows no model may learn from: crc32 of the id as text leaves 2 modulo 7, or the id is missing."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(True))


def _pieces(text: memoryview, chunk_bytes: int) -> Iterator[bytes]:
    """A text's translated bytes and its end, a very long one in parts."""
    data = bytes(text).translate(_TABLE)
    bounds = cut_points(data, chunk_bytes)
    for low, high in zip(bounds, bounds[1:], strict=False):
        yield data[low:high] + (END if high == len(data) else b"")


def word_counts(texts: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``word`` and ``c`` over all of the column ``text``; the end of a text is the word of one line break."""

    def counted(data: bytes) -> pa.RecordBatch:
        found = tokens(data)
        counts = np.bincount(found.codes, minlength=len(found.words)).astype(np.int64)
        return pa.RecordBatch.from_arrays([found.words.cast(pa.binary()), pa.array(counts)], ["word", "c"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in column_bytes(batch.column(0)):
                for piece in _pieces(text, chunk_bytes):
                    held.append(piece)
                    size += len(piece)
                    if size >= chunk_bytes:
                        yield counted(b" ".join(held))
                        held, size = [], 0
        if held:
            yield counted(b" ".join(held))

    rows = mapped(texts.select("text"), count, "word binary, c bigint")
    return rows.groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The dictionary in the order of its counts, the head first, and how its words are classed."""

    words: pa.Array
    counts: np.ndarray
    head: int
    bands: np.ndarray  # of every word its band, -1 in the head
    all_tokens: int
    all_words: int

    @property
    def n_bands(self) -> int:
        return int(self.bands.max(initial=-1)) + 1

    @property
    def head_classes(self) -> int:
        return -(-self.head // CLASS_WORDS)

    @property
    def classes(self) -> int:
        return self.head_classes + self.n_bands + 1

    @property
    def start(self) -> int:
        """The input before the first word: behind those of head, bands and rest."""
        return self.head + self.n_bands + 1

    @property
    def rest(self) -> tuple[int, int]:
        """Tokens and words outside the dictionary."""
        return self.all_tokens - int(self.counts.sum()), self.all_words - len(self.words)

    def codes(self, words: pa.Array) -> np.ndarray:
        """Places in the dictionary, its length for words that it lacks."""
        found = pc.index_in(words.cast(pa.binary()), value_set=self.words)
        return pc.fill_null(found, len(self.words)).to_numpy(zero_copy_only=False).astype(np.int64)

    def symbols(self) -> np.ndarray:
        """Of every place in the dictionary, and of what it lacks, the input."""
        own = np.where(self.bands >= 0, self.head + self.bands, np.arange(len(self.words)))
        return np.append(own, self.head + self.n_bands).astype(np.int64)

    def class_of(self) -> np.ndarray:
        own = np.where(self.bands >= 0, self.head_classes + self.bands, np.arange(len(self.words)) // CLASS_WORDS)
        return np.append(own, self.classes - 1).astype(np.int64)

    def within(self) -> np.ndarray:
        """The logarithm of a band's word given the band; zero elsewhere."""
        mass = np.bincount(self.bands + 1, weights=self.counts, minlength=1)
        own = np.where(self.bands >= 0, np.log(np.maximum(self.counts, 1) / np.maximum(mass[self.bands + 1], 1)), 0.0)
        return np.append(own, 0.0)


def vocabulary(counts: DataFrame, head_words: int = HEAD_WORDS, dictionary_words: int = DICTIONARY_WORDS) -> Vocabulary:
    """The dictionary: all words down to a count such that there are at most ``dictionary_words``.

    Counts are compared in steps of an eighth of a power of two, so that the driver gets some hundred numbers and then
    the words, which the bound on their number and length keeps below 15 MB.
    """
    step = F.floor(F.log2(F.col("c").cast("double")) * 8).cast("int")
    fits = (F.octet_length("word") <= DICTIONARY_BYTES) & (F.col("c") >= 2) | (F.col("word") == END)
    found = counts.groupBy(F.when(fits, step).alias("step")).agg(F.count("*").alias("words"), F.sum("c").alias("tokens")).collect()
    least, taken = None, 0
    for row in sorted((row for row in found if row["step"] is not None), key=lambda row: -row["step"]):
        taken += row["words"]
        if taken > dictionary_words:
            break
        least = row["step"]
    chosen = counts.filter(fits & ((step >= F.lit(least)) | (F.col("word") == END))).toArrow()
    words, own = chosen["word"].to_pylist(), chosen["c"].to_numpy()
    order = sorted(range(len(words)), key=lambda i: (words[i] != END, -own[i], words[i]))
    head = min(head_words, len(order))
    at = np.arange(len(order))
    bands = np.where(at < head, -1, np.floor(np.log2(np.maximum(at, 1) / max(head, 1))).astype(int))
    return Vocabulary(
        pa.array([words[i] for i in order], pa.binary()),
        own[order].astype(np.int64),
        head,
        bands,
        sum(row["tokens"] for row in found),
        sum(row["words"] for row in found),
    )


def _even(bias: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Whether exponentials of ``bias + weights @ h`` and their sum keep within single precision for any state."""
    reach = np.abs(weights).sum(axis=-1)
    return ((bias + reach).max(axis=-1, initial=-np.inf) < 80) & ((bias - reach).max(axis=-1, initial=-np.inf) > -80)


@dataclass
class Model:
    """A gated recurrent layer, whose ``table`` holds every input's term for the three gates, and two softmax layers."""

    table: np.ndarray  # 3H x inputs
    state: np.ndarray  # 3H x H
    bias: np.ndarray  # H x 1, inside the reset gate
    classes: np.ndarray  # classes x H
    class_bias: np.ndarray  # classes x 1
    words: np.ndarray  # head classes x words x H
    word_bias: np.ndarray  # head classes x words

    @classmethod
    def fresh(cls, vocab: Vocabulary, hidden: int = HIDDEN, seed: int = 3) -> Model:
        """Weights before training: the biases alone give every word its share of the counts."""
        rng = np.random.default_rng(seed)
        counts = np.zeros(vocab.head_classes * CLASS_WORDS)
        counts[: vocab.head] = vocab.counts[: vocab.head]
        mass = np.zeros(vocab.classes)
        mass[: vocab.head_classes] = counts.reshape(-1, CLASS_WORDS).sum(axis=1)
        for band in range(vocab.n_bands):
            mass[vocab.head_classes + band] = vocab.counts[vocab.bands == band].sum()
        mass[-1] = vocab.rest[0] + 1
        with np.errstate(divide="ignore"):
            bias = np.maximum(np.log(counts), -60.0).reshape(-1, CLASS_WORDS)  # a place without a word is never taken

        def drawn(scale: float, *shape: int) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        return cls(
            drawn(0.3, 3 * hidden, vocab.start + 1),
            drawn(1 / np.sqrt(hidden), 3 * hidden, hidden),
            np.zeros((hidden, 1), np.float32),
            drawn(0.02, vocab.classes, hidden),
            np.log(np.maximum(mass, 0.5))[:, None].astype(np.float32),
            drawn(0.02, vocab.head_classes, CLASS_WORDS, hidden),
            (bias - bias.max(axis=1, keepdims=True, initial=-60.0)).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [getattr(self, f.name) for f in fields(self)]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts()])

    def filled(self, flat: np.ndarray, copy: bool = True) -> Model:
        """A model of the same shape with the weights of ``flat``, or on them."""
        out, low = [], 0
        for part in self.parts():
            out.append(flat[low : low + part.size].reshape(part.shape).astype(np.float32, copy=copy))
            low += part.size
        return Model(*out)

    def step(self, x: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
        """States (H x columns) after the inputs ``x``; ``keep`` gets what the way back needs."""
        n = len(h)
        a = np.take(self.table, x, axis=1)
        u = self.state @ h
        gates = a[: 2 * n]
        gates += u[: 2 * n]
        gates *= 0.5
        np.tanh(gates, out=gates)  # a logistic gate is a hyperbolic tangent of half its input, halved and raised
        gates *= 0.5
        gates += 0.5
        update, reset = gates[:n], gates[n:]
        inner = u[2 * n :]
        inner += self.bias
        new = a[2 * n :]
        new += reset * inner
        np.tanh(new, out=new)
        if keep is not None:
            keep.append((x, h, update, reset, inner, new))
        out = h - new
        out *= update
        out += new
        return out

    def log_probabilities(self, h: np.ndarray, codes: np.ndarray, class_of: np.ndarray, within: np.ndarray, grads: Model | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural logarithms of the words at places ``codes`` in the dictionary, given the states ``h`` (H x words).

        With ``grads`` the gradients of their negative sum are added there, and those of the states returned.
        """
        kinds, m = class_of[codes], h.shape[1]
        logits = self.classes @ h
        logits += self.class_bias
        if not _even(self.class_bias[:, 0], self.classes):
            logits -= logits.max(axis=0)
        columns = np.arange(m)
        taken = logits[kinds, columns].astype(np.float64)
        np.exp(logits, out=logits)
        total = logits.sum(axis=0)
        out = taken - np.log(total) + within[codes]
        down = None
        if grads is not None:
            logits /= total
            logits[kinds, columns] -= 1
            grads.classes += logits @ h.T
            grads.class_bias += logits.sum(axis=1, keepdims=True)
            down = self.classes.T @ logits
        head = len(self.words)
        order = np.argsort(kinds.astype(np.int16) if head < 2**14 else kinds, kind="stable")
        bounds = np.searchsorted(kinds[order], np.arange(head + 1))
        rows = np.ascontiguousarray(h.T[order[: bounds[-1]]])
        inside = codes[order[: bounds[-1]]] % CLASS_WORDS
        even = _even(self.word_bias, self.words)
        inner = np.empty_like(rows)
        for kind, (low, high) in enumerate(zip(bounds.tolist(), bounds[1:].tolist(), strict=False)):
            if low == high:
                continue
            own, at = rows[low:high], order[low:high]
            scores = own @ self.words[kind].T
            scores += self.word_bias[kind]
            if not even[kind]:
                scores -= scores.max(axis=1, keepdims=True)
            lines, target = np.arange(high - low), inside[low:high]
            got = scores[lines, target].astype(np.float64)
            np.exp(scores, out=scores)
            sums = scores.sum(axis=1)
            out[at] += got - np.log(sums)
            if grads is not None:
                scores /= sums[:, None]
                scores[lines, target] -= 1
                grads.words[kind] += scores.T @ own
                grads.word_bias[kind] += scores.sum(axis=0)
                np.matmul(scores, self.words[kind], out=inner[low:high])
        if grads is not None:
            down[:, order[: bounds[-1]]] += inner.T
        return out, down

    def back(self, kept: list, downs: list[np.ndarray], first: np.ndarray, grads: Model) -> None:
        """Backpropagation through the kept steps of a window.

        ``downs`` are the output's gradients of the states. Where a document begins (``first``), the state before
        was another document's and gets no gradient.
        """
        n = len(self.bias)
        x, before, update, reset, inner, new = (np.stack(own) for own in zip(*kept, strict=True))
        to_new, to_update, to_reset = (1 - update) * (1 - new * new), (before - new) * update * (1 - update), inner * reset * (1 - reset)
        du, dnew = np.empty((len(x), 3 * n, x.shape[1]), np.float32), np.empty_like(new)
        dh = np.zeros_like(new[0])
        for i in range(len(x) - 1, -1, -1):
            dh += downs[i]
            np.multiply(dh, to_new[i], out=dnew[i])
            np.multiply(dh, to_update[i], out=du[i, :n])
            np.multiply(dnew[i], to_reset[i], out=du[i, n : 2 * n])
            np.multiply(dnew[i], reset[i], out=du[i, 2 * n :])
            dh *= update[i]
            dh += self.state.T @ du[i]
            dh[:, first[i]] = 0
        grads.state += (du @ before.transpose(0, 2, 1)).sum(axis=0)
        grads.bias += du[:, 2 * n :].sum(axis=(0, 2))[:, None]
        du[:, 2 * n :] = dnew
        x = x.ravel()
        order = np.argsort(x.astype(np.int16) if self.table.shape[1] < 2**15 else x, kind="stable")
        inputs, starts = np.unique(x[order], return_index=True)
        rows = du.transpose(0, 2, 1).reshape(-1, 3 * n).take(order, axis=0)
        grads.table[:, inputs] += np.add.reduceat(rows, starts, axis=0).T


def train(model: Model, vocab: Vocabulary, codes: np.ndarray, ends: np.ndarray, lanes: int = LANES, window: int = WINDOW, rate: float = RATE) -> tuple[Model, float]:
    """A replica of the model, trained over documents in one pass, and its mean loss.

    ``codes`` are the documents' words one after the other, ``ends`` the places behind each document. The stream is cut in lanes that
    advance together; states are carried from window to window, gradients are not, and a document begins without state.
    Where lanes differ by a word, that one is a last step of the longer lanes alone.
    """
    symbols, class_of, within = vocab.symbols(), vocab.class_of(), vocab.within()
    weights = model.flat()
    model = model.filled(weights, copy=False)
    inputs = np.empty_like(codes)
    inputs[1:] = symbols[codes[:-1]]
    first = np.zeros(len(codes), dtype=bool)
    first[0] = True
    first[ends[:-1]] = True
    inputs[first] = vocab.start
    lanes = max(1, min(lanes, len(codes) // window))
    length, longer = divmod(len(codes), lanes)
    steps = length + (longer > 0)
    lane = np.arange(lanes)
    at = np.minimum(np.arange(steps)[:, None] + lane * length + np.minimum(lane, longer), len(codes) - 1)
    inputs, targets, first = inputs[at], codes[at], first[at]
    h = np.zeros((len(model.bias), lanes), dtype=np.float32)
    slope, mean, square = (np.zeros_like(weights) for _ in range(3))
    grads, change = model.filled(slope, copy=False), np.empty_like(weights)
    loss, pace = 0.0, 0
    bounds = [*range(0, length, window), steps]
    for low, high in zip(bounds, bounds[1:], strict=False):
        n = min(high * lanes, len(codes)) - low * lanes  # words; what stands behind them in a last step is none
        kept, states = [], []
        for i in range(low, high):
            h = model.step(inputs[i], np.where(first[i], np.float32(0), h), kept)
            states.append(h)
        slope[:] = 0
        got, down = model.log_probabilities(np.concatenate(states, axis=1)[:, :n], targets[low:high].ravel()[:n], class_of, within, grads)
        loss -= float(got.sum())
        down = np.pad(down, ((0, 0), (0, (high - low) * lanes - n)))
        downs = [down[:, i * lanes : (i + 1) * lanes] for i in range(high - low)]
        model.back(kept, downs, first[low:high], grads)
        pace += 1
        slope /= n
        mean *= 0.9
        mean += np.multiply(slope, 0.1, out=change)
        slope *= slope
        square *= 0.99
        square += np.multiply(slope, 0.01, out=change)
        np.sqrt(square, out=change)
        change /= (1 - 0.99**pace) ** 0.5
        change += 1e-6
        np.divide(mean, change, out=change)
        change *= rate / (1 - 0.9**pace)
        weights -= change
    return model, loss / len(codes)


@dataclass
class Buffer:
    """Rows (all columns but the text), their words as places in the dictionary, and the place behind each row's words.

    What the dictionary lacks is listed apart, sorted by the number of the row: row, word, how often.
    """

    rows: list[tuple]
    codes: np.ndarray
    ends: np.ndarray
    lacks: tuple[np.ndarray, pa.Array, np.ndarray]


def read_documents(batches: Iterator[pa.RecordBatch], column: int, vocab: Vocabulary, chunk_bytes: int, most: int) -> Iterator[Buffer]:
    """The documents of a task, some hundred thousand words at a time or one longer text."""
    rows: list[tuple] = []
    codes, ends, lacks = [], [], []
    held: list[bytes] = []
    size = total = 0

    def flush() -> None:
        nonlocal held, size, total
        if not held:
            return
        found = tokens(b" ".join(held))
        own = vocab.codes(found.words)[found.codes]
        behind = np.flatnonzero(found.breaks) + 1
        unknown = np.flatnonzero(own == len(vocab.words))
        row_of = np.searchsorted(behind, unknown, "right") + sum(map(len, ends))
        pairs, n = np.unique(row_of * len(found.words) + found.codes[unknown], return_counts=True)
        lacks.append((pairs // len(found.words), found.words.take(pa.array(pairs % len(found.words))).cast(pa.binary()), n))
        codes.append(own.astype(np.int32))
        ends.append(behind + total)
        total += len(own)
        held, size = [], 0

    def buffer() -> Buffer:
        nonlocal rows, codes, ends, lacks, total
        flush()
        each = [np.concatenate([own[0] for own in lacks]), pa.concat_arrays([own[1] for own in lacks]), np.concatenate([own[2] for own in lacks])]
        out = Buffer(rows, np.concatenate(codes), np.concatenate(ends), tuple(each))
        rows, codes, ends, lacks, total = [], [], [], [], 0
        return out

    for batch in batches:
        others = [c.to_pylist() for i, c in enumerate(batch.columns) if i != column]
        own = zip(*others, strict=True) if others else [()] * batch.num_rows
        for row, text in zip(own, column_bytes(batch.column(column)), strict=True):
            rows.append(row)
            for piece in _pieces(text, chunk_bytes):
                held.append(piece)
                size += len(piece)
                if size >= chunk_bytes:
                    flush()
            if total >= most:
                yield buffer()
    if rows:
        yield buffer()


def document_scores(model: Model, vocab: Vocabulary, codes: np.ndarray, ends: np.ndarray, scored_at_once: int = SCORED_AT_ONCE) -> np.ndarray:
    """The natural logarithm of every document's probability; words that the dictionary lacks count as the rest."""
    symbols, class_of, within = vocab.symbols(), vocab.class_of(), vocab.within()
    starts = np.append(0, ends[:-1])
    lengths = ends - starts
    order = np.argsort(-lengths, kind="stable")
    base, lengths = starts[order], lengths[order]
    inputs = np.empty_like(codes)
    inputs[1:] = symbols[codes[:-1]]
    inputs[starts] = vocab.start
    logs = np.zeros(len(codes))
    h = np.zeros((len(model.bias), len(order)), dtype=np.float32)
    states, places, waiting = [], [], 0
    alive = np.searchsorted(-lengths, -np.arange(lengths[0]), "left") if len(lengths) else []

    def settle() -> None:
        nonlocal states, places, waiting
        at = np.concatenate(places)
        logs[at] = model.log_probabilities(np.concatenate(states, axis=1), codes[at], class_of, within)[0]
        states, places, waiting = [], [], 0

    for t, n in enumerate(alive.tolist() if len(lengths) else []):
        at = base[:n] + t
        h = model.step(inputs[at], h[:, :n])
        states.append(h)
        places.append(at)
        waiting += n
        if waiting >= scored_at_once:
            settle()
    if waiting:
        settle()
    return np.add.reduceat(logs, starts)


def _mean(part: DataFrame, *keys: str) -> DataFrame:
    """Weighted sums of the slices of replicas, which become means when divided by the weight."""

    def add(own: pa.Table) -> pa.Table:
        total, weight = None, 0.0
        for values, tokens_ in zip(own["values"].to_pylist(), own["weight"].to_pylist(), strict=True):
            value = np.frombuffer(values, dtype="<f8")
            total, weight = value.copy() if total is None else total + value, weight + tokens_
        return pa.table([own["slice"][:1], own["salt"][:1], pa.array([weight]), pa.array([total.tobytes()], pa.binary())], ["slice", "salt", "weight", "values"])

    return part.groupBy(*keys).applyInArrow(add, "slice int, salt int, weight double, values binary")


def train_round(model: Model, vocab: Vocabulary, texts: DataFrame, lanes: int = LANES, window: int = WINDOW, rate: float = RATE, chunk_bytes: int = CHUNK_BYTES, tokens_at_once: int = TOKENS_AT_ONCE) -> Model:
    """The weighted mean of the replicas that the tasks train, each on its own documents."""

    def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = model, 0
        for read_ in read_documents(batches, 0, vocab, chunk_bytes, tokens_at_once):
            own, _ = train(own, vocab, read_.codes, read_.ends, lanes, window, rate)
            seen += len(read_.codes)
        if seen:
            flat = own.flat().astype("<f8") * seen
            parts = [flat[low : low + SLICE].tobytes() for low in range(0, len(flat), SLICE)]
            n = len(parts)
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([float(seen)] * n), pa.array(parts, pa.binary())], ["slice", "weight", "values"])

    rows = mapped(texts.select("text"), replicas, "slice int, weight double, values binary")
    salted = rows.select("slice", F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"), "weight", "values")
    met = _mean(_mean(salted, "slice", "salt"), "slice").select("slice", "weight", "values").collect()
    if not met:
        return model
    flat = np.concatenate([np.frombuffer(row["values"], dtype="<f8") / row["weight"] for row in sorted(met, key=lambda row: row["slice"])])
    return model.filled(flat)


SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, in_dictionary bigint, base double, log_p double, lacks array<struct<word: binary, times: bigint>>"


def with_scores(texts: DataFrame, model: Model, vocab: Vocabulary, chunk_bytes: int = CHUNK_BYTES, tokens_at_once: int = TOKENS_AT_ONCE) -> DataFrame:
    """What the dictionary and the model say of every document, and the words that the dictionary lacks."""
    logs = np.append(np.log10(vocab.counts + 1.0), 0.0)
    known = np.append(np.ones(len(vocab.words), dtype=np.int64), 0)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for read_ in read_documents(batches, 2, vocab, chunk_bytes, tokens_at_once):
            codes, ends = read_.codes, read_.ends
            starts = np.append(0, ends[:-1])
            scores = document_scores(model, vocab, codes, ends) / _LN10
            row_of, words, times = read_.lacks
            offsets = np.searchsorted(row_of, np.arange(len(read_.rows) + 1)).astype(np.int32)
            columns = [
                pa.array([row[0] for row in read_.rows], pa.int64()),
                pa.array([row[1] for row in read_.rows], pa.bool_()),
                pa.array(ends - starts, pa.int64()),
                pa.array(np.add.reduceat(known[codes], starts), pa.int64()),
                pa.array(np.add.reduceat(logs[codes], starts)),
                pa.array(scores),
                pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([words, pa.array(times, pa.int64())], ["word", "times"])),
            ]
            whole = pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCORED.split(", ")[:6]] + ["lacks"])
            for low in range(0, len(read_.rows), 1_000):
                yield whole.slice(low, 1_000)

    return mapped(texts, score, SCORED)


def score_documents(docs: DataFrame, share: int = SHARE, passes: int = PASSES, head_words: int = HEAD_WORDS, dictionary_words: int = DICTIONARY_WORDS, seed: int = 3) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` of every row.

    A missing text is an empty one and consists of its end alone. Rows without an id are held out; repeated rows are
    scored each. Where nothing may be learnt from, every score is the base score, which is then zero. Other columns are ignored.
    The model learns in ``passes`` passes of ``share`` rounds; each pass takes every document that is not held out once.
    The model depends on how the documents are dealt to tasks, since each trains a replica; counts and base scores do not.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), set_apart().alias("held_out"), text.alias("text"))
    learnt = rows.filter(~F.col("held_out"))
    counts = stored(word_counts(learnt), "word-counts")
    vocab = vocabulary(counts, head_words, dictionary_words)
    train_tokens, train_words = vocab.all_tokens, vocab.all_words
    model = Model.fresh(vocab, seed=seed)
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(share))
    for number in range(passes * share if train_tokens else 0):
        model = train_round(model, vocab, learnt.filter(drawn == number % share), rate=RATE / (1 + number))

    scored = with_scores(rows, model, vocab).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "scored")
    lacks = scored.select("row", F.inline("lacks"))
    known = counts.select(F.col("word").alias("__word"), "c")
    c = F.coalesce(F.col("c"), F.lit(0))
    met = lacks.join(known, F.col("word") == F.col("__word"), "left")
    rest = met.groupBy(F.col("row").alias("__row")).agg(
        F.sum(F.col("times") * F.log10(c + F.lit(1.0))).alias("rest_log"),
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rest_known"),
    )
    joined = scored.drop("lacks").join(rest, F.col("row") == F.col("__row"), "left")
    rest_log, n = F.coalesce("rest_log", F.lit(0.0)), F.col("n_tokens")
    rest_tokens, rest_words = vocab.rest
    base = F.col("base") + rest_log - n * float(np.log10(train_tokens + train_words + 1))
    own = F.col("log_p") + rest_log - (n - F.col("in_dictionary")) * float(np.log10(rest_tokens + rest_words + 1))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("in_dictionary") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(train_tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (own if train_tokens else base).alias("score"),
    )


def op13_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents by a language model learnt from those that are not held out."""
    return score_documents(read(spark, sf_dir, "documents"))
