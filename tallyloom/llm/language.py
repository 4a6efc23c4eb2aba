"""Language identification: a bidirectional gated recurrent network over bytes.

A text is cut into windows of bytes, none left out. Two gated recurrent layers read a window from either
side; at every byte their states give a distribution over the languages, and a document's
probabilities are the mean over its bytes. The network is trained here, in numpy, by
backpropagation through time with Adam, on a bounded sample of windows.

States have one row per window and the gates lie apart, so that a byte's input terms are copied as a
whole and every step works on gapless arrays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import held_out, mapped, read

UNKNOWN = "und"
WINDOW = 64
HIDDEN = 12
#: The training sample: so many documents of a language at most, and so many windows of each.
DOCS_PER_LANGUAGE = 400
WINDOWS_PER_DOC = 6
STEPS = 300
BATCH = 192
RATE = 0.02
COLUMNS = 1_024

_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether any character is a letter; what the pattern finds may be a number sign, such as a fraction."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


@dataclass
class Direction:
    """One gated recurrent layer; its first axis names the update gate, the reset gate and the candidate.

    ``table`` holds the input term of every byte.
    """

    table: np.ndarray  # 3 x 256 x H
    state: np.ndarray  # 3 x H x H
    bias: np.ndarray  # H, inside the reset gate

    @classmethod
    def fresh(cls, rng: np.random.Generator, hidden: int) -> Direction:
        return cls(
            _by_gate(rng.normal(0, 0.3, (3 * hidden, 256))),
            _by_gate(rng.normal(0, 1 / np.sqrt(hidden), (3 * hidden, hidden))),
            np.zeros(hidden, dtype=np.float32),
        )

    def step(self, x: np.ndarray, h: np.ndarray, keep: list | None = None) -> np.ndarray:
        """The state after the bytes ``x``; ``keep`` gets what the way back needs."""
        a = np.take(self.table, x, axis=1)
        u = h @ self.state
        gates = a[:2]
        gates += u[:2]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        z, r = gates
        m = u[2]
        m += self.bias
        c = a[2]
        c += r * m
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((x, h, z, r, m, c))
        after = h - c
        after *= z
        after += c
        return after

    def back(self, kept: tuple, dh: np.ndarray, grads: Direction) -> np.ndarray:
        """The gradient of the state before a step; adds the step's part to ``grads``."""
        x, h, z, r, m, c = kept
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * m * r * (1 - r)
        da = np.stack([dz, dr, dc])
        du = np.stack([dz, dr, dc * r])
        hot = np.zeros((256, len(x)), dtype=np.float32)
        hot[x, np.arange(len(x))] = 1
        grads.table += hot @ da
        grads.state += h.T @ du
        grads.bias += du[2].sum(axis=0)
        return dh * z + (du @ self.state.transpose(0, 2, 1)).sum(axis=0)

    def parts(self) -> list[np.ndarray]:
        return [self.table, self.state, self.bias]


def _by_gate(drawn: np.ndarray) -> np.ndarray:
    """Three blocks of rows as three matrices that multiply states from the right."""
    return np.ascontiguousarray(drawn.reshape(3, -1, drawn.shape[1]).transpose(0, 2, 1), dtype=np.float32)


@dataclass
class Network:
    """Both directions and the output layer; ``languages`` names its rows."""

    languages: list[str]
    ahead: Direction
    behind: Direction
    out: np.ndarray  # K x 2H
    out_bias: np.ndarray  # K x 1
    hidden: int = field(default=HIDDEN)

    @classmethod
    def fresh(cls, languages: list[str], hidden: int = HIDDEN, seed: int = 5) -> Network:
        rng = np.random.default_rng(seed)
        k = len(languages)
        out = rng.normal(0, 0.1, (k, 2 * hidden)).astype(np.float32)
        return cls(languages, Direction.fresh(rng, hidden), Direction.fresh(rng, hidden), out, np.zeros((k, 1), np.float32), hidden)

    def parts(self) -> list[np.ndarray]:
        return [*self.ahead.parts(), *self.behind.parts(), self.out, self.out_bias]

    def zeros(self) -> Network:
        like = [np.zeros_like(part) for part in self.parts()]
        return Network(self.languages, Direction(*like[:3]), Direction(*like[3:6]), like[6], like[7], self.hidden)

    def _probabilities(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        logits = self.out[:, : self.hidden] @ left.T
        logits += self.out[:, self.hidden :] @ right.T
        logits += self.out_bias
        logits -= logits.max(axis=0)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=0)
        return logits

    def label(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The sum over a window's bytes of their distributions: one row per window."""
        t, b = windows.shape
        lefts = np.empty((t, b, self.hidden), dtype=np.float32)
        h = np.zeros((b, self.hidden), dtype=np.float32)
        for i in range(t):
            h = lefts[i] = self.ahead.step(windows[i], h)
        total = np.zeros((len(self.languages), b), dtype=np.float32)
        h = np.zeros((b, self.hidden), dtype=np.float32)
        shortest = lengths.min(initial=t)
        for i in range(t - 1, -1, -1):
            h = self.behind.step(windows[i], h)
            p = self._probabilities(lefts[i], h)
            total += p if i < shortest else p * (lengths > i)
        return total.T

    def train_step(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, Network]:
        """Mean cross entropy over all bytes, and its gradients by backpropagation through time."""
        t, b = windows.shape
        grads, n = self.zeros(), self.hidden
        ahead, behind, lefts, rights = [], [], [], [None] * t
        h = np.zeros((b, n), dtype=np.float32)
        for i in range(t):
            h = self.ahead.step(windows[i], h, ahead)
            lefts.append(h)
        h = np.zeros((b, n), dtype=np.float32)
        for i in range(t - 1, -1, -1):
            h = self.behind.step(windows[i], h, behind)
            rights[i] = h
        total, loss = max(float(lengths.sum()), 1.0), 0.0
        down = [None] * t
        for i in range(t):
            p = self._probabilities(lefts[i], rights[i])
            mask = (lengths > i).astype(np.float32) / total
            loss -= float((np.log(p[labels, np.arange(b)] + 1e-9) * mask).sum())
            p[labels, np.arange(b)] -= 1
            p *= mask
            grads.out[:, :n] += p @ lefts[i]
            grads.out[:, n:] += p @ rights[i]
            grads.out_bias += p.sum(axis=1, keepdims=True)
            down[i] = p.T @ self.out
        dh = np.zeros((b, n), dtype=np.float32)
        for i in range(t - 1, -1, -1):
            dh = self.ahead.back(ahead[i], dh + down[i][:, :n], grads.ahead)
        dh = np.zeros((b, n), dtype=np.float32)
        for i in range(t):
            dh = self.behind.back(behind[t - 1 - i], dh + down[i][:, n:], grads.behind)
        return loss, grads


def cut(data: bytes, window: int = WINDOW) -> np.ndarray:
    """The windows of a text's bytes, one per row, the last one filled up with zeros."""
    rows = np.zeros(-(-len(data) // window) * window, dtype=np.uint8)
    rows[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    return rows.reshape(-1, window)


def train(windows: list[bytes], labels: list[str], steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 5) -> Network | None:
    """A network fitted to the windows; None when there are none. Every language is drawn equally often."""
    languages = sorted(set(labels))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    net = Network.fresh(languages, seed=seed)
    data = np.concatenate([cut(w[:WINDOW]) for w in windows])
    lengths = np.array([min(len(w), WINDOW) for w in windows])
    number = np.array([languages.index(label) for label in labels])
    of = [np.flatnonzero(number == k) for k in range(len(languages))]
    first, second = net.zeros().parts(), net.zeros().parts()
    for step in range(1, steps + 1):
        drawn = np.concatenate([rng.choice(of[k % len(of)], batch // len(of) + 1) for k in range(len(of))])
        _, grads = net.train_step(np.ascontiguousarray(data[drawn].T), lengths[drawn], number[drawn])
        size = np.sqrt(sum(float((g * g).sum()) for g in grads.parts()))
        pace = rate * min(1.0, 1 / max(size, 1e-9)) if size > 1 else rate
        pace *= 1 - 0.9 * step / steps
        for part, grad, m, v in zip(net.parts(), grads.parts(), first, second, strict=True):
            m += 0.1 * (grad - m)
            v += 0.01 * (grad * grad - v)
            part -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return net


def training_sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, windows: int = WINDOWS_PER_DOC) -> tuple[list[bytes], list[str]]:
    """At most ``per_language`` documents of each language, as windows spread over their whole texts.

    They are drawn by a hash of id and text, so rows that share an id are drawn each for itself and copies of a
    row count once. The draw is made in Spark: the driver gets no more than is learnt from.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("lang", F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id"), F.col("text"), F.lit(11)).alias("draw"))
    counts = {row["lang"]: row["n"] for row in known.groupBy("lang").agg(F.approx_count_distinct("draw").alias("n")).collect()}
    if not counts:
        return [], []
    # Half as many again as needed pass, then the smallest hashes are taken.
    shares = {lang: min(1.0, 1.5 * (per_language + 20) / n) for lang, n in counts.items()}
    bounds = F.create_map(*(F.lit(v) for lang, share in shares.items() for v in (lang, min(int(2**64 * share) - 2**63, 2**63 - 1))))
    passed = known.filter(F.col("draw") <= bounds[F.col("lang")])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for text in batch.column(2):
                data = text.as_py().encode("utf-8", "replace")
                starts = np.linspace(0, max(len(data) - WINDOW, 0), windows).astype(int)
                parts.append([data[s : s + WINDOW] for s in sorted(set(starts.tolist()))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(parts, pa.list_(pa.binary()))], ["lang", "draw", "parts"])

    cut_up = mapped(passed.select("lang", "draw", "text"), spread, "lang string, draw bigint, parts array<binary>")
    once = cut_up.groupBy("lang", "draw").agg(F.min("parts").alias("parts"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw"))
    drawn = once.withColumn("place", place).filter(F.col("place") <= per_language).collect()
    found: tuple[list[bytes], list[str]] = ([], [])
    for row in sorted(drawn, key=lambda r: (r["lang"], r["place"])):
        for part in row["parts"]:
            if part:
                found[0].append(bytes(part))
                found[1].append(row["lang"])
    return found


def identify(docs: DataFrame, net: Network | None) -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score``, the pooled probability of that language, for every row.

    A text that is missing, empty or without a letter is ``und`` with score 0, as is every text when
    nothing was learnt. Other columns are ignored; repeated rows each get their prediction.
    """

    def batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            k = len(net.languages) if net else 0
            totals = np.zeros((len(ids), k))
            held: list[np.ndarray] = []
            owners: list[np.ndarray] = []
            sizes: list[np.ndarray] = []
            waiting = 0

            def flush(all_of: bool) -> None:
                nonlocal held, owners, sizes, waiting
                if not waiting:
                    return
                rows, owner, size = np.concatenate(held), np.concatenate(owners), np.concatenate(sizes)
                end = len(rows) if all_of else len(rows) // COLUMNS * COLUMNS
                for low in range(0, end, COLUMNS):
                    part = slice(low, min(low + COLUMNS, end))
                    labelled = net.label(np.ascontiguousarray(rows[part].T), size[part])
                    for j in range(k):
                        totals[:, j] += np.bincount(owner[part], weights=labelled[:, j], minlength=len(ids))
                held, owners, sizes, waiting = [rows[end:]], [owner[end:]], [size[end:]], len(rows) - end

            lettered = np.zeros(len(ids), dtype=bool)
            for i, text in enumerate(texts):
                value = text.as_py() or ""
                if not net or not has_letter(value):
                    continue
                lettered[i] = True
                data = value.encode("utf-8", "replace")
                step = COLUMNS * WINDOW
                for low in range(0, len(data), step):  # a very long text is labelled in parts
                    rows = cut(data[low : low + step])
                    size = np.full(len(rows), WINDOW)
                    size[-1] = len(data[low : low + step]) - WINDOW * (len(rows) - 1)
                    held.append(rows)
                    owners.append(np.full(len(rows), i))
                    sizes.append(size)
                    waiting += len(rows)
                    if waiting >= COLUMNS:
                        flush(False)
            flush(True)
            share = totals / np.maximum(totals.sum(axis=1, keepdims=True), 1e-9)
            best = share.argmax(axis=1) if k else np.zeros(len(ids), dtype=int)
            names = [net.languages[j] if ok else UNKNOWN for j, ok in zip(best, lettered, strict=True)] if net else [UNKNOWN] * len(ids)
            score = np.where(lettered, share.max(axis=1) if k else 0.0, 0.0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(names, pa.string()), pa.array(np.clip(score, 0.0, 1.0))], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, batches, "doc_id bigint, lang_pred string, score double")


def learn_and_identify(docs: DataFrame) -> DataFrame:
    """Languages of all rows of ``docs``, learnt from those with a language that are not held out."""
    net = train(*training_sample(docs))
    return identify(docs, net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents."""
    return learn_and_identify(read(spark, sf_dir, "documents"))
