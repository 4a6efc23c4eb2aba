"""SimHash near-duplicates by covering locality-sensitive hashing.

Every text has a 64-bit fingerprint; texts are linked whose fingerprints differ in at most ``radius`` bits.
Each bit position gets a vector of ``radius + 1`` bits; every non-zero vector ``v`` is a table whose mask
holds the positions with an odd inner product with ``v``. At most ``radius`` differing positions span less
than the whole vector space, so some ``v`` is orthogonal to all of them: its mask leaves them out and
the pair collides in that table. No pair is missed, whatever the fingerprints.

Equal fingerprints are one class before any table is built. Buckets are compared in vectorised blocks
that give the links of a spanning forest, never all pairs. A bucket of more than ``bucket_rows`` classes
is first divided by the bits its mask leaves out, cut in ``radius + 1`` pieces: two members within the
radius agree on at least one piece, so the division loses no pair either.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.common import free_names, mapped, read, ship, stored

BITS = 64
SHINGLE_WORDS = 3
RADIUS = 3
BUCKET_ROWS = 2_048
SEED = 42
BYTES_AT_ONCE = 500_000

_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(data: bytes, size: int) -> Iterator[list[bytes]]:
    """The words of a text, some at a time."""
    low = 0
    while len(data) - low > size:
        gap = _GAP.search(data, low + size)
        high = gap.start() if gap else len(data)
        yield data[low:high].split()
        low = high
    yield data[low:].split()


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, bytes_at_once: int = BYTES_AT_ONCE) -> int:
    """The SimHash of a text's word shingles, repeats included; 0 for a text without a word."""
    data = (text or "").encode("utf-8", "replace").lower()  # bytes: A-Z only, as splitting knows ASCII white space only
    ones, n, digest, last = np.zeros(BITS, dtype=np.int64), 0, xxhash.xxh64_intdigest, []
    for run in _word_runs(data, bytes_at_once):
        parts = last + run
        last = parts[len(parts) - words + 1 :] if len(parts) >= words else parts
        if len(parts) < words:
            continue
        joined = b" ".join(parts)
        ends = np.cumsum([len(p) + 1 for p in parts]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends.tolist()[words - 1 :], strict=False)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n:
        return digest(b" ".join(last), SEED) if last else 0  # fewer words than a shingle has: all of them
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def row_key(docs: DataFrame) -> Column:
    """Names a row by its id, which may be missing, and its whole text."""
    return F.concat_ws(" ", F.coalesce(docs["doc_id"].cast("string"), F.lit("none")), F.sha2(F.coalesce(docs["text"].cast("string"), F.lit("")), 256))


def with_fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id``, the row's ``key`` and ``fp``, the fingerprint as a signed long."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(text.as_py(), words) for text in batch.column(2)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps)], ["doc_id", "key", "fp"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_key(docs).alias("key"), F.col("text").cast("string").alias("text"))
    return mapped(rows, marked, "doc_id bigint, key string, fp bigint")


def covering_masks(radius: int, bits: int = BITS, seed: int = 7) -> list[int]:
    """The masks of the ``2 ** (radius + 1) - 1`` tables, as unsigned numbers."""
    size = 2 ** (radius + 1)
    # Every non-zero vector serves about equally many positions, in an order fixed by the seed.
    vectors = np.random.default_rng(seed).permutation([1 + i % (size - 1) for i in range(bits)]).tolist()
    return [sum(1 << i for i, at in enumerate(vectors) if (at & v).bit_count() % 2) for v in range(1, size)]


def _pieces(mask: int, parts: int, bits: int = BITS) -> list[int]:
    """The positions that a mask leaves out, cut in ``parts`` masks."""
    rest = [i for i in range(bits) if not mask >> i & 1]
    return [sum(1 << i for i in rest[k::parts]) for k in range(parts)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def bucket_links(fps: np.ndarray, radius: int, block: int = 1_024) -> list[tuple[int, int]]:
    """A spanning forest of the pairs within the radius, as positions; ``block`` squared comparisons at once."""
    root = np.arange(len(fps))
    links: list[tuple[int, int]] = []
    for low in range(0, len(fps), block):
        left = fps[low : low + block]
        for other in range(low, len(fps), block):
            a, b = np.nonzero(np.bitwise_count(left[:, None] ^ fps[None, other : other + block]) <= radius)
            a, b = a + low, b + other
            while len(a):
                fresh = root[a] != root[b]
                a, b = a[fresh], b[fresh]
                tops = np.maximum(root[a], root[b])
                tops, pick = np.unique(tops, return_index=True)  # every tree is hung below a smaller one, once
                links.extend(zip(a[pick].tolist(), b[pick].tolist(), strict=True))
                root[tops] = np.minimum(root[a[pick]], root[b[pick]])
                while (root[root] != root).any():
                    root = root[root]
    return links


def _linked(rows: DataFrame, keys: list[str], radius: int) -> DataFrame:
    """Links within buckets; rows of a bucket stand together, and a bucket may span batches."""

    def links(ids: np.ndarray, fps: np.ndarray, cuts: np.ndarray) -> pd.DataFrame:
        found_a, found_b = [], []
        edges = [0, *cuts.tolist(), len(fps)]
        sizes = np.diff(edges)
        pairs = np.flatnonzero(sizes == 2)
        at = np.array(edges)[pairs]
        near = at[np.bitwise_count(fps[at] ^ fps[at + 1]) <= radius] if len(at) else at
        found_a.append(ids[near])
        found_b.append(ids[near + 1])
        for k in np.flatnonzero(sizes > 2).tolist():
            own = slice(edges[k], edges[k + 1])
            for i, j in bucket_links(fps[own], radius):
                found_a.append(ids[own][i : i + 1])
                found_b.append(ids[own][j : j + 1])
        return pd.DataFrame({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: pd.DataFrame | None = None
        for frame in frames:
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            bounds = np.flatnonzero((held[keys].to_numpy()[1:] != held[keys].to_numpy()[:-1]).any(axis=1)) + 1
            if not len(bounds):
                continue
            done, held = held.iloc[: bounds[-1]], held.iloc[bounds[-1] :]
            yield links(done["rep"].to_numpy(), done["fp"].to_numpy().view(np.uint64), bounds[:-1])
        if held is not None and len(held):
            yield links(held["rep"].to_numpy(), held["fp"].to_numpy().view(np.uint64), np.array([], dtype=int))

    ship(rows.sparkSession)
    dealt = rows.select(*keys, "rep", "fp").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(batches, "a bigint, b bigint")


def near_links(classes: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Links (a, b) that join every two classes (``rep``, ``fp``) within the radius, directly or over others."""
    masks = covering_masks(radius)
    tables = F.array(*(F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)))
    rows = classes.select("rep", "fp", F.inline(tables))
    full = rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    parts = radius + 1
    whole = F.array(F.struct(F.lit(-1).alias("p"), F.lit(0).cast("bigint").alias("rest")))
    pieces = F.get(
        F.array(*(F.array(*(F.struct(F.lit(p).alias("p"), F.col("fp").bitwiseAND(F.lit(_signed(piece))).alias("rest")) for p, piece in enumerate(_pieces(m, parts)))) for m in masks)),
        F.col("t"),
    )
    dealt = rows.join(full, ["t", "key"]).select("t", "key", "rep", "fp", F.inline(F.when(F.col("n") <= bucket_rows, whole).otherwise(pieces)))
    links = _linked(dealt, ["t", "key", "p", "rest"], radius)
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected with, for every node of a link.

    Alternating star contraction: each round hangs every node's larger neighbours, then its smaller
    ones, below the smallest of all. Rounds are written to the shared folder; they end when no link
    changes, after a number that grows with the logarithm of the nodes.
    """
    edges = stored(links.filter("a != b").select("a", "b").distinct(), "links")
    before = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").filter("a != b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("b")), F.struct(F.col("m").alias("a"), F.col("a").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").filter("a != b").distinct(), "links")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def fingerprint_roots(marked: DataFrame, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``__fp`` and ``root``, one fingerprint that names the component, for every fingerprint.

    Fingerprints are linked as they are, whatever ids their rows have or lack.
    """
    classes = marked.select("fp").distinct().withColumn("rep", F.col("fp"))
    roots = components(near_links(classes, radius, bucket_rows))
    named = classes.join(roots, classes["rep"] == roots["node"], "left")
    return stored(named.select(F.col("fp").alias("__fp"), F.coalesce("root", "rep").alias("root")), "component-roots")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: ``doc_id``, ``fingerprint`` and ``component_id``, the smallest id reachable.

    A missing text is an empty one; texts without a word have fingerprint zero and are linked like any.
    Rows without an id are linked like any too; a component in which no row has an id has no name. Other columns are ignored.
    """
    marked = stored(with_fingerprints(docs, words).drop("key"), "fingerprints")
    roots = fingerprint_roots(marked, radius, bucket_rows)
    least = marked.groupBy("fp").agg(F.min("doc_id").alias("least"))
    names = least.join(roots, F.col("fp") == F.col("__fp")).groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "__root")
    # Written first: a fingerprint of many documents then meets its component in a join whose skew Spark can split.
    named = stored(roots.join(names, F.col("root") == F.col("__root")).select("__fp", "component_id"), "component-names")
    out = marked.join(named, marked["fp"] == named["__fp"], "left")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """The documents that stay, one row of each component, with all their columns.

    The row with the smallest id stays, one with an id rather than one without, and of several with that id the one whose
    text has the smallest digest. Rows that share id and text stand for each other: one of them stays, if any does.
    """
    key, = free_names(docs, "__key")
    marked = stored(with_fingerprints(docs, words), "fingerprints")
    roots = fingerprint_roots(marked, radius)
    order = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "key")
    rows = marked.groupBy("fp", "doc_id", "key").agg(F.count("*").alias("n"))
    rows = stored(rows.join(roots, F.col("fp") == F.col("__fp")).select("root", "key", "n", order.alias("order")), "rows-of-components")
    first = stored(rows.groupBy(F.col("root").alias("__root")).agg(F.min("order").alias("first")), "first-rows")
    decided = rows.join(first, F.col("root") == F.col("__root")).select("key", "n", (F.col("order.key") == F.col("first.key")).alias("stays"))
    apart = stored(decided.filter(~F.col("stays") | (F.col("n") > 1)), "rows-apart")
    keyed = docs.withColumn(key, row_key(docs))
    alone = keyed.join(apart.select("key"), keyed[key] == apart["key"], "left_anti")
    repeated = apart.filter("stays")
    one_each = keyed.join(repeated, keyed[key] == repeated["key"], "left_semi").dropDuplicates([key])
    return alone.unionByName(one_each).drop(key)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_groups(read(spark, sf_dir, "documents"))
