"""Exact groups, SimHash components and repeated passages against brute force."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F
import xxhash

from tallyloom.llm.exact_dedup import exact_dedup, exact_groups
from tallyloom.llm import substrings
from tallyloom.llm.simhash import bucket_links, components, covering_masks, fingerprint, near_dedup, near_groups, near_links
from tallyloom.llm.substrings import Hashes, Suffixes, without_repeats


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def exact(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[lower(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(map(repr, out))


@pytest.mark.parametrize("salts", [1, 3])
def test_exact_groups(hostile, hostile_rows, documents, salts):
    got = exact_groups(hostile.repartition(5), salts)
    assert sorted(map(repr, map(tuple, got.collect()))) == exact([r[:2] for r in hostile_rows])
    got = exact_groups(documents.repartition(5), salts)
    assert sorted(map(repr, map(tuple, got.collect()))) == exact([(r.doc_id, r.text) for r in documents.collect()])


def test_exact_dedup_keeps_the_largest_id_and_all_columns(hostile, nothing, hostile_rows):
    kept = exact_dedup(hostile)
    assert kept.columns == hostile.columns
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows) == len({lower(text) for _, text in rows}) == len({lower(r[1]) for r in hostile_rows})
    best = {lower(t): max((r[0] for r in hostile_rows if lower(r[1]) == lower(t) and r[0] is not None), default=None) for _, t in rows}
    assert all(best[lower(text)] == doc_id for doc_id, text in rows)
    assert exact_dedup(nothing).count() == exact_groups(nothing).count() == 0


def simhash(text, words=3):
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def linked(rows, radius=3):
    fps = {}
    for doc_id, text in rows:
        fps.setdefault(simhash(text), []).append(doc_id)
    known = list(fps)
    parent = {fp: fp for fp in known}

    def find(fp):
        while parent[fp] != fp:
            fp = parent[fp]
        return fp

    for i, a in enumerate(known):
        for b in known[:i]:
            if (a ^ b).bit_count() <= radius:
                parent[find(a)] = find(b)
    least = {}
    for fp in known:
        least.setdefault(find(fp), []).extend(i for i in fps[fp] if i is not None)
    return sorted(repr((i, f"{fp:016x}", min(least[find(fp)], default=None))) for fp, ids in fps.items() for i in ids)


def test_near_groups(hostile, hostile_rows, documents, nothing):
    rows = [(i, t) for i, t, *_ in hostile_rows if not t or len(t) < 1000]
    short = hostile.filter("text is null or length(text) < 1000")
    assert sorted(map(repr, map(tuple, near_groups(short).collect()))) == linked(rows)
    assert sorted(map(repr, map(tuple, near_groups(documents).collect()))) == linked([(r.doc_id, r.text) for r in documents.collect()])
    assert near_groups(nothing).count() == near_dedup(nothing).count() == 0


def test_near_groups_with_divided_buckets(documents):
    assert sorted(map(repr, map(tuple, near_groups(documents, bucket_rows=2).collect()))) == linked([(r.doc_id, r.text) for r in documents.collect()])


def test_near_dedup_keeps_one_of_each_component(hostile, documents):
    kept = near_dedup(documents)
    assert kept.columns == documents.columns
    groups = near_groups(documents).collect()
    assert sorted(r.doc_id for r in kept.collect()) == sorted({g.component_id for g in groups})
    assert near_dedup(hostile).columns == hostile.columns


def test_near_dedup_of_rows_that_share_an_id(spark):
    text = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, text), (2, text), (2, "quite another text under the second id, and clean"), (3, text)], "doc_id bigint, text string")
    assert sorted(r.doc_id for r in near_dedup(docs).collect()) == [1, 2]


def test_near_dedup_decides_by_row(spark):
    text, other = "one two three four five six seven eight nine ten", "one text that is like no other text in this table at all"
    rows = [(None, text), (None, text), (4, text), (None, text), (None, other), (None, other), (9, ""), (9, ""), (9, "")]
    docs = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], "doc_id bigint, text string, at int")
    assert sorted(map(repr, ((r.doc_id, r.text) for r in near_dedup(docs).collect()))) == sorted(map(repr, [(4, text), (None, other), (9, "")]))


def test_a_chain_through_rows_without_ids(spark, monkeypatch):
    fps = {"a": 0, "b": 0b111, "c": 0b111111, "d": 0b111111111}
    monkeypatch.setattr("tallyloom.llm.simhash.with_fingerprints", lambda docs, words: docs.select("doc_id", "key", F.col("text").cast("bigint").alias("fp")))
    rows = [(5, fps["a"]), (None, fps["b"]), (3, fps["c"]), (None, fps["d"]), (8, 0xFF << 40), (None, 0xFF << 52)]
    docs = spark.createDataFrame([(i, str(fp), f"{i} {fp}") for i, fp in rows], "doc_id bigint, text string, key string")
    got = {(r.doc_id, int(r.fingerprint, 16)): r.component_id for r in near_groups(docs).collect()}
    assert got == {(i, fp): 3 if fp < 1 << 20 else i for i, fp in rows}


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_difference(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    rng = np.random.default_rng(1)
    for _ in range(3000):
        apart = sum(1 << int(b) for b in rng.choice(64, radius, replace=False))
        assert any(not mask & apart for mask in masks)


def test_long_shingle_runs_are_counted_in_parts():
    text = " ".join(f"w{i % 977}" for i in range(70_000))
    assert fingerprint(text) == fingerprint(text, bytes_at_once=30) == simhash(text)
    for short in ("", " ", "a", "a b", "A  b\tC", "a b c d"):
        assert fingerprint(short) == fingerprint(short, bytes_at_once=1) == simhash(short)


def test_dense_bucket_becomes_one_tree():
    fps = np.arange(3000, dtype=np.uint64)
    links = bucket_links(fps, 3)
    assert len(links) == len(fps) - 1 and len({i for pair in links for i in pair}) == len(fps)


def test_a_cluster_larger_than_a_bucket(spark):
    rows = [(i * 3, i) for i in range(300)] + [(10_000, -1), (10_001, -8)]
    classes = spark.createDataFrame(rows, "rep bigint, fp bigint")
    for limit in (2048, 4):
        roots = {r.node: r.root for r in components(near_links(classes, 3, limit)).collect()}
        assert {roots[i * 3] for i in range(1, 300)} == {0} and roots[10_001] == 10_000


def test_components_of_a_long_chain(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000)], "a bigint, b bigint")
    assert {(r.node, r.root) for r in components(chain).collect()} == {(i, 0) for i in range(1, 301)}


def passages(rows, length=50):
    """Every byte that a string of an earlier document covers, by looking at all strings."""
    starts, out = {}, []
    for doc_id, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - length + 1):
            own = data[i : i + length]
            at = doc_id if doc_id is not None else float("inf")
            starts[own] = min(starts.get(own, at), at)
    for doc_id, text in rows:
        data, at = (text or "").encode(), doc_id if doc_id is not None else float("inf")
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if starts[data[i : i + length]] < at:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(data), sum(gone), spans, kept))
    return sorted(map(repr, out))


@pytest.mark.parametrize("hot, block_bytes", [(1024, 2_000_000), (1, 5_000)])
def test_repeated_passages(documents, hot, block_bytes):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = without_repeats(documents.repartition(3), hot, block_bytes)
    assert sorted(repr((*r[:4], bytes(r[4]))) for r in got.collect()) == passages(rows)


def test_repeated_passages_of_hostile_rows(spark, hostile, hostile_rows, nothing):
    few = [(i, t[:3000] if t else t) for i, t, *_ in hostile_rows]
    rows = few + [(900, "x" * 400), (901, "x" * 120 + "y"), (902, "é" * 60), (903, "é" * 61), (904, "z" * 49), (905, "z" * 49), (905, "z" * 50), (904, "z" * 50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = without_repeats(docs.repartition(3), 2, 500)
    assert sorted(repr((*r[:4], bytes(r[4]))) for r in got.collect()) == passages(rows)
    assert without_repeats(hostile).count() == len(hostile_rows)
    assert without_repeats(nothing).count() == 0


def test_equal_strings_have_one_anchor_in_blocks_of_any_size(monkeypatch):
    rng = np.random.default_rng(6)
    text = rng.integers(97, 123, 3_000).astype(np.uint8).tobytes()
    filler = rng.integers(97, 123, 900_000).astype(np.uint8).tobytes()
    mix = substrings._mix
    monkeypatch.setattr(substrings, "_mix", lambda h: mix(h) & np.uint64(0xFF << 12 | 0xF << 60))  # ties in most of the bits

    def keys(data):
        one = np.array([1], dtype=np.int64)
        block = substrings.Block.of(one.tobytes(), np.array([False]).tobytes(), np.array([len(data)], dtype=np.int64).tobytes(), zstandard.ZstdCompressor().compress(data))
        return {int(first) + i: int(key) for first, n, key in zip(block.first, block.strings, block.key, strict=True) for i in range(n)}

    small, large = keys(text), keys(text + filler)
    assert len(small) == 2_951 and all(large[at] == key for at, key in small.items())


def test_suffix_sort_by_hashes():
    rng = np.random.default_rng(3)
    for trial in range(30):
        data = rng.integers(97, 99 + trial % 3, 400).astype(np.uint8)
        start, length, group = rng.integers(0, 340, 120), rng.integers(1, 60, 120), np.sort(rng.integers(0, 1 + trial % 7, 120))
        suffixes = Suffixes(data, Hashes(data), start, length)
        order = suffixes.sort(group)
        keys = [(group[i], data[start[i] : start[i] + length[i]].tobytes()) for i in order]
        assert keys == sorted(keys) and sorted(order) == list(range(120))
        same = suffixes.equal_neighbours(order, group)
        assert same.tolist() == [k > 0 and keys[k] == keys[k - 1] for k in range(120)]
