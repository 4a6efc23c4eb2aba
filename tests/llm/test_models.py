"""Packing, quality, language, decontamination and the pipeline."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import decontaminate, language, packing, quality, simhash
from tallyloom.llm.tokens import WordEncoder


def held_out(doc_id):
    return doc_id is None or zlib.crc32(str(doc_id).encode()) % 3 == 1


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


# Packing


def expected_pieces(tokenizer, rows, capacity=4096):
    out = []
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for k, low in enumerate(range(0, len(ids), capacity)):
            part = ids[low : low + capacity]
            out.append((doc_id, k, low, len(part), zlib.crc32(part.tobytes())))
    return sorted(map(repr, out))


def check_sequences(rows, capacity=4096, spare=1.03):
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(places) <= -(-sum(r.length for r in rows) // capacity) * spare + 1


def test_all_documents_are_packed(spark, documents, tokenizer):
    rows = packing.pack_documents(documents).collect()
    assert sorted(repr(tuple(r[:5])) for r in rows) == expected_pieces(tokenizer, [(r.doc_id, r.text) for r in documents.collect()])
    check_sequences(rows)


def test_hostile_documents_are_packed(hostile, hostile_rows, nothing, tokenizer):
    rows = packing.pack_documents(hostile.repartition(5), capacity=64).collect()
    assert sorted(repr(tuple(r[:5])) for r in rows) == expected_pieces(tokenizer, [r[:2] for r in hostile_rows], 64)
    check_sequences(rows, 64)
    assert packing.pack_documents(nothing).count() == 0


def test_ids_can_be_kept(documents, tokenizer):
    row = packing.pack_documents(documents.filter("doc_id = 1"), with_ids=True).first()
    text = documents.filter("doc_id = 1").first().text
    assert np.frombuffer(row.ids, "<u4").tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_pieces_of_one_length_over_many_tasks(spark):
    cut = spark.range(5000, numPartitions=7).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.when(F.col("id") % 3 > 0, 30).otherwise(F.col("id") % 64 + 1).cast("bigint").alias("length"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = packing.pack(cut, 64).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(rows) == 5000 and len({(r.sequence_id, r.offset) for r in rows}) == 5000
    check_sequences(rows, 64, spare=1.12)


def naive_best_fit(counts, capacity):
    """The rounds over single pieces and gaps: a gap, from the smallest on, takes the largest piece that fits and is left."""
    left = {length: list(range(n)) for length, n in counts.items() if n}
    gaps, goes, opened, matched = [], {}, 0, 0
    while any(left.values()):
        if not matched:
            new = -(-sum(length * len(ranks) for length, ranks in left.items()) // capacity)
            gaps += [(capacity, opened + i) for i in range(new)]
            opened, matched = opened + new, 0
        matched, after = 0, []
        for size, sequence in sorted(gaps):
            fitting = [length for length, ranks in left.items() if ranks and length <= size]
            if fitting:
                length = max(fitting)
                goes[length, left[length].pop(0)] = (sequence, capacity - size)
                matched += 1
                size -= length
            if size:
                after.append((size, sequence))
        gaps = after
    return goes


def by_hand(ranges):
    return [packing.sweep_range(*runs) for runs in ranges]


@pytest.mark.parametrize("ranges", [1, 2, 3, 5, 16])
@pytest.mark.parametrize("seed", range(6))
def test_sweeps_over_ranges_equal_one_gap_at_a_time(seed, ranges):
    rng = np.random.default_rng(seed)
    counts = {int(length): int(rng.integers(1, 40)) for length in rng.integers(1, 101, 1 + 15 * seed)}
    goes = {}
    for length, rank, n, first, offset in packing.best_fit(counts, by_hand, 100, ranges).tolist():
        for k in range(n):
            assert (length, rank + k) not in goes
            goes[length, rank + k] = (first + k, offset)
    assert goes == naive_best_fit(counts, 100)


def test_sweeps_in_tasks(spark):
    rng = np.random.default_rng(9)
    counts = {int(length): int(rng.integers(1, 2000)) for length in rng.permutation(np.arange(1, 301, 9))}
    for own in (counts, {7: 3}, {}):
        assert packing.best_fit(own, packing.in_tasks(spark), 300).tolist() == packing.best_fit(own, by_hand, 300).tolist()


def test_words_are_encoded_as_the_tokenizer_does(tokenizer):
    rng = np.random.default_rng(4)
    encoder = WordEncoder(packing.tokenizer_path(), 50, 50)
    for alphabet in ("aB'sé ÉßİΣς́ ​\x1c\x85|<12²½日本 \n\t\r!!$%٣ǅﬁͅΩ😀ſŉĸŁƁ×÷_-KÅ", "aBz'setdrmlvéÉßĳÿŁ .,!?#$_-09\n\t"):
        for i in range(1500):
            text = "".join(rng.choice(list(alphabet), rng.integers(0, 50))) + (" <|endoftext|> it's |x| we're" if i % 9 == 0 else "")
            assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    long = "thion anea, stble. " * 120_000
    assert encoder.encode(long) == encoder.encode("thion anea, stble. ") * 120_000


# Quality


def test_quality_of_rows_never_learnt_from(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    rows = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    known = {r.doc_id: r.quality for r in labels.collect() if held_out(r.doc_id)}
    assert len(rows) == docs.count() and all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in rows.items())
    assert np.mean([rows[i].predicted == q for i, q in known.items()]) >= 0.96
    wrong = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert {r.doc_id: r.score for r in quality.classify(docs.withColumn("lang", F.lit("xx")), wrong).collect()} == {i: r.score for i, r in rows.items()}


def test_scores_are_the_density_ratio():
    rng = np.random.default_rng(2)
    x = [rng.normal(0, 1, (400, 3)) @ np.diag([1, 2, 3]), rng.normal(1, 2, (300, 3))]
    model = quality.discriminant(np.array([400.0, 300.0]), np.array([v.sum(0) for v in x]), np.array([v.T @ v for v in x]), 0.0, 0.0)

    def log_density(v, own):
        c = np.cov(own.T, bias=True)
        d = v - own.mean(0)
        return -0.5 * d @ np.linalg.inv(c) @ d - 0.5 * np.log(np.linalg.det(c))

    for v in rng.normal(0, 2, (20, 3)):
        ratio = log_density(v, x[1]) + np.log(301 / 702) - log_density(v, x[0]) - np.log(401 / 702)
        assert model.scores(v[None])[0] == pytest.approx(1 / (1 + np.exp(-ratio)), rel=1e-6)


def test_quality_of_hostile_rows(spark, hostile, hostile_rows, nothing):
    labels = spark.createDataFrame([(-20, 1), (-13, 0), (1, None), (8, 7), (15, 0), (15, 1), (None, 0)], "doc_id bigint, quality int")
    got = quality.classify(hostile, labels)
    assert got.count() == len(hostile_rows) and not any(np.isnan(r.score) for r in got.collect())
    assert quality.classify(nothing, labels).count() == 0
    assert {r.score for r in quality.classify(hostile, labels.limit(0)).collect()} == {0.5}
    kept = quality.keep_good(hostile, labels)
    assert kept.columns == hostile.columns and quality.keep_good(nothing, labels).count() == 0


# Language


def test_languages_of_rows_never_learnt_from(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in language.learn_and_identify(docs).collect()}
    known = {r.doc_id: r.lang for r in docs.collect() if held_out(r.doc_id)}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows.values())
    assert np.mean([rows[i].lang_pred == lang for i, lang in known.items()]) >= 0.96


def test_the_sample_takes_rows_not_ids_and_copies_once(spark):
    """A language under one id is learnt from, no language sends the driver more than its share, copies are one document."""
    held = [i for i in range(99) if not held_out(i)][0]
    one_id = spark.range(3000).select(F.lit(held).cast("bigint").alias("doc_id"), F.concat(F.lit("word "), "id").alias("text"), F.lit("one").alias("lang"))
    copies = spark.range(3000).select(F.lit(held).cast("bigint").alias("doc_id"), F.lit("copy").alias("text"), F.lit("same").alias("lang"))
    few = spark.range(3).select(F.lit(held).cast("bigint").alias("doc_id"), F.concat(F.lit("few "), "id").alias("text"), F.lit("few").alias("lang"))
    parts, langs = language.training_sample(one_id.unionByName(copies).unionByName(few), per_language=50, windows=3)
    assert Counter(langs) == {"one": 50, "same": 1, "few": 3}
    assert len(set(parts)) == 54
    again = language.training_sample(few.unionByName(copies).unionByName(one_id).repartition(7), per_language=50, windows=3)
    assert (parts, langs) == again


def test_gradients_by_backpropagation_through_time():
    rng = np.random.default_rng(0)
    net = language.Network.fresh(["a", "b", "c"], 4)
    windows, lengths, labels = rng.integers(97, 110, (7, 5)).astype(np.uint8), np.array([7, 7, 3, 5, 1]), np.array([0, 1, 2, 0, 1])
    _, grads = net.train_step(windows, lengths, labels)
    for part, grad in zip(net.parts(), grads.parts(), strict=True):
        for _ in range(5):
            at = tuple(int(rng.integers(0, n)) for n in part.shape)
            if part.ndim == 3 and part.shape[1] == 256:
                at = (at[0], int(windows[rng.integers(0, 7), rng.integers(0, 5)]), at[2])
            old, losses = part[at], []
            for shift in (1e-2, -1e-2):
                part[at] = old + shift
                losses.append(net.train_step(windows, lengths, labels)[0])
            part[at] = old
            assert grad[at] == pytest.approx((losses[0] - losses[1]) / 2e-2, rel=0.05, abs=2e-3)


def naive_labels(net, data, window):
    """Probabilities of the languages added up over a text's bytes, one window, byte and unit at a time."""

    def states(layer, seen):
        h, out = [0.0] * net.hidden, []
        units = range(net.hidden)
        for byte in seen:
            z, r = ([1 / (1 + math.exp(-layer.table[g, byte, j] - sum(h[i] * layer.state[g, i, j] for i in units))) for j in units] for g in (0, 1))
            m = [sum(h[i] * layer.state[2, i, j] for i in units) + layer.bias[j] for j in units]
            c = [math.tanh(layer.table[2, byte, j] + r[j] * m[j]) for j in units]
            h = [z[j] * h[j] + (1 - z[j]) * c[j] for j in units]
            out.append(h)
        return out

    total = [0.0] * len(net.languages)
    for low in range(0, len(data), window):
        own = data[low : low + window]
        padded = own + bytes(window - len(own))
        ahead, behind = states(net.ahead, padded), states(net.behind, padded[::-1])[::-1]
        for i in range(len(own)):
            logits = [math.exp(sum(w * s for w, s in zip(row, ahead[i] + behind[i], strict=True)) + b[0]) for row, b in zip(net.out, net.out_bias, strict=True)]
            total = [t + x / sum(logits) for t, x in zip(total, logits, strict=True)]
    return total


def test_predictions_equal_a_naive_network(spark):
    net = language.train([b"the cat and the dog", b"der Hund und die Katze", b"le chien et le chat"] * 3, ["en", "de", "fr"] * 3, steps=30)
    texts = ["the", "der Hund und der Hund, und die Katze, und nochmals der Hund und eine Katze mehr", "le chat \u00e9tait l\u00e0", "a\u00df" * 70]
    got = language.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(2), net)
    rows = {r.doc_id: r for r in got.collect()}
    for doc_id, text in enumerate(texts):
        total = naive_labels(net, text.encode(), language.WINDOW)
        best = max(range(3), key=total.__getitem__)
        assert rows[doc_id].lang_pred == net.languages[best]
        assert rows[doc_id].score == pytest.approx(total[best] / len(text.encode()), abs=1e-4)


def test_every_byte_is_labelled_wherever_texts_are_cut(spark):
    net = language.train([b"aaaa bbbb", b"cccc dddd"] * 4, ["x", "y"] * 4, steps=20)
    text = "aaaa bbbb cccc " * 20_000
    got = language.identify(spark.createDataFrame([(1, text), (2, "a"), (3, text[:100])], "doc_id bigint, text string"), net)
    scores = {r.doc_id: r.score for r in got.collect()}
    for doc_id, own in ((1, text), (2, "a"), (3, text[:100])):
        rows = language.cut(own.encode())
        size = np.array([min(language.WINDOW, len(own) - language.WINDOW * i) for i in range(len(rows))])
        total = net.label(np.ascontiguousarray(rows.T), size).sum(axis=0)
        assert scores[doc_id] == pytest.approx(total.max() / len(own), abs=1e-4)


def test_languages_of_hostile_rows(hostile, hostile_rows, nothing):
    rows = language.learn_and_identify(hostile).collect()
    assert len(rows) == len(hostile_rows)
    by_text = {(r[0], r[1]): r[1] for r in hostile_rows}
    lettered = {doc_id for doc_id, text in by_text if any(c.isalpha() for c in text or "")}
    assert all((r.lang_pred == "und") == (r.doc_id not in lettered) for r in rows if r.doc_id is not None)
    assert [language.has_letter(t) for t in ("½ ² Ⅷ 12 _ !", "½ é", "日", "")] == [False, True, True, False]
    assert language.learn_and_identify(nothing).count() == 0
    unlearnt = hostile.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language.learn_and_identify(unlearnt).collect()} == {("und", 0.0)}


# Decontamination


def edits_within(segment, text):
    """Least edits of a segment anywhere in a text."""
    row = np.zeros(len(text) + 1, dtype=int)
    for j, c in enumerate(segment, 1):
        now = np.empty_like(row)
        now[0] = j
        best = np.minimum(row[:-1] + (text != c), row[1:] + 1)
        for i in range(len(text)):
            now[i + 1] = min(best[i], now[i] + 1)
        row = now
    return int(row.min())


def test_filter_and_alignment_find_what_all_alignments_find():
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefgh "))
    items = [(i, "".join(rng.choice(letters, n))) for i, n in enumerate((40, 96, 97, 150, 8, 5))]
    index = decontaminate.Index.of(items)
    for trial in range(12):
        text = list("".join(rng.choice(letters, 300)))
        own = list(items[trial % 4][1])
        for _ in range(rng.integers(0, 14)):
            at = int(rng.integers(0, len(own)))
            own[at : at + int(rng.integers(0, 2))] = list(rng.choice(letters, rng.integers(0, 2)))
        text[100:100] = own
        codes = decontaminate.characters("".join(text))
        segment, diagonal = decontaminate.regions(codes, index)
        edits, _ = decontaminate.align(codes, index, segment, diagonal)
        found = {int(s) for s, e in zip(segment, edits, strict=True) if e <= index.edits[s]}
        lengths = np.diff(index.starts)
        want = {s for s in range(len(lengths)) if edits_within(index.codes[index.starts[s] : index.starts[s + 1]], codes) <= index.edits[s]}
        assert found == want


def test_leaks_are_found_and_clean_documents_stay(spark, documents, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    docs = {r.doc_id: r.text for r in documents.collect()}
    found = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(documents, benchmark).collect()}
    whole = {(d, i) for d, text in docs.items() for i, item in items.items() if item in (text or "")}
    assert whole and whole <= set(found)
    for (d, i), r in found.items():
        shown = {docs[d][k : k + 12] for k in range(len(docs[d]))}
        held = [items[i][k : k + 12] in shown for k in range(len(items[i]) - 11)]
        assert np.mean(held) > 0.3 and r.found >= 0.5 and 0 <= r.first < r.last <= len(docs[d]) + 10
    kept = decontaminate.without_leaks(documents, benchmark)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == set(docs) - {d for d, _ in found}


def test_edited_cut_and_shouted_leaks(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    item = max(benchmark.collect(), key=lambda r: len(r.text))
    words = item.text.split()
    text = {
        1: item.text.upper() if item.text.isascii() else item.text,
        2: "x y " * 50 + "\n".join(words) + " z" * 30,
        3: " ".join(w[:-1] + "q" if k % 9 == 4 else w for k, w in enumerate(words)),
        4: item.text[: int(len(item.text) * 0.7)],
        5: " ".join(reversed(words)),
        6: item.text[: int(len(item.text) * 0.2)],
        7: None,
        8: "",
    }
    docs = spark.createDataFrame(list(text.items()), "doc_id bigint, text string").withColumn("item_id", F.lit("clash"))
    assert {r.doc_id for r in decontaminate.find_leaks(docs, benchmark).collect() if r.item_id == item.item_id} == {1, 2, 3, 4}


@pytest.mark.parametrize("blank", ["  ", "\u00a0", " \t\u2003 ", "\n\n"])
def test_white_space_of_any_kind_is_one_blank(spark, sf_dir, blank):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    ahead, behind = "before it " * 9, " and behind it" * 9
    docs = spark.createDataFrame([(i, ahead.replace(" ", "   ") + text.replace(" ", blank) + behind) for i, text in items], "doc_id bigint, text string")
    found = {r.doc_id: r for r in decontaminate.find_leaks(docs, benchmark).collect() if r.doc_id == r.item_id}
    assert set(found) == {i for i, _ in items}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i, text in items:
        own = texts[i][found[i].first : found[i].last]
        assert abs(len(" ".join(own.split())) - len(" ".join(text.split()))) <= 0.2 * len(text) + 2


def test_characters_are_those_that_places_are_told_of():
    rng = np.random.default_rng(3)
    alphabet = list("aB \t\n\u00a0\u2003\u3000\x1c\u0085\u2028é日½\x00😀")
    for n in (0, 1, 2, 30, 300):
        for _ in range(60):
            text = "".join(rng.choice(alphabet, n))
            codes, at = decontaminate._placed(text)
            assert decontaminate.characters(text).tolist() == codes.tolist()
            plain = "".join(chr(c) for c in codes)
            assert plain.split() == text.replace("\x1c", " ").translate({c: c + 32 for c in range(65, 91)}).split() and "  " not in plain
            assert at is None or [len(at), text[at[0]].isspace()] == [len(codes), plain[0] == " "]


def test_short_items_count_whole_and_apart(spark):
    benchmark = spark.createDataFrame([(1, "a b"), (2, "Query"), (3, "½"), (4, " x+y "), (5, "")], "item_id bigint, text string")
    rows = [(10, "the A   B of it"), (11, "a bc"), (12, "no queryx, no xquery"), (13, "(query)"), (14, "3½"), (15, "x + y"), (16, "say x+y."), (17, None), (18, "b a  b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.first, r.last, r.found) for r in decontaminate.find_leaks(docs, benchmark).collect())
    assert got == [(10, 1, 4, 9, 1.0), (13, 2, 1, 6, 1.0), (16, 4, 4, 7, 1.0), (18, 1, 2, 6, 1.0)]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, benchmark).collect()) == [11, 12, 14, 15, 17]


def test_leaks_of_hostile_rows_and_benchmarks(spark, hostile, nothing):
    rows = [(1, None), (2, ""), (3, "abc"), (4, "one two three four five six seven eight nine ten eleven twelve"), (4, "thion anea stble of the erou " * 4), (None, "released under the mit license.")]
    benchmark = spark.createDataFrame(rows, "item_id bigint, text string").withColumn("doc_id", F.lit("clash"))
    found = decontaminate.find_leaks(hostile, benchmark).collect()
    assert {r.item_id for r in found} == {4, None}
    assert any(r.doc_id is None for r in found)
    assert decontaminate.find_leaks(nothing, benchmark).count() == 0
    assert decontaminate.find_leaks(hostile, benchmark.limit(0)).count() == 0
    assert decontaminate.without_leaks(hostile, benchmark.limit(0)).count() == hostile.count()


def test_texts_are_searched_alike_in_parts_of_any_size(documents, spark, sf_dir):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    whole = sorted(map(tuple, decontaminate.contaminations(documents, items).collect()))
    assert whole == sorted(map(tuple, decontaminate.contaminations(documents, items, chars_at_once=700).collect()))


def test_benchmarks_larger_than_a_block(spark, sf_dir, documents):
    """Blocks hold every item once, repeated ones each, and find what one block finds."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    more = benchmark.unionByName(benchmark.limit(5)).unionByName(spark.createDataFrame([(-1, None), (-2, ""), (None, "no id")], "item_id bigint, text string"))
    blocks = list(decontaminate.blocks(more, 2_000))
    longest = max(len(text) for block in blocks for _, text in block)
    assert len(blocks) > 2 and max(sum(len(text) for _, text in block) for block in blocks) <= 2_000 + longest
    assert Counter(map(repr, (item for block in blocks for item in block))) == Counter(repr(tuple(r)) for r in more.filter("text != ''").select("item_id", "text").collect())
    chars = sum(len(text) for block in blocks for _, text in block) // 3
    whole = decontaminate.find_leaks(documents, more).collect()
    assert whole and sorted(map(repr, whole)) == sorted(map(repr, decontaminate.find_leaks(documents, more, block_chars=chars).collect()))
    held = {r.doc_id for r in whole}
    clean = decontaminate.without_leaks(documents, more, block_chars=chars).collect()
    assert sorted(map(repr, clean)) == sorted(repr(r) for r in documents.collect() if r.doc_id not in held)


def test_excerpts_that_begin_and_end_inside_segments(spark, sf_dir):
    rng = np.random.default_rng(11)
    letters = np.array(list("abcdefghijklmnopqrstuvw    "))
    items = [(n, "".join(rng.choice(letters, n)).replace("  ", "xy").strip()) for n in (60, 90, 97, 120, 150, 192, 200, 288, 300, 450)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    filler = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(40).collect() if r.text]
    shown = {}
    for item_id, text in items:
        for percent in (20, 40, 55, 60, 75, 90):
            size = -(-len(text) * percent // 100)
            for low in {0, (len(text) - size) // 2, (len(text) - size) // 3, len(text) - size}:
                excerpt = text[low : low + size]
                shown[len(shown)] = (item_id, percent, excerpt)
                if percent >= 75:  # an edit in about thirty characters
                    shown[len(shown)] = (item_id, percent, "".join("#" if k % 30 == 14 else c for k, c in enumerate(excerpt)))
    rows = [(i, f"{filler[i % len(filler)][:500]} {excerpt} {filler[(i + 7) % len(filler)][:500]}") for i, (_, _, excerpt) in shown.items()]
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id bigint, text string"), benchmark).collect()}
    assert found == {(i, item_id) for i, (item_id, percent, _) in shown.items() if percent > 50}


def test_the_longest_parts_are_those_of_all_alignments():
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdefgh "))
    items = [(i, "".join(rng.choice(letters, n)).strip()) for i, n in enumerate((60, 90, 130))]
    index = decontaminate.Index.of(items)
    for trial in range(6):
        own = items[trial % 3][1]
        size = len(own) * (55 + 6 * trial) // 100
        own = list(own[(len(own) - size) // 2 :][:size])
        for at in rng.integers(0, len(own), size // 14):
            own[at] = str(rng.choice(letters))
        codes = decontaminate.characters("".join(rng.choice(letters, 70)) + "".join(own) + "".join(rng.choice(letters, 70)))
        segment, diagonal = decontaminate.regions(codes, index)
        held = decontaminate.promising(codes, index, segment, diagonal) & (index.parts[segment] > 0)
        lengths, edits, lows, _ = decontaminate.longest(codes, index, segment[held], diagonal[held])
        found = {}
        for s, length in zip(segment[held].tolist(), lengths.tolist(), strict=True):
            found[s] = max(found.get(s, 0), length)
        for s in np.flatnonzero(index.parts).tolist():
            text = index.codes[index.starts[s] : index.starts[s + 1]]
            want = 0
            for low in range(len(text) - int(index.parts[s]) + 1):
                row = np.zeros(len(codes) + 1, dtype=int)
                for j, c in enumerate(text[low:], 1):
                    now = np.append(j, np.minimum(row[:-1] + (codes != c), row[1:] + 1))
                    row = np.minimum.accumulate(now - np.arange(len(now))) + np.arange(len(now))
                    if j >= index.parts[s] and row.min() <= decontaminate.budget(j)[0]:
                        want = max(want, j)
            assert found.get(s, 0) == want


def test_rows_are_decided_by_their_own_text(spark, sf_dir, documents, hostile):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    item = benchmark.orderBy("item_id").first().text
    rows = spark.createDataFrame([(1, f"xx {item} yy"), (1, "a clean text"), (None, f"zz {item}"), (None, "another clean text")], "doc_id bigint, text string")
    kept = decontaminate.without_leaks(rows, benchmark).collect()
    assert sorted(r.text for r in kept) == ["a clean text", "another clean text"]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    missing = documents.limit(60).withColumn("doc_id", F.lit(None).cast("bigint"))
    shared = documents.limit(60).withColumn("doc_id", F.lit(-5).cast("bigint"))
    known = {r.doc_id: r.predicted for r in quality.classify(documents, labels).collect()}
    bad = sorted(r.text or "" for r in documents.limit(60).collect() if not known[r.doc_id])
    assert bad
    for extra in (missing, shared):
        docs = documents.unionByName(extra)
        predicted = [bool(r.predicted) for r in quality.classify(docs, labels).collect()]
        kept = quality.keep_good(docs, labels)
        assert kept.columns == docs.columns
        assert len(predicted) > sum(predicted) == kept.count()


# Pipeline


def test_pipeline_is_its_stages_one_after_the_other(spark, sf_dir, documents, tokenizer):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.classify(documents, labels).filter("predicted = 1").collect()}
    texts = {r.doc_id: r.text for r in documents.collect() if r.doc_id in good}
    best = {}
    for doc_id, text in texts.items():
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        best[low] = max(best.get(low, doc_id), doc_id)
    left = sorted(best.values())
    fps = {i: simhash.fingerprint(texts[i]) for i in left}
    parent = {i: i for i in left}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in left:
        for b in left:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    left = [i for i in left if find(i) == i]
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    leaking = {i for i in left if any(item in (texts[i] or "") for item in items)}
    got = {r.doc_id for r in rows}
    assert not got & leaking and got <= set(left) - leaking and len(got) >= 0.97 * len(set(left) - leaking)
    assert sorted(repr(tuple(r[:5])) for r in rows) == expected_pieces(tokenizer, [(i, texts[i]) for i in got])
    check_sequences(rows)


def test_stages_keep_columns_and_bear_hostile_rows(spark, sf_dir, hostile, nothing):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, hostile, sf_dir).columns == hostile.columns
        assert stage(spark, hostile, sf_dir).count() > 0
        assert stage(spark, nothing, sf_dir).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, nothing, sf_dir).count() == 0
