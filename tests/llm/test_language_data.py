"""Collocations, hard negatives and language-model scores against brute force."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import collocations, lm, negatives, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Words


def test_tokens_are_words_and_breaks():
    table = words.translation(b" \t", b".\n")
    found = words.tokens("Ab  cD.\te\n\nÀ".encode().translate(table))
    spelt = [found.words[int(code)].as_py().decode() for code in found.codes]
    assert spelt == ["ab", "cd", "\n", "e", "\n", "\n", "À"]
    assert found.breaks.tolist() == [False, False, True, False, True, True, False]
    assert len(words.tokens(b"").codes) == len(words.tokens(b"   ").codes) == 0


def test_cut_points_begin_between_words():
    data = b"one two three four five"
    bounds = words.cut_points(data, 5)
    assert bounds[0] == 0 and bounds[-1] == len(data)
    assert all(data[b : b + 1] == b" " for b in bounds[1:-1]) and len(bounds) > 3


# Collocations


def expected_collocations(rows, max_words=3, least=10, top=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            own = re.findall(r"[^ \t]+", piece)
            for m in range(1, max_words + 1):
                for i in range(len(own) - m + 1):
                    counts[lang or "und"][tuple(own[i : i + m])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for phrase, c in f.items() if len(phrase) == 1)
        candidates = {phrase: a for phrase, a in f.items() if len(phrase) > 1 and a >= least}
        found = []
        for phrase, a in candidates.items():
            longer = [b for other, b in candidates.items() if len(other) > len(phrase) and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))]
            if any(100 * b >= 50 * a for b in longer):
                continue
            cuts = [(1_000_000 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k, f[phrase[:k]], f[phrase[k:]]) for k in range(1, len(phrase))]
            score, _, left, right = min(cuts)
            found.append((-score, -a, " ".join(phrase).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def phrases(df):
    return sorted(tuple(row) for row in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def test_collocations_equal_brute_force(spark, documents):
    rows = [(row["lang"], row["text"]) for row in documents.select("lang", "text").collect()]
    assert phrases(collocations.collocations(documents)) == expected_collocations(rows)


@pytest.mark.parametrize("max_words", [2, 4])
def test_collocations_of_other_lengths_and_a_few_ranks(spark, documents, max_words):
    few = documents.filter("doc_id < 40")
    rows = [(row["lang"], row["text"]) for row in few.select("lang", "text").collect()]
    assert phrases(collocations.collocations(few, max_words, 6, 50)) == expected_collocations(rows, max_words, 6, 50)


def test_small_chunks_a_full_filter_and_hot_prefixes_change_nothing(spark, documents):
    few = documents.filter("doc_id < 60")
    rows = [(row["lang"], row["text"]) for row in few.select("lang", "text").collect()]
    got = collocations.collocations(few, least=5, chunk_bytes=700, filter_bits=1 << 10, hot_share=50)
    assert phrases(got) == expected_collocations(rows, least=5)


def test_collocations_of_hostile_rows(spark, hostile, hostile_rows, nothing):
    rows = [(lang, text) for _, text, lang, _, _ in hostile_rows]
    assert phrases(collocations.collocations(hostile, least=2)) == expected_collocations(rows, least=2)
    assert phrases(collocations.collocations(hostile, least=2, chunk_bytes=1_000)) == expected_collocations(rows, least=2)
    assert phrases(collocations.collocations(nothing)) == []


def test_products_may_pass_64_bits(spark):
    big = 4_000_000_000
    rows = [("x", "", 0, 3 * big), ("x", "a", 1, 2 * big), ("x", "b", 1, big), ("x", "a b", 2, big - 1)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, m int, f bigint")
    got = collocations.scored(frequent).collect()
    assert [(r["l"], r["r"], r["score"]) for r in got] == [(2 * big, big, 1_000_000 * (big - 1) ** 2 // (2 * big * big))]


def test_ties_after_flooring_go_to_the_smaller_cut_and_equal_ranks_to_the_phrase(spark):
    text = "a b c. " * 12 + "é b d. " * 12
    docs = spark.createDataFrame([("en", text)], "lang string, text string")
    assert phrases(collocations.collocations(docs)) == expected_collocations([("en", text)])


# Hard negatives


def expected_negatives(rows, positives=5, negatives_=10, every=100):
    kept = []
    for number, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if number is not None and number % 7 == 0:
            label = int(math.fmod(label + 1, 10))
        kept.append((number, label, [math.floor(256 * x) for x in vector]))
    out = []
    for i, (anchor, label, point) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(point, p, strict=False)), n is None, n or 0, own) for j, (n, own, p) in enumerate(kept) if j != i]
        near = sorted(s[:3] for s in scored if s[3] == label)[:positives]
        for score, missing, number in near:
            ps = -score
            fits = sorted(s[:3] for s in scored if s[3] != label and 30 * ps <= -100 * s[0] <= 90 * ps)[:negatives_]
            for rank, (other, absent, negative) in enumerate(fits, 1):
                out.append((anchor, None if missing else number, rank, None if absent else negative, ps, -other))
    return sorted(out, key=repr)


def found_negatives(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(row) for row in df.select(names).collect()), key=repr)


EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"


def test_hard_negatives_of_small_tiles_equal_brute_force(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [tuple(row) for row in table.select("vec_id", "embedding", "label").collect()]
    got = negatives.hard_negatives(table, tile_rows=37, leaf_rows=4, anchors_at_once=2)
    assert found_negatives(got) == expected_negatives(rows)


def test_hard_negatives_with_ties_repeats_and_broken_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 3) / 4], int(i % 3)) for i in range(160)]
    rows += [(i, [0.5, 0.25, -0.25], i % 4) for i in range(200, 260)]  # one vector many times
    rows += [(300, None, 1), (301, [0.5, None, 0.1], 1), (302, [0.5, float("nan"), 0.1], 2), (303, [float("inf"), 0.0, 0.0], 2), (304, [0.1, 0.2, 0.3], None)]
    rows += [(None, [0.75, 0.75, 0.75], 1), (400, [], 1), (401, [0.5], 2), (500, [0.5, 0.5, 0.5, 0.5], 9), (-100, [0.75, 0.5, 0.25], 1), (-7, [0.75, 0.5, 0.25], -4)]
    rows += [rows[0], rows[0], rows[100]]
    table = spark.createDataFrame(rows, EMBEDDINGS).withColumn("row", F.lit("clash")).withColumn("tile", F.lit("clash")).withColumn("score", F.lit(1))
    for sizes in ({}, {"tile_rows": 16, "leaf_rows": 3, "anchors_at_once": 1}):
        assert found_negatives(negatives.hard_negatives(table, **sizes)) == expected_negatives(rows)


def test_large_components_stay_exact(spark):
    base = 2.0**28
    rows = [(i, [base + i * 1024, -base / (i + 1)], i % 2) for i in (0, 1, 2, 3, 4, 5, 100)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    # Scores pass 2 to the 63rd: an error, and not a wrong number.
    small = [(i, [x / 2**12 for x in vector], label) for i, vector, label in rows]
    got = negatives.hard_negatives(spark.createDataFrame(small, "vec_id bigint, embedding array<double>, label int"))
    assert found_negatives(got) == expected_negatives(small)
    with pytest.raises(Exception, match="[Oo]verflow|too large|too big"):
        negatives.hard_negatives(table).collect()


def test_hard_negatives_of_nothing(spark):
    assert found_negatives(negatives.hard_negatives(spark.createDataFrame([], EMBEDDINGS))) == []
    alone = spark.createDataFrame([(100, [1.0], 1)], EMBEDDINGS)
    assert found_negatives(negatives.hard_negatives(alone)) == []


def test_a_box_bounds_every_row_in_it():
    rng = np.random.default_rng(1)
    points = rng.integers(-300, 300, (500, 8)).astype(float)
    leaves = negatives.str_leaves(points, 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(500)) and max(map(len, leaves)) <= 16
    for leaf, anchor in itertools.product(leaves, rng.integers(-300, 300, (20, 8)).astype(float)):
        own = points[leaf] @ anchor
        low, high = points[leaf].min(axis=0)[None], points[leaf].max(axis=0)[None]
        assert negatives._least(anchor, low, high)[0] <= own.min() and own.max() <= negatives._greatest(anchor, low, high)[0]


def test_the_search_leaves_boxes_out():
    rng = np.random.default_rng(2)
    points = np.sort(rng.integers(-300, 300, (2000, 2)).astype(float), axis=0)
    opened = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            opened.append(1)
            return np.asarray(self) @ other

    leaves = []
    for leaf in negatives.str_leaves(points, 20):
        own = points[leaf]
        leaves.append(negatives.Node(own.min(axis=0), own.max(axis=0), frozenset([1]), rows=leaf, ids=leaf.tolist(), label=np.ones(len(leaf)), points=own.view(Counted)))
    wanted = negatives.Wanted(-np.inf, np.inf, 5)
    anchor = np.array([100.0, 50.0])
    negatives.search(negatives.tree(leaves), anchor, -1, 0, False, [wanted])
    order = sorted((-int(s), False, i, i) for i, s in enumerate(points @ anchor))
    assert wanted.found == order[:5] and len(opened) < len(leaves) / 3


# Language model


def expected_base(rows):
    def cut(text):
        return [*re.findall(r"[^ \t-\r]+", (text or "").translate(LOWER)), None]

    def held(number):
        return number is None or zlib.crc32(str(number).encode()) % 7 == 2

    counts = Counter(token for number, text in rows if not held(number) for token in cut(text))
    n, v = sum(counts.values()), len(counts)
    out = []
    for number, text in rows:
        own = cut(text)
        base = sum(math.log10((counts[token] + 1) / (n + v + 1)) for token in own)
        out.append((number, held(number), len(own), sum(counts[token] > 0 for token in own), n, base))
    return sorted(out, key=repr)


def close(got, expected):
    assert [row[:5] for row in got] == [row[:5] for row in expected]
    assert np.allclose([row[5] for row in got], [row[5] for row in expected], rtol=1e-9, atol=1e-9)


def scores(df):
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    return sorted((tuple(row) for row in df.select(names).collect()), key=repr)


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, documents):
    rows = [(row["doc_id"], row["text"]) for row in documents.select("doc_id", "text").collect()]
    found = lm.score_documents(documents, share=2, dictionary_words=3_000).cache()
    close(scores(found), expected_base(rows))
    apart = found.filter("held_out").agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()
    assert apart[0] > apart[1] + 0.02


def test_scores_of_hostile_rows(spark, hostile, hostile_rows, nothing):
    found = lm.score_documents(hostile, share=1)
    close(scores(found), expected_base([(number, text) for number, text, *_ in hostile_rows]))
    assert all(row["score"] < 0 and math.isfinite(row["score"]) for row in found.collect())
    assert lm.score_documents(nothing).collect() == []
    none = hostile.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert {(row["base_score"], row["score"], row["train_tokens"]) for row in lm.score_documents(none).collect()} == {(0.0, 0.0, 0)}


@pytest.mark.parametrize("how", [{}, {"share": 3, "passes": 2}])
def test_the_network_learns_from_every_document_not_held_out(spark, hostile_rows, monkeypatch, how):
    rows = [(number, text) for number, text, *_ in hostile_rows] + [(1_000 + i, f"w{i % 7} w{i % 11} w{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    learnt = []

    def seen(model, vocab, texts, **_):
        learnt.extend(bytes(row["text"]).decode() for row in texts.select("text").collect())
        return model

    monkeypatch.setattr(lm, "train_round", seen)
    lm.score_documents(docs, **how)
    times = how.get("passes", 1)
    assert Counter(learnt) == Counter([text or "" for number, text in rows if number is not None and zlib.crc32(str(number).encode()) % 7 != 2] * times)


def test_training_takes_every_word_of_a_stream():
    vocab = small_vocabulary()
    rng = np.random.default_rng(2)
    codes = rng.integers(1, 70, 8 * 37 + 5)  # words of the head: those of a band teach the same
    model = drawn_model(vocab)
    ends = np.array([len(codes)])
    trained = lm.train(model, vocab, codes, ends, lanes=8)[0].flat()
    for place in (0, 100, len(codes) - 5, len(codes) - 1):
        other = codes.copy()
        other[place] = codes[place] % 69 + 1
        assert not np.array_equal(lm.train(model, vocab, other, ends, lanes=8)[0].flat(), trained), place
    # at no rate the weights stay, and the loss is that of the lanes, each begun without a state
    _, loss = lm.train(model, vocab, codes, ends, lanes=8, rate=0.0)
    symbols, total = vocab.symbols(), 0.0
    for lane in np.array_split(np.arange(len(codes)), 8):
        h = np.zeros((len(model.bias), 1), np.float32)
        for at in lane:
            h = model.step(symbols[codes[at - 1 : at]] if at else np.array([vocab.start]), h)
            total -= model.log_probabilities(h, codes[at : at + 1], vocab.class_of(), vocab.within())[0][0]
    assert abs(loss - total / len(codes)) < 1e-4


def small_vocabulary(n=150, head=70):
    counts = np.arange(n, 0, -1) ** 2
    at = np.arange(n)
    bands = np.where(at < head, -1, np.floor(np.log2(np.maximum(at, 1) / head)).astype(int))
    names = [lm.END] + [b"w%d" % i for i in range(1, n)]
    return lm.Vocabulary(pa.array(names, pa.binary()), counts, head, bands, int(counts.sum()) + 40, n + 25)


def drawn_model(vocab, hidden=5):
    rng = np.random.default_rng(9)
    model = lm.Model.fresh(vocab, hidden)
    return model.filled(model.flat() + rng.normal(0, 0.1, model.flat().size))


def naive_scores(model, vocab, codes):
    """One word after the other, every probability written out; also checks that they are a distribution."""
    h = np.zeros(len(model.bias))
    symbol, total = vocab.start, 0.0
    n = len(h)
    for code in codes:
        a, u = model.table[:, symbol].astype(float), model.state.astype(float) @ h
        update, reset = 1 / (1 + np.exp(-(a[:n] + u[:n]))), 1 / (1 + np.exp(-(a[n : 2 * n] + u[n : 2 * n])))
        new = np.tanh(a[2 * n :] + reset * (u[2 * n :] + model.bias[:, 0]))
        h = update * h + (1 - update) * new
        logits = model.classes @ h + model.class_bias[:, 0]
        kinds = np.exp(logits) / np.exp(logits).sum()
        probabilities = np.zeros(len(vocab.words) + 1)
        for kind in range(vocab.head_classes):
            inner = np.exp(model.words[kind] @ h + model.word_bias[kind])
            for k, p in enumerate(inner / inner.sum()):
                if kind * lm.CLASS_WORDS + k < vocab.head:
                    probabilities[kind * lm.CLASS_WORDS + k] = kinds[kind] * p
        for band in range(vocab.n_bands):
            own = np.flatnonzero(vocab.bands == band)
            probabilities[own] = kinds[vocab.head_classes + band] * vocab.counts[own] / vocab.counts[own].sum()
        probabilities[-1] = kinds[-1]
        assert abs(probabilities.sum() - 1) < 1e-5
        total += math.log(probabilities[code])
        symbol = vocab.symbols()[code]
    return total


def test_document_scores_equal_one_word_at_a_time():
    vocab = small_vocabulary()
    model = drawn_model(vocab)
    rng = np.random.default_rng(4)
    documents = [np.append(rng.integers(1, 151, n), 0) for n in (0, 3, 90, 1, 40, 3)]
    ends = np.cumsum([len(d) for d in documents])
    expected = [naive_scores(model, vocab, d) for d in documents]
    for at_once in (7, 1 << 15):
        got = lm.document_scores(model, vocab, np.concatenate(documents), ends, at_once)
        assert np.allclose(got, expected, rtol=1e-4)


def test_gradients_equal_differences_of_the_naive_loss():
    vocab = small_vocabulary()
    model = drawn_model(vocab)
    rng = np.random.default_rng(6)
    documents = [np.append(rng.integers(1, 151, 5), 0), np.append(rng.integers(1, 151, 3), 0)]
    codes = np.concatenate(documents)
    symbols, inputs = vocab.symbols(), np.empty_like(codes)
    inputs[1:] = symbols[codes[:-1]]
    first = np.zeros(len(codes), dtype=bool)
    first[[0, 6]] = True
    inputs[first] = vocab.start
    kept, states, h = [], [], np.zeros((len(model.bias), 1), np.float32)
    for x, new in zip(inputs, first, strict=True):
        h = model.step(np.array([x]), np.where(new, np.float32(0), h), kept)
        states.append(h)
    grads = lm.Model(*(np.zeros_like(part) for part in model.parts()))
    _, down = model.log_probabilities(np.concatenate(states, axis=1), codes, vocab.class_of(), vocab.within(), grads)
    model.back(kept, [down[:, i : i + 1] for i in range(len(codes))], first[:, None], grads)
    flat, slope = model.flat().astype(float), grads.flat()
    for at in rng.choice(np.flatnonzero(np.abs(slope) > 0.02), 40, replace=False):
        sides = []
        for sign in (1, -1):
            moved = flat.copy()
            moved[at] += sign * 1e-3
            wide = model.filled(moved)
            sides.append(-sum(naive_scores(wide, vocab, d) for d in documents))
        assert abs((sides[0] - sides[1]) / 2e-3 - slope[at]) < 0.02 * abs(slope[at]) + 2e-3


def test_training_lowers_the_loss_and_rounds_average_replicas(spark):
    vocab = small_vocabulary()
    rng = np.random.default_rng(8)
    codes = np.concatenate([np.append(np.tile([1 + k, 90, 2 + k], 30), 0) for k in rng.integers(0, 40, 300)])
    ends = np.flatnonzero(codes == 0) + 1
    model = lm.Model.fresh(vocab, 8)
    trained, _ = lm.train(model, vocab, codes, ends, lanes=8)
    before, after = (lm.document_scores(m, vocab, codes, ends).sum() for m in (model, trained))
    assert after > 0.6 * before
    texts = ["w%d w90 w%d " % (1 + k, 2 + k) * 30 for k in range(40)]
    docs = [spark.createDataFrame([(text.encode(),) for text in texts[:n]], "text binary").coalesce(1) for n in (20, 40)]
    parts = [lm.train_round(model, vocab, own, lanes=4).flat() for own in docs]
    assert not np.allclose(parts[0], parts[1])
    twice = spark.createDataFrame(spark.sparkContext.parallelize([(text.encode(),) for text in texts[:20]] * 2, 2), "text binary")
    both = lm.train_round(model, vocab, twice, lanes=4).flat()
    assert np.allclose(both, parts[0], atol=1e-6)  # the mean of two equal replicas
