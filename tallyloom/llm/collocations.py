"""Phrase collocations by the stripes pattern.

A stripe belongs to a prefix of words and is an associative counter of the words that follow it. Tasks count stripes
over some megabytes of text at a time; the stripes of a prefix are merged element by element. Merged stripes hold
all that is asked for: their entries are the counts of extended phrases, the stripe before gives the totals of
their prefixes, and the largest entries a phrase takes part in, as prefix or behind one, tell what subsumes it.

Stripes grow level by level: the empty prefix first, which counts words, then prefixes of one word, of two, and so on.
A phrase can only be frequent if the phrases one word shorter in it are, so from the second level on a position is
counted only where both pass a bit filter of the frequent ones. The filter has a fixed size and lets through
what it cannot tell apart, so no phrase is lost.

A prefix that holds more than one in ``HOT_SHARE`` of all words has its stripe parted in ``BLOCKS`` by a hash of the next
word, the same everywhere; there are at most ``HOT_SHARE`` such prefixes, and the empty one. No stripe is ever
held whole: merging is an aggregation that spills.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import mapped, read, stored
from tallyloom.llm.words import column_bytes, cut_points, tokens, translation

MAX_WORDS = 3
LEAST = 10
TOP = 2_000
SUBSUMED_PERCENT = 50
SCALE = 1_000_000
CHUNK_BYTES = 8 << 20
FILTER_BITS = 1 << 25
HOT_SHARE = 20_000
BLOCKS = 128
RANK_SALTS = 32
UNKNOWN = "und"

GAPS, BREAKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
_TABLE = translation(GAPS, BREAKS)
_FOLD = np.uint64(0x9E3779B97F4A7C15)
STRIPES = "lang string, prefix binary, block int, nexts array<binary>, counts array<bigint>"


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "replace"), 1))


def _fold(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a phrase that goes on with a word, from the hashes of both."""
    with np.errstate(over="ignore"):
        mixed = (phrase ^ word) * _FOLD
    return mixed ^ (mixed >> np.uint64(29))


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64(bits - 1)
    return hashes & low, (hashes >> np.uint64(32)) & low


def _passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    out = np.ones(len(hashes), dtype=bool)
    for place in _places(hashes, 64 * len(bitmap)):
        out &= (bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return out


def count_stripes(lang: str, data: bytes, k: int, bitmap: np.ndarray | None, hot: np.ndarray) -> tuple[pa.RecordBatch, bytes]:
    """The stripes of the prefixes of ``k`` words in translated bytes, and the last ``k`` tokens to go on with.

    ``bitmap`` is the filter of the frequent phrases of ``k`` words, ``hot`` the sorted hashes of the hot prefixes.
    The empty prefix also gets an empty next word, which counts all words.
    """
    found = tokens(data)
    codes, n = found.codes.astype(np.int64), len(found.codes)
    word_hashes = np.fromiter(map(xxhash.xxh64_intdigest, found.words.to_pylist()), np.uint64, len(found.words))
    of_token = word_hashes[codes]
    tail = b" ".join(found.words.take(pa.array(codes[max(n - k, 0) :])).to_pylist()) if k else b""

    hashes = np.full(n, _seed(lang), dtype=np.uint64)  # of the k words from a token on
    whole = np.ones(n, dtype=bool)  # these are k words of one piece
    for j in range(k):
        end = max(n - j, 0)
        hashes[:end] = _fold(hashes[:end], of_token[j:])
        whole[:end] &= ~found.breaks[j:]
        whole[end:] = False
    if k == 0:
        at = np.flatnonzero(~found.breaks)
    else:
        alive = whole.copy()
        if bitmap is not None:
            alive[whole] = _passes(bitmap, hashes[whole])
        at = np.flatnonzero(alive[:-1] & alive[1:])  # the phrase here may go on, and so may the one a word later
    size = max(len(found.words), 1)
    prefix = np.zeros(len(at), dtype=np.int64)
    firsts = np.zeros(1 if len(at) else 0, dtype=np.int64)
    for j in range(k):  # dense numbers, so that no product leaves 64 bits
        _, firsts, prefix = np.unique(prefix * size + codes[at + j], return_index=True, return_inverse=True)
    entries, counts = np.unique(prefix * size + codes[at + k], return_counts=True)
    prefix, following = entries // size, entries % size

    starts = at[firsts]  # for every prefix a place where it stands
    is_hot = np.isin(hashes[starts], hot) if k else np.ones(len(starts), dtype=bool)
    block = np.where(is_hot[prefix], (word_hashes[following] >> np.uint64(7)) % np.uint64(BLOCKS), 0).astype(np.int32) if len(prefix) else np.zeros(0, np.int32)
    if k == 0 and len(at):
        prefix, following, counts, block = (np.append(a, b) for a, b in ((prefix, 0), (following, size), (counts, len(at)), (block, 0)))
    order = np.lexsort((block, prefix))
    prefix, following, counts, block = prefix[order], following[order], counts[order], block[order]
    new = np.flatnonzero(np.diff(prefix, prepend=-1) | np.diff(block, prepend=-1))
    offsets = pa.array(np.append(new, len(prefix)).astype(np.int32))
    words = pa.concat_arrays([found.words.cast(pa.binary()), pa.array([b""], pa.binary())])
    parts = [words.take(pa.array(codes[starts[prefix[new]] + j])) for j in range(k)]
    names = pc.binary_join_element_wise(*parts, b" ") if k > 1 else parts[0] if k else pa.array([b""] * len(new), pa.binary())
    columns = [
        pa.array([lang] * len(new), pa.string()),
        names,
        pa.array(block[new].astype(np.int32)),
        pa.ListArray.from_arrays(offsets, words.take(pa.array(following))),
        pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int64))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["lang", "prefix", "block", "nexts", "counts"]), tail


def stripes(texts: DataFrame, k: int, bitmap: np.ndarray | None, hot: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Partial stripes of prefixes of ``k`` words over ``lang`` and ``text``."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1)), strict=True):
                if len(text) <= chunk_bytes:
                    held.setdefault(lang, []).append(bytes(text).translate(_TABLE))
                    size += len(text)
                else:  # a very long text is counted in parts; each goes on with the last words of the one before
                    data, tail = bytes(text).translate(_TABLE), b""
                    bounds = cut_points(data, chunk_bytes)
                    for low, high in zip(bounds, bounds[1:], strict=False):
                        rows, tail = count_stripes(lang, tail + b" " + data[low:high], k, bitmap, hot)
                        yield rows
                if size >= chunk_bytes:
                    for name, parts in held.items():
                        yield count_stripes(name, b"\n".join(parts), k, bitmap, hot)[0]
                    held, size = {}, 0
        for name, parts in held.items():
            yield count_stripes(name, b"\n".join(parts), k, bitmap, hot)[0]

    return mapped(texts, counted, STRIPES)


def merged(partial: DataFrame, k: int, least: int) -> DataFrame:
    """Stripes merged element by element: ``lang``, ``phrase``, ``m`` words and the count ``f``, where that is ``least`` or more."""
    dealt = partial.repartition("lang", "prefix", "block")
    entries = dealt.select("lang", "prefix", "block", F.inline(F.arrays_zip("nexts", "counts")))
    counts = entries.groupBy("lang", "prefix", "block", "nexts").agg(F.sum("counts").alias("f")).filter(F.col("f") >= least)
    following = F.col("nexts").cast("string")
    phrase = F.concat_ws(" ", F.col("prefix").cast("string"), following) if k else following
    return counts.select("lang", phrase.alias("phrase"), F.when(phrase == "", 0).otherwise(k + 1).alias("m"), "f")


def _phrase_hashes(langs: list[str], phrases: list[str]) -> np.ndarray:
    out = np.zeros(len(phrases), dtype=np.uint64)
    for i, (lang, phrase) in enumerate(zip(langs, phrases, strict=True)):
        value = np.array([_seed(lang)])
        for word in phrase.encode("utf-8", "replace").split(b" "):
            value = _fold(value, np.array([xxhash.xxh64_intdigest(word)], dtype=np.uint64))
        out[i] = value[0]
    return out


def phrase_filter(frequent: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """The bit filter of the phrases: at most ``bits`` / 64 numbers reach the driver, however many phrases there are."""

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = _phrase_hashes(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            place = np.concatenate(_places(hashes, bits))
            slot, mask = (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63))
            order = np.argsort(slot)
            slots, starts = np.unique(slot[order], return_index=True)
            if len(slots):
                masks = np.bitwise_or.reduceat(mask[order], starts).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(masks)], ["slot", "mask"])

    rows = mapped(frequent.select("lang", "phrase"), marked, "slot bigint, mask bigint")
    found = rows.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    bitmap = np.zeros(bits // 64, dtype=np.uint64)
    bitmap[found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return bitmap


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, chunk_bytes: int = CHUNK_BYTES, filter_bits: int = FILTER_BITS, hot_share: int = HOT_SHARE) -> DataFrame:
    """All phrases of up to ``max_words`` words that occur ``least`` times in a language, with their counts.

    The phrase of no word counts all words. A missing language is ``und``, a missing text an empty one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), text.alias("text"))
    levels: list[DataFrame] = []
    bitmap, hot, total = None, np.zeros(0, dtype=np.uint64), 0
    for k in range(max_words):
        level = stored(merged(stripes(texts, k, bitmap, hot, chunk_bytes), k, least), f"phrases-{k + 1}")
        levels.append(level)
        if k == 0:
            total = level.filter("m = 0").agg(F.sum("f")).first()[0] or 0
        if k + 1 < max_words:
            words = level.filter("m > 0")
            bitmap = phrase_filter(words, filter_bits)
            most = words.filter(F.col("f") * hot_share > total).select("lang", "phrase").toArrow()  # fewer than hot_share
            hot = np.sort(_phrase_hashes(most["lang"].to_pylist(), most["phrase"].to_pylist()))
    return reduce(DataFrame.unionByName, levels)


def _words(low: Column | int, count: Column | int) -> Column:
    low, count = (F.lit(x) if isinstance(x, int) else x for x in (low, count))
    return F.array_join(F.slice("words", low, count), " ")


def scored(frequent: DataFrame, max_words: int = MAX_WORDS, subsumed_percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """Candidates of two words or more with the cut of the lowest score, without those that a longer one subsumes.

    A phrase inside a candidate that is two words longer is also inside one between them that is as frequent at
    least, so only the next longer ones are asked.
    """
    phrases = frequent.filter("m >= 2").select("lang", "phrase", "m", F.col("f").alias("a"), F.split("phrase", " ").alias("words"))
    cuts = F.explode(F.sequence(F.lit(1), F.col("m") - 1)).alias("k")
    halves = phrases.select("lang", "phrase", "m", "a", "words", cuts).select(
        "lang", "phrase", "a", "k", F.inline(F.array(
            F.struct(F.lit(True).alias("ahead"), _words(1, F.col("k")).alias("part")),
            F.struct(F.lit(False).alias("ahead"), _words(F.col("k") + 1, F.col("m") - F.col("k")).alias("part")),
        )),
    )
    counts = frequent.filter((F.col("m") >= 1) & (F.col("m") < max_words)).select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("f").alias("__f"))
    known = halves.join(counts, (F.col("lang") == F.col("__lang")) & (F.col("part") == F.col("__part")))
    sides = [F.max(F.when((F.col("k") == k) & (F.col("ahead") == ahead), F.col("__f"))).alias(f"{name}{k}") for k in range(1, max_words) for name, ahead in (("l", True), ("r", False))]
    totals = known.groupBy("lang", "phrase", "a").agg(*sides)

    def cut(k: int) -> Column:
        # Products of counts may pass 64 bits; the quotient is at most the scale.
        score = F.expr(f"{SCALE} * cast(a as decimal(15,0)) * cast(a as decimal(15,0)) div (cast(l{k} as decimal(15,0)) * cast(r{k} as decimal(15,0)))")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(score.cast("bigint").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))

    best = F.array_min(F.array_compact(F.array(*(cut(k) for k in range(1, max_words)))))
    candidates = totals.select("lang", "phrase", "a", best.alias("best"))

    longer = phrases.filter("m >= 3").select(
        "lang", "a", F.explode(F.array(_words(1, F.col("m") - 1), _words(2, F.col("m") - 1))).alias("phrase")
    )
    above = longer.groupBy(F.col("lang").alias("__lang"), F.col("phrase").alias("__phrase")).agg(F.max("a").alias("__above"))
    met = candidates.join(above, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__phrase")), "left")
    stay = F.col("__above").isNull() | (F.col("__above") * 100 < F.col("a") * subsumed_percent)
    return met.filter(stay).select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def ranked(rows: DataFrame, top: int = TOP, salts: int = RANK_SALTS) -> DataFrame:
    """The first ``top`` rows of each language with their ``rank``; every salt keeps its own first rows beforehand."""
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
    first = salted.withColumn("__rank", F.row_number().over(Window.partitionBy("lang", "__salt").orderBy(*order))).filter(F.col("__rank") <= top)
    own = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return own.filter(F.col("rank") <= top).drop("__salt", "__rank")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """The best collocations of every language: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score``.

    Rows without a language are ``und``, as are rows that say so; missing texts are empty; repeated rows count each.
    An empty table, or one where nothing occurs ``least`` times, gives no rows. Columns other than ``lang`` and
    ``text`` are ignored. Very long texts are counted in parts.
    """
    frequent = frequent_phrases(docs, max_words, least, **sizes)
    best = ranked(scored(frequent, max_words), top)
    n = frequent.filter("m = 0").select(F.col("lang").alias("__lang"), F.col("f").alias("n"))
    return best.join(n, F.col("lang") == F.col("__lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best collocations of two or three words of each language in all documents."""
    return collocations(read(spark, sf_dir, "documents"))


OP11_SQL = f"""
with p as (
  select coalesce(lang, '{UNKNOWN}') as lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
  from documents),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as ws from p),
g as (
  select lang, m, unnest([array_to_string(ws[i : i + m - 1], ' ') for i in range(1, len(ws) - m + 2)]) as phrase
  from w, (values (1), (2), (3)) as sizes(m)),
f as materialized (select lang, m, phrase, count(*) as f from g group by lang, m, phrase having count(*) >= {LEAST} or m = 1),
n as (select lang, sum(f)::bigint as n from f where m = 1 group by lang),
c as materialized (select lang, m, phrase, f as a, string_split(phrase, ' ') as ws from f where m >= 2),
h as (
  select lang, m, phrase, a, cut, array_to_string(ws[1 : cut], ' ') as ahead, array_to_string(ws[cut + 1 : m], ' ') as behind
  from c, (values (1), (2)) as cuts(cut) where cut < m),
k as (
  select h.lang, h.phrase, h.a, cut, x.f as l, y.f as r, ({SCALE}::hugeint * h.a * h.a) // (x.f::hugeint * y.f) as score
  from h join f as x on x.lang = h.lang and x.phrase = h.ahead join f as y on y.lang = h.lang and y.phrase = h.behind),
b as (select *, row_number() over (partition by lang, phrase order by score, cut) as pick from k),
i as (
  select lang, phrase, max(a) as above
  from (select lang, a, unnest([array_to_string(ws[1 : 2], ' '), array_to_string(ws[2 : 3], ' ')]) as phrase from c where m = 3)
  group by lang, phrase),
s as (
  select b.* from b left join i on i.lang = b.lang and i.phrase = b.phrase
  where pick = 1 and not coalesce(100 * above >= {SUBSUMED_PERCENT} * a, false)),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from s)
select lang, rank, phrase, a, l, r, n, score::bigint as score from o join n using (lang) where rank <= {TOP}
"""
