"""License scan, chat formatting and WARC archives: brute force, round trips and plans."""

from __future__ import annotations

import base64
import gzip
import hashlib
import math
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.llm import queries
from tallyloom.llm.chat import format_chats, read_chats
from tallyloom.llm.common import scratch
from tallyloom.llm.licenses import BAG, PHRASES, TEMPLATES, THRESHOLD, scan, widths
from tallyloom.llm.warc import assemble, captures, parse_archive, read_records, write_archives

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def scanned(text):
    words = WORD.findall(lower(text))
    places, names, best, blocks = [], set(), 0.0, 0
    for phrase, label in PHRASES:
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += found
        names |= {label} if found else set()
    base = ",".join(sorted(names))
    for longest, members in widths(TEMPLATES).items():
        for start in range(0, max(len(words), 1), longest // 2):
            block = set(words[start : start + longest + longest // 2])
            for label, wording in (TEMPLATES[t] for t in members):
                own = set(wording.split())
                shared = len(own & block)
                if shared >= math.ceil(THRESHOLD * len(own) - 1e-9):
                    names.add(label)
                    best = max(best, shared / len(own))
                    blocks += 1
    score = 1.0 if base else BAG * best
    return (len(words), len(places), min(places, default=None), max(places, default=None), base, ",".join(sorted(names)), score, blocks)


def test_license_scan(hostile, hostile_rows, documents, nothing):
    got = sorted(repr(tuple(r)) for r in scan(hostile).collect())
    assert got == sorted(repr((r[0], *scanned(r[1]))) for r in hostile_rows)
    rows = documents.collect()
    got = sorted(repr(tuple(r)) for r in scan(documents).collect())
    assert got == sorted(repr((r.doc_id, *scanned(r.text))) for r in rows)
    assert any("cc-by-nc" in r for r in got)
    assert scan(nothing).count() == 0


def test_license_wording_across_lines_with_a_word_missing(spark):
    texts = ["x " * 40 + "Licensed under the\nApache License,  version 2 " + "y " * 40, "licensed version apache", "released under MIT license"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in scan(docs).collect()}
    assert got[0].labels == "apache" and got[0].n_base == 1 and got[0].first_word == 43
    assert got[1].labels == "" and got[1].score == 0
    assert got[2].base_labels == "mit" and got[2].labels == "mit"


def test_every_template_is_found_in_prose_and_with_a_tenth_of_its_words_changed(spark):
    rows = []
    for number, (_, wording) in enumerate(TEMPLATES):
        words = wording.split()
        changed = [f"w{k}" if k % 10 == 9 else word for k, word in enumerate(words)]
        rows += [(2 * number, "before it " * 31 + wording.upper() + "\nbehind it" * 17), (2 * number + 1, "so " * number + ", ".join(changed))]
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for number, (label, _) in enumerate(TEMPLATES):
        for doc_id in (2 * number, 2 * number + 1):
            assert label in got[doc_id].labels.split(","), (label, doc_id)
    texts = {r.doc_id: scanned(text) for r, text in ((got[d], t) for d, t in rows)}
    assert {d: tuple(r)[1:] for d, r in got.items()} == texts


def test_words_of_a_template_far_apart_or_in_any_order_are_worth_less(spark):
    far = "released " + "x " * 30 + "under the " + "y " * 30 + "license of mit"
    bag = "the license under which a bus was released is with the mit"
    got = {r.doc_id: r for r in scan(spark.createDataFrame([(1, far), (2, bag), (3, "mit license")], "doc_id bigint, text string")).collect()}
    assert got[1].labels == "" and got[1].score == 0
    assert got[2].score <= BAG < got[3].score == 1


@pytest.mark.parametrize("name", ["op4_license_scan", "op9_chat_formatting"])
def test_native_plans_run_no_python(spark, sf_dir, name):
    plan = queries.llm_queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|ExistingRDD", plan)


# Chat formatting

said = st.text(alphabet=st.sampled_from(list("ab\\<>/ \n#é😀")), max_size=6).map(lambda s: s)
marks = st.sampled_from(["<turn>", "</turn>", "<says>", "<part>", "<\\turn>", "<\\\\/turn>", "### Assistant: ", "\\", "<", "\n"])
texts = st.lists(st.one_of(said, marks), max_size=5).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["user", "assistant", "<says>", ""]), texts), min_size=1, max_size=60))
def test_chats_come_back(spark, rows):
    turns = spark.createDataFrame([(c, i // 2, role, text) for i, (c, role, text) in enumerate(rows)], "conv_id bigint, turn bigint, role string, text string")
    back = {r.conv_id: r for r in read_chats(format_chats(turns)).collect()}
    for conv in {c for c, *_ in rows}:
        own = sorted((i // 2, role, text) for i, (c, role, text) in enumerate(rows) if c == conv)
        assert [(t.role, t.text) for t in back[conv].turns] == [(role, text) for _, role, text in own]
        assert back[conv].loss_text == "".join(text for _, role, text in own if role == "assistant")


def test_chats_with_missing_values_repeats_and_clashing_columns(spark):
    rows = [
        (1, 0, "user", None),
        (1, 0, "user", None),
        (1, None, None, "x"),
        (None, 3, "assistant", "y"),
        (2, 1, "assistant", ""),
        (2, 2, "assistant", "b" * 200_000),
        (2, 3, "user", "q"),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = turns.withColumn("turns", F.lit(1)).withColumn("blocks", F.lit(2)).withColumn("row", F.lit(3))
    back = {r.conv_id: r for r in read_chats(format_chats(turns)).collect()}
    assert [(t.role, t.text) for t in back[1].turns] == [("", "x"), ("user", ""), ("user", "")]
    assert back[None].loss_text == "y" and back[2].loss_text == "b" * 200_000
    assert back[2].formatted.count("<turn>") == 2  # two turns of one role are one block
    assert read_chats(format_chats(turns.limit(0))).count() == 0


# WARC


def expected_captures(rows):
    of = {}
    for page_id, _, html in rows:
        of.setdefault(html or "", []).append(page_id)
    out = []
    for html, ids in of.items():
        data = html.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        first, *others = sorted(ids, key=lambda page_id: (page_id is None, -(page_id or 0)))
        out.append(repr((first, len(data), digest, "response", None)))
        out.extend(repr((page_id, len(data), digest, "revisit", first)) for page_id in others)
    return sorted(out)


def back(spark, pages):
    folder = scratch(spark, "warc-test")
    write_archives(captures(pages), folder, records_per_file=7)
    return folder


PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, "http://a/2\r\nX: y", "<p>one</p>"),
    (3, None, "WARC/1.1\r\nContent-Length: 5\r\n\r\n\r\n\r\nWARC/1.0\r\n\r\n"),
    (4, "http://a/4", None),
    (5, "http://a/5", ""),
    (6, "http://a/6", "é" * 100_000),
    (6, "http://a/6", "é" * 100_000),
    (6, "http://a/6", "other"),
    (None, "http://a/n", "<p>one</p>"),
    (None, None, "alone"),
    (None, None, "alone"),
    (2, "http://a/2b", "<p>one</p>"),
    (1, "http://a/1b", "<p>one</p>"),
    (1, "http://a/1", "<p>one</p>"),
]


def test_archives_come_back(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").withColumn("payload", F.lit("clash")).withColumn("sha", F.lit(1))
    monkeypatch.setattr("tallyloom.llm.warc.read", lambda *_: pages)
    got = queries.llm_queries()["op10_warc"](spark, "")
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected_captures(PAGES)
    monkeypatch.setattr("tallyloom.llm.warc.read", lambda *_: pages.limit(0))
    assert queries.llm_queries()["op10_warc"](spark, "").count() == 0


def test_all_pages_come_back(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    got = queries.llm_queries()["op10_warc"](spark, sf_dir)
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected_captures(rows)


def test_captures_nest_their_records(spark):
    folder = back(spark, spark.createDataFrame(PAGES, "page_id bigint, url string, html string"))
    rows = assemble(read_records(spark, folder)).collect()
    assert len(rows) == len(PAGES) == len({r.record_id for r in rows}) and all(r.request and r.metadata for r in rows)
    assert {r.response.uri for r in rows} >= {"http://a/1", "http://a/1b", "http://a/2b"}
    by_page = {r.metadata.fields["page-id"]: r for r in rows if r.response.type == "response"}
    assert bytes(by_page["3"].response.payload).decode() == PAGES[2][2]
    revisits = [r for r in rows if r.response.type == "revisit"]
    assert {r.response.refers_to for r in revisits} <= {r.record_id for r in rows}
    records = read_records(spark, folder)
    alone = assemble(records.filter("type != 'request'")).collect()
    assert len(alone) == len(PAGES) and not any(r.request for r in alone)


def test_parser_reads_members_and_refuses_damage(spark):
    folder = back(spark, spark.createDataFrame(PAGES[:2], "page_id bigint, url string, html string"))
    files = [bytes(r.content) for r in spark.read.format("binaryFile").load(folder).collect() if bytes(r.content)]
    whole = b"".join(gzip.decompress(f) for f in files)
    assert len(list(parse_archive(whole))) == 6
    assert len(list(parse_archive(gzip.compress(whole) + gzip.compress(whole)))) == 12
    with pytest.raises(ValueError, match="differ"):
        list(parse_archive(whole.replace(b"<p>one</p>", b"<p>two</p>")))
    with pytest.raises(ValueError, match="no WARC"):
        list(parse_archive(b"x" + whole))
