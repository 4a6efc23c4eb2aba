from __future__ import annotations

import pytest
from pyspark.sql import functions as F

LONG = "thion anea stble of the erou " * 12_000  # about 350,000 characters, one line


@pytest.fixture(scope="session")
def hostile_rows():
    """Documents with missing values, empty, blank and very long texts, ties, repeats and odd characters."""
    texts = [
        None,
        "",
        " \n\t ",
        "a",
        "Ab cd",
        "aB CD",
        "  ab   cd ",
        "ÀB cd",
        "one two three four five six seven eight nine ten eleven twelve",
        "one two three four five six seven eight nine ten eleven twelve",
        "ONE two three four five six seven eight nine ten eleven twelve",
        "İ Σ ς K 日本語 😀 ½ \x1c \x00 <|endoftext|> it's we're",
        "12 34 !! ?? ...",
        LONG,
        LONG + " end",
        "Released under the MIT License.\nGeneral Public License, general public license",
        "mit license mit license apache\nlicense",
    ]
    rows = [(i * 7 - 20, text, "en" if i % 2 else None, f"src{i % 3}" if i % 5 else None, len(text or "")) for i, text in enumerate(texts)]
    rows.append(rows[8])  # a whole row again
    rows.append((rows[8][0], "another text under an id that is there already", "de", None, None))
    rows.append((None, "one two three four five six seven eight nine ten eleven twelve", None, None, None))
    rows.append((None, None, None, None, None))
    return rows


@pytest.fixture(scope="session")
def hostile(spark, hostile_rows):
    """The same as a table, with columns whose names operators use themselves."""
    docs = spark.createDataFrame(hostile_rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name in ("sha", "row", "block", "length", "offset", "fp", "label", "x", "component_id", "kept", "__id", "__sha", "key", "n", "page_id"):
        docs = docs.withColumn(name, F.lit("clash"))
    return docs


@pytest.fixture(scope="session")
def nothing(hostile):
    return hostile.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
