"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns, for every operator and stage."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from areaweave.llm import (
    chat_format, decontamination, html_extract, language_model, packing, quality_rules, secret_scan, simhash,
    suffix_dedup, warc,
)
from areaweave.llm.queries import tokenizer_path

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, words string, n_words string, h string, "
          "fingerprint string, node string, chunk string, bucket string, path string, doc string, whole_row string")


def sentence(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["the", "of", "and", "to", f"w{rng.randrange(3000)}"]) for _ in range(n))


LONG = sentence(0, 30_000)
ROWS = [(1, None), (2, ""), (3, LONG), (4, LONG), (4, LONG), (5, " \n\t "), (None, "one two three"), (None, None),
        (6, sentence(1, 80)), (7, sentence(1, 80) + " end"), (8, "ünï çødé " * 40), (9, "x" * 70_000)]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, None, None, None if t is None else len(t), *["clash"] * 10) for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "w1"), (3, "w1"), (4, LONG[:3000])], "item_id long, text string")


def pages(docs):
    return docs.select(F.col("doc_id").alias("page_id"), F.lit(None).cast("string").alias("url"), F.col("text").alias("html"),
                       "words", "node", "chunk")


OPERATORS = {
    "html": lambda s, d: html_extract.extract_pages(pages(d)),
    "suffix": lambda s, d: suffix_dedup.remove_repeats(d),
    "rules": lambda s, d: quality_rules.quality_rules(d),
    "benchmark": lambda s, d: decontamination.contamination(d, items(s)),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "model": lambda s, d: language_model.score_documents(d),
    "warc": lambda s, d: warc.merge_index(warc.read_archives(s, warc.write_archives(pages(d)))),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(spark, edge, name):
    ids = sorted(str(r[0]) for r in OPERATORS[name](spark, edge).select(
        "page_id" if name in ("html", "warc") else "doc_id").collect())
    assert ids == sorted(str(i) for i, _ in ROWS)
    empty = OPERATORS[name](spark, edge.limit(0))
    assert empty.count() == 0


def test_model_without_any_word(spark):
    got = language_model.score_documents(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in got) == [(1, 1), (2, 1)]


def test_packing_edges(spark, edge):
    found = packing.pack(edge, tokenizer_path())
    assert {str(r.doc_id) for r in found.collect()} == {str(i) for i, _ in ROWS}
    assert found.where("piece = 0").count() == len(ROWS)
    assert found.where("length = 1").count() == 4  # null, empty and blank texts are an end token
    assert packing.pack(edge.limit(0), tokenizer_path()).count() == 0


def test_secret_edges(spark, edge):
    found, forest = secret_scan.scan(edge)
    assert found.count() == 0
    assert secret_scan.redact(edge, forest).count() == len(ROWS)


def test_chat_edges(spark):
    schema = "conv_id long, seq long, turn long, kind string, role string, text string, piece string, head string"
    rows = [(None, 0, 0, "message", None, None, "x", "y"), (1, 0, 0, "message", "user", "a", "", ""),
            (1, 0, 0, "message", "user", "a", "", ""), (2, None, None, None, "assistant", " </turn>\n", "", "")]
    frame = spark.createDataFrame(rows, schema)
    read = chat_format.read_back(chat_format.render(chat_format.fold_events(frame)))
    got = {r.conv_id: [(t.role, t.text) for t in r.read] for r in read.collect()}
    assert got == {None: [("", "")], 1: [("user", "a")] * 2, 2: [("assistant", " </turn>\n")]}
    assert chat_format.render(chat_format.fold_events(frame.limit(0))).count() == 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_edges(spark, edge, sf, name, stage):
    out = stage(spark, edge, sf)
    if name != "packing":
        assert out.columns == list(corpus_pipeline.COLUMNS)
    expected = {"simhash_dedup": 6, "quality_rules": 2, "packing": None}.get(name, len(ROWS))
    assert expected is None or out.count() == expected
    assert stage(spark, edge.limit(0), sf).count() == 0
