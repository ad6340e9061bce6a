"""The stored trigram index finds what the scan finds, and reads no more than it has to."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reportloom.operators import text_index
from reportloom.operators.compare import search_reports
from reportloom.operators.text_index import rarest, search_indexed, text_hits, trigrams, write_text_index


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(3)
    rows = [(f"k{i % 90}", "".join(rng.choices("abcAB .%é😀\n", k=rng.randrange(60)))) for i in range(300)]
    rows += [("k1", None), (None, "abc lost"), ("ab.", "x"), ("k2", "Straße ÄÖ"), ("k3", "aaaa" * 500)]
    return spark.createDataFrame(rows, "report_key string, text string").cache()


@pytest.fixture(scope="module")
def index(records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index") / "i")
    write_text_index(records, path, parts=8)
    return path


def test_trigrams_of_a_text(evaluate):
    got = evaluate(["abab", "", "ab", "a😀b\nc", None], trigrams)
    assert got == [["aba", "bab"], [], [], ["a😀b", "😀b\n", "b\nc"], []]


@pytest.mark.parametrize("query", ["abc", "AB", "b a", "é😀", "straSSE", "straße äö", "aaaaaaaaa", "nowhere", "k8", " ", "c\na"])
def test_index_finds_what_the_scan_finds(spark, records, index, query):
    for least in (None, 2):
        wanted = sorted(map(tuple, search_reports(records, query, min_unique=least).collect()))
        assert sorted(map(tuple, search_indexed(spark, index, query, min_unique=least).collect())) == wanted


def test_only_rare_trigrams_and_their_texts_are_read(spark, index):
    assert rarest(spark, index, "straße äö")[0] in {"str", "tra", "raß", "aße", "ße ", "e ä", " äö"}
    assert rarest(spark, index, "zzz") is None
    plan = text_hits(spark, index, "Straße")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(trigram" in plan and "dynamicpruning" in plan
    touched = spark.read.parquet(f"{index}/postings").filter(F.col("trigram") == "raß").select("part").distinct().count()
    assert touched == 1


def test_index_of_no_reports(spark, records, tmp_path):
    write_text_index(records.limit(0), str(tmp_path / "none"))
    assert search_indexed(spark, str(tmp_path / "none"), "abc").count() == 0


def test_texts_of_a_block_share_a_posting(spark, index):
    """A posting is a row per trigram and block, not per trigram and text; together they hold all texts of all trigrams."""
    texts, postings = (spark.read.parquet(f"{index}/{folder}") for folder in ("texts", "postings"))
    pairs = texts.select(F.explode(trigrams(F.col("text"))).alias("trigram"), "number").cache()
    held = postings.select("trigram", "first", F.explode("offsets").alias("offset")).select("trigram", (F.col("first") + F.col("offset")).alias("number"))
    assert held.count() == pairs.count() and held.exceptAll(pairs).isEmpty()
    blocks = postings.select("part", "first").distinct().count()
    assert postings.count() == postings.select("trigram", "part", "first").distinct().count() <= blocks * pairs.select("trigram").distinct().count()
    assert postings.count() < pairs.count()
    counts = spark.read.parquet(f"{index}/trigrams")
    assert counts.exceptAll(pairs.groupBy("trigram").agg(F.count("*").alias("n"))).isEmpty()


def test_blocks_are_bounded(monkeypatch):
    monkeypatch.setattr(text_index, "BLOCK_BYTES", 10)
    rows = [("aaaa", 0, 0), ("bbbb", 1, 0), ("cccc", 2, 0), ("d" * 50, 3, 0), ("", 4, 0), ("e", 4 + (1 << 15), 0), ("f", 5, 0), ("g", 6, 1), ("h", 1 << 33, 1)]
    text, number, part = zip(*rows, strict=True)
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in text]), pa.array(number, pa.int64()), pa.array(part, pa.int32())], ["text", "number", "part"])
    assert [b["number"].to_pylist() for b in text_index.blocks(batch)] == [[0, 1], [2], [3], [4], [4 + (1 << 15)], [5], [6], [1 << 33]]
    assert list(text_index.blocks(batch.slice(0, 0))) == []


@pytest.mark.parametrize("texts", [["", "ab", "abab\0\0\0", "\0\0\0", "a😀bab"], [""], ["".join(map(chr, range(0xE000, 0xE000 + 70_000))), *["abc"] * 20_000]])
def test_trigrams_of_texts_with_any_alphabet(texts):
    got = set()
    for found, starts, labels in text_index.texts_by_trigram([t.encode() for t in texts], np.arange(len(texts), dtype=np.int16)):
        got |= {(t, n) for t, a, b in zip(found, starts, starts[1:], strict=False) for n in labels[a:b].tolist()}
    assert got == {(t[i : i + 3], n) for n, t in enumerate(texts) for i in range(len(t) - 2)}
