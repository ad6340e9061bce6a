"""Rows that share an id, or have none, and texts that hold markers."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers

from reportloom.llm import mixing, neighbours, ngram_join, token_files, warc

BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_markers_get_the_ids_of_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    texts = ["a <|endoftext|> b", "<|endoftext|>", "plain words", "x<|endoftext|><|endoftext|>y", "nul\0 here <|end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_files.token_files(docs, BYTES).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(got, texts, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_shards_are_read_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FRAMES_PER_READ", 8)
    docs = spark.createDataFrame([(i, "some words") for i in range(100)], "doc_id long, text string")
    read = token_files.read_shards(token_files.write_shards(docs, BYTES))
    assert read.rdd.getNumPartitions() > 8 and read.count() == 100


def test_archives_of_null_ids(spark):
    same, alone = "s" * 120, "t" * 120
    rows = [(None, "http://n/", same), (6, "http://b/", same), (5, "http://a/", same), (None, "http://c/", alone), (None, "http://d/", alone)]
    got = warc.round_trip(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    kinds = sorted((r.page_id or 0, r.payload_digest, r.record_type, r.refers_to) for r in got)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    wanted = [(0, digest(same), "revisit", 5), *[(0, digest(alone), "response", None)] * 2, (5, digest(same), "response", None), (6, digest(same), "revisit", 5)]
    assert kinds == sorted(wanted)


def test_one_row_of_each_class_by_id_and_text(spark):
    base = " ".join(f"w{i}" for i in range(60))
    near, other = base + " tail", " ".join(f"v{i}" for i in range(60))
    rows = [(0, base), (1, base), (1, other), (2, near), (None, "no words shared with any other text at all"), (5, None), (5, None), (7, other), (0, base)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, key int, n int")
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()))
    assert got == sorted([(False, 0, base), (False, 1, other), (True, 0, rows[4][1]), (False, 5, ""), (False, 5, "")])


def test_mix_of_rows_that_share_an_id(spark):
    """Many rows of one id or of none, alike or not: the mix still comes near its targets."""
    rows = [(7, f"t{i} " * 13, "a") for i in range(50)] + [(None, f"u{i} " * 10, "b") for i in range(50)]
    rows += [(9, "alike " * 11, "c")] * 40 + [(i, "w " * 5, "d") for i in range(300)] + [(None, None, "c"), (9, "", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    for source, largest in (("a", 13), ("b", 10), ("c", 11), ("d", 5)):
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= largest
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()), key=str)
    assert mixing.mixed(docs).count() == sum(r["taken"] // r["size"] for r in got if r["size"])


def test_neighbours_of_rows_that_share_an_id(spark):
    rows = [(1, [1.0, 0.1]), (1, [0.9, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, every=100).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == [(0, 1, 1), (0, 1, 1), (0, 2, 1), (0, 2, 1), (0, 3, 0), (0, 3, 0)]
    assert abs(min(r.score for r in got) - 0.1) < 1e-12
