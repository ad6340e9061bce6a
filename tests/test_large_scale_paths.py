"""Vocabulary by threshold, dictionary prefixes, the ledger of paid calls and k-means of many sets."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.errors import PythonException
from pyspark.sql import functions as F

from reportloom.operators import topics as T
from reportloom.operators.infer import with_chunk_id
from reportloom.checks.inputs import table
from reportloom.operators.ledger import GROUP, answers, batches_of, call_missing
from reportloom.operators.lloyd import assigned, cluster_sets, lloyd, starts
from reportloom.operators.membership import WordSet
from reportloom.operators.spans import gazetteer_spans
from reportloom.plans.cluster import cluster_each_source, describe
from reportloom.sources.records import decode_lines, read_lines


def test_word_set_holds_its_words(spark):
    words = spark.createDataFrame([(f"word {i}",) for i in range(3_000)], "w string")
    known = WordSet(words, "w", 3_000)
    other = spark.createDataFrame([(f"other {i}",) for i in range(3_000)], "w string")
    held = lambda df: known.beside(df).select(F.exists(F.array("w"), known.holds).alias("h")).filter("h").count()
    assert held(words) == 3_000
    assert held(other) < 300


@pytest.mark.parametrize("size", [1, 7, 40, 10_000])
def test_vocabulary_is_exact(spark, size):
    rng = random.Random(size)
    words = [f"w{int(rng.paretovariate(0.7)) % 400}" for _ in range(3_000)]
    texts = [(" ".join(words[i : i + 25]),) for i in range(0, 3_000, 25)] + [(None,), ("",), ("x",)]
    docs = spark.createDataFrame(texts, "text string")
    whole = T.term_stats(docs).orderBy(F.desc("tf"), "term").limit(size).collect()
    assert T.vocabulary(docs, size=size).collect() == whole


def test_pairs_with_a_rare_word_are_no_rows(spark):
    common = "alpha beta " * 20
    docs = spark.createDataFrame([(f"{common} rare{i} alpha rare{i + 1}",) for i in range(200)], "text string")
    frequent = spark.createDataFrame([("alpha",), ("beta",)], "term string")
    pairs = T.frequent_pairs(docs, frequent)
    made = {r.term for r in pairs.collect()}
    assert {"alpha beta", "beta alpha"} <= made and len(made) < 20


def test_long_names_cost_nothing_where_they_do_not_start(spark):
    """Only words that may start a name become rows, whatever the longest name."""
    names = spark.createDataFrame(
        [("Anna Berg", "PER"), ("Anna", "PER"), (" ".join(["Zeta"] * 12), "LOC"), ("!!", "PER")], "name string, label string"
    )
    chunks = spark.createDataFrame([(i, 0, "heute kam frau Anna  Berg und " + "wort " * 50) for i in range(50)], "id int, chunk_no int, chunk string")
    found = gazetteer_spans(chunks, names, "id")
    got = {(r.start, r.end, r.label) for r in found.collect()}
    assert got == {(15, 25, "PER"), (15, 19, "PER")} and found.count() == 100
    assert gazetteer_spans(chunks, names.limit(0), "id").count() == 0


def chunks_of(spark, n):
    return with_chunk_id(spark.createDataFrame([(f"text {i}",) for i in range(n)], "chunk string"))


def test_paid_calls_go_on_where_they_stopped(spark, tmp_path):
    ledger, chunks = str(tmp_path / "ledger"), chunks_of(spark, 100)

    def failing():
        def client(texts):
            if any(t == "text 50" for t in texts):
                raise RuntimeError("away")
            return [t.upper() for t in texts]

        return client

    with pytest.raises(PythonException):
        call_missing(chunks, failing, ledger, 4, callers=1)
    kept = answers(spark, ledger).count()
    assert kept % 4 == 0 and kept < 100
    asked = call_missing(chunks, lambda: lambda texts: [t.upper() for t in texts], ledger, 4, callers=3)
    left = 100 - kept
    assert math.ceil(left / 4) <= asked <= left // 4 + 3  # each caller may have one smaller batch
    assert {r.translated for r in answers(spark, ledger).collect()} == {f"TEXT {i}" for i in range(100)}
    assert call_missing(chunks, failing, ledger, 4) == 0  # nothing is asked again
    assert call_missing(chunks_of(spark, 101), lambda: lambda texts: texts, ledger, 4) == 1


def test_a_task_that_runs_again_does_not_pay_again(spark, tmp_path):
    """A batch whose file is there is not asked for, even if the list of missing chunks is older."""
    ledger, chunks = str(tmp_path / "ledger"), chunks_of(spark, 20)
    call_missing(chunks, lambda: lambda texts: texts, ledger, 5, callers=2)
    files = sorted(p.name for p in (tmp_path / "ledger").glob("*.parquet"))
    assert 4 <= len(files) <= 6 and not list((tmp_path / "ledger").glob("_*"))


def test_a_ledger_of_many_batches_has_few_files(spark, tmp_path):
    ledger, chunks = str(tmp_path / "ledger"), chunks_of(spark, 4 * GROUP + 100)

    def failing():
        left = [2 * GROUP - 10]

        def client(texts):
            left[0] -= 1
            if left[0] < 0:
                raise RuntimeError("away")
            return [t.upper() for t in texts]

        return client

    with pytest.raises(PythonException):
        call_missing(chunks, failing, ledger, 2, callers=1)
    assert len(list((tmp_path / "ledger").glob("*.parquet"))) == 1 + GROUP - 10
    assert answers(spark, ledger).count() == 2 * (2 * GROUP - 10)
    call_missing(chunks, lambda: lambda texts: [t.upper() for t in texts], ledger, 2, callers=1)
    got = [r.translated for r in answers(spark, ledger).collect()]
    assert sorted(got) == sorted(f"TEXT {i}" for i in range(4 * GROUP + 100))
    # Of the second run's batches some make no whole group; those of the first one that stopped stay.
    assert len(list((tmp_path / "ledger").glob("*.parquet"))) == 1 + (GROUP - 10) + 60
    assert not list((tmp_path / "ledger").glob("_*"))


def test_batches_do_not_depend_on_the_parts_they_come_in():
    import pyarrow as pa

    table = pa.table({"x": list(range(23))})
    for part in (1, 4, 7, 23):
        got = [t["x"].to_pylist() for t in batches_of(iter(table.to_batches(max_chunksize=part)), 5)]
        assert got == [list(range(i, min(i + 5, 23))) for i in range(0, 23, 5)]


def blobs(spark):
    rng = random.Random(4)
    rows = []
    for s, centres in (("a", [(0, 0), (9, 9), (0, 9)]), ("b", [(5, 5), (50, 50), (90, 0)])):
        rows += [(s, i, [c[0] + rng.gauss(0, 0.1), c[1] + rng.gauss(0, 0.1)]) for i, c in enumerate(centres * 20)]
    rows += [("one", 0, [1.0, 2.0]), ("same", 0, [3.0, 3.0]), ("same", 1, [3.0, 3.0])]
    return spark.createDataFrame(rows, "source_file string, idx_global long, embedding array<double>")


def test_sets_are_clustered_in_the_same_passes(spark):
    vectors = blobs(spark)
    members, centers = cluster_sets(vectors, k=3)
    got = members.collect()
    assert len(got) == 123
    for s in ("a", "b"):
        by_blob = {(r.idx_global % 3, r.cluster) for r in got if r.source_file == s}
        assert len(by_blob) == 3 and len({c for _, c in by_blob}) == 3
        assert max(r.distance for r in got if r.source_file == s) < 1
    sizes = {r.source_file: r["count"] for r in centers.groupBy("source_file").count().collect()}
    assert sizes == {"a": 3, "b": 3, "one": 1, "same": 1}  # no more starts than different vectors


def test_starts_and_steps_repeat_and_improve(spark):
    vectors = blobs(spark).filter("source_file = 'b'")
    first = sorted(map(tuple, starts(vectors, 3, seed=5).collect()))
    assert first == sorted(map(tuple, starts(vectors.repartition(7), 3, seed=5).collect()))
    given = spark.createDataFrame([("b", 0, [0.0, 0.0]), ("b", 1, [1.0, 1.0]), ("b", 2, [500.0, 500.0])], "source_file string, cluster int, center array<double>")
    cost = lambda centers: assigned(vectors, centers).agg(F.sum(F.col("distance") * F.col("distance"))).first()[0]
    costs = [cost(lloyd(vectors, given, max_iter=n, tol=-1.0)) for n in (0, 1, 2, 4)]
    assert costs == sorted(costs, reverse=True) and costs[-1] < costs[0]
    kept = {r.cluster: r.center for r in lloyd(vectors, given, max_iter=1, tol=-1.0).collect()}
    assert kept[2] == [500.0, 500.0]  # a centre without members stays


def test_a_source_without_vectors_is_reported(spark):
    rows = [("good", i, f"k{i}", [float(i % 2) * 9, 1.0]) for i in range(8)] + [("bad", 0, "x", [float("nan"), 1.0])]
    vectors = spark.createDataFrame(rows, "source_file string, row_index long, report_key string, embedding array<float>")
    results = cluster_each_source(vectors, None, [], k=2, with_projection=False)
    assert isinstance(results["bad"], ValueError)
    assert sorted(r.n for r in results["good"].members.groupBy("cluster").agg(F.count("*").alias("n")).collect()) == [4, 4]


def test_only_tables_in_few_pieces_are_dealt_out(spark, tmp_path):
    rows = spark.range(4000)
    rows.coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    rows.repartition(4 * spark.sparkContext.defaultParallelism).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(0).write.parquet(str(tmp_path / "none.parquet"))
    plans = {name: str(table(spark, str(tmp_path), name)._jdf.queryExecution().executedPlan()) for name in ("one", "many")}
    assert "RoundRobin" in plans["one"] and "Exchange" not in plans["many"]
    for name, count in (("one", 4000), ("many", 4000), ("none", 0)):
        assert table(spark, str(tmp_path), name).agg(F.count("*"), F.countDistinct("id")).first() == (count, count)


def test_lines_of_files_are_decoded_without_a_shuffle(spark, tmp_path):
    (tmp_path / "a.jsonl").write_bytes("ä\nb\n".encode())
    lines = decode_lines(read_lines(spark, str(tmp_path)))
    assert sorted(r.value for r in lines.collect()) == ["b", "ä"]
    (tmp_path / "b.jsonl").write_bytes("c\nö\n".encode("latin-1"))
    lines = decode_lines(read_lines(spark, str(tmp_path)))
    assert sorted((r.source_file, r.value) for r in lines.collect()) == [
        ("a.jsonl", "b"), ("a.jsonl", "ä"), ("b.jsonl", "c"), ("b.jsonl", "ö"),
    ]
    assert "Exchange hashpartitioning" not in str(lines._jdf.queryExecution().executedPlan())


def test_corpus_is_cut_into_words_once_and_gives_the_texts(spark, tmp_path):
    """The texts are read for the corpus only: representatives take theirs from it, topics its words."""
    members = spark.createDataFrame(
        [(i, f"k{i % 5}" if i % 7 else None, "s", i % 2, float(i)) for i in range(30)],
        "idx_global long, report_key string, source_file string, cluster int, distance double",
    )
    rows = [("k1", "b", 0, "Zweite Wahl"), ("k1", "a", 1, "rote rote Beete"), ("k2", "a", 2, None), ("k3", "a", 3, ""), ("k0", "a", 4, "blaue Beete")]
    spark.createDataFrame(rows, "report_key string, source_file string, line_no long, text string").write.parquet(str(tmp_path / "texts"))
    texts = spark.read.parquet(str(tmp_path / "texts"))
    found = describe(members, texts, ["source_file", "line_no"], k=2, reps=6)
    wanted = {"k1": "rote rote Beete", "k2": None, "k3": "", "k0": "blaue Beete", "k4": None, None: None}
    got = found.representatives.collect()
    assert len(got) == 12 and all(r.text == wanted[r.report_key] for r in got)
    assert not any(str(tmp_path) in file for file in found.representatives.inputFiles())
    docs = members.select("idx_global", "cluster", "report_key").collect()
    docs = spark.createDataFrame([(r.idx_global, r.cluster, wanted[r.report_key] or "") for r in docs], "idx_global long, cluster int, text string")
    whole = T.cluster_topics(T.cluster_term_scores(docs, "idx_global")).select("cluster", "rank", "term")
    assert sorted(found.topics.select("cluster", "rank", "term").collect()) == sorted(whole.collect())
