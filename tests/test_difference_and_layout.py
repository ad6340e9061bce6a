"""Ordered differences against brute force, and plans that shuffle texts once."""

from __future__ import annotations

import random
from collections import Counter
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from reportloom.operators.assemble import assemble
from reportloom.operators.difference import changes, kept, ordered_difference
from reportloom.operators.translate import glossary_translations
from reportloom.plans.files import cluster_files


def longest_common(a, b):
    @lru_cache(None)
    def best(i, j):
        if i == len(a) or j == len(b):
            return 0
        if a[i] == b[j]:
            return 1 + best(i + 1, j + 1)
        return max(best(i + 1, j), best(i, j + 1))

    return best(0, 0)


def replayed(a, b, found):
    """``b`` made from ``a`` by the changes alone."""
    gone = {x[2] for x in found if x[2] is not None}
    placed = {x[3]: x[1] for x in found if x[3] is not None}
    rest = iter([line for i, line in enumerate(a) if i not in gone])
    return [placed[j] if j in placed else next(rest) for j in range(len(b))]


def test_differences_without_repeats_keep_as_much_as_possible():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.sample("abcdefghijkl", rng.randrange(11))
        b = rng.sample("abcdefghijkl", rng.randrange(11))
        stay = kept(a, b)
        assert len(stay) == longest_common(tuple(a), tuple(b))
        assert all(a[i] == b[j] for i, j in stay) and stay == sorted(stay, key=lambda p: p[1])


def test_differences_of_any_texts_make_the_second_from_the_first():
    rng = random.Random(2)
    for _ in range(500):
        a, b = (rng.choices("abcd", k=rng.randrange(12)) for _ in range(2))
        found = changes("\n".join(a), "\n".join(b))
        assert replayed(a, b, found) == b
        net = Counter(b)
        net.subtract(a)
        assert Counter(x[1] for x in found if x[0] == "added") == +net
        assert Counter(x[1] for x in found if x[0] == "removed") == -net


def test_long_texts_of_one_line_or_swapped_halves():
    assert changes("x\n" * 50_000, "x\n" * 40_000) == [("removed", "x", i, None) for i in range(40_000, 50_000)]
    lines = [str(i) for i in range(20_000)]
    found = changes("\n".join(lines), "\n".join(lines[12_000:] + lines[:12_000]))
    assert len(found) == 8_000 and {x[0] for x in found} == {"moved"}


def test_ordered_difference_of_tables(spark):
    pairs = spark.createDataFrame(
        [(1, "a\nb\nc", "c\na\nb"), (2, "same", "same"), (3, "x", ""), (4, None, "n\r\nm"), (None, "p\np", "p")],
        "report_key long, text_a string, text_b string",
    )
    got = sorted(map(tuple, ordered_difference(pairs).collect()), key=str)
    assert got == sorted(
        [(1, "moved", "c", 2, 0), (4, "added", "n", None, 0), (4, "added", "m", None, 1), (None, "removed", "p", 1, None)], key=str
    )
    assert ordered_difference(pairs.limit(0)).count() == 0


def plan_of(spark, df):
    """The plan without broadcasts, as for tables beyond Spark's limit."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_assembly_shuffles_and_reads_once(spark, no_broadcast, tmp_path):
    rows = [("f", "k", i, f"{i},") for i in range(9_000)] + [("f", None, None, "x"), ("g", "k", 1, "y")]
    spark.createDataFrame(rows, "source_file string, report_key string, seq long, text string").write.parquet(str(tmp_path / "t"))
    fragments = spark.read.parquet(str(tmp_path / "t"))
    for scope in ("file", "global"):
        plan = plan_of(spark, assemble(fragments, scope=scope))
        assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    got = {(r.source_file, r.report_key): r.text for r in assemble(fragments).collect()}
    assert got == {("f", "k"): "".join(f"{i}," for i in range(9_000)), ("f", None): "x", ("g", "k"): "y"}


def test_glossary_in_the_row(spark, no_broadcast):
    chunks = spark.createDataFrame(
        [(1, "Der Hund, der HUND!"), (2, ""), (3, "ohne Treffer"), (4, None), (5, " der\nKater ")], "chunk_id int, chunk string"
    )
    glossary = spark.createDataFrame([("der", "the"), ("hund", "dog"), ("katze", "cat")], "word string, target string")
    done = glossary_translations(chunks, glossary)
    assert plan_of(spark, done).count("Generate explode") == 1
    assert sorted(map(tuple, done.collect())) == [(1, "the dog, the dog!"), (2, ""), (3, "ohne Treffer"), (5, " the\nKater ")]
    assert glossary_translations(chunks, glossary.limit(0)).filter(F.col("chunk_id") == 1).first().translated == "Der Hund, der HUND!"


def test_cluster_job_finds_texts_by_name_or_hits(spark, tmp_path):
    rows = [(f"k{i}", [float(i % 2) * 9 + i * 0.01, 1.0], f"{'ab'[i // 10]}.emb.parquet") for i in range(20)]
    rows.append(("bad", [float("nan"), 1.0], "c.emb.parquet"))
    vectors, lines = str(tmp_path / "v"), tmp_path / "lines"
    spark.createDataFrame(rows, "report_key string, embedding array<float>, source_file string").repartition(3).write.parquet(vectors)
    lines.mkdir()
    line = '{{"report_key": "k{0}", "text": "{1} k{0}"}}\n'
    (lines / "a.jsonl").write_text("".join(line.format(i, "own") for i in range(10)) + "broken\n" + line.format(0, "again"))
    (lines / "other.jsonl").write_text("".join(line.format(i, "other") for i in range(5, 20)))
    found = cluster_files(spark, vectors, str(lines), str(tmp_path / "out"), k=2, reps=3)
    assert sorted(found) == ["a.emb.parquet", "b.emb.parquet", "c.emb.parquet"] and isinstance(found["c.emb.parquet"], ValueError)
    for name, word in (("a", "own"), ("b", "other")):
        got = spark.read.json(str(tmp_path / "out" / f"{name}.emb.parquet" / "clusters")).collect()
        assert len(got) == 6 and all(r.text == f"{word} {r.report_key}" for r in got)
        assert spark.read.parquet(str(tmp_path / "out" / f"{name}.emb.parquet" / "projection")).count() == 10
    merged = cluster_files(spark, vectors, str(lines), str(tmp_path / "all"), merge=True, k=2, reps=20, with_projection=False)["merged"]
    got = {r.report_key: r.text for r in spark.read.json(str(tmp_path / "all" / "merged" / "clusters")).collect()}
    assert got == {f"k{i}": f"{'own' if i < 10 else 'other'} k{i}" for i in range(20)} and merged.members.count() == 20
