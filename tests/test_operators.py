"""Operator semantics on small tables, including forced splitting of hot keys."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportloom.operators import clusters as C
from reportloom.operators.assemble import assemble, load_stats, preview
from reportloom.operators.attach import attach_text, discover_source, first_texts
from reportloom.operators.compare import line_difference, search_reports, version_index, version_pairs
from reportloom.operators.positions import positions
from reportloom.operators.project import project
from reportloom.operators.skew import join_to_unique, size_setting
from reportloom.operators.spans import gazetteer_spans
from reportloom.operators.topics import cluster_term_scores, cluster_topics, term_stats, topic_lists, vocabulary

FRAGMENTS = "source_file string, report_key string, seq int, text string"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_assemble_nulls_ties_and_scope(spark):
    df = spark.createDataFrame(
        [
            ("f1", "a", 2, "z"), ("f1", "a", None, "0"), ("f1", "a", 1, None), ("f1", "a", 1, "y"), ("f1", "a", 1, "x"),
            ("f2", "a", 0, "q"), ("f1", "b", 1, None), ("f1", None, 1, "n"), ("f1", "c", 1, ""),
        ],
        FRAGMENTS,
    )
    assert rows(assemble(df)) == [
        ("f1", None, "n"), ("f1", "a", "0xyz"), ("f1", "b", ""), ("f1", "c", ""), ("f2", "a", "q"),
    ]
    assert rows(assemble(df, scope="global").filter("report_key = 'a'")) == [("a", "0qxyz")]
    with pytest.raises(ValueError):
        assemble(df, scope="both")
    assert rows(load_stats(df)) == [(None, 9, 5), ("f1", 8, 4), ("f2", 1, 1)]


def test_assemble_many_blocks_and_text_sequence(spark):
    n = 20_000
    df = spark.range(n).select(
        F.lit("f").alias("source_file"), F.lit("hot").alias("report_key"),
        (F.lit(n) - F.col("id")).alias("seq"), F.concat(F.col("id").cast("string"), F.lit(";")).alias("text"),
    )
    whole = "".join(f"{i};" for i in range(n - 1, -1, -1))
    assert assemble(df, seq_block=64).first().text == whole
    named = spark.createDataFrame([("f", "a", "s2", "2"), ("f", "a", "s1", "1")], FRAGMENTS.replace("int", "string"))
    assert assemble(named).first().text == "12"


def test_preview_is_null_safe(spark):
    df = spark.createDataFrame([("b", "x" * 300, None, "p"), ("a", "e", "d", "p")],
                               "report_key string, text string, text_decoded string, text_plain string")
    first, second = preview(df, rows=5).collect()
    assert first.encoded == "e..." and second.decoded is None and len(second.encoded) == 103


def test_join_to_unique_splits_hot_and_null_keys(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), F.col("id"))).alias("k"), "id")
    right = left.filter("k is not null").select("k").distinct().filter("k <> 'k5'").withColumn("v", F.upper("k"))
    for how in ("left", "inner"):
        plain = rows(join_to_unique(left, right, "k", how, ["id"], salt=False).select("id", "k", "v"))
        salted = join_to_unique(left, right, "k", how, ["id"], hot_rows=100, salt=True)
        assert rows(salted.select("id", "k", "v")) == plain
        assert salted.columns == ["k", "id", "v"]
    assert size_setting(spark, "no.such.setting", "64MB") == 64 << 20


@pytest.mark.parametrize("within", [False, True])
def test_positions_with_gaps_and_a_hot_source(spark, within):
    df = spark.range(5000).filter("id % 7 <> 3").select(
        F.when(F.col("id") < 4000, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("src"), "id")
    got = rows(positions(df, "src", "id", "n", within_source=within, block_rows=64), "src", "id")
    count = {}
    for total, (src, _, n) in enumerate(got):
        assert n == (count.get(src, 0) if within else total)
        count[src] = count.get(src, 0) + 1


def test_first_text_wins_and_misses_are_null(spark):
    texts = spark.createDataFrame(
        [("b", 1, "1", "late"), ("a", 2, "1", "second"), ("a", 1, "1", None), ("a", 1, "2", "two"), ("a", 3, None, "x")],
        "f string, line int, report_key string, text string",
    )
    assert rows(first_texts(texts, ["f", "line"])) == [("1", None), ("2", "two")]
    vectors = spark.createDataFrame([(0, "1"), (1, "2"), (2, "2"), (3, "9")], "idx int, report_key string")
    got = rows(attach_text(vectors, texts, ["f", "line"], ["idx"], hot_rows=1).select("idx", "text"))
    assert got == [(0, None), (1, "two"), (2, "two"), (3, None)]


def test_source_discovery_by_name_then_hits(spark):
    ids = spark.range(300).select(F.col("id").alias("report_key"))
    lines = spark.createDataFrame(
        [("c.jsonl", i, "5") for i in range(3)] + [("b.jsonl", i, str(i)) for i in range(2)]
        + [("d.jsonl", i, str(i)) for i in range(9)], "source_file string, line_no int, report_key string")
    found = discover_source(lines, ids, "zzz").collect()
    assert [(r.source_file, r.n_hits, r.n_needed) for r in found] == [("c.jsonl", 3, 3)]
    assert discover_source(lines, ids, "d").first().source_file == "d.jsonl"


def test_search_falls_back_to_text_only_without_listed_key(spark):
    df = spark.createDataFrame([("ab1", "x Y.Z"), ("ab1", "other"), ("cd2", "AB1"), ("cd2", None), ("ef3", "y.z")],
                               "report_key string, text string")
    assert [r.report_key for r in search_reports(df, "AB1").collect()] == ["ab1"]
    assert [r.report_key for r in search_reports(df, "Y.Z").orderBy("report_key").collect()] == ["ab1", "ef3"]
    assert [r.report_key for r in search_reports(df, "y.z", min_unique=2).collect()] == ["ab1"]
    assert search_reports(df, "nothing").count() == 0
    assert rows(version_index(df)) == [("ab1", 2, 2), ("cd2", 2, 2), ("ef3", 1, 1)]


def test_pairs_and_line_difference(spark):
    df = spark.createDataFrame(
        [("k", "a\nb\nb\n", 1), ("k", "a\nb\nb\n", 2), ("k", "b\nc", 3), ("k", "later", 4), ("one", "x", 1), ("nul", None, 1)],
        "report_key string, text string, at int",
    )
    pairs = version_pairs(df, ["at"])
    assert rows(pairs) == [("k", "a\nb\nb\n", "b\nc"), ("nul", "", ""), ("one", "x", "")]
    assert rows(line_difference(pairs)) == [
        ("k", "a", "removed", 1), ("k", "b", "removed", 1), ("k", "c", "added", 1),
    ]


def test_gazetteer_matches_longest_name_and_split_path(spark):
    chunks = spark.createDataFrame([(1, 0, "Frau Anna  Maria Ößl, Anna."), (2, 0, "anna"), (3, 0, "")],
                                   "id int, chunk_no int, chunk string")
    names = spark.createDataFrame([("Anna", "PER"), ("anna maria ößl", "PER"), ("!", "PER")], "name string, label string")
    got = rows(gazetteer_spans(chunks, names, "id").select("id", "start", "end"))
    assert got == [(1, 5, 9), (1, 5, 20), (1, 22, 26), (2, 0, 4)]


def test_topics_keep_empty_clusters(spark):
    docs = spark.createDataFrame(
        [(0, 0, "aa bb aa"), (1, 0, ""), (2, 1, "bb cc"), (3, 2, ""), (4, 2, "a 1")],
        "idx_global int, cluster int, text string",
    )
    scores = cluster_term_scores(docs, "idx_global")
    best = cluster_topics(scores, top_n=2)
    assert rows(topic_lists(docs, best).select("cluster", F.array_join("terms", "|")))[2] == (2, "")
    n, df = 5, {"aa": 1, "bb": 2, "aa bb": 1, "bb aa": 1}
    weights = {t: (2 if t == "aa" else 1) * (np.log((1 + n) / (1 + d)) + 1) for t, d in df.items()}
    norm = np.sqrt(sum(w * w for w in weights.values()))
    got = {r.term: r.score for r in scores.filter("cluster = 0").collect()}
    for term, weight in weights.items():
        assert got[term] == pytest.approx(weight / norm / 2)


@pytest.mark.parametrize("size", [3, 40, 5000])
def test_pruned_vocabulary_is_the_same(spark, size):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    whole = term_stats(docs).orderBy(F.desc("tf"), "term").limit(size).collect()
    assert vocabulary(docs, size=size).collect() == whole
    tiny = spark.createDataFrame([("cc bb aa bb",), ("",), (None,), ("aa",)], "text string")
    both = [vocabulary(tiny, size=size).collect(), term_stats(tiny).orderBy(F.desc("tf"), "term").limit(size).collect()]
    assert both[0] == both[1] and tuple(both[0][0]) == ("aa", 2, 2)


def blobs(spark, n=300, dims=6):
    rng = np.random.default_rng(3)
    data = rng.normal(size=(n, dims)) + np.arange(3)[rng.integers(0, 3, n)][:, None] * 9
    frame = [(i, str(i), "f", [float(x) for x in v]) for i, v in enumerate(data)]
    return data, spark.createDataFrame(
        frame, "idx_global int, report_key string, source_file string, embedding array<float>"
    )


def test_kmeans_invariants(spark):
    data, vectors = blobs(spark)
    members, centers = C.cluster_vectors(vectors, k=3)
    got = members.orderBy("idx_global").collect()
    centre = {r.cluster: np.array(r.center) for r in centers.collect()}
    assert sorted(centre) == [0, 1, 2]
    for row, point in zip(got, data.astype(np.float32)):
        distances = {c: np.linalg.norm(point - v) for c, v in centre.items()}
        assert row.distance == pytest.approx(distances[row.cluster], abs=1e-5)
        assert row.distance <= min(distances.values()) + 1e-5
    stepped = {r.cluster: np.array(r.center) for r in C.lloyd_step(vectors, centers).collect()}
    before = sum(r.distance**2 for r in got)
    after = sum(min(np.sum((p - v) ** 2) for v in stepped.values()) for p in data)
    assert after <= before + 1e-3


def test_effective_k(spark):
    _, vectors = blobs(spark, n=2)
    assert C.effective_k(3, 10) == 3
    with pytest.raises(ValueError):
        C.effective_k(0, 10)
    assert C.cluster_vectors(vectors, k=1)[0].select("cluster").distinct().count() == 1


def test_projection_matches_eigenvectors(spark):
    data, vectors = blobs(spark)
    plane, share = project(vectors)
    got = np.array([(r.x, r.y) for r in plane.orderBy("idx_global").collect()])
    centred = data - data.mean(axis=0)
    values, axes = np.linalg.eigh(np.cov(centred.T))
    axes = axes[:, ::-1][:, :2]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), range(2)])
    assert len(got) == len(data)
    assert np.allclose(got, centred @ axes, atol=1e-3)
    assert share == pytest.approx(values[::-1][:3].sum() / values.sum(), abs=1e-4)


def test_json_line_statuses(spark):
    from reportloom.operators.records import rewrite_lines
    from reportloom.sources.records import apply_policy, malformed_counts, parse_records

    lines = ['{"k": 1, "t": "am 1.2.2020", "z": {"n": [1, null, "ü"]}}', '{"k": "1", "t": null, "x": 5}', "  ", "{bad",
             "[1]", "null", '{"t": "no key"}', ' {"k": 2, "t": ""} ']
    df = spark.createDataFrame([(v,) for v in lines], "value string").coalesce(1)
    records = parse_records(df, key="k", text="t")
    assert [(r.status, r.report_key, r.text) for r in records.collect()] == [
        ("record", "1", "am 1.2.2020"), ("record", "1", None), ("unparsable", None, None), ("not_object", None, None),
        ("not_object", None, None), ("record", None, "no key"), ("record", "2", ""),
    ]
    assert malformed_counts(records).first() == (7, 3, 1, 3)
    assert apply_policy(records, "drop").count() == 4
    with pytest.raises(ValueError):
        apply_policy(records, "skip")
    written = [r.value for r in rewrite_lines(records, F.lit("neu"), "t", preserve_suffix="_de").collect()]
    assert json.loads(written[0]) == {
        "k": 1, "t": "neu", "t_de": "am 1.2.2020", "z": {"n": [1, None, "ü"]},
    }
    assert "ü" in written[0]
    assert written[1:5] == [lines[1], "{bad", "[1]", "null"]
    assert json.loads(written[6]) == {"k": 2, "t": "neu", "t_de": ""}
    hosted = rewrite_lines(records, F.lit("neu"), "t", empty_passes=True).collect()
    assert json.loads(hosted[6].value) == {"k": 2, "t": ""}
