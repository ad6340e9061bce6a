"""Sources, sinks, model calls, whole jobs, the stream, and the shape of plans."""

import json

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from reportloom.operators.infer import distinct_chunks, embed, translate_with
from reportloom.plans.anonymize import anonymize, gazetteer_tagger
from reportloom.plans.decode import preview_reports
from reportloom.plans.cluster import cluster_each_source, cluster_reports
from reportloom.plans.translate import client_translator, model_translator, report_chunks, translate
from reportloom.session import scratch_path, scratch_root
from reportloom.sinks.exports import export_csv, export_jsonl, export_pairs, export_vectors
from reportloom.sources.fragments import read_fragments
from reportloom.sources.records import decode_lines, read_lines
from reportloom.sources.vectors import read_vectors
from reportloom.streaming.incremental import redact_stream, stream_lines, write_lines

SF = "/root/testdata/sf0.001"


def test_fragment_scan_takes_files_as_they_are(spark, tmp_path):
    df = spark.createDataFrame([("a", 1, "x")], "report_key string, seq int, text string").coalesce(1)
    df.write.parquet(str(tmp_path / "set"))
    df.write.parquet(str(tmp_path / "set" / "below"))
    assert read_fragments(spark, str(tmp_path / "set")).count() == 1
    (part,) = (tmp_path / "set").glob("part-*.parquet")
    other = tmp_path / "fragments.bin"
    other.write_bytes(part.read_bytes())
    assert read_fragments(spark, str(other)).first().source_file == "fragments.bin"
    (tmp_path / "empty").mkdir()
    for path in ("empty", "missing"):
        with pytest.raises(ValueError):
            read_fragments(spark, str(tmp_path / path))


def test_preview_takes_null_keys_first(spark):
    df = spark.createDataFrame(
        [("f", "b", 1, "62"), ("f", "b", 2, "63"), ("f", None, 1, "6e"), ("f", "c", 1, "64"), ("g", "b", 1, "65")],
        "source_file string, report_key string, seq int, text string",
    )
    got = preview_reports(df, rows=3).collect()
    assert [r.report_key for r in got] == [None, "b", "b"]
    assert sorted(r.plain for r in got) == ["bc...", "e...", "n..."]
    assert preview_reports(df, rows=1).first().plain == "n..."


def test_lines_keep_file_order_and_nesting(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "b.jsonl").write_text("\n".join(f"b{i}" for i in range(200)))
    (tmp_path / "a.jsonl").write_text("a0\r\na1\n")
    (tmp_path / "sub" / "c.jsonl").write_text("c0\n")
    (tmp_path / "other.txt").write_text("no\n")
    flat = read_lines(spark, str(tmp_path)).repartition(4).orderBy("source_file", "block_start", "line_id")
    assert [r.value for r in flat.collect()] == ["a0", "a1"] + [f"b{i}" for i in range(200)]
    assert read_lines(spark, str(tmp_path), recursive=True).count() == 203
    assert read_lines(spark, str(tmp_path / "other.txt")).count() == 1


def test_latin1_is_decided_per_file(spark, tmp_path):
    (tmp_path / "u.jsonl").write_bytes("ä\nb\n".encode())
    (tmp_path / "l.jsonl").write_bytes("b\n".encode() + "ä\n".encode("latin-1") + "ä\n".encode())
    got = decode_lines(read_lines(spark, str(tmp_path))).orderBy("source_file", "line_id").collect()
    assert [r.value for r in got] == ["b", "ä", "Ã¤", "ä", "b"]


def test_exports_keep_nulls_and_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "q"\nü, x'), (2, None), (3, "")], "report_key int, text string")
    export_jsonl(df, str(tmp_path / "j"))
    lines = [json.loads(x) for f in (tmp_path / "j").glob("part-*") for x in f.read_text().splitlines()]
    assert {"report_key": 2, "text": None} in lines
    assert any("ü" in f.read_text() for f in (tmp_path / "j").glob("part-*"))
    export_csv(df, str(tmp_path / "c"))
    back = spark.read.schema(df.schema).option("header", True).option("escape", '"').option("multiLine", True).option("nullValue", "\0")
    assert sorted(map(tuple, back.csv(str(tmp_path / "c")).collect())) == [(1, 'a "q"\nü, x'), (2, None), (3, "")]
    export_pairs(spark.createDataFrame([("k", "a", "")], "report_key string, text_a string, text_b string"), str(tmp_path / "p"))
    assert tuple(spark.read.json(str(tmp_path / "p")).first()) == ("k", "a", "")
    export_vectors(df.filter("false").select(F.lit("k").alias("report_key"), F.array(F.lit(1.0)).alias("embedding")),
                   str(tmp_path / "v"))
    assert read_vectors(spark, str(tmp_path / "v")).count() == 0
    with pytest.raises(ValueError):
        read_vectors(spark, str(tmp_path / "v"), embedding="other")


class Session:
    """The parts of a session that the scratch folder depends on."""

    def __init__(self, shared, master):
        self.shared, self.master, self.chosen = shared, master, None
        self.conf = self.sparkContext = self

    def get(self, name, default):
        assert name == "spark.checkpoint.dir"
        return self.shared or default

    def getCheckpointDir(self):
        return self.chosen

    def setCheckpointDir(self, path):
        self.chosen = path


def test_scratch_is_the_folder_the_session_names():
    assert scratch_root(Session("hdfs:///shared", "yarn")) == "hdfs:///shared"
    with pytest.raises(ValueError):
        scratch_root(Session(None, "yarn"))
    local = Session(None, "local[2]")
    assert scratch_root(local) == scratch_root(local)
    assert scratch_path(local, "x") != scratch_path(local, "x")


def counting_client(log):
    def client(source_lang, target_lang, formality):
        def call(texts):
            with open(log, "a", encoding="utf-8") as out:
                out.writelines(json.dumps([source_lang, target_lang, formality, t]) + "\n" for t in texts)
            return [t.upper() for t in texts]

        return call

    return client


def test_paid_client_sees_each_chunk_once(spark, tmp_path):
    log = str(tmp_path / "calls")
    df = spark.createDataFrame([(i, f"satz {i % 3}") for i in range(30)] + [(30, ""), (31, None)], "report_key int, text string")
    done = translate(df, client_translator(counting_client(log)), hosted=True, preserve_original=True)
    first, second = done.collect(), done.orderBy("report_key").collect()
    assert len(first) == 32 and second[4].text == "SATZ 1" and second[4].text_original == "satz 1"
    assert second[30].text == "" and second[31].text is None
    calls = [json.loads(x) for x in open(log, encoding="utf-8")]
    assert sorted(c[3] for c in calls) == ["satz 0", "satz 1", "satz 2"]
    assert calls[0][:3] == ["DE", "EN-US", None]


def test_local_translation_sends_empty_text_and_chunks_long_text(spark):
    long = ". ".join(f"satz {i:03}" for i in range(100)) + "."
    df = spark.createDataFrame([(1, ""), (2, long), (3, None)], "report_key int, text string")
    done = translate(df, model_translator(lambda: lambda ts: [f"<{t}>" for t in ts]), output="en")
    got = {r.report_key: r for r in done.collect()}
    assert got[1].en == "<>" and got[3].en is None and got[2].text == long
    whole = translate(df, model_translator(lambda: lambda ts: [f"<{t}>" for t in ts], 1), whole=True)
    assert {r.report_key: r.text for r in whole.collect()} == {1: "<>", 2: f"<{long}>", 3: None}
    assert got[2].en.count("<") == report_chunks(df).filter("report_key = 2").count() > 2


def test_embed_batches_and_single_call_per_text(spark, tmp_path):
    log = str(tmp_path / "sizes")

    def factory():
        def model(texts):
            with open(log, "a") as out:
                out.write(f"{len(texts)}\n")
            return [[float(len(t)), 1.0] for t in texts]

        return model

    df = spark.range(150).select(F.col("id").cast("string").alias("t")).coalesce(1)
    got = df.select(embed(F.col("t"), factory, 64).alias("v")).select(F.posexplode("v")).collect()
    assert len(got) == 300
    sizes = [int(x) for x in open(log)]
    assert sum(sizes) == 150 and max(sizes) == 64


def test_anonymize_redacts_dates_that_meet_after_chunking(spark):
    df = spark.createDataFrame([(1, "Anna am 5\nMai 2020. Ende"), (2, None), (3, "")], "report_key int, text string")
    names = spark.createDataFrame([("Anna", "PER")], "name string, label string")
    got = {r.report_key: r.text for r in anonymize(df, gazetteer_tagger(names)).collect()}
    assert got == {1: "[NAME_REDACTED] am [DATE_REDACTED]. Ende", 2: None, 3: ""}
    kept = anonymize(df, gazetteer_tagger(names), output="clean", preserve_original=True)
    assert kept.columns == ["report_key", "text", "clean", "text_de"]


def test_clusters_per_source_report_failures(spark):
    rows = [(str(i), "a", i, [float(i % 4), float(i)]) for i in range(20)] + [("x", "b", 0, [float("nan"), 1.0])]
    vectors = spark.createDataFrame(rows, "report_key string, source_file string, row_index long, embedding array<float>")
    results = cluster_each_source(vectors, None, [], k=3)
    assert isinstance(results["b"], ValueError)
    found = results["a"]
    assert found.summary.first() == (20, 3, 20)
    assert found.labels.filter("label = concat('cluster ', cluster)").count() == 3
    assert found.topics.count() == 0
    assert found.projection.count() == 20 and 0 < found.explained_variance <= 1.0001
    small = cluster_reports(vectors.filter("report_key in ('1', '2')"), None, [], with_projection=False)
    assert small.summary.first().k == 2


def test_stream_matches_batch(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"text": "am 1.2.2020", "n": 1}\n\n{bad\n{"text": null}\n')
    (source / "b.jsonl").write_text('{"text": "nichts"}\n')
    for _ in range(2):
        query = write_lines(redact_stream(stream_lines(spark, str(source))), str(tmp_path / "out"), str(tmp_path / "cp"))
        assert query.awaitTermination(120)
    got = sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect())
    assert got == sorted(['{"n":1,"text":"am [DATE_REDACTED]"}', "{bad", '{"text": null}', '{"text":"nichts"}'])


def plan_of(spark, name):
    return queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["decode_reports", "redact_dates", "pack_chunks", "tfidf_weights", "cluster_representatives", "version_pairs",
     "version_line_diff", "anonymize_reports", "translate_reports", "attach_text", "assign_nearest_center"],
)
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = plan_of(spark, name)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


@pytest.mark.parametrize("name", ["cluster_representatives", "version_pairs", "cluster_topics", "attach_text"])
def test_rank_limits_apply_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan_of(spark, name)


@pytest.mark.parametrize("name", ["cluster_representatives", "cluster_topics", "version_pairs", "chunk_table", "assemble_fragments"])
def test_no_single_task_exchange(spark, name):
    outer = plan_of(spark, name).split("Subquery")[0]
    assert "SinglePartition" not in outer


def test_scan_reads_only_what_it_needs(spark):
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan_of(spark, "pack_chunks")


def test_distinct_chunks_reach_the_model(spark):
    df = spark.createDataFrame([(i, "gleich") for i in range(100)], "report_key int, text string")
    chunks = distinct_chunks(report_chunks(df))
    assert chunks.count() == 1
    assert translate_with(chunks, lambda: lambda ts: ts).first().translated == "gleich"
