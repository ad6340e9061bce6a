"""Keys that repeat or are null, long names, lenient JSON, equal file names, null texts, whole file jobs."""

import json
import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportloom.functions.decode import strip_rtf
from reportloom.operators.infer import attach_translations, distinct_chunks, embed, tag, with_chunk_id
from reportloom.operators.records import field, rewrite_lines
from reportloom.operators.skew import join_to_unique, may_be_hot
from reportloom.plans.anonymize import anonymize, gazetteer_tagger
from reportloom.plans.files import anonymize_jsonl, compare_folders, embed_jsonl, translate_jsonl
from reportloom.plans.translate import model_translator, translate
from reportloom.session import scratch_root
from reportloom.sources.records import decode_lines, parse_records, read_lines
from reportloom.sources.vectors import read_vectors


@pytest.fixture
def names(spark):
    return spark.createDataFrame([("Anna", "PER"), ("Maria del Carmen Lopez", "PER")], "name string, label string")


def test_redaction_needs_no_unique_key(spark, names):
    rows = [(None, "Frau Anna kam"), ("k", "Anna ging. Herr Anna"), ("k", "Herr Ott ging"), (None, None), ("m", "Maria del Carmen Lopez, Anna")]
    got = anonymize(spark.createDataFrame(rows, "report_key string, text string"), gazetteer_tagger(names))
    mark = "[NAME_REDACTED]"
    wanted = [(None, f"Frau {mark} kam"), ("k", f"{mark} ging. Herr {mark}"), ("k", "Herr Ott ging"), (None, None), ("m", f"{mark}, {mark}")]
    key = lambda r: (r[0] or "", r[1] or "")
    assert sorted(((r.report_key, r.text) for r in got.collect()), key=key) == sorted(wanted, key=key)


def test_translation_needs_no_unique_key(spark):
    rows = [(None, "eins"), ("k", "zwei"), ("k", "drei"), (None, None)]
    got = translate(spark.createDataFrame(rows, "report_key string, text string"), model_translator(lambda: lambda ts: [t.upper() for t in ts]))
    assert sorted((r.report_key or "", r.text or "") for r in got.collect()) == [("", ""), ("", "EINS"), ("k", "DREI"), ("k", "ZWEI")]


def test_null_keys_in_the_split_join(spark):
    left = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(40)], "id long, k string")
    right = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    got = join_to_unique(left, right, "k", "left", ["id"], hot_rows=5, salt=True)
    assert sorted((r.id, r.v) for r in got.collect()) == [(i, None if i % 2 else 1) for i in range(40)]


def test_lenient_json(spark):
    lines = [
        '{"report_key": "1", "text": "a", "x": 1, "x": 2}', '{"report_key": "2", "text": "NaN: NaN, b", "x": NaN, "y": [-Infinity, 1]}',
        '{"report_key": "3", "text": "open', "NaN", '{"report_key": NaN, "text": "\\"NaN"}',
    ]
    records = parse_records(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [(r.report_key, r.text, r.status) for r in records.select("report_key", "text", "status").collect()]
    assert got == [("1", "a", "record"), ("2", "NaN: NaN, b", "record"), (None, None, "unparsable"), (None, None, "not_object"), (None, '"NaN', "record")]
    assert [r.x for r in records.select(field(F.col("record"), "x").alias("x")).collect()][:2] == ["2", None]


def test_field_names_with_quotes(spark):
    line = json.dumps({"it's": 1, 'a"b': 2, "both'\"": 3})
    record = spark.createDataFrame([(line,)], "v string").select(F.parse_json("v").alias("r"))
    got = record.select(*[field(F.col("r"), n).alias(f"c{i}") for i, n in enumerate(["it's", 'a"b', "both'\"", "no'\""])]).first()
    assert tuple(got) == ("1", "2", "3", None)


def test_files_of_one_name(spark, tmp_path):
    for folder, data in (("a", "Größe".encode()), ("b", "Größe".encode("latin-1"))):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "x.jsonl").write_bytes(data + b"\n")
        spark.createDataFrame([(folder, [1.0, 2.0])], "report_key string, embedding array<float>").coalesce(1).write.parquet(str(tmp_path / folder / "v"))
    lines = decode_lines(read_lines(spark, str(tmp_path), recursive=True))
    assert [(r.value, r.source_file) for r in lines.collect()] == [("Größe", "x.jsonl")] * 2
    vectors = read_vectors(spark, str(tmp_path / "a" / "v"), str(tmp_path / "b" / "v"))
    assert vectors.select("file_path").distinct().count() == 2


def test_vectors_keep_their_source(spark, tmp_path):
    path = str(tmp_path / "v")
    spark.createDataFrame([("1", [1.0], "own.jsonl")], "report_key string, embedding array<float>, source_file string").write.parquet(path)
    assert read_vectors(spark, path).first().source_file == "own.jsonl"


def counted():
    return lambda texts: np.array([[len(t), 1.0] for t in texts])


def test_null_texts_are_not_embedded(spark):
    for texts in ([None, "abc", None, "x"], [None, None]):
        df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
        got = [r.v for r in df.select(embed(F.col("t"), counted).alias("v")).collect()]
        assert got == [None if t is None else [len(t), 1.0] for t in texts]


def test_short_answers_of_a_tagger_are_errors(spark):
    chunks = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "id int, chunk_no int, chunk string").coalesce(1)
    with pytest.raises(Exception, match="zip"):
        tag(chunks, lambda: lambda texts: [[]], "id").collect()


def test_deeply_nested_rtf_groups(spark, evaluate):
    deep = "{\\rtf1 a{\\info{\\a{\\b{\\c{\\d geheim}}}}}b{\\*\\x {y}}{\\b c}\\{d\\}{\\pict{z}}}"
    assert evaluate([deep], strip_rtf) == ["abc{d}"]


def test_jobs_from_files_to_files(spark, names, tmp_path):
    rows = [{"report_key": k, "text": t, "more": [1, {"x": None}]} for k, t in [("1", "Anna am 1.2.2020"), ("1", "Anna da"), (None, "x"), ("2", None)]]
    source = tmp_path / "in" / "deep"
    source.mkdir(parents=True)
    (source / "x.jsonl").write_text("\n".join([*map(json.dumps, rows), "broken {", ""]), encoding="utf-8")
    path = str(tmp_path / "in")
    read = lambda name: [r.value for r in spark.read.text(str(tmp_path / name)).collect()]
    anonymize_jsonl(spark, path, str(tmp_path / "clean"), gazetteer_tagger(names))
    lines = read("clean")
    got = [json.loads(x) for x in lines if not x.startswith("broken")]
    assert "broken {" in lines and all(r["more"] == [1, {"x": None}] for r in got)
    assert sorted(str(r["text"]) for r in got) == ["None", "[NAME_REDACTED] am [DATE_REDACTED]", "[NAME_REDACTED] da", "x"]
    translate_jsonl(spark, path, str(tmp_path / "en"), model_translator(lambda: lambda ts: [t.upper() for t in ts]), policy="drop", output_key="en")
    got = [json.loads(x) for x in read("en")]
    assert sorted(str(r.get("en")) for r in got) == ["ANNA AM 1.2.2020", "ANNA DA", "None", "X"]
    embed_jsonl(spark, path, str(tmp_path / "emb"), counted)
    assert sorted((r.report_key, r.embedding[0], r.source_file) for r in spark.read.parquet(str(tmp_path / "emb")).collect()) == [
        ("1", 7.0, "x.jsonl"), ("1", 16.0, "x.jsonl")
    ]
    compared = compare_folders(spark, path)
    assert [tuple(r) for r in compared.index.select("report_key", "n_unique").collect()] == [("1", 2)]
    assert [(r.text_a, r.text_b) for r in compared.pairs.collect()] == [("Anna am 1.2.2020", "Anna da")]


ODD_LINES = [
    '{"text": "ein Wort", "n": 1.50, "big": 123456789012345678901234567890123456789012345678, "e": 1E5, "tiny": 1e-300, "neg": -0.0}',
    '{"text": "zwei", "q": "a \\"b\\" \\\\ \\u00e4\\n\\u2028", "o": {"b": null, "a": [1, [], {}]}, "": "x", "text_original": "alt", "en": 1}',
    '{"text": "drei", "nan": NaN, "inf": [-Infinity], "s": "NaN"}', '{"text": ""}', '{"text": "nur"}', '{"text": 12, "b": true}',
    '{"text": null, "z": 1,  "a": 2}', ' {"z": 1,  "a": 2} ', "[1]", "broken {", "   ", '{"text": " \\n ", "a": 0.10}',
]


@pytest.mark.parametrize(
    ("output_key", "preserve", "hosted"), [(None, False, False), (None, False, True), ("text", False, False), ("en", False, True), ("en", True, False)]
)
def test_translated_lines_are_the_rewritten_records(spark, tmp_path, output_key, preserve, hosted):
    """Lines that go on without their text come out as if their whole record had been kept."""
    (tmp_path / "x.jsonl").write_text("\n".join(ODD_LINES), encoding="utf-8")
    upper = model_translator(lambda: lambda ts: [t.upper() for t in ts])
    translate_jsonl(spark, str(tmp_path / "x.jsonl"), str(tmp_path / "out"), upper, output_key=output_key, preserve_original=preserve, hosted=hosted)
    records = parse_records(read_lines(spark, str(tmp_path / "x.jsonl")))
    wanted = rewrite_lines(records, F.trim(F.upper(F.translate("text", "\n", ""))), "text", output_key, "_original" if preserve else None, hosted)
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(r.value for r in wanted.collect())


def test_translation_of_lines_stores_a_text_once(spark, tmp_path):
    rng = random.Random(3)
    texts = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=380)) for _ in range(2000)]
    (tmp_path / "x.jsonl").write_text("\n".join(json.dumps({"report_key": i, "text": t}) for i, t in enumerate(texts)), encoding="utf-8")
    root = Path(scratch_root(spark).removeprefix("file:"))
    stored = lambda: sum(f.stat().st_size for f in root.rglob("*.parquet"))
    before = stored()
    translate_jsonl(spark, str(tmp_path), str(tmp_path / "out"), model_translator(lambda: lambda ts: [t[::-1] for t in ts]))
    assert stored() - before < 1.5 * sum(map(len, texts))
    assert sorted(json.loads(r.value)["text"] for r in spark.read.text(str(tmp_path / "out")).collect()) == sorted(t[::-1] for t in texts)


def test_answers_are_moved_for_hot_chunks_only(spark):
    rows = [(i, 0, f"chunk {i % 40 or 'x'}") for i in range(400)]
    chunks = with_chunk_id(spark.createDataFrame(rows, "id int, chunk_no int, chunk string"))
    answers = distinct_chunks(chunks).select("chunk_id", F.upper("chunk").alias("translated"))
    assert not may_be_hot(chunks, "chunk_id", 10) and may_be_hot(chunks, "chunk_id", 9)
    for hot_rows in (5, 10):
        got = attach_translations(chunks, answers, "id", hot_rows=hot_rows)
        moved = "_part" in got._jdf.queryExecution().optimizedPlan().toString()
        assert moved == (hot_rows == 5) and sorted(map(tuple, got.select("id", "translated").collect())) == [(i, c.upper()) for i, _, c in rows]
