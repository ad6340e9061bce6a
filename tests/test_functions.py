"""Literal cases and random text against short Python twins."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportloom.functions.chunk import chunk, join_chunks, split_sentences
from reportloom.functions.decode import decode_hex, strip_rtf
from reportloom.functions.fixed import BIRTH_LABELS, BIRTH_REACH, MONTH_NAMES, SENTENCE_ENDS
from reportloom.functions.redact import is_person_label, redact_dates, redact_spans
from reportloom.functions.text import ngrams, strip
from reportloom.functions.vector import distance, is_finite, unit
from reportloom.checks.models import hashing_model
from reportloom.operators.chunks import chunk_table
from reportloom.operators.hashing import hashing_vectors
from reportloom.operators.spans import resolve_spans, token_spans
from reportloom.operators.topics import count_terms

LETTERS = "abcdefÄÖüßé019 ._-!?…;:\n\t\r\u00a0\u2003\u0085\u001f😀'\"\\{}Geb"
texts = st.lists(st.text(alphabet=LETTERS, max_size=60), min_size=30, max_size=60)
relaxed = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_decode_hex_literals(evaluate):
    cases = {
        "426566756e643a": "Befund:",
        "e4": "ä",
        "abc": "abc",
        "2024": " $",
        "  ": "",
        "41 4\n2": "AB",
        "41\r": "41\r",
        "41g2": "41g2",
        "": "",
        None: None,
    }
    assert evaluate(list(cases), decode_hex) == list(cases.values())
    assert evaluate(["2024", "42656675"], lambda x: decode_hex(x, min_hex_len=8)) == ["2024", "Befu"]


@relaxed
@given(st.lists(st.text(alphabet=LETTERS, max_size=30), min_size=30))
def test_hex_gives_the_text_back(evaluate, values):
    assert evaluate([v.encode().hex() for v in values], decode_hex) == values
    spaced = [" ".join(f"{b:02X}" for b in v.encode()) + "\n" for v in values]
    assert evaluate(spaced, decode_hex) == values


@relaxed
@given(st.lists(st.text(alphabet=LETTERS, max_size=30), min_size=30))
def test_other_text_is_no_hex(evaluate, values):
    marked = [v + "g" for v in values] + ["0" * (2 * len(v) + 1) for v in values]
    assert evaluate(marked, decode_hex) == marked


@relaxed
@given(st.lists(st.binary(min_size=1, max_size=20), min_size=30))
def test_hex_of_any_bytes(evaluate, values):
    for raw, got in zip(values, evaluate([v.hex() for v in values], decode_hex), strict=True):
        assert raw in (got.encode(), got.encode("latin-1", "replace"))


def test_strip_rtf(evaluate):
    head = r"{\rtf1\ansi\deff0{\fonttbl{\f0 Arial;}{\f1\fnil{\*\falt X}Times;}}{\colortbl;\red0;}"
    cases = {
        head + r"\pard Bef\'fcnd: \u228?\b fett\b0\par Zeile\tab x}": "Befünd: äfett\nZeile\tx",
        head + r"\{a\} C:\\tmp \'80\'93 \u-10179?\u-8704?\line e}": "{a} C:\\tmp €“ 😀\ne",
        head + "ab\ncd\\\nef \\endash  gh\\cell}": "abcd\nef – gh|",
        r"{\rtf1{\info{\title geheim}{\author x}}sichtbar\~da}": "sichtbar\u00a0da",
        "kein rtf {x}": "kein rtf {x}",
        " " * 60 + r"{\rtf1 spaet}": " " * 60 + r"{\rtf1 spaet}",
        r"Kopf {\rtf1 da}": "Kopf da",
        None: None,
    }
    assert evaluate(list(cases), strip_rtf) == list(cases.values())


def test_redact_dates_literals(evaluate):
    cases = {
        "am 15 MÄRZ 2024 da": "am [DATE_REDACTED] da",
        "vom 15. Januar 2024": "vom 15. Januar 2024",
        "H S, geb. 23.08.1960.": "H S, [DATE_REDACTED]].",
        "10.1.2.34": "10.[DATE_REDACTED]",
        "10.1.23.4": "[DATE_REDACTED].4",
        "x1.2.2020": "x1.2.2020",
        "1/2-20": "[DATE_REDACTED]",
        "": "",
        None: None,
    }
    assert evaluate(list(cases), redact_dates) == list(cases.values())
    dotted = evaluate(["vom 15. Januar 2024"], lambda x: redact_dates(x, day_dot_month=True))
    assert dotted == ["vom [DATE_REDACTED]"]


@relaxed
@given(
    st.lists(
        st.lists(
            st.sampled_from(["am ", " 7.3.2021", "30-11-98", " 8 Juni", " 24\u00a0april 1987", "ö", "_", " ", "\n", "²", ".", "y", " und so weiter"]),
            max_size=8,
        ).map("".join),
        min_size=40,
    )
)
def test_redact_dates_random(evaluate, values):
    """No number of a date's shape is left, redaction changes nothing more when repeated, and other text stays."""
    numbers = re.compile(r"(?<![\w])\d{1,2}[./-]\d{1,2}[./-]\d{4}(?![\w])")
    redacted = evaluate(values, redact_dates)
    assert not any(numbers.search(r) for r in redacted)
    assert evaluate(redacted, redact_dates) == redacted
    assert all(r == v for v, r in zip(values, redacted, strict=True) if not re.search(r"\d", v))


def chunk_twin(text, parts, size):
    """Sentences of a text packed one after the other."""
    if not parts:
        return [text.strip()]
    out = [parts[0]]
    for part in parts[1:]:
        if len(out[-1]) + 1 + len(part) <= size:
            out[-1] += " " + part
        else:
            out.append(part)
    return out


@relaxed
@given(texts)
def test_sentences_chunks_random(evaluate, values):
    assert evaluate(values, strip) == [v.strip() for v in values]
    sentences = evaluate(values, split_sentences)
    for text, parts in zip(values, sentences, strict=True):
        assert "".join("".join(parts).split()) == "".join(text.split())
        assert all(p and p == p.strip() and "\n" not in p for p in parts)
        # a sentence holds no end mark before white space, so none could be cut further
        assert not any(a in SENTENCE_ENDS and b.isspace() for p in parts for a, b in zip(p, p[1:], strict=False))
    packed = [chunk_twin(v, p, 12) for v, p in zip(values, sentences, strict=True)]
    assert evaluate(values, lambda x: chunk(x, 12, True)) == packed
    joined = evaluate(values, lambda x: join_chunks(chunk(x, 12, True), strip_each=True))
    assert joined == [" ".join(c.strip() for c in p).replace("  ", " ").strip() for p in packed]


def test_chunk_literals(evaluate):
    assert evaluate(["aa.\nbb.\ncccc\nd"], lambda x: chunk(x, 7, True)) == [["aa. bb.", "cccc d"]]
    assert evaluate(["ein langer satz ohne ende", None, " \n "], lambda x: chunk(x, 5, True)) == [
        ["ein langer satz ohne ende"],
        [""],
        [""],
    ]
    assert evaluate([" a. b ", " a. b  "], lambda x: chunk(x, 6, False)) == [[" a. b "], ["a. b"]]
    triple = evaluate(["x"], lambda x: join_chunks(F.array(x, F.lit("  y"))))
    assert triple == ["x  y"]


def test_long_text_packs_whole(evaluate):
    text = "\n".join(f"satz {i}" for i in range(5000))
    (chunks,) = evaluate([text], lambda x: chunk(x, 40, True))
    assert chunks == chunk_twin(text, text.split("\n"), 40)
    assert len(chunks) > 1000


def ngram_twin(text):
    tokens = re.findall(r"\b\w\w+\b", text.lower())
    return tokens + [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


@relaxed
@given(texts)
def test_ngrams_random(evaluate, values):
    got = evaluate(values, ngrams)
    assert got == [ngram_twin(v) for v in values]
    counted = evaluate(values, lambda x: count_terms(ngrams(x)))
    for terms, value in zip(counted, values):
        twin = ngram_twin(value)
        assert [(t["term"], t["tf"]) for t in terms or []] == sorted(
            ((t, twin.count(t)) for t in set(twin)), key=lambda p: p[0].encode()
        )


@relaxed
@given(texts)
def test_token_spans_random(evaluate, values):
    for spans, value in zip(evaluate(values, token_spans), values):
        twin = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"\w+", value)]
        assert [(s["start"], s["end"], s["token"]) for s in spans] == twin


def test_redact_spans(spark):
    rows = [
        ("ab cdef g", [(0, 2), (5, 7)], "[N] cd[N] g"),
        ("abc", [(2, 99), (-1, 1), (1, 1)], "abc"),
        ("abc", None, "abc"),
        ("abc", [], "abc"),
        ("ä😀b", [(1, 2)], "ä[N]b"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "t string, s array<struct<start:int,end:int>>")
    got = [r.y for r in df.select(redact_spans(F.col("t"), F.col("s"), "[N]").alias("y")).collect()]
    assert got == [r[2] for r in rows]


def test_resolve_spans(spark):
    df = spark.createDataFrame(
        [([(5, 9), (0, 4), (0, 8), (8, 9), (8, 12)],)], "s array<struct<start:int,end:int>>"
    )
    (row,) = df.select(resolve_spans(F.col("s")).alias("y")).collect()
    assert [(s["start"], s["end"]) for s in row.y] == [(0, 8), (8, 12)]


def test_person_labels(evaluate):
    labels = ["PER", "B-PER", "Person", "NAME", "surname", "ORG", "", None]
    assert evaluate(labels, is_person_label) == [True] * 5 + [False] * 3


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [([1.0, 2.0],), ([nan, 1.0],), ([1.0, -inf],), ([],), (None,), ([1.0, None],)]
    df = spark.createDataFrame(rows, "v array<float>")
    assert [r.y for r in df.select(is_finite(F.col("v")).alias("y")).collect()] == [
        True, False, False, True, False, False,
    ]
    one = spark.createDataFrame([([0.0, 3.0], [4.0, 0.0])], "a array<double>, b array<double>")
    row = one.select(distance(F.col("a"), F.col("b")).alias("d"), unit(F.col("a")).alias("u")).first()
    assert row.d == 5.0 and row.u == [0.0, 1.0]


def test_hashing_vectors_without_terms(spark):
    df = spark.createDataFrame([(1, "wort und wort"), (2, "a 1"), (3, None)], "k int, t string")
    got = {r.k: r.embedding for r in hashing_vectors(df, "k", "t", 8).collect()}
    assert got[2] == got[3] == [0.0] * 8
    assert abs(sum(v * v for v in got[1]) - 1) < 1e-6


def test_hashing_vectors_are_counted_once_and_equal_the_model(spark):
    texts = ["Straße straße STRASSE a ß", "one two one two three", "", None, "x", "a1 _b É 数字 ok ok ok", "z" * 3000 + " ab" * 4000]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    vectors = hashing_vectors(df, "k", "t", 64)
    rows = vectors.select("k", F.posexplode("embedding").alias("dim", "value"))
    assert str(rows._jdf.queryExecution().executedPlan()).count("ArrowEvalPython") == 1  # not once more in a filter
    found = {}
    for r in rows.orderBy("k", "dim").collect():
        found.setdefault(r.k, []).append(r.value)
    for k, wanted in enumerate(hashing_model()([t or "" for t in texts])):
        assert found[k] == pytest.approx(wanted, abs=1e-6)


def test_chunks_are_made_once(spark):
    df = spark.createDataFrame([(1, "a. b. c."), (2, ""), (3, None)], "k int, t string")
    chunks = chunk_table(df, chunk(F.col("t"), 4, always=True), "k")
    plan = str(chunks._jdf.queryExecution().optimizedPlan())
    assert not [line for line in plan.splitlines() if "Filter" in line and "split(" in line]
    assert sorted(map(tuple, chunks.collect())) == [(1, 0, "a."), (1, 1, "b."), (1, 2, "c."), (2, 0, ""), (3, 0, "")]
    none = F.when(F.col("k") == 1, F.array(F.lit("x"), F.lit(None)))  # an absent array has no rows, a null chunk has one
    assert sorted(map(tuple, chunk_table(df, none, "k").collect())) == [(1, 0, "x"), (1, 1, None)]
