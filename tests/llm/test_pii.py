"""Personal data: base rules against plain regular expressions, boosted candidates on held-out forms."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import boosting, pii

DATA = "/root/testdata/sf0.1/documents.parquet"


def check_digit_holds(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        value = int(c) * (1 + i % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """The base rules as they are stated, by whole-text matching."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.group().split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and check_digit_holds(digits(m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    ]
    return sorted((m.start(), m.end(), k) for k, (rule, holds) in enumerate(rules) for m in re.finditer(rule, text) if holds(m))


def base(text: str) -> list[tuple[int, int, int]]:
    return sorted(pii.base_matches(text, pii.zones(text))[0])


@settings(max_examples=500, deadline=None)
@given(st.text("0123456789. -+@()ab_%\nü", max_size=60))
def test_base_rules(text):
    assert base(text) == plain_spans(text)


def test_base_rules_on_examples():
    for text in ["a@b@c.de.f", "x..y@z-1.example.com, 1.2.3.4.5.6.7.8.9", "4111 1111-1111 1111 and +49 (30) 1234-567 8", "1.2.3.999 300.1.1.1", "@a.b +1", "٣.1.2.3.4²"]:
        assert base(text) == plain_spans(text)


def test_base_rules_on_hard_long_texts():
    """Long runs of one character take time in proportion to their length."""
    for text in ["a" * 300_000 + "@", "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 100_000]:
        base(text)
        pii.candidates(text, pii.zones(text), [])


@pytest.fixture(scope="module")
def detector(spark):
    return pii.fit(spark.read.parquet(DATA))


FORMS = [
    ("please write to jane.doe at example dot org soon", "email", "jane.doe at example dot org"),
    ("my mail: tom_1 [at] mail.example.net thanks", "email", "tom_1 [at] mail.example.net"),
    ("the host 10[.]20[.]30[.]40 is down", "ip", "10[.]20[.]30[.]40"),
    ("paid by card 4111.1111.1111.1111 today", "card", "4111.1111.1111.1111"),
    ("please call (415) 555-2671 today", "phone", "(415) 555-2671"),
    ("tel: 030-555-2671 or later", "phone", "030-555-2671"),
]
CLEAN = [
    "On 2024-05-17 and on 12/05/2021 we met at home. The dog was there.",
    "From 1990-1995 the number rose to 1.234.567, that is 12,345 more, at 10:30.",
    "Version 3.12.1 of the order 4111.1111.1111.1112 is out", "Look at this. It is 16 m long", "", "plain words only",
]


def test_looser_forms_are_found_and_clean_texts_left_alone(detector):
    for text, kind, value in FORMS:
        ((found, more),) = pii.spans_of([text], detector)
        assert found == [] and [(pii.KINDS[k], text[s:e]) for s, e, k in more] == [(kind, value)]
    for text in CLEAN:
        assert pii.spans_of([text], detector) == [([], [])]


def test_scores_on_folds_that_were_not_learned(spark):
    """Trees and thresholds of two thirds of the texts on the last third."""
    texts = [r.text for r in spark.read.parquet(DATA).select("text").distinct().orderBy("text").collect() if r.text and len(r.text) < 20_000]
    made = [(i % 4, *e) for i, t in enumerate(texts) if re.search("[0-9@]", t) for e in pii.examples(t)]
    fold, values, labels = (np.array(x) for x in zip(*made, strict=True))
    own = fold < 3
    model = pii.learned(values[own], labels[own].astype(float), fold[own])
    scores = model.trees.scores(values[~own])
    passed = scores >= model.thresholds[values[~own, 0].astype(int)]
    assert labels[~own][passed].mean() > 0.95
    assert passed[labels[~own] == 1].mean() > 0.8


def test_rows_of_personal_data(spark, detector):
    """Null, empty and very long texts, repeated rows and ids, characters beyond the basic plane, clashing columns."""
    rows = [(1, None), (1, ""), (None, "😀 a.b@c.de 😀 1.2.3.4"), (2, "x " * 200_000 + "4111 1111 1111 1111"), (3, FORMS[4][0]), (3, FORMS[4][0]), (4, CLEAN[0])]
    rows += [(5, "see +1 (415) 555-2671 192.168.1.1 end")]  # a phone number that swallows an address
    docs = spark.createDataFrame([(*r, "q", 7) for r in rows], "doc_id long, text string, spans string, n_email int")
    got = pii.find_pii(docs, detector).collect()
    assert len(got) == len(rows)
    by_text = {r.spans: r for r in got}
    for doc_id, text in rows:
        own = plain_spans(text or "")
        listed = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, e, k in sorted(own, key=lambda x: (x[0], x[2])))
        match = [r for r in got if r.doc_id == doc_id and r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()]
        assert match and [match[0][f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == i for s in own) for i in range(4)]
        assert set(listed.split(",")) <= set(match[0].spans.split(",")) or not own
    assert by_text["email:2:10,ip:13:20"].redacted == "😀 [EMAIL] 😀 [IP]"
    assert by_text["phone:12:26"].redacted == "please call [PHONE] today"
    assert pii.personal_data(docs.limit(0)).collect() == []
    assert {r.spans for r in pii.personal_data(spark.createDataFrame([(1, "no data"), (2, "a@b.cd")], "doc_id long, text string")).collect()} == {"", "email:0:6"}


def test_trees_learn_and_thresholds_are_calibrated():
    rng = np.random.default_rng(3)
    values = rng.random((4_000, 5))
    labels = ((values[:, 0] > 0.5) & (values[:, 3] < 0.7)).astype(float)
    noisy = np.where(rng.random(4_000) < 0.02, 1 - labels, labels)
    trees = boosting.fit(values[:3_000], noisy[:3_000])
    scores = trees.scores(values[3_000:])
    assert ((scores > 0.5) == labels[3_000:]).mean() > 0.97
    points, shares = boosting.calibrated(scores, noisy[3_000:])
    assert (np.diff(points) > 0).all() and (np.diff(shares) >= -1e-12).all()
    limit = boosting.threshold(scores, noisy[3_000:], 0.9, 20)
    assert noisy[3_000:][scores >= limit].mean() >= 0.9
    assert boosting.threshold(scores, np.zeros(1_000), 0.9, 1) == float("inf")
    assert boosting.fit(values, np.zeros(4_000)).scores(values[:2]).max() < 0.01
    assert boosting.fit(values[:0], labels[:0]).scores(values[:2]).shape == (2,)
