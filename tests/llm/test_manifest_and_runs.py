"""Merkle manifest and periodic runs on small cases, against plain versions of both."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reportloom.llm import merkle, runs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(digests: list[str]) -> list[list[str]]:
    levels = [digests]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def steps_of(levels: list[list[str]], at: int) -> list[str]:
    steps = []
    for level in levels[:-1]:
        other = at ^ 1
        steps.append("" if other >= len(level) else ("L" if at % 2 else "R") + level[other])
        at //= 2
    return steps


def fold(digest: str, steps: list[str]) -> str:
    for s in steps:
        digest = sha(s[1:], digest) if s[:1] == "L" else sha(digest, s[1:])
    return digest


def leaf(doc_id, source, lang, n_chars, text) -> str:
    coded = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)]
    return sha(*coded)


def plain_manifest(rows: list[tuple]) -> list[tuple]:
    """``doc_id, leaf, subroot, root, proof, folded root, verified`` by whole trees held in memory."""
    by_lang: dict = {}
    for doc_id, text, lang, source, n_chars in rows:
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0
        other = None if n_chars is None else n_chars + hit
        entry = (doc_id is not None, doc_id or 0, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, other, text), doc_id)
        by_lang.setdefault(lang, []).append(entry)
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: levels_of([e[2] for e in sorted(by_lang[x], key=lambda e: e[:4])]) for x in langs}
    top = levels_of([trees[x][-1][0] for x in langs])
    out = []
    for j, lang in enumerate(langs):
        for i, (_, _, own, given_, doc_id) in enumerate(sorted(by_lang[lang], key=lambda e: e[:4])):
            steps = steps_of(trees[lang], i) + steps_of(top, j)
            root = fold(given_, steps)
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], sha(*[s[1:] for s in steps]), root, root == top[-1][0]))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("count", [1, 2, 3, 5, 8, 13, 64, 65])
def test_appends_complete_the_same_tree(count):
    digests = [sha(str(i)) for i in range(count)]
    levels = levels_of(digests)
    root, steps = merkle.subtree(digests)
    assert root == levels[-1][0]
    assert steps == [steps_of(levels, i) for i in range(count)]


@pytest.mark.parametrize("block", [2, 4, 1024])
def test_manifest_equals_whole_trees(spark, block):
    rows = [(i, f"text {i}", ["en", "de", None, "ä"][i % 4 if i % 5 else 0], f"s{i % 3}", 10 * i) for i in range(1, 40)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = merkle.manifest(docs, block=block).select("doc_id", "leaf", "subroot", "root", "steps").collect()
    want = {r[0]: r for r in plain_manifest(rows)}
    assert len(got) == len(rows)
    for r in got:
        assert (r.leaf, r.subroot, r.root) == want[r.doc_id][1:4]
        assert sha(*[s[1:] for s in r.steps]) == want[r.doc_id][4]
        assert fold(r.leaf, r.steps) == r.root


def test_manifest_of_odd_rows(spark):
    """Null fields and ids, empty and long texts, repeated rows and ids, one lone language, clashing columns."""
    rows = [
        (None, None, None, None, None), (None, "", "", "", 0), (7, "x" * 200_000, "en", "a", 5), (7, "y", "en", "a", 5), (7, "y", "en", "a", 5),
        (10, "ü", "fr", None, None), *[(i, "same", "en", "a", 4) for i in range(20, 40)],
    ]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], f"{DOCS}, index int, steps string")
    got = merkle.verified_manifest(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert in_order(got.collect()) == in_order(plain_manifest(rows))
    assert {r.verified for r in got.collect()} == {True, False}  # tampered rows are told


def test_manifest_of_nothing_and_of_one(spark):
    assert merkle.verified_manifest(spark.createDataFrame([], DOCS)).collect() == []
    one = [(3, "t", "en", "s", 1)]
    (row,) = merkle.verified_manifest(spark.createDataFrame(one, DOCS)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha("") and row.verified


def plain_runs(words, least=6, repeats=4):
    found = set()
    for q in range(1, len(words) // repeats + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            part = words[i : j + q]
            smaller = any(part[p:] == part[:-p] for p in range(1, q))
            if j > i and len(part) >= max(least, repeats * q) and not smaller:
                found.add((i, len(part), q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


blocks = st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=5), st.integers(1, 9)), max_size=8)


@settings(max_examples=300, deadline=None)
@given(blocks)
def test_runs_equal_a_look_at_every_period(parts):
    words = [w for block, times in parts for w in block * times]
    assert runs.find_runs(np.array(words, np.int64)) == plain_runs(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=40))
def test_lyndon_lengths_of_both_orders(words):
    ranks = np.unique(words, return_inverse=True)[1]
    for order in (ranks, ranks.max() - ranks):
        plain, text = [], order.tolist()
        for i in range(len(text)):
            plain.append(next((j for j in range(i + 1, len(text)) if text[j:] < text[i:]), len(text)) - i)
        assert runs.lyndon_lengths(order).tolist() == plain


def plain_row(doc_id, text, planted):
    words = [w for w in (text or "").translate({c: " " for c in range(9, 14)}).split(" ") if w]
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if planted and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    found = plain_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(lines), sha(kept))


def test_rows_of_runs(spark):
    """Null, empty, blank, very long and repeated texts, null ids, other white space, clashing columns."""
    odd = "a b c d " * 3
    texts = [None, "", " \t\n", "word", "ha " * 6, "ha " * 5, "x y " * 4 + "x", "p q\x0br\x0c" * 6 + "tail", odd, "a b a b a b a b b b b b b b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no no no no no no no"), (4, "ha " * 6)]
    rows += [(i, " ".join(f"w{(i * 7 + j) % 23}" for j in range(40))) for i in range(20, 60)]  # some are made periodic
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, period int")
    for planted in (False, True):
        got = runs.periodic_runs(docs, planted=planted).collect()
        assert in_order(got) == in_order(plain_row(*r, planted) for r in rows)
    long = spark.createDataFrame([(1, "one two three " * 60_000 + "end")], "doc_id long, text string")
    (row,) = runs.periodic_runs(long).collect()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (1, 0, 180_000, 3, 60_000_000)
    assert row.collapsed_sha256 == sha("one two three end")
    assert runs.periodic_runs(docs.limit(0)).collect() == []


def test_runs_of_three_repeats_and_no_fewer():
    words = np.array([0, 1, 0, 1, 0, 1, 2], np.int64)
    assert runs.find_runs(words, 3, 3) == [(0, 6, 2)]
    with pytest.raises(ValueError):
        runs.find_runs(words, 2, 2)
