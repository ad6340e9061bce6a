"""Archives, toxicity, languages, mixing, neighbours and the pipeline on small cases."""

import hashlib
import math
import random
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportloom.llm import language_id, mixing, neighbours, toxicity, warc

SMALL = "/root/testdata/sf0.001"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, kind string")


def test_archives_read_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_ROWS", 3)
    monkeypatch.setattr(warc, "RANGE_ROWS", 8)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2_000)
    rng = random.Random(2)
    rows = [(i, f"http://h{i % 5}.example.org/p{i % 11}", rng.choice(["é" * 60, "y" * 200, "z" * 99, f"own {i} " * 30])) for i in range(90)]
    rows += [(200, None, None), (201, "http://a/\r\nX: y", ""), (202, "http://www.a.org/#f", "q" * 100), (None, "http://n/", "only here" * 20)]
    rng.shuffle(rows)
    index, folder = warc.archive(pages(spark, rows).repartition(6))
    got = warc.read_records(index, folder).collect()
    first = {}
    for page_id, _, html in rows:
        if len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page_id), page_id) if page_id is not None else None
    wanted = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        lead = first.get(html)
        again = html in first and lead != page_id
        wanted.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", lead if again else None, b"" if again else data))
    assert Counter((r[0], r[1], r[2], r[3], r[4], bytes(r["payload"])) for r in got) == Counter(wanted)
    captures = index.orderBy("part", "place").collect()
    keys = [warc.order((r["urlkey"], r["captured"], r["page_id"], r["archive"], r["offset"])) for r in captures]
    assert keys == sorted(keys) and len(keys) == len(rows)
    assert index.select("part").distinct().count() > 1


def test_archives_of_no_rows(spark):
    assert warc.round_trip(pages(spark, [])).count() == 0


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree(runs):
    rng = random.Random(runs)
    parts = [sorted(rng.randrange(20) for _ in range(rng.randrange(9))) for _ in range(runs)]
    merged = list(warc.LoserTree([iter([(x, x) for x in p]) for p in parts]))
    assert merged == sorted(x for p in parts for x in p)


def test_url_keys(spark):
    rows = [("http://www.B.example.org/Path?q=1#top", "org,example,b)/path?q=1"), ("x", "x)"), (None, ")")]
    got = spark.createDataFrame(rows, "url string, key string").select(warc.url_key(F.col("url")).alias("got"), "key")
    assert all(r["got"] == r["key"] for r in got.collect())


TOXIC = ["moronic", "scumbag", "worthless", "disgusting"]


def remarks(seed, count):
    rng = random.Random(seed)
    words = ["".join(rng.choices("aeinorst", k=rng.randint(3, 8))) for _ in range(400)]
    out = []
    for i in range(count):
        text = rng.choices(words, k=rng.randint(20, 200))
        toxic = i % 3 == 0
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(TOXIC)
        out.append((i, " ".join(text), int(toxic)))
    return out


def test_toxicity_on_held_out_rows_and_misspellings(spark):
    rows = remarks(4, 600)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(1000, None, "x"), (1001, "", "x"), (None, "a b", "x")], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    truth = {i: y for i, _, y in rows}
    held = [r for i, r in got.items() if i in truth and r["held_out"]]
    assert len(held) > 100
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    assert got[1000]["score"] == got[1001]["score"] and not got[1000]["predicted"]
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(1, rows[1][1] + " morronic scumbagg")], "doc_id long, text string")
    assert toxicity.score(odd, model).first()["predicted"] == 1


def test_toxicity_learns_no_held_out_label(spark):
    rows = remarks(4, 200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (toxicity.fit(docs, x).embeddings for x in (labels, turned))
    assert np.array_equal(one, other)


def test_toxicity_sample_of_repeated_rows_keeps_its_bound(spark):
    """Copies of rows neither fill the sample nor displace other ids; they count while all of them fit."""
    rows = [r for r in remarks(4, 80) if zlib.crc32(str(r[0]).encode()) % 4 != 2][:40]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    many, more = (reduce(DataFrame.unionAll, [df] * 4) for df in (docs, labels))
    got = toxicity.sample(many, more, rows=40).collect()
    assert sorted((r["doc_id"], r["text"], r["toxic"], r["n"]) for r in got) == sorted((*r, 16) for r in rows)
    assert np.array_equal(toxicity.fit(many, more, rows=40).embeddings, toxicity.fit(docs, labels, rows=40).embeddings)
    other = docs.withColumn("text", F.concat("text", F.lit(" end")))
    assert toxicity.sample(docs.unionAll(other), more, rows=40).count() == 40
    twice = [r for r in sorted(rows) for _ in range(4)]
    assert np.array_equal(toxicity.fit(docs, more).embeddings, toxicity.train([t for _, t, _ in twice], [y for *_, y in twice]).embeddings)


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, none).first()["predicted"] == 0
    assert toxicity.toxicity(docs.limit(0), none).count() == 0


def tongues(count):
    rng = random.Random(8)
    letters = {"xx": "abcde", "yy": "klmno", "zz": "éèßñç"}
    out = []
    for i in range(count):
        lang = rng.choice(list(letters))
        text = " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(30))
        out.append((i, text, lang, f"s{i % 4}"))
    return out


def test_languages(spark):
    rows = tongues(200)
    mute = [(300, None, "xx", "s0"), (301, "", None, None), (302, "!!!", "yy", "s1"), (None, rows[0][1], None, "s9")]
    docs = spark.createDataFrame(rows + mute, "doc_id long, text string, lang string, source string")
    # half of the labels are hidden: those are the held-out texts
    half = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang")))
    pages_ = spark.createDataFrame([(1, "http://a.b.yy/yy/7", '<html lang="yy">'), (2, "ftp", None), (3, None, "x")], "page_id long, url string, html string")
    got = {r["doc_id"]: r for r in language_id.identify(half, pages_).collect()}
    assert all(got[i]["lang_id"] == lang and got[i]["accepted"] for i, _, lang, _ in rows)
    assert not any(got[i]["accepted"] for i in (300, 301, 302)) and got[None]["accepted"]
    kept = language_id.accepted_only(half, pages_)
    assert kept.columns == docs.columns and kept.count() == 201


def test_texts_of_no_known_language_are_rejected(spark):
    rows = tongues(200)
    # one language has a much smaller sample, which must not draw the unknown
    rows = [r for r in rows if r[2] != "zz" or r[0] < 30]
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choices(letters, k=5))
    strange = ["0123456789", "пятьшесо", "我们今天去北京", "uvwxyz", "abcdefghijklmnopqrstuvwxyz0123456789"]
    odd = [(500 + i, " ".join(word(letters) for _ in range(n)), None, "s0") for i, (letters, n) in enumerate((x, n) for x in strange for n in (8, 60))]
    noisy = [(600 + i, f"{text} 0172 555 19.37.233.111", None, "s1") for i, (_, text, _, _) in enumerate(rows[:20])]
    docs = spark.createDataFrame(rows + odd + noisy, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r for r in language_id.identify(docs).collect()}
    assert not [i for i, *_ in odd if got[i]["accepted"]]
    assert all(got[i]["accepted"] and got[i]["lang_id"] == lang for i, _, lang, _ in rows)
    assert all(got[600 + i]["lang_id"] == lang and got[600 + i]["accepted"] for i, (_, _, lang, _) in enumerate(rows[:20]))


def test_sample_has_all_languages_alike(spark):
    assert language_id.quotas({"a": 5, "b": 1000, "c": 90}, 300) == {"a": 5, "b": 205, "c": 90}
    assert language_id.quotas({"a": 5, "b": 1000}, 3) == {"a": 1, "b": 2}


def test_evidence_is_fused_as_by_hand(spark):
    rows = [(1, 3, [0.0, -1.0], "a.b.org", "en"), (2, 5, [-0.2, 0.0], "a.b.org", "de"), (3, 4, [-9.0, 0.0], "c.b.org", None), (4, 0, [0.0, 0.0], None, None)]
    got = {r["i"]: r for r in language_id.fused(spark.createDataFrame(rows, "i int, words int, text_log array<double>, host string, declared string"), ["p", "q"]).collect()}
    total = np.array([1.5, 2.5])
    base = total / total.sum()
    counts = lambda name, value: np.array([float(sum(r[name] == value and r[1] and int(np.argmax(r[2])) == k for r in part)) for k in (0, 1)])
    w = language_id.HOST_WEIGHT
    part = [(*r, r[3] and r[3][-5:], r[3] and "org") for r in rows]
    for r in part:
        seen = [counts(c, r[c]) if r[c] else np.zeros(2) for c in (4, 6, 5, 3)]
        declared, suffix = (np.log((s + w * base) / (s.sum() + w) / base) for s in seen[:2])
        domain = (seen[2] + w * base) / (seen[2].sum() + w)
        host = (seen[3] + w * domain) / (seen[3].sum() + w)
        score = np.array(r[2]) + declared + suffix + np.log(host)
        odds = np.exp(score - score.max())
        assert got[r[0]]["lang_id"] == "pq"[int(score.argmax())]
        assert math.isclose(got[r[0]]["posterior"], odds.max() / odds.sum(), rel_tol=1e-9)


def test_all_pages_of_a_document_count(spark):
    """A page's share of its document is the same for all of them, whatever their order or the case of their scheme."""
    schema = "page_id long, url string, html string"
    rows = [(1, "HTTPS://A.b.xx/xx/7?q", '<HTML LANG="XX">'.lower()), (2, "http://c.d.yy/7", None), (2, "http://c.d.yy/7", None),
            (3, "http://c.d.yy/7", None), (None, "http://x.org/8", "<html>"), (4, "http://x.org/none", None), (5, None, None)]
    got = sorted((r.doc_id, r.host, r.declared, r.weight) for r in language_id.page_evidence(spark.createDataFrame(rows, schema)).collect())
    one = language_id.ONE
    assert got == [(7, "a.b.xx", "xx", one // 4), (7, "c.d.yy", None, one * 3 // 4), (8, "x.org", None, one)]


def test_pages_are_fused_as_by_hand(spark):
    """Rows of one id share their places; a row without a page has its source."""
    texts = [(1, "s", 3, [0.0, -1.0]), (1, "t", 2, [-2.0, 0.0]), (2, "s", 5, [-0.2, 0.0]), (None, None, 1, [0.0, -3.0]), (3, "s", 0, [0.0, 0.0])]
    places = [(1, "a.b.org", "en", 3), (1, "c.org", None, 1), (2, "a.b.org", None, 4)]
    one = language_id.ONE
    docs = spark.createDataFrame(texts, "doc_id long, source string, words int, text_log array<double>")
    pages_ = spark.createDataFrame([(*p[:3], p[3] * one // 4) for p in places], "doc_id long, host string, declared string, weight long")
    got = language_id.fused_with_pages(docs, pages_, ["p", "q"]).collect()
    assert len(got) == len(texts)
    where = lambda i, s: [p[1:] for p in places if p[0] == i] or [(s, None, 4)]
    parts = lambda host: (host, host and "." in host and ".".join(host.split(".")[-2:]) or None, host and "." in host and host.split(".")[-1] or None)
    seen = [(*parts(h), d, int(np.argmax(t)), w / 4) for i, s, n, t in texts if n for h, d, w in where(i, s)]
    total = np.array([sum(x[5] for x in seen if x[4] == k) for k in (0, 1)]) + language_id.SMOOTHING
    base, w0 = total / total.sum(), language_id.HOST_WEIGHT
    counts = lambda at, value: np.array([sum(x[5] for x in seen if value and x[at] == value and x[4] == k) for k in (0, 1)])

    def said(host, declared):
        h, domain, suffix = parts(host)
        out = sum(np.log((c + w0 * base) / (c.sum() + w0) / base) for c in (counts(3, declared), counts(2, suffix)))
        by_domain = (counts(1, domain) + w0 * base) / (counts(1, domain).sum() + w0)
        return out + np.log((counts(0, h) + w0 * by_domain) / (counts(0, h).sum() + w0))

    wanted = []
    for i, s, _, text_log in texts:
        score = np.array(text_log) + sum(w / 4 * said(h, d) for h, d, w in where(i, s))
        odds = np.exp(score - score.max())
        wanted.append((str(i), str(s), "pq"[int(score.argmax())], round(odds.max() / odds.sum(), 6)))
    assert sorted((str(r.doc_id), str(r.source), r.lang_id, round(r.posterior, 6)) for r in got) == sorted(wanted)


def test_many_rows_and_pages_of_one_id_are_not_paired(spark):
    docs = spark.range(3_000).selectExpr("7L AS doc_id", "'s' AS source", "3 AS words", "array(0D, -1D) AS text_log")
    pages_ = spark.range(3_000).selectExpr("7L AS doc_id", "concat('h', id, '.org') AS host", "CAST(NULL AS STRING) AS declared", "300L AS weight")
    got = language_id.fused_with_pages(docs, pages_, ["p", "q"])
    assert got.count() == 3_000 and got.select("lang_id", "posterior").distinct().count() == 1


def test_languages_of_no_rows_or_labels(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert language_id.identify(empty).count() == 0
    bare = spark.createDataFrame([(1, "a b", None, None)], empty.schema)
    assert [(r["lang_id"], r["accepted"]) for r in language_id.identify(bare).collect()] == [(None, False)]


def mix_twin(rows):
    sizes = [(i, s, len(mixing_words(t))) for i, t, s in rows]
    sources = sorted({s for _, s, _ in sizes}, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    total = {s: sum(n for _, x, n in sizes if x == s) for s in sources}
    target, free = {s: 0.0 for s in sources}, list(sources)
    left = sum(total.values())
    while free:
        rate = left / sum(weight[s] for s in free)
        over = [s for s in free if 3 * total[s] <= rate * weight[s]]
        if not over:
            target |= {s: rate * weight[s] for s in free}
            break
        for s in over:
            target[s] = 3.0 * total[s]
            left -= 3 * total[s]
            free.remove(s)
    return sizes, total, target


def mixing_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_mix_against_brute_force(spark):
    rng = random.Random(6)
    big = {"a": 300, "b": 10, "c": 60, None: 40, "é": 1}
    rows = []
    for s, n in big.items():
        rows += [(len(rows) + i, "w " * rng.randint(0, 30), s) for i in range(n)]
    rows += [(9_000, None, "a"), (9_001, " x", "empty?"), (9_001, " x", "empty?"), (None, "a b", "b"), (9_002, "", "only empty")]
    got = mixing.mix(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")).collect()
    sizes, total, target = mix_twin(rows)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter(sizes)
    for s in total:
        own = [r for r in got if r["source"] == s]
        assert all(math.isclose(r["target"], target[s], rel_tol=1e-9, abs_tol=1e-9) and r["source_size"] == total[s] for r in own)
        largest = max((r["size"] for r in own), default=0)
        assert abs(sum(r["taken"] for r in own) - target[s]) <= 2 * largest + 1e-6
    assert all(r["taken"] <= 3 * r["size"] and (r["taken"] == 0 or r["taken"] % r["size"] == 0) for r in got)


def test_mixed_rows_follow_the_plan(spark):
    rows = [(i, "w " * (i % 7), "ab"[i % 5 == 0], "x") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["size"]}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["doc_id"] for r in mixed.collect()) == Counter({i: n for i, n in taken.items() if n})


def test_mix_of_no_rows_and_plan_without_python(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    out = mixing.mix(docs)
    assert out.count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def nearest_twin(rows, k, every):
    good = [(n, i, v) for n, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, q, v in good:
        if q % every == 0:
            near = sorted((math.dist(v, w), i) for m, i, w in good if m != n and len(w) == len(v))[:k]
            out += [(q, rank, i, d) for rank, (d, i) in enumerate(near, 1)]
    return sorted(out)


def test_neighbours_in_full(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(120)]
    rows += [(i, rows[10][1]) for i in range(200, 240)] + [(300, [0.0] * 6), (310, None), (320, [1.0, None] * 3), (330, [float("nan")] * 6)]
    rows += [(340, [float("inf")] * 6), (350, [1.0, 2.0]), (351, [2.0, 2.0]), (360, [7.0]), (20, rows[20][1]), (None, rows[1][1]), (370, [])]
    vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, rank int")
    got = sorted(map(tuple, neighbours.nearest(vectors, k=5, every=10).collect()))
    wanted = nearest_twin(rows, 5, 10)
    assert [r[:3] for r in got] == [r[:3] for r in wanted]
    assert np.allclose([r[3] for r in got], [r[3] for r in wanted], rtol=1e-12)


def test_neighbours_recall(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 1_000)
    data = np.random.default_rng(2).standard_normal((4_000, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), every=100).collect()
    found = {(r["query_id"], r["vec_id"]) for r in got}
    wanted = {r[::2] for r in nearest_twin(rows, 10, 100)}
    assert len(got) == 400 and len(found & wanted) >= 0.9 * len(wanted)


def test_forest_leaves_candidates_out():
    data = np.random.default_rng(2).standard_normal((2_000, 32))
    seen = neighbours.Forest(data).candidates(data[:20], 300)
    assert (seen.sum(axis=1) >= 300).all() and seen.mean() < 0.6 and seen[np.arange(20), np.arange(20)].all()


def test_neighbours_of_no_rows(spark):
    assert neighbours.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_pipeline_stage_by_stage(spark):
    import corpus_pipeline
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    outs = []
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, SMALL), "stage")
        outs.append(docs)
    assert all(o.columns == columns for o in outs[:-1])
    counts = [o.count() for o in outs]
    assert counts[0] == 200 and counts[1] == counts[0] and 0 < counts[2] <= counts[1] and counts[4] == counts[3] > 0
    texts = {r["doc_id"]: r["text"] for r in outs[3].collect()}
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for row in outs[4].collect():
        assert row["decodes"] and row["ids"] == library.encode(texts[row["doc_id"]])
