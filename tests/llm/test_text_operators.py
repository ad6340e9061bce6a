"""SentencePiece, token files, exact and near duplicates, lines: small cases against brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from reportloom.llm import exact_dedup, line_dedup, ngram_join, sentencepiece, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "  two  spaces ", "a", "a\n\nb\n", "▁x▁", "<s> <0x41>", "漢字 😀 ç\x00", "na" * 4000, "the the the"]


def frame(spark, texts, first=0, **extra):
    rows = [(first + i, t, *extra.values()) for i, t in enumerate(texts)]
    kinds = "".join(f", {k} string" for k in extra)
    return spark.createDataFrame(rows, f"doc_id long, text string{kinds}")


def prose(seed, count, words=60):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(200)]
    return [" ".join(rng.choices(vocabulary, k=words)) for _ in range(count)]


def test_sentencepiece_equals_the_library(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices("the and\n▁ç漢0 ", k=rng.randint(1, 40))) for _ in range(300)]
    rows = frame(spark, texts, ids="clash").select("doc_id", "text", sentencepiece.encode_column(F.col("text"), PIECES).alias("ids"))
    rows = rows.withColumn("back", sentencepiece.decode_column(F.col("ids"), PIECES))
    for row in rows.collect():
        wanted = library.encode(row["text"] or "")
        assert row["ids"] == wanted
        assert row["back"] == library.decode(wanted)


def test_sentencepiece_of_no_rows(spark):
    assert frame(spark, []).select(sentencepiece.encode_column(F.col("text"), PIECES)).count() == 0


def test_token_files_read_back(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    texts = [*ODD, "it's  fine\n then", "<|endoftext|> x", "x" * 3000, "Ünïcode, words; end"]
    rows = frame(spark, texts, first=5, start="clash").repartition(5).unionByName(frame(spark, ["a tie"], first=7, start="x"))
    manifest = token_files.write_shards(rows, BYTES)
    got = sorted(token_files.read_shards(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted([*range(5, 5 + len(texts)), 7])
    before = 0
    for row in got:
        assert row["start"] == before
        before += row["n_tokens"]
        text = [texts[row["doc_id"] - 5] or ""] + (["a tie"] if row["doc_id"] == 7 else [])
        ids = [[*library.encode(t, add_special_tokens=False).ids, 2] for t in text]
        assert (row["n_tokens"], row["ids_crc32"]) in [(len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in ids]
    wanted = spark.createDataFrame([(6,), (999,)], "doc_id long")
    fetched = token_files.fetch(spark, manifest, wanted).collect()
    assert [(r["doc_id"], r["ids"]) for r in fetched] == [(6, [2])]


def test_token_files_of_no_rows_and_null_ids(spark):
    assert token_files.token_files(frame(spark, []), BYTES).count() == 0
    rows = spark.createDataFrame([(None, "a b"), (1, None)], "doc_id long, text string")
    got = token_files.token_files(rows, BYTES).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in got] == [(None, 3), (1, 1)]


def test_damaged_frames_are_found(tmp_path):
    from pyarrow import fs

    path = str(tmp_path / "x.zst")
    with open(path, "wb") as out:
        token_files.write_shard(out, iter([(1, np.arange(50, dtype=np.int32)), (2, np.arange(9, dtype=np.int32))]))
    data = bytearray(open(path, "rb").read())
    assert token_files.ShardReader(fs.LocalFileSystem().open_input_file(path)).ids(1).tolist() == list(range(9))
    data[12] ^= 0xFF
    open(path, "wb").write(data)
    reader = token_files.ShardReader(fs.LocalFileSystem().open_input_file(path))
    assert reader.ids(1).tolist() == list(range(9))
    with pytest.raises(Exception):  # noqa: B017 - the library's or our own error
        reader.ids(0)


def exact_twin(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return Counter(out)


@pytest.mark.parametrize("bits", [None, 3])
def test_exact_groups(spark, monkeypatch, bits):
    """Also with fingerprints so short that different texts collide."""
    if bits:
        plain = exact_dedup.fingerprints
        monkeypatch.setattr(exact_dedup, "fingerprints", lambda d: plain(d).withColumns(
            {"h0": F.col("h0") % bits, "h1": F.lit(0).cast("long")}))
    long = "lorem ipsum é " * 12_000
    texts = [None, "", "a", "a", "b", long, long, long[:-1] + "x", "a ", "B", *"cdefgbbc", *["many"] * 30]
    rows = [*enumerate(texts), (3, "a"), (None, "b"), (None, "only"), (40, None)]
    got = exact_dedup.exact_groups(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, keep_id string"))
    assert Counter(map(tuple, got.collect())) == exact_twin(rows)


def test_exact_groups_of_no_rows(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


def test_chunk_hashes_compose():
    data = np.random.default_rng(1).integers(0, 256, 5_000).astype(np.uint8)
    for base, prime in zip(exact_dedup.BASES, exact_dedup.PRIMES, strict=True):
        powers = exact_dedup.power_table(5_000, base, prime)
        whole = lambda part: int((part[::-1].astype(np.uint64) + np.uint64(1)) @ powers[: len(part)]) % prime  # noqa: B023, E731
        a, b = data[:1_234], data[1_234:]
        assert whole(data) == (whole(a) * pow(base, len(b), prime) + whole(b)) % prime


def near_twin(rows, similarity=0.8, width=5):
    sets = []
    for _, text in rows:
        words = (text or "").split()
        k = min(width, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set())
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(root(i), []).append(i)
    return Counter(
        (rows[i][0], min(rows[j][0] for j in members[root(i)]), links[i], len(members[root(i)])) for i in range(len(rows))
    )


@pytest.mark.parametrize("block", [256, 3])
def test_near_duplicates(spark, monkeypatch, block):
    """Also with blocks so small that groups take many of them."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    rng = random.Random(9)
    base = prose(1, 12)
    texts = [*base, base[0], base[0], None, "", " ", "one two", "one two", "one", "x " * 500]
    for text in base[:6]:
        words = text.split()
        for _ in range(4):
            words = list(words)
            words[rng.randrange(len(words))] = f"new{rng.random()}"
            texts.append(" ".join(words))
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(1000, base[0])]
    frame_ = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, links string").repartition(4)
    got = ngram_join.near_duplicates(frame_)
    assert Counter(map(tuple, got.collect())) == near_twin(rows)
    kept = {r["doc_id"] for r in ngram_join.one_of_each(frame_).select("doc_id").collect()}
    assert kept == {c for _, c, _, _ in near_twin(rows)}


def test_near_duplicates_of_repeated_ids(spark):
    """The smallest id of a member is repeated, with its own text and with others."""
    a, b, c = prose(2, 3)
    near_a, near_b = a + " new", b + " new"
    rows = [(7, a), (7, a), (9, near_a), (1, b), (1, c), (2, near_b), (3, c + " new")]
    got = ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == near_twin(rows)


def test_shingles_do_not_depend_on_kept_words(monkeypatch):
    from reportloom.llm import grams

    texts = prose(3, 20)
    plain = ngram_join.Shingler(5)
    wanted = [plain.of(t).tolist() for t in texts]
    monkeypatch.setattr(grams, "KEPT_WORDS", 20)
    forgetful = ngram_join.Shingler(5)
    assert [forgetful.of(t).tolist() for t in texts] == wanted


def test_near_duplicates_of_no_rows(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    assert ngram_join.near_duplicates(frame(spark, [None, ""])).count() == 2


def test_forest_depth_meets_its_target():
    depth = ngram_join.depth_for(0.8)
    assert 1 - (1 - 0.8**depth) ** ngram_join.TREES >= ngram_join.TARGET_RECALL
    assert ngram_join.depth_for(0.99) >= depth >= ngram_join.depth_for(0.5)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("threshold", [1, 2, 3])
def test_banded_distance(spark, threshold):
    rng = random.Random(threshold)
    pairs = [("", ""), ("", "a"), ("abc", ""), ("é😀x", "é😀"), ("kitten", "sitting")]
    for _ in range(300):
        a = "".join(rng.choices("abc", k=rng.randint(0, 12)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            b.insert(rng.randint(0, len(b)), rng.choice("abc")) if rng.random() < 0.5 or not b else b.pop(rng.randrange(len(b)))
        pairs.append((a, "".join(b)))
    rows = spark.createDataFrame(pairs, "a string, b string").withColumn("near", line_dedup.within(F.col("a"), F.col("b"), threshold))
    for row in rows.collect():
        assert row["near"] == (distance(row["a"], row["b"]) <= threshold), row


def lines_twin(rows, threshold, least):
    first, owner = {}, {}
    for doc_id, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            if line:
                first[line] = min(first.get(line, (doc_id, n)), (doc_id, n))
    for line, (doc_id, _) in first.items():
        owner[line] = (doc_id, line)
    near = {
        a for a in first for b in first
        if len(a) >= least and len(b) >= least and owner[b] < owner[a] and distance(a, b) <= threshold
    }
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for n, x in enumerate(lines) if not x or (x not in near and (doc_id, n) == first[x])]
        out.append((doc_id, "\n".join(kept) if text is not None else None, len(lines) - len(kept) if text is not None else 0))
    return Counter(out)


@pytest.mark.parametrize("threshold", [1, 2])
def test_lines_against_brute_force(spark, threshold):
    rng = random.Random(5)
    pool = ["".join(rng.choices("abcdé ", k=rng.randint(8, 30))) for _ in range(40)]
    for line in list(pool):
        for _ in range(2):
            other = list(line)
            for _ in range(rng.randint(1, 3)):
                other[rng.randrange(len(other))] = rng.choice(["", "x", "yz"])
            pool.append("".join(other))
    texts = ["\n".join(rng.choices(pool, k=rng.randint(1, 6))) for _ in range(60)] + [None, "", "\n\n", "same\nsame"]
    rows = list(enumerate(texts))
    got = line_dedup.dedup_lines(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, dropped string"), ((12, threshold),))
    assert got.columns == ["doc_id", "text", "dropped", "line_count", "dropped_count"]
    assert Counter((r["doc_id"], r["text"], r["dropped_count"]) for r in got.collect()) == lines_twin(rows, threshold, 12)


def test_lines_by_length_against_brute_force(spark):
    """Thresholds of several lengths, pairs across their bounds, one word replaced."""
    rng = random.Random(6)
    classes = ((12, 1), (18, 2), (26, 4))
    pool = ["".join(rng.choices("abcdé ", k=rng.randint(8, 36))) for _ in range(40)]
    for line in list(pool):
        for _ in range(3):
            other = list(line)
            for _ in range(rng.randint(1, 5)):
                other[rng.randrange(len(other))] = rng.choice(["", "x", "yz"])
            pool.append("".join(other))
    rows = list(enumerate("\n".join(rng.choices(pool, k=rng.randint(1, 6))) for _ in range(80)))
    first = {}
    for n, text in rows:
        for line in text.split("\n"):
            first.setdefault(line, n)
    bound = lambda size: max([t for least, t in classes if size >= least], default=-1)
    near = {a for a in first for b in first if (first[b], b) < (first[a], a) and distance(a, b) <= bound(min(len(a), len(b)))}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {bytes(r["line_key"]) for r in line_dedup.near_lines(docs, classes).collect()}
    assert near and got == {hashlib.md5(line.encode()).digest() for line in near}


def test_long_lines_across_bands_against_brute_force(spark):
    """Lines that are close and on both sides of a band's bound; a line has few probes, whatever its length."""
    rng = random.Random(7)
    classes = ((12, 1), (18, 2))
    pool = ["".join(rng.choices("abcdé ", k=size)) for size in (36, 39, 40, 47, 48, 56, 63, 64, 65, 79, 80, 81, 96)]
    for line in list(pool):
        for _ in range(4):
            other = list(line)
            for _ in range(rng.randint(1, 3)):
                other[rng.randrange(len(other))] = rng.choice(["", "x", "yz"])
            pool.append("".join(other))
    rows = list(enumerate(pool))
    got = line_dedup.dedup_lines(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, dropped string"), classes)
    near = {n for n, a in rows for m, b in rows if m < n and distance(a, b) <= 2}
    assert near and {r["doc_id"] for r in got.filter("dropped_count > 0").collect()} == near

    lines = frame(spark, [prose(1, 1, 80)[0]]).select(F.unhex(F.md5("text")).alias("line_key"), F.char_length("text").alias("chars"), F.encode("text", "UTF-32").alias("wide"))
    assert line_dedup.probes(lines, line_dedup.BY_LENGTH).count() <= 30 + 37  # were 121: 30 of its own band, 37 if another one is in reach


def test_language_model_gets_texts_in_small_batches(spark):
    from reportloom.session import BATCH_CONF, arrow_batches

    before = spark.conf.get(BATCH_CONF)
    sizes = lambda batches: ([batch.slice(0, 0)] if batch.num_rows <= 1_000 else [batch] for batch in batches)
    with arrow_batches(spark, 1_000):
        assert spark.range(0, 3_000, 1, 1).mapInArrow(lambda bs: (b for one in sizes(bs) for b in one), "id long").count() == 0
    assert spark.conf.get(BATCH_CONF) == before


def test_pipeline_drops_a_line_with_one_word_replaced(spark):
    import corpus_pipeline

    line = "the committee agreed to publish all figures of the quarter {} before the end of June"
    texts = [line.format("report"), line.format("survey"), "twenty-four letters 1234", "twenty-four letters 1243"]
    got = corpus_pipeline.new_lines(spark, frame(spark, texts, lang="en", source="s").withColumn("n_chars", F.lit(0)), "")
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {0: texts[0], 1: "", 2: texts[2], 3: ""}


def test_lines_of_no_rows_and_null_ids(spark):
    assert line_dedup.dedup_lines(frame(spark, [])).count() == 0
    rows = spark.createDataFrame([(None, "one\ntwo"), (1, "two\nthree"), (1, "two\nthree")], "doc_id long, text string")
    got = line_dedup.dedup_lines(rows)
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got.collect()) == [(0, "one\ntwo"), (1, "three"), (1, "three")]


def test_lines_plan_has_no_python(spark):
    plan = line_dedup.dedup_lines(frame(spark, ["a\nb"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
