"""Language identification by Bayesian fusion of text, markup, address and host evidence.

The text's likelihood is that of its words' character n-grams in each language, counted on a
bounded sample of labelled texts. The declared markup language and the address suffix are
likelihoods too, and the host is a prior; all three are counted over all documents by grouped
aggregation, with the language that the text alone suggests. Hosts with few documents lean
on their domain, domains on the whole.

"None of these" is a class of its own: its likelihood of a word lies a fixed gap below what
held-out texts of the best language have on average. An n-gram that a language has not been
seen with is equally likely in all languages, whatever the sizes of their samples.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import arrow_batches, materialize
from .grams import WordValues, word_grams, words_of

BATCH_ROWS = 1_000  # texts that a Python worker gets at once
SAMPLE_ROWS = 4_000  # labelled texts that the n-gram counts come from, at most
SAMPLE_CHARS = 20_000  # longer texts are not counted; all are classified whole
GRAMS = (2, 3)
BUCKETS = 1 << 16
TEXT_WORDS = 24  # the words of a text weigh no more than this many independent ones
PORTION_WORDS = 20_000  # words whose n-grams are in memory at once
SMOOTHING = 0.5
UNSEEN = 0.1  # share of a language's probability that is spread over all n-grams alike
NONE_GAP = 2.5  # a word in none of the languages is so much less likely, mean log over its n-grams
NONE_PRIOR = 0.001
NO_LETTERS = 50.0  # log odds for none of the languages, of a text without letters
HOST_WEIGHT = 10.0  # documents of a host that weigh as much as its domain's shares
MIN_POSTERIOR = 0.5
ONE = 1 << 20  # the weight of a document among its places, in whole numbers
LOG_STEPS = 1 << 30  # steps of a logarithm in such sums


@dataclass
class GramModel:
    """Log probability of each n-gram bucket in each language, and the floor of a word's in each (-inf: none)."""

    languages: list[str]
    log_odds: np.ndarray
    floors: np.ndarray

    def of_words(self, words: list[str]) -> np.ndarray:
        """Log likelihood of each word, the mean over its n-grams, and a one; zeros for words without letters."""
        flat, counts = word_grams(words, GRAMS, BUCKETS)
        values = np.add.reduceat(self.log_odds[flat], np.cumsum(counts) - counts) / counts[:, None]
        letters = np.array([any(map(str.isalpha, w)) for w in words], np.float64)[:, None]
        return np.hstack([values, np.ones((len(words), 1))]) * letters


def quotas(sizes: dict[str, int], rows: int) -> dict[str, int]:
    """Texts of each language in a sample of at most ``rows``: alike, but for languages that have fewer."""
    out: dict[str, int] = {}
    for i, name in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[name] = min(sizes[name], (rows - sum(out.values())) // (len(sizes) - i))
    return out


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS) -> GramModel:
    """Count n-grams on about ``rows`` texts of ``doc_id, text, lang`` with a label, never more.

    Each language has a like number of texts, as far as it has them, chosen by a hash of doc_id.
    """
    known = docs.filter(F.col("lang").isNotNull() & (F.length("text").between(1, SAMPLE_CHARS)))
    known = known.select("lang", "text", F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t"))
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # few languages
    if not sizes:
        return train([], [])
    wanted = quotas(sizes, rows)
    shares = F.create_map(*[F.lit(x) for name in sizes for x in (name, wanted[name] / sizes[name])])
    # hashes only are ordered; texts are fetched for the chosen rows, of which there are ``rows`` at most
    taken = known.filter(F.pmod("h", F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30))
    chosen = taken.select("h", "t").orderBy("h", "t").limit(rows).distinct()
    got = taken.join(F.broadcast(chosen), ["h", "t"]).select("lang", "text", "h", "t").limit(rows).collect()
    got.sort(key=lambda r: (r["h"], r["t"]))
    return train([r["text"] for r in got], [r["lang"] for r in got])


def counted(seen: list[Counter], languages: list[str]) -> GramModel:
    """Probabilities from the words of each language, without floors."""
    counts = np.zeros((BUCKETS, len(languages)))
    for k, own in enumerate(seen):
        words, times = list(own), np.array(list(own.values()), np.float64)
        for part in (slice(i, i + PORTION_WORDS) for i in range(0, len(words), PORTION_WORDS)):
            flat, sizes = word_grams(words[part], GRAMS, BUCKETS)
            counts[:, k] += np.bincount(flat, np.repeat(times[part], sizes), BUCKETS)
    shares = counts / np.maximum(counts.sum(axis=0), 1.0)
    return GramModel(languages, np.log((1 - UNSEEN) * shares + UNSEEN / BUCKETS), np.full(len(languages), -np.inf))


def train(texts: list[str], labels: list[str]) -> GramModel:
    """The model of all texts; each half of them is held out once for the floors. A language of one text has none."""
    languages = sorted(set(labels))
    halves: list[list[Counter]] = [[Counter() for _ in languages] for _ in range(2)]
    turn = Counter()
    for text, label in zip(texts, labels, strict=True):
        halves[turn[label] % 2][languages.index(label)].update(words_of(text))
        turn[label] += 1
    model = counted([a + b for a, b in zip(*halves, strict=True)], languages)
    held = np.zeros((2, len(languages)))  # sums of the words' values, numbers of words
    for own, other in (halves, halves[::-1]):
        half = counted(own, languages)
        for k, seen in enumerate(other):
            words = list(seen) if own[k] else []
            for part in (words[i : i + PORTION_WORDS] for i in range(0, len(words), PORTION_WORDS)):
                values = half.of_words(part)[:, [k, -1]]
                held[:, k] += np.array([seen[w] for w in part], np.float64) @ values
    model.floors[held[1] > 0] = (held[0] / np.maximum(held[1], 1))[held[1] > 0] - NONE_GAP
    return model


def text_evidence(rows: DataFrame, model: GramModel) -> DataFrame:
    """Add ``words``, ``text_log`` and ``none_log`` to ``text`` rows; drops the text.

    ``text_log`` has the log likelihoods of the whole text by language, the best one being 0,
    and ``none_log`` that of none of them, null without words. Words without letters do not count.
    """
    others = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordValues(model.of_words, len(model.languages) + 1)
        for batch in batches:
            counts, logs, nones = [], [], []
            for text in (value.as_py() for value in batch.column("text")):  # one text at a time, not all of the batch
                words = words_of(text)
                counts.append(len(words))
                places = known.places(words) if words else []
                total = known.values[places].sum(axis=0)
                if total[-1]:
                    weight = min(total[-1], TEXT_WORDS)
                    value = total[:-1] / total[-1] * weight
                    best = int(value.argmax())
                    logs.append(value - value[best])
                    nones.append(model.floors[best] * weight - value[best] + np.log(NONE_PRIOR))
                else:
                    logs.append(np.zeros(len(model.languages)))
                    nones.append(NO_LETTERS if words else None)
            kept = batch.select(others)
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(counts, pa.int32()), pa.array(logs, pa.list_(pa.float64())), pa.array(nones, pa.float64())],
                [*others, "words", "text_log", "none_log"],
            )

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
    return rows.mapInArrow(run, f"{schema}, words int, text_log array<double>, none_log double")


def domain_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def page_evidence(pages: DataFrame) -> DataFrame:
    """``doc_id, host, declared, weight`` from ``url, html``: the different places where a document's pages are.

    The path of an address ends in the number of the document it shows. All pages of a document
    count, with the same share of one (``ONE``); ``declared`` is the language its markup names, or null.
    """
    number = F.regexp_extract("url", r"^[a-zA-Z]+://[^/]+/(?:[a-z]{2}/)?(\d{1,18})(?:[^0-9]|$)", 1)
    rows = pages.select(
        F.when(number != "", number.cast("long")).alias("doc_id"),
        F.nullif(F.lower(F.regexp_extract("url", r"^[a-zA-Z]+://([^/:?#]+)", 1)), F.lit("")).alias("host"),
        F.nullif(F.lower(F.regexp_extract("html", r"<html[^>]*\slang=[\"']?([A-Za-z]{2,3})", 1)), F.lit("")).alias("declared"),
    ).filter("doc_id IS NOT NULL AND host IS NOT NULL")
    places = rows.groupBy("doc_id", "host", "declared").agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy("doc_id"))
    return places.select("doc_id", "host", "declared", F.round(F.col("n") / total * ONE).cast("long").alias("weight"))


def with_guess(rows: DataFrame) -> DataFrame:
    """Add ``guess``, the number of the language that the text alone suggests: null if it has none."""
    guess = F.array_position("text_log", F.array_max("text_log")) - 1
    return rows.withColumn("guess", F.when((F.col("words") > 0) & (none_of(rows) <= 0), guess))


def none_of(rows: DataFrame) -> Column:
    return F.coalesce("none_log", F.lit(float("-inf"))) if "none_log" in rows.columns else F.lit(float("-inf"))


def parts_of(rows: DataFrame) -> DataFrame:
    """Add the ``domain`` and ``suffix`` of ``host``."""
    address = F.col("host").contains(".")  # a source that stands for a host is none
    suffix = F.substring_index("host", ".", -1)
    return rows.withColumns({"domain": F.when(address, domain_of(F.col("host"))), "suffix": F.when(address, suffix)})


def shares(rows: DataFrame, by: str, size: int) -> DataFrame:
    """Documents of each value of ``by`` per language the text alone suggests: ``by, counts``.

    ``weight`` is in whole numbers, so that no order of adding changes a sum.
    """
    counts = F.array(*[F.sum(F.when(F.col("guess") == k, F.col("weight")).otherwise(0)) / ONE for k in range(size)])
    return rows.filter(F.col(by).isNotNull() & F.col("guess").isNotNull()).groupBy(by).agg(counts.alias(f"{by}_counts"))


def place_logs(places: DataFrame, evidence: DataFrame, size: int) -> DataFrame:
    """Add ``place_log`` to ``host, declared``: what markup, suffix and host say for each language.

    ``evidence`` has ``host, declared, guess, weight`` of all documents, summed up or not.
    """
    evidence = parts_of(evidence)
    whole = shares(evidence.withColumn("all", F.lit(1)), "all", size).first()  # one row
    total = np.array(whole["all_counts"] if whole else [0.0] * size) + SMOOTHING
    base = total / total.sum()
    zeros = F.array(*[F.lit(0.0)] * size)
    kept = places.columns
    rows = parts_of(places)
    for by in ("declared", "suffix", "domain", "host"):
        rows = rows.join(shares(evidence, by, size), by, "left")
    at = lambda name, k: F.coalesce(F.col(f"{name}_counts"), zeros)[k]
    everything = lambda name: F.aggregate(F.coalesce(F.col(f"{name}_counts"), zeros), F.lit(0.0), lambda a, x: a + x)
    logs = []
    for k in range(size):
        # likelihood ratio of a value: its share of the language against the language's share of all
        def ratio(name: str, k=k) -> Column:
            seen = (at(name, k) + F.lit(HOST_WEIGHT * base[k])) / (everything(name) + HOST_WEIGHT)
            return F.log(seen / F.lit(float(base[k])))

        by_domain = (at("domain", k) + F.lit(HOST_WEIGHT * base[k])) / (everything("domain") + HOST_WEIGHT)
        prior = (at("host", k) + HOST_WEIGHT * by_domain) / (everything("host") + HOST_WEIGHT)
        logs.append(ratio("declared") + ratio("suffix") + F.log(prior))
    return rows.select(*kept, F.array(*logs).alias("place_log"))


def decided(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Posterior of each language from ``text_log, place_log``; adds ``lang_id, posterior``.

    ``none_log``, if there and not null, takes its part of the posterior.
    """
    none = none_of(rows)
    rows = rows.withColumn("score", F.zip_with("text_log", "place_log", lambda x, y: x + y))
    best = F.array_max("score")
    posterior = 1 / F.aggregate(F.transform("score", lambda x: F.exp(x - best)), F.exp(none - best), lambda a, x: a + x)
    return rows.withColumn("posterior", posterior).withColumn(
        "lang_id", F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position("score", best).cast("int"))
    )


def fused(rows: DataFrame, languages: list[str]) -> DataFrame:
    """Language of rows ``words, text_log, host, declared`` that each have one place; adds ``lang_id, posterior``.

    Rows whose text speaks for none of the languages do not count as evidence for others.
    """
    rows = with_guess(rows)
    evidence = rows.select("host", "declared", "guess", F.lit(ONE).alias("weight"))
    return decided(place_logs(rows, evidence, len(languages)), languages)


def fused_with_pages(rows: DataFrame, places: DataFrame, languages: list[str]) -> DataFrame:
    """The same for rows ``doc_id, source, words, text_log`` and the ``places`` of their pages.

    Documents without a page have their source for a host. Of several places the weighted mean of
    their logarithms counts. Rows meet one row per id only: counts per id and guess go to the
    places, and the places come back as one list of numbers per id, so an id of very many
    rows and pages does not pair them.
    """
    size = len(languages)
    rows = with_guess(rows)
    placed = places.select("doc_id").distinct()
    guesses = rows.filter("guess IS NOT NULL").groupBy("doc_id", "source", "guess").agg(F.count("*").alias("n"))
    by_id = guesses.groupBy("doc_id", "guess").agg(F.sum("n").alias("n"))
    from_pages = places.join(by_id, "doc_id").select("host", "declared", "guess", (F.col("weight") * F.col("n")).alias("weight"))
    named = F.lit(None).cast("string").alias("declared")
    from_sources = guesses.join(placed, "doc_id", "left_anti").select("source", named, "guess", (F.lit(ONE) * F.col("n")).alias("weight"))
    evidence = from_pages.unionAll(from_sources.withColumnRenamed("source", "host"))
    evidence = materialize(evidence.groupBy("host", "declared", "guess").agg(F.sum("weight").alias("weight")), "evidence")
    sources = rows.select(F.col("source").alias("host")).distinct().select("host", named)
    asked = places.select("host", "declared").unionAll(sources).distinct()
    logs = materialize(place_logs(asked, evidence, size), "places")
    same = logs.host.eqNullSafe(places.host) & logs.declared.eqNullSafe(places.declared)
    # whole numbers again, so that the mean does not depend on the order of its places
    share = [F.sum(F.col("weight") * F.round(logs.place_log[k] * LOG_STEPS).cast("long")) for k in range(size)]
    per_id = places.join(logs, same).groupBy("doc_id").agg(F.array(*[x / F.sum("weight") / LOG_STEPS for x in share]).alias("page_log"))
    own = logs.filter("declared IS NULL").select(F.col("host").alias("_host"), F.col("place_log").alias("source_log"))
    rows = rows.join(per_id, "doc_id", "left").join(own, F.col("source").eqNullSafe(F.col("_host")), "left")
    return decided(rows.withColumn("place_log", F.coalesce("page_log", "source_log")).drop("_host", "page_log", "source_log"), languages)


def identify(docs: DataFrame, pages: DataFrame | None = None, rows: int = SAMPLE_ROWS, least: float = MIN_POSTERIOR) -> DataFrame:
    """Language of each row of ``doc_id, text, lang, source``: ``doc_id, doc_hash, lang_id, posterior, accepted``.

    A document's hosts are those of its pages, else its source. ``accepted`` is false for texts
    without a word, and where no language reaches ``least`` beside "none of these", as in texts
    of unknown languages, of digits or of random letters. ``lang`` serves as the label of the
    sample only. Without any labelled text every row is undetermined (null) and rejected. A
    null text has no words. Rows with a null id match no page. Other columns do not matter.
    """
    text = F.col("text").cast("string")
    base = docs.select(
        F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("doc_hash"), F.col("source").cast("string")
    )
    model = fit(docs, rows)
    if not model.languages:
        return base.select("doc_id", "doc_hash", F.lit(None).cast("string").alias("lang_id"), F.lit(None).cast("double").alias("posterior"), F.lit(False).alias("accepted"))
    suffix_free = F.concat(F.lit("source "), F.regexp_replace("source", r"\.", " "))  # is no address
    with arrow_batches(docs.sparkSession, BATCH_ROWS):
        seen = materialize(text_evidence(base.withColumn("source", suffix_free), model), "text-evidence")
    if pages is None:
        out = fused(seen.withColumns({"host": F.col("source"), "declared": F.lit(None).cast("string")}), model.languages)
    else:
        out = fused_with_pages(seen, materialize(page_evidence(pages), "page-evidence"), model.languages)
    return out.select("doc_id", "doc_hash", "lang_id", "posterior", ((F.col("words") > 0) & (F.col("posterior") >= least)).alias("accepted"))


def accepted_only(docs: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """``docs`` without the documents whose language is not identified; all columns stay."""
    found = identify(docs, pages).filter("NOT accepted").select(F.col("doc_id").alias("_id"), F.col("doc_hash").alias("_of")).distinct()
    rows = docs.withColumn("_hash", F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    return rows.join(found, rows.doc_id.eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_of")), "left_anti").drop("_hash")

