"""Personal data by candidate gradient boosting.

Fixed base rules give spans of addresses, numbers and cards in their plain forms; they always
count. Beside them, generators of high recall propose overlapping spans of looser forms: spelled
out or bracketed marks, other separators, national numbers, numbers that fail a check. Boosted
trees score each candidate by its format and its surroundings; a candidate is a span if its score
passes its kind's calibrated threshold, if it overlaps no base span and no better candidate.

There are no marked spans to learn from, so labels are made: base spans of a bounded sample of
texts, and those spans rewritten in looser forms in their own surroundings, are positive; other
candidates of the sample, and rewritten spans with a broken check, are negative. Texts are
labelled by the executors; only features reach the driver.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
SAMPLE_TEXTS = 8_000  # texts that candidates to learn from are taken from, at most
SAMPLE_CHARS = 20_000  # longer texts are not learned from; all are searched whole
SAMPLE_CANDIDATES = 40_000  # candidates to learn from, at most
SURE = 0.97  # calibrated share of true spans that a threshold asks for
LEAST_TRUE = 20  # true candidates of a kind that a threshold needs
NEAR = 40  # characters of surroundings
ZONE_GAP = 10  # digits that are further apart are in different zones

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD_FORM = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_FORM = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
LOOSE_DOMAIN = re.compile(
    r"[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?(?:dot|\.)\x20?[\])}]\x20?|\x20(?:dot|punkt|punto|point)\x20)[A-Za-z0-9-]{2,63}){1,6}", re.IGNORECASE
)
AT_MARKS = re.compile(r"\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20|\x20@\x20|\x20@|@\x20|\x20?＠\x20?", re.IGNORECASE)
LOOSE_FORMS = (
    (IP, re.compile(r"[0-9]{1,3}(?:(?:\x20?[\[({](?:\.|dot)[\])}]\x20?|\x20dot\x20|,|\x20?\.\x20?)[0-9]{1,3}){3}", re.IGNORECASE)),
    (IP, re.compile(r"[0-9]{1,5}(?:\.[0-9]{1,5}){2,7}")),
    (CARD, re.compile(r"[0-9]{3,6}(?:[\x20./_: –-]{1,3}[0-9]{2,6}){1,4}")),
    (CARD, re.compile(r"[0-9]{11,20}")),
    (PHONE, re.compile(r"\(?[0-9]{2,5}\)?(?:[\x20./ –-]{1,2}\(?[0-9]{2,5}\)?){1,5}")),
    (PHONE, re.compile(r"(?:00|0)[0-9]{7,14}")),
)
CUES = (
    frozenset("email mail e-mail mailto correo courriel contact kontakt contacto adresse address write".split()),
    frozenset("ip host server addr address ping login gateway from servidor serveur".split()),
    frozenset("card visa mastercard amex credit debit karte kreditkarte carte tarjeta crédito payment iban".split()),
    frozenset("phone tel telephone telefon teléfono téléphone call fax mobile cell handy móvil portable whatsapp ring".split()),
)  # fixed: words that announce a kind
ANNOUNCED = ("mail", "ip", "card", "tel")
ENDINGS = ("com", "org", "net", "de", "fr", "es", "co.uk", "info")
Span = tuple[int, int, int]  # start, end, kind


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    twice = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(twice)) % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGITS.findall(text))


def emails(text: str) -> Iterator[Span]:
    """A match starts as far left of its mark as characters of a name go, after the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        match = DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            done = match.end()
            yield begin, done, EMAIL
        at = text.find("@", max(at + 1, done))


def zones(text: str) -> list[tuple[int, int]]:
    """Stretches with digits, cut where none follows for a while."""
    out: list[tuple[int, int]] = []
    for match in DIGITS.finditer(text):
        if out and match.start() - out[-1][1] <= ZONE_GAP:
            out[-1] = (out[-1][0], match.end())
        else:
            out.append((match.start(), match.end()))
    return out


def base_matches(text: str, places: list[tuple[int, int]]) -> tuple[list[Span], list[Span]]:
    """Spans of the base rules, and what matches their forms but fails their checks."""
    good, bad = list(emails(text)), []
    for begin, end in places:
        for match in DOTTED.finditer(text, begin, end):
            parts = [(m.start(), m.end()) for m in DIGITS.finditer(text, match.start(), match.end())] if "." in match.group() else []
            for i in range(0, len(parts) - 3, 4):
                fits = all(len(x := text[s:e].lstrip("0")) <= 3 and int(x or 0) <= 255 for s, e in parts[i : i + 4])
                (good if fits else bad).append((parts[i][0], parts[i + 3][1], IP))
        for match in CARD_FORM.finditer(text, begin, end):
            digits = only_digits(match.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                good.append((match.start(), match.end(), CARD))
            elif 11 <= len(digits) <= 20:
                bad.append((match.start(), match.end(), CARD))
    if "+" in text:
        for match in PHONE_FORM.finditer(text):
            digits = len(only_digits(match.group()))
            (good if 9 <= digits <= 15 else bad).append((match.start(), match.end(), PHONE))
    return good, bad


def loose_emails(text: str) -> Iterator[Span]:
    """Addresses with spelled out, bracketed or spaced marks."""
    for mark in AT_MARKS.finditer(text) if any(m in text for m in ("at]", "at)", "at}", "AT]", "AT)", "AT}")) else spaced_marks(text):
        match = LOOSE_DOMAIN.match(text, mark.end())
        begin = mark.start()
        while begin > 0 and mark.start() - begin < 64 and text[begin - 1] in LOCAL:
            begin -= 1
        if match and begin < mark.start():
            yield begin, match.end(), EMAIL


def spaced_marks(text: str) -> Iterator[re.Match]:
    """Marks without brackets, found by plain search first."""
    for plain in (" at ", " AT ", "@", "＠"):
        at = text.find(plain)
        while at >= 0:
            match = AT_MARKS.match(text, max(0, at - (plain in "@＠" and text[at - 1 : at] == " ")))
            if match:
                yield match
            at = text.find(plain, at + 1)


def candidates(text: str, places: list[tuple[int, int]], bad: list[Span]) -> list[Span]:
    """What the generators propose beside the base spans; spans may overlap, each is given once."""
    found = set(bad) | set(loose_emails(text))
    for begin, end in places:
        if end - begin < 7:
            continue
        for kind, form in LOOSE_FORMS:
            for match in form.finditer(text, max(0, begin - 1), end + 1):
                found.add((match.start(), match.end(), kind))
    whole = lambda s: not (text[s[0] - 1 : s[0]].isdigit() and text[s[0]].isdigit()) and not (text[s[1] : s[1] + 1].isdigit() and text[s[1] - 1].isdigit())
    return sorted(filter(whole, found))


def side(char: str) -> int:
    """Kind of a neighbouring character."""
    if not char or char.isspace():
        return 0
    if char.isalpha():
        return 3 if char in "abcdefABCDEF" else 4
    return 5 if char.isdigit() else 1 if char in ".,;:!?)" else 2


FEATURES = 26


def features(text: str, span: Span) -> list[float]:
    """Format and surroundings of a candidate."""
    start, end, kind = span
    value = text[start:end]
    groups = DIGITS.findall(value)
    digits = "".join(groups)
    marks = [c for c in value if not c.isalnum()]
    left, right = text[max(0, start - NEAR) : start], text[end : end + NEAR]
    words = [w.strip(".,;:!?()[]\"'").lower() for w in left.split()[-3:]]
    announced = [any(w in cues for w in words) for cues in CUES]
    numbers = [int(g) for g in groups if len(g) < 10]
    dates = len(groups) == 3 and sorted(map(len, groups)) in ([2, 2, 4], [1, 2, 4], [1, 1, 4]) or (1900 <= numbers[0] <= 2099 if numbers else False)
    return [
        kind, len(value), len(digits), sum(map(str.isalpha, value)), len(marks), len(set(marks)), len(groups),
        max(map(len, groups), default=0), min(map(len, groups), default=0), len(groups[0]) if groups else 0, len(groups[-1]) if groups else 0,
        luhn(digits) if digits else -1, all(n <= 255 for n in numbers) and len(numbers) == len(groups), value[:1] == "+", value[:1] == "(",
        digits[:1] == "0", int(digits[:1] or -1), len(set(digits)), side(left[-1:]), side(right[:1]), announced[kind],
        sum(announced) - announced[kind], dates, any(m in value.lower() for m in ("[", "{", "dot", "(at")), len(value.rpartition(".")[2]),
        left.rsplit("\n", 1)[-1].strip() == "",
    ]


def rewritten(value: str, kind: int, rng: random.Random, words: list[str]) -> tuple[list[str], list[str]]:
    """A base span in looser forms, and in forms that are no longer one."""
    digits = only_digits(value)
    if kind == EMAIL:
        name, _, domain = value.rpartition("@")
        word = lambda: rng.choice(words)
        name = rng.choice([name, word(), f"{word()}.{word()}", f"{word()}_{rng.randint(1, 99)}"])
        domain = rng.choice([domain, f"{word()}.{rng.choice(ENDINGS)}", f"{word()}.{word()}.{rng.choice(ENDINGS)}"])
        spelled = domain.replace(".", rng.choice([" dot ", " [dot] ", "(dot)", "."]))
        marks = [" [at] ", "(at)", " at ", " @ "]
        good = [name + mark + (spelled if mark == " at " and spelled != domain else domain if mark != " at " else domain.replace(".", " dot ")) for mark in marks]
        return good, [f"{word()} at {word()}.{rng.choice(['The', 'and', 'Then', *ENDINGS])}", f"{word()} @ {word()}. {word()}"]
    if kind == IP:
        parts = value.split(".")
        high = [*parts[:3], str(rng.randint(256, 999))]
        rng.shuffle(high)
        bad = [".".join(high), "[.]".join(high), ".".join([*parts, parts[0]])[: len(value) + 2], ", ".join(parts)]
        return [mark.join(parts) for mark in ("[.]", "(.)", " dot ", "[dot]")], bad
    if kind == CARD:
        broken = str((int(digits[0]) + rng.randint(1, 4)) % 10) + digits[1:]
        if luhn(broken):
            broken = broken[:-1] + str((int(broken[-1]) + 1) % 10)
        cut = lambda d, mark: mark.join(d[i : i + 4] for i in range(0, len(d), 4))
        return [cut(digits, m) for m in (".", "/", "  ", "_")], [broken, *[cut(broken, m) for m in (".", "/", "  ", " ", "-")]]
    tail = digits[-10:]
    plain = f"{tail[:3]}{{0}}{tail[3:6]}{{0}}{tail[6:]}"
    day = f"{rng.randint(1, 28):02d}{{0}}{rng.randint(1, 12):02d}{{0}}{rng.randint(1950, 2030)}"
    good = [plain.format("-"), plain.format("."), f"({tail[:3]}) {tail[3:6]}-{tail[6:]}", "00" + digits, f"0{tail[:3]}/{tail[3:]}"[:14]]
    good += [" ".join(["0" + tail[0], *[tail[i : i + 2] for i in range(1, 9, 2)]]), f"0{tail[:2]} {tail[2:]}"]
    other = f"{rng.randint(1900, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}"
    number = ".".join([str(rng.randint(1, 999)), *[f"{rng.randint(0, 999):03d}" for _ in range(rng.randint(2, 3))]])
    return good, [day.format("."), day.format("/"), day.format("-"), other, f"{rng.randint(1000, 2000)}-{rng.randint(1000, 2000)}", number]


def examples(text: str) -> Iterator[tuple[list[float], int]]:
    """Features and labels that a text gives: its base spans, the other candidates, and both kinds of rewritten spans."""
    places = zones(text)
    good, bad = base_matches(text, places)
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    for span in good:
        yield features(text, span), 1
    for span in candidates(text, places, bad):
        if not any(span[0] < g[1] and g[0] < span[1] for g in good):
            yield features(text, span), 0
    for start, end, kind in good:
        left, right = text[max(0, start - NEAR) : start], text[end : end + NEAR]
        # other digits nearby would only add candidates of unknown label
        left, right = DIGITS.sub("", left), DIGITS.sub("", right)
        words = re.findall("[a-z]{2,12}", left + right) or ["info"]
        for label, values in zip((1, 0), rewritten(text[start:end], kind, rng, words), strict=True):
            for value in values:
                cue = rng.choice(["", "", f" {rng.choice(ANNOUNCED)}: " if rng.random() < 0.3 else f" {ANNOUNCED[kind]}: "])
                before = left + cue
                new = f"{before}{value}{right}"
                at = (len(before), len(before) + len(value))
                places_ = zones(new)
                for span in candidates(new, places_, base_matches(new, places_)[1]):
                    if label and span[:2] == at and span[2] == kind:
                        yield features(new, span), 1
                    elif span[0] < at[1] and at[0] < span[1] and (not label or span[2] != kind):
                        yield features(new, span), 0


@dataclass
class Detector:
    """Trees and the threshold of each kind."""

    trees: boosting.BoostedTrees
    thresholds: np.ndarray

    def added(self, texts: list[str], found: list[tuple[list[Span], list[Span]]]) -> list[list[Span]]:
        """Per text the candidates that pass, best first, without overlaps among them or with base spans."""
        owner = [i for i, (_, spans) in enumerate(found) for _ in spans]
        spans = [s for _, own in found for s in own]
        out: list[list[Span]] = [[] for _ in texts]
        if not spans or not np.isfinite(self.thresholds).any():
            return out
        scores = self.trees.scores(np.array([features(texts[i], s) for i, s in zip(owner, spans, strict=True)], np.float64))
        passed = np.flatnonzero(scores >= self.thresholds[[s[2] for s in spans]])
        taken: dict[int, list[tuple[int, int]]] = {}
        for at in sorted(passed.tolist(), key=lambda k: (owner[k], -scores[k], spans[k][0] - spans[k][1], spans[k])):
            start, end, kind = spans[at]
            if owner[at] not in taken:
                taken[owner[at]] = merged(found[owner[at]][0])
            places = taken[owner[at]]
            i = bisect.bisect_left(places, (start, end))
            if (i < len(places) and places[i][0] < end) or (i and places[i - 1][1] > start):
                continue
            places.insert(i, (start, end))
            out[owner[at]].append((start, end, kind))
        return out


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The places that spans cover, in order, without overlaps."""
    out: list[tuple[int, int]] = []
    for start, end, _ in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def learned(values: np.ndarray, labels: np.ndarray, folds: np.ndarray) -> Detector:
    """Trees from folds 1 and 2, thresholds from fold 0."""
    own = folds > 0
    trees = boosting.fit(values[own], labels[own])
    scores, kinds = trees.scores(values[~own]), values[~own, 0]
    kept = labels[~own]
    limits = [boosting.threshold(scores[kinds == k], kept[kinds == k], SURE, LEAST_TRUE) for k in range(len(KINDS))]
    return Detector(trees, np.array(limits))


def fit(docs: DataFrame, texts: int = SAMPLE_TEXTS, rows: int = SAMPLE_CANDIDATES) -> Detector:
    """Learn from at most ``texts`` texts with a digit or a mark, and at most ``rows`` of their candidates, by hashes of the texts.

    The texts of one fold are never used for another. Equal texts count once.
    """
    marked = docs.select(F.col("text").cast("string").alias("text"))
    marked = marked.filter((F.length("text") <= SAMPLE_CHARS) & F.col("text").rlike("[0-9@]"))
    marked = marked.select("text", F.xxhash64("text").alias("h"), F.crc32(F.col("text").cast("binary")).alias("c"))
    chosen = marked.groupBy("h", "c").agg(F.lit(1).alias("one")).orderBy("h", "c").limit(texts).drop("one")
    few = marked.join(F.broadcast(chosen), ["h", "c"]).dropDuplicates(["h", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(h, c % 3, x, y) for h, c, t in zip(*batch.to_pydict().values(), strict=True) for x, y in examples(t)]
            if found:
                columns = zip(*found, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.list_(pa.float64()), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["h", "fold", "x", "y"])

    made = few.select("h", "c", "text").mapInArrow(run, "h long, fold int, x array<double>, y int")
    got = made.orderBy(F.xxhash64("h", "x"), "h", "x", "y").limit(rows).collect()
    values = np.array([r["x"] for r in got], np.float64).reshape(-1, FEATURES)
    return learned(values, np.array([r["y"] for r in got], np.float64), np.array([r["fold"] for r in got], np.int64))


def listed(spans: list[Span]) -> str:
    """``kind:start:end`` of each span, by start, then kind."""
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, end, kind in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def spans_of(texts: list[str], detector: Detector) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    good, loose = [], []
    for text in texts:
        places = zones(text)
        own, bad = base_matches(text, places)
        good.append(own)
        loose.append((own, candidates(text, places, bad)))
    return list(zip(good, detector.added(texts, loose), strict=True))


def replaced(text: str, spans: list[Span]) -> str:
    """The text with its spans replaced by their kinds; spans that overlap become one, of the first one's kind."""
    out, at = [], 0
    for start, end in merged(spans):
        kind = min(s for s in spans if s[0] == start)[2]
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, detector: Detector) -> DataFrame:
    """Spans of each row of ``doc_id, text``, one row per row, and the redacted text.

    Gives the numbers of base spans by kind, SHA-256 of their list, the list of all spans, and
    ``redacted``. Places count characters (code points). A null text is an empty one and its
    redacted text is empty; null and repeated ids are rows like others; other columns do not matter.
    """
    counts = [f"n_{kind}" for kind in KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = spans_of(texts, detector)
                tallies = [Counter(s[2] for s in base) for base, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"), *[pa.array([t[k] for t in tallies], pa.int64()) for k in range(len(KINDS))],
                        pa.array([hashlib.sha256(listed(base).encode()).hexdigest() for base, _ in found]),
                        pa.array([listed(base + more) for base, more in found], pa.string()),
                        pa.array([replaced(t, base + more) for t, (base, more) in zip(texts, found, strict=True)], pa.string()),
                    ],
                    ["doc_id", *counts, "base_sha256", "spans", "redacted"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = ", ".join(["doc_id long", *[f"{c} long" for c in counts], "base_sha256 string, spans string, redacted string"])
    return rows.mapInArrow(run, schema)


def personal_data(docs: DataFrame) -> DataFrame:
    """Learn from a bounded sample of ``docs`` and find the personal data of every row."""
    return find_pii(docs, fit(docs))
