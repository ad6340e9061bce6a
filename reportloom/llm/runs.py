"""Periodic runs of words, by Baier's grouping and extension of Lyndon roots.

The first phase of Baier's suffix sorter puts the suffixes of a sequence into groups, highest
first: a suffix leaves its group for a higher one when what follows its context turns out to be
a context of a processed group. When a group is processed, the length of its context is that of
the longest Lyndon word that starts at each of its places. Done for an order of the words and
for its reverse, this gives both Lyndon arrays directly, without a finished suffix array. Every
maximal repetition has a Lyndon word of one of the two orders as its root (the runs theorem),
so roots extended by longest common extensions to both sides give all runs. Common extensions
are exact: they compare names of equal stretches of 1, 2, 4, ... words.

A document is one row of work, so nothing is shuffled. Before grouping, a sequence is cut at
words that cannot be in any wanted run: a run of at least ``repeats`` periods holds each of its
words ``repeats`` times, so a word that is rarer within its piece is in none. Pieces are cut
again until nothing changes. This drops no run.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_WORDS = 6
LEAST_REPEATS = 4
CUTS = 8  # times that a piece is cut again; what is left then is grouped as it is
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)
Run = tuple[int, int, int]


def lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place; ``ranks`` are 0, 1, ... without gaps.

    Groups are stretches of a notional suffix array and are named by their first index, so a
    group's name is also its order. The names of the elements that stay do not change when some
    are split off to the right of them.
    """
    n = len(ranks)
    sizes = np.bincount(ranks)
    firsts = np.cumsum(sizes) - sizes
    group: list[int] = firsts[ranks].tolist()
    size, context, left_of_end = [0] * n, [1] * n, [0] * (n + 1)
    members: list[list[int]] = [[] for _ in range(n)]
    for first, count in zip(firsts.tolist(), sizes.tolist(), strict=True):
        size[first], left_of_end[first + count] = count, first
    for i, g in enumerate(group):
        members[g].append(i)
    before = [-1] * n  # the nearest place to the left in a lower group
    out = [0] * n
    end = n
    while end:
        g = left_of_end[end]
        length = context[g]
        times: dict[int, int] = {}
        for i in members[g]:
            if group[i] != g:
                continue  # has moved on to a higher group
            out[i] = length
            p = i - 1
            while p >= 0 and group[p] >= g:
                p = before[p]
            before[i] = p
            if p >= 0:
                times[p] = times.get(p, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for p, many in times.items():
            moved.setdefault((-many, group[p]), []).append(p)
        for (many, h), places in sorted(moved.items()):  # contexts followed by more repeats are higher
            rest = size[h] - len(places)
            if not rest:
                context[h] -= many * length
                continue
            new = h + rest
            left_of_end[h + size[h]], left_of_end[new] = new, h
            size[h], size[new] = rest, len(places)
            context[new] = context[h] - many * length
            places.sort()
            members[new] = places
            for p in places:
                group[p] = new
        members[g] = []
        end = g
    return np.array(out, np.int64)


def names_of_powers(ids: np.ndarray) -> list[np.ndarray]:
    """Per power of two the names of the stretches of that many words: equal names, equal words."""
    names = [ids.astype(np.int64)]
    width = 1
    while 2 * width <= len(ids):
        last = names[-1]
        both = last[: len(ids) - 2 * width + 1] * (len(ids) + 1) + last[width : len(ids) - width + 1]
        names.append(np.unique(both, return_inverse=True)[1])
        width *= 2
    return names


def common_right(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal words from the places ``a`` and ``b`` on, ``a`` before ``b``."""
    at, far = a.copy(), b.copy()
    for k in range(len(names) - 1, -1, -1):
        for _ in range(2):  # twice for the widest, where more than one stretch may fit
            fits = np.flatnonzero(far + (1 << k) <= len(names[0]))
            same = fits[names[k][at[fits]] == names[k][far[fits]]]
            at[same] += 1 << k
            far[same] += 1 << k
            if k < len(names) - 1:
                break
    return at - a


def common_left(names: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of equal words that end just before the places ``a`` and ``b``, ``a`` before ``b``."""
    at, far = a.copy(), b.copy()
    for k in range(len(names) - 1, -1, -1):
        for _ in range(2):
            fits = np.flatnonzero(at >= 1 << k)
            same = fits[names[k][at[fits] - (1 << k)] == names[k][far[fits] - (1 << k)]]
            at[same] -= 1 << k
            far[same] -= 1 << k
            if k < len(names) - 1:
                break
    return a - at


def runs_of_piece(ids: np.ndarray, least: int, repeats: int) -> set[Run]:
    """``start, length, period`` of the runs of one piece."""
    ranks = np.unique(ids, return_inverse=True)[1]
    n = len(ranks)
    roots = []
    for order in (ranks, ranks.max() - ranks):
        periods = lyndon_lengths(order)
        at = np.arange(n)
        # the first root of a run of 4 periods or more has two more periods and a word behind it
        inside = at + (repeats - 1) * periods <= n
        at, periods = at[inside], periods[inside]
        same = ranks[at] == ranks[at + periods]
        roots.append(np.stack([at[same], periods[same]]))
    at, period = np.concatenate(roots, axis=1)
    if not len(at):
        return set()
    names = names_of_powers(ranks)
    right = common_right(names, at, at + period)
    keep = right > (repeats - 2) * period
    at, period, right = at[keep], period[keep], right[keep]
    left = common_left(names, at, at + period)
    length = left + period + right
    keep = length >= np.maximum(least, repeats * period)
    return set(zip((at - left)[keep].tolist(), length[keep].tolist(), period[keep].tolist(), strict=True))


def pieces(ids: np.ndarray, least: int, repeats: int) -> Iterator[tuple[int, int]]:
    """Stretches that hold all runs: cut at words that occur less than ``repeats`` times within them."""
    todo = [(0, len(ids), CUTS)]
    while todo:
        begin, end, cuts = todo.pop()
        if end - begin < least:
            continue
        own = ids[begin:end] - ids[begin:end].min()
        if len(own) < own.max():  # few of the document's words: number them anew
            own = np.unique(own, return_inverse=True)[1]
        rare = np.flatnonzero(np.bincount(own)[own] < repeats)
        if not len(rare) or not cuts:
            yield begin, end
            continue
        edges = np.concatenate([[-1], rare, [end - begin]])
        for gap in np.flatnonzero(np.diff(edges) > least).tolist():
            todo.append((begin + int(edges[gap]) + 1, begin + int(edges[gap + 1]), cuts - 1))


def find_runs(ids: np.ndarray, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS) -> list[Run]:
    """All maximal stretches of ``ids`` with a smallest period ``q`` that are ``least`` and ``repeats * q``
    long or longer, as ``start, length, q`` in order of start, then period. ``repeats`` is 3 or more.

    ``ids`` are whole numbers from 0 on, equal for equal words.
    """
    if repeats < 3:
        raise ValueError("roots are sure to be followed by another one from 3 repeats on")
    found: set[Run] = set()
    for begin, end in pieces(ids, least, repeats):
        found |= {(begin + s, n, q) for s, n, q in runs_of_piece(ids[begin:end], least, repeats)}
    return sorted(found, key=lambda run: (run[0], run[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """A number per word, by first occurrence."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def without_repeats(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def with_period(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, from some place on made periodic for about a tenth of the ids, as the contract of the query has it."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, repeats: int = LEAST_REPEATS, planted: bool = False) -> DataFrame:
    """Runs of words of each row of ``doc_id, text``, one row per row.

    Words are stretches of characters other than space and the characters 9 to 13. A run is a stretch with
    a smallest period ``q``, ``least`` words and ``repeats * q`` words long or longer, that cannot
    be extended. Gives ``n_runs``; ``start, length, period, exponent_milli`` of the longest run
    (the first, then that of the smallest period; nulls without one); SHA-256 of all runs as lines
    and of the text without repeats (the words that a run holds after its first period). A null
    text has no words; null and repeated ids are rows like others; other columns do not matter.
    With ``planted``, a tenth of the documents, by their id, are made periodic before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                part = batch.slice(begin, 512)
                rows = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    words = (text.as_py() or b"").split()  # of bytes: at the six ASCII spaces only
                    if planted:
                        words = with_period(words, doc_id)
                    runs = find_runs(numbered(words), least, repeats) if len(words) >= least else []
                    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
                    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                    rows.append((
                        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
                        hashlib.sha256(lines.encode()).hexdigest(),
                        hashlib.sha256(b" ".join(without_repeats(words, runs))).hexdigest(),
                    ))
                kinds = [*[pa.int64()] * 6, pa.string(), pa.string()]
                names = [c.split()[0] for c in SCHEMA.split(", ")]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
