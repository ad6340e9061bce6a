"""Ordered line differences of two versions of a report: lines removed, added and moved."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

ROWS_A_BATCH = 20_000


def rising(places: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A longest part of ``places``, ordered by their first number, whose second number rises too."""
    ends: list[int] = []  # least last number of a rising part of each length
    at: list[int] = []  # index of the pair that has it
    before: list[int] = []
    for i, (_, b) in enumerate(places):
        k = bisect_left(ends, b)
        before.append(at[k - 1] if k else -1)
        ends[k : k + 1] = [b]
        at[k : k + 1] = [i]
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(places[i])
        i = before[i]
    return out[::-1]


def numbered(lines: list[str], start: int, end: int) -> dict[tuple[str, int], int]:
    """The place of each line and occurrence within a window."""
    seen: Counter[str] = Counter()
    out = {}
    for i in range(start, end):
        out[lines[i], seen[lines[i]]] = i
        seen[lines[i]] += 1
    return out


def anchors(a: list[str], b: list[str], window: tuple[int, int, int, int]) -> list[tuple[int, int]]:
    """Lines that both windows have once; without any, the same occurrence of a line that both have."""
    a0, a1, b0, b1 = window
    left, right = numbered(a, a0, a1), numbered(b, b0, b1)
    again = {line for side in (left, right) for line, nth in side if nth}
    both = [(i, right[key]) for key, i in left.items() if key in right]
    return rising([p for p in both if a[p[0]] not in again] or both)


def kept(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Places of the lines that stay, in the same order in both.

    Common ends of a window stay; its anchors split the rest into windows that are treated alike.
    """
    stay: list[tuple[int, int]] = []
    windows = [(0, len(a), 0, len(b))]
    while windows:
        a0, a1, b0, b1 = windows.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            stay.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            stay.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        found = anchors(a, b, (a0, a1, b0, b1))
        stay += found
        if found:
            edges = [(a0 - 1, b0 - 1), *found, (a1, b1)]
            windows += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(edges, edges[1:])]
    return sorted(stay)


def changes(text_a: str, text_b: str) -> list[tuple[str, str, int | None, int | None]]:
    """``(change, line, place in a, place in b)``, places from 0; kept lines are left out.

    A line that is gone at one place and new at another has moved.
    """
    a, b = text_a.splitlines(), text_b.splitlines()
    stay = kept(a, b)
    in_a, in_b = {i for i, _ in stay}, {j for _, j in stay}
    new: dict[str, list[int]] = defaultdict(list)
    for j in range(len(b) - 1, -1, -1):
        if j not in in_b:
            new[b[j]].append(j)
    out: list[tuple[str, str, int | None, int | None]] = []
    for i, line in enumerate(a):
        if i not in in_a:
            out.append(("moved", line, i, new[line].pop()) if new.get(line) else ("removed", line, i, None))
    out += [("added", line, None, j) for line, places in new.items() for j in reversed(places)]
    return out


def ordered_difference(pairs: DataFrame, key: str = "report_key") -> DataFrame:
    """``(key, change, line, line_a, line_b)`` of pairs with a second version; kept lines are no rows.

    ``change`` is ``removed`` (only ``line_a``, its number from 0), ``added`` (only ``line_b``) or
    ``moved`` (both). Lines end where Python's ``splitlines`` ends them. No shuffle is needed: a pair is
    one row, and a pair of n lines takes n log n steps but for lines that repeat. Counting moved lines
    as neither added nor removed gives what ``line_difference`` counts.
    """
    kind = dict(pairs.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = batch.column(0), []
            for i, (text_a, text_b) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                rows += [(i, *change) for change in changes(text_a or "", text_b)]
                if len(rows) >= ROWS_A_BATCH or i == len(keys) - 1:
                    places, kinds, lines, from_a, to_b = zip(*rows) if rows else ((),) * 5
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(places, pa.int64())), pa.array(kinds, pa.string()), pa.array(lines, pa.string()),
                         pa.array(from_a, pa.int64()), pa.array(to_b, pa.int64())],
                        [key, "change", "line", "line_a", "line_b"],
                    )
                    rows = []

    wanted = pairs.filter("text_b <> ''").select(key, "text_a", "text_b")
    return wanted.mapInArrow(run, f"`{key}` {kind}, change string, line string, line_a long, line_b long")
