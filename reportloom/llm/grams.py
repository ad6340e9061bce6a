"""Hashed character n-grams of words, as flat arrays."""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np

WORD = re.compile(r"\w+")
KEPT_WORDS = 500_000


def words_of(text: str | None) -> list[str]:
    """Runs of letters, digits and underscores in lower case; none for null."""
    return WORD.findall(text.lower()) if text else []


def word_grams(words: list[str], sizes: tuple[int, int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word with its edges marked, and their number per word.

    Each word has at least one: a word shorter than the smallest n-gram counts as one.
    """
    text = "".join(f"<{w}>" for w in words)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes))  # characters to the word's end
    found, of = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, sizes[1] + 1):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[: len(codes) - n + 1] = codes[n - 1 :]
        rolling = (rolling ^ shifted) * np.uint64(0x9E3779B97F4A7C15)
        rolling ^= rolling >> np.uint64(29)
        if n < sizes[0]:
            continue
        at = np.flatnonzero(left >= n)
        found.append((rolling[at] >> np.uint64(3)) % np.uint64(buckets))
        of.append(word[at])
    flat, of = np.concatenate(found).astype(np.int64), np.concatenate(of)
    counts = np.bincount(of, minlength=len(words))
    return flat[np.argsort(of, kind="stable")], counts


class WordValues:
    """A row of values per different word, computed once; starts anew beyond ``KEPT_WORDS`` words."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], width: int, kind: type = np.float64):
        self.compute, self.width, self.kind = compute, width, kind
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.values = np.zeros((0, self.width), self.kind)

    def places(self, words: list[str]) -> np.ndarray:
        """The rows of ``values`` that belong to ``words``."""
        if len(self.place) > KEPT_WORDS:
            self.clear()
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            missed = [words[i] for i in missing]
            new = list(dict.fromkeys(missed))
            self.values = np.concatenate([self.values, self.compute(new)])
            self.place.update(zip(new, range(len(self.place), len(self.values)), strict=True))
            at[missing] = list(map(self.place.__getitem__, missed))
        return at
