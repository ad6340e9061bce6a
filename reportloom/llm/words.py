"""Token ids of words, kept so that each different word of a task is tokenized once."""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np

WHITE_ASCII = [c + " " for c in map(chr, range(128)) if c.isspace()]
WHITE_OTHER = [c + " " for c in map(chr, range(128, 0x3001)) if c.isspace()]
WORD_START = re.compile(r"(?<=\S)(?= )")
KEPT_WORDS = 800_000
KEPT_IDS = 8_000_000


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``values[start:start + length]``, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
    return values[at]


def space_words(text: str) -> list[str]:
    """``text`` cut before each space that follows a character other than white space.

    The pieces rejoin to ``text``; each but the first starts with a space. Byte-level
    and sentence-piece vocabularies never join characters over such a cut.
    """
    if not text:
        return []
    if any(pair in text for pair in WHITE_ASCII) or (not text.isascii() and any(pair in text for pair in WHITE_OTHER)):
        return WORD_START.split(text)
    if "\0" in text:
        first, *rest = text.split(" ")
        return ([first] if first else []) + [" " + word for word in rest]
    words = text.replace(" ", "\0 ").split("\0")  # keeps the spaces without a step per word
    return words if words[0] else words[1:]


class WordStore:
    """Ids per word. ``tokenize`` takes new words and gives them, in any order,
    with all their ids and each one's number.

    It starts anew beyond ``KEPT_WORDS`` words or ``KEPT_IDS`` ids, which bounds the memory;
    that changes the speed only.
    """

    def __init__(self, tokenize: Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray]]):
        self.tokenize = tokenize
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(0, np.int32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)

    def add(self, words: list[str]) -> None:
        words, ids, lengths = self.tokenize(words)
        ends = np.cumsum(lengths)
        self.starts = np.concatenate([self.starts, len(self.ids) + ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])
        self.place.update(zip(words, range(len(self.place), len(self.starts)), strict=True))

    def encode(self, parts: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts given as lists of words, and the number of ids of each text."""
        if len(self.place) > KEPT_WORDS or len(self.ids) > KEPT_IDS:
            self.clear()
        words = [word for part in parts for word in part]
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            missed = [words[i] for i in missing]
            self.add(list(dict.fromkeys(missed)))
            at[missing] = list(map(self.place.__getitem__, missed))
        lengths = self.lengths[at]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return gather(self.ids, self.starts[at], lengths), np.diff(ends[bounds])


def in_portions(texts: list[str | None], most_chars: int):
    """Neighbouring texts (null: empty) in lists of about ``most_chars`` characters; a longer text stands alone."""
    portion: list[str] = []
    chars = 0
    for text in texts:
        text = text or ""
        if portion and chars + len(text) > most_chars:
            yield portion
            portion, chars = [], 0
        portion.append(text)
        chars += len(text)
    if portion:
        yield portion
