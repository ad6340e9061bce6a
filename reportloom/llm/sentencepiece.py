"""SentencePiece encoding and decoding by vectorised merge rounds.

The texts of a batch become flat arrays of symbols, one per character, cut into segments
over which no piece of the vocabulary can reach. Each round finds the smallest pair rank of
every segment (a segmented minimum), merges its leftmost occurrences at once, and compacts
the arrays, until no pair remains. Words met before in the task are not merged again.

Merging all occurrences at once gives what one merge at a time would give as long as a new
piece cannot start or end a pair of the same or a better rank; that is known per piece from
the vocabulary. For the other pieces only the leftmost occurrence is merged in a round.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .words import WordStore, in_portions, space_words

SPACE = "▁"
OTHER = 1 << 20  # symbols of characters that no longer piece holds: OTHER + code point
NONE = np.iinfo(np.int32).max
PORTION_CHARS = 1_000_000


class Vocabulary:
    """Pieces, pair ranks and cuts of a BPE model with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        plain = [
            i for i in range(size)
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
        ]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.unknown = model.unk_id()
        symbols = {names[i]: i for i in plain}
        for char in sorted({c for i in plain for c in names[i]} - set(symbols)):
            symbols[char] = size + len(symbols)  # part of pieces, but none itself
        self.size = size
        self.width = np.int64(OTHER + 0x110000)
        scores = {names[i]: -model.get_score(i) for i in plain}
        order = {s: r for r, s in enumerate(sorted(set(scores.values())))}
        keys, ranks, merged, cuts = [], [], [], set()
        for name, score in scores.items():
            cuts.update(zip(name, name[1:], strict=False))
            for at in range(1, len(name)):
                left, right = symbols.get(name[:at]), symbols.get(name[at:])
                if left is not None and right is not None:
                    keys.append(left * int(self.width) + right)
                    ranks.append(order[score])
                    merged.append(symbols[name])
        by_key = np.argsort(np.array(keys, np.int64))
        self.keys = np.array(keys, np.int64)[by_key]
        self.ranks = np.array(ranks, np.int32)[by_key]
        self.merged = np.array(merged, np.int64)[by_key]
        best = np.full(size, NONE, np.int64)  # best rank of a pair that a piece can enter
        for side in (self.keys // self.width, self.keys % self.width):
            known = side < size
            np.minimum.at(best, side[known], self.ranks[known])
        of = np.full(size, -1, np.int64)
        of[plain] = [order[scores[names[i]]] for i in plain]
        self.alone = best <= of  # only its leftmost occurrence may be merged in a round
        shared = np.bincount(of[plain])[of] > 1
        self.alone |= shared  # pieces of equal rank go strictly from left to right
        self.joined = np.unique(np.array([ord(a) << 21 | ord(b) for a, b in cuts], np.int64))
        chars = {s: i for s, i in symbols.items() if len(s) == 1}
        self.chars = np.arange(OTHER, OTHER + 0x110000, dtype=np.int64)
        self.chars[[ord(c) for c in chars]] = list(chars.values())
        extra = {i: c for c, i in chars.items() if i >= size}
        self.extra_code = {i: ord(c) for i, c in extra.items()}
        hidden = [i for i in range(size) if model.is_control(i)]
        self.bytes = [n.replace(SPACE, " ").encode() for n in names]
        for value, i in enumerate(self.byte_ids.tolist()):
            self.bytes[i] = bytes([value])
        for i in hidden:
            self.bytes[i] = b""
        self.bytes[self.unknown] = " ⁇ ".encode()
        self.opens = {i for i, n in enumerate(names) if n.startswith(SPACE)}
        self.store = WordStore(self.merge_words)

    def pair(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE: no pair) and merged symbol of neighbouring symbols."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE), self.merged[at]

    def merge_words(self, words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """``words`` (spaces written as they are), all their ids and the number of ids of each."""
        text = "".join(words).replace(" ", SPACE)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.repeat(np.arange(len(words)), sizes)
        cut = np.ones(len(codes), bool)  # a segment starts here
        two = codes[:-1] << 21 | codes[1:]
        at = np.minimum(np.searchsorted(self.joined, two), len(self.joined) - 1)
        cut[1:] = (self.joined[at] != two) | (word[1:] != word[:-1])
        symbol, word = self.merge(self.chars[codes], word, cut)
        return words, *self.finish(symbol, word, len(words))

    def merge(self, symbol, word, cut) -> tuple[np.ndarray, np.ndarray]:
        """Symbols and their words after all merge rounds, in order."""
        place = np.arange(len(symbol))
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        rank = np.full(len(symbol), NONE, np.int32)
        result = np.zeros(len(symbol), np.int64)
        inner = np.flatnonzero(~cut[1:])
        rank[inner], result[inner] = self.pair(symbol[inner], symbol[inner + 1])
        while len(symbol):
            starts = np.flatnonzero(cut)
            lengths = np.diff(np.append(starts, len(symbol)))
            least = np.minimum.reduceat(rank, starts)
            open_ = least < NONE
            if not open_.all():  # segments without a pair leave the arrays
                stay = np.repeat(open_, lengths)
                done.append((place[~stay], symbol[~stay], word[~stay]))
                symbol, word, cut, place = symbol[stay], word[stay], cut[stay], place[stay]
                rank, result = rank[stay], result[stay]
                starts, lengths, least = np.flatnonzero(cut), lengths[open_], least[open_]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(least, lengths))
            segment = np.searchsorted(starts, at, side="right") - 1
            first = np.append(True, segment[1:] != segment[:-1])
            run = np.append(True, (at[1:] != at[:-1] + 1) | first[1:])  # overlapping pairs: every other one
            runs = np.flatnonzero(run)
            odd = (np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) & 1
            at = at[first | ((odd == 0) & ~self.alone[result[at]] & ~self.alone[result[at[first]]][np.cumsum(first) - 1])]
            symbol[at] = result[at]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            shift = np.cumsum(keep) - 1
            at = shift[at]
            symbol, word, cut, place = symbol[keep], word[keep], cut[keep], place[keep]
            rank, result = rank[keep], result[keep]
            ends = np.append(cut[1:], True)
            near = np.zeros(len(symbol), bool)
            near[at] = True
            near[at[~cut[at]] - 1] = True
            changed = np.flatnonzero(near)
            rank[changed] = NONE
            changed = changed[~ends[changed]]
            rank[changed], result[changed] = self.pair(symbol[changed], symbol[changed + 1])
        if not done:
            return symbol, word
        place, symbol, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(place, kind="stable")
        return symbol[order], word[order]

    def finish(self, symbol, word, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids from symbols; characters without a piece become the pieces of their bytes."""
        odd = np.flatnonzero(symbol >= self.size)
        counts = np.ones(len(symbol), np.int64)
        if len(odd):
            codes = [self.extra_code.get(s, s - OTHER) for s in symbol[odd].tolist()]
            encoded = [chr(c).encode("utf-8", "replace") for c in codes]
            counts[odd] = [len(b) for b in encoded]
            ids = np.repeat(symbol, counts)
            is_byte = np.repeat(symbol >= self.size, counts)
            ids[is_byte] = self.byte_ids[np.frombuffer(b"".join(encoded), np.uint8)]
            symbol = ids
        return symbol.astype(np.int32), np.bincount(word, counts, words).astype(np.int64)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts`` and the number of ids of each; null and empty texts have none."""
        ids, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for portion in in_portions(texts, PORTION_CHARS):
            spaced = [f" {t.replace(SPACE, ' ')}" if t else "" for t in portion]
            parts = [space_words(t) for t in spaced]
            got, size = self.store.encode(parts)
            ids.append(got)
            sizes.append(size)
        return np.concatenate(ids), np.concatenate(sizes)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ``ids``. The space set before the text is taken off again, markers such as
        begin and end give nothing, and bytes that form no character give U+FFFD."""
        ids = ids.tolist()
        data = b"".join(map(self.bytes.__getitem__, ids))
        opening = next((i for i in ids if self.bytes[i]), None)
        return data[opening in self.opens :].decode("utf-8", "replace")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, loaded once per Python worker."""
    return Vocabulary(path)


def encode_column(text: Column, path: str) -> Column:
    """Ids of each text as an array of ints; a null text counts as empty and gives ``[]``."""

    @F.arrow_udf("array<int>")
    def ids_of(texts: pa.Array) -> pa.Array:
        ids, sizes = vocabulary(path).encode(texts.to_pylist())
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))

    return ids_of(text)


def decode_column(ids: Column, path: str) -> Column:
    """Text of each array of ids; null gives an empty text."""

    @F.arrow_udf("string")
    def text_of(arrays: pa.Array) -> pa.Array:
        model = vocabulary(path)
        flat = arrays.flatten().to_numpy(zero_copy_only=False)
        lengths = np.array([0 if x is None else x for x in arrays.value_lengths().to_pylist()], np.int64)
        ends = np.cumsum(lengths)
        return pa.array([model.decode(flat[e - n : e]) for e, n in zip(ends, lengths, strict=True)], pa.string())

    return text_of(ids)
