"""Hex and RTF decoding as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import CP1252_UPPER, HEX_BLANKS, RTF_CHARACTERS, RTF_MARK, RTF_MARK_WITHIN
from .scan import fold_emit, let


def decode_hex(text: Column, min_hex_len: int = 0) -> Column:
    """Text written as hex digits of UTF-8 (else Latin-1) bytes; other text unchanged.

    Blanks between digits are ignored. Digit text of even length such as ``2024``
    counts as hex; ``min_hex_len`` leaves shorter runs alone.
    """
    digits_only = text.rlike(rf"\A[0-9a-fA-F{''.join(HEX_BLANKS)}]*+\z")

    def from_bytes(raw: Column) -> Column:
        as_utf8 = raw.cast("string")
        return F.when(F.is_valid_utf8(as_utf8), as_utf8).otherwise(F.decode(raw, "ISO-8859-1"))

    def from_digits(digits: Column) -> Column:
        even = (F.length(digits) % 2 == 0) & (F.length(digits) >= min_hex_len)
        return F.when(even, let(F.unhex(digits), from_bytes)).otherwise(text)

    # Plain text fails the pattern at its first other character and costs nothing more.
    decoded = let(F.translate(text, "".join(HEX_BLANKS), ""), from_digits)
    return F.when(digits_only, decoded).otherwise(text)


def is_rtf(text: Column) -> Column:
    """Whether the RTF mark stands in the first characters."""
    return F.contains(F.substring(text, 1, RTF_MARK_WITHIN), F.lit(RTF_MARK))


# The start of a group that is not text.
_HIDDEN = (
    r"\{\s*(?:\\\*|\\(?:fonttbl|colortbl|stylesheet|info|pict|header|footer|generator"
    r"|listtable|listoverridetable|themedata|datastore)(?![a-zA-Z]))"
)


def _drop_hidden(text: Column) -> Column:
    """Text without hidden groups, however deep they nest; escaped braces are gone by now.

    The number of braces open since a hidden group began is carried along; 0 means text.
    """
    tokens = F.regexp_extract_all(text, F.lit(_HIDDEN + r"|[{}]|[^{}]++"), F.lit(0))

    def step(open_: Column, token: Column) -> Column:
        opens, closes = F.startswith(token, F.lit("{")), token == "}"
        inside = F.when(opens, open_ + 1).when(closes, open_ - 1).otherwise(open_)
        return F.when(open_ > 0, inside).when(opens & (F.length(token) > 1), 1).otherwise(0)

    def shown(open_: Column, token: Column) -> Column:
        return (open_ == 0) & ~(F.startswith(token, F.lit("{")) & (F.length(token) > 1))

    kept = fold_emit(tokens, F.lit(0), step, shown, lambda _, token: token, "string")
    return F.array_join(kept, "")

# Private-use stand-ins for escaped characters while control words are removed.
_BACKSLASH, _OPEN, _CLOSE = "\ue000", "\ue001", "\ue002"


def replace_matches(text: Column, pattern: str, decode: Callable[[Column], Column]) -> Column:
    """Replace each match of ``pattern`` by ``decode(match)``, in one pass over the text."""

    def rebuild(t: Column) -> Column:
        plain = F.split(t, pattern, -1)
        found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
        rest = F.slice(plain, F.lit(2), F.size(found))
        joined = F.array_join(F.zip_with(found, rest, lambda f, p: F.concat(decode(f), p)), "")
        return F.when(F.size(found) == 0, t).otherwise(F.concat(F.get(plain, F.lit(0)), joined))

    return let(text, rebuild)


def _unicode_run(run: Column) -> Column:
    r"""Characters of a run of ``\uN``; UTF-16 units, so surrogate pairs come together."""

    def unit(number: Column) -> Column:
        code = number.cast("int")
        return F.lpad(F.hex(F.when(code < 0, code + 65536).otherwise(code)), 4, "0")

    units = F.transform(F.regexp_extract_all(run, F.lit(r"\\u(-?[0-9]{1,5})"), F.lit(1)), unit)
    return F.decode(F.unhex(F.array_join(units, "")), "UTF-16BE")


def _byte_run(run: Column) -> Column:
    r"""Characters of a run of ``\'xx`` in Windows code page 1252."""
    raw = F.unhex(F.replace(run, F.lit("\\'"), F.lit("")))
    controls = "".join(chr(c) for c in range(0x80, 0xA0))
    return F.translate(F.decode(raw, "ISO-8859-1"), controls, CP1252_UPPER)


def _named_character(word: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in RTF_CHARACTERS.items() for x in pair])
    return F.element_at(table, F.regexp_extract(word, "[a-z]+", 0))


def strip_rtf(text: Column) -> Column:
    """Plain text of an RTF document; text without the RTF mark is unchanged.

    Font, colour, style and other ignorable groups go with all that is nested in them.
    """
    t = F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH))
    t = F.replace(t, F.lit("\\{"), F.lit(_OPEN))
    t = F.replace(t, F.lit("\\}"), F.lit(_CLOSE))
    t = F.regexp_replace(t, r"\\\r?\n", r"\\par ")
    t = F.translate(t, "\r\n", "")
    t = let(t, lambda x: F.when(x.rlike(_HIDDEN), _drop_hidden(x)).otherwise(x))
    # A stand-in character for old readers follows each \uN.
    t = replace_matches(t, r"(?:\\u-?[0-9]{1,5} ?(?:\\'[0-9a-fA-F]{2}|[^\\{}])?)+", _unicode_run)
    t = replace_matches(t, r"(?:\\'[0-9a-fA-F]{2})+", _byte_run)
    names = "|".join(RTF_CHARACTERS)
    t = replace_matches(t, rf"\\(?:{names})(?![a-zA-Z])(?:-?[0-9]+)? ?", _named_character)
    t = F.replace(t, F.lit("\\~"), F.lit("\u00a0"))
    t = F.replace(t, F.lit("\\_"), F.lit("\u2011"))
    t = F.replace(t, F.lit("\\-"), F.lit("\u00ad"))
    t = F.regexp_replace(t, r"\\(?:[a-zA-Z]+(?:-?[0-9]+)? ?|[^a-zA-Z])", "")
    t = F.translate(t, "{}", "")
    t = F.translate(t, _BACKSLASH + _OPEN + _CLOSE, "\\{}")
    return F.when(is_rtf(text), t).otherwise(text)
