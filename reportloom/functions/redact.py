"""Date redaction, person labels and span replacement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed import (
    BIRTH_LABELS,
    BIRTH_REACH,
    DATE_PLACEHOLDER,
    MONTH_NAMES,
    NAME_PLACEHOLDER,
    NON_SPACE_CLASS,
    PERSON_LABELS,
    SPACE_CLASS,
    WORD_CLASS,
)

_NO_WORD_BEFORE = f"(?<!{WORD_CLASS})"
_NO_WORD_AFTER = f"(?!{WORD_CLASS})"
_EDGE = f"(?:(?<={WORD_CLASS}){_NO_WORD_AFTER}|{_NO_WORD_BEFORE}(?={WORD_CLASS}))"
_DAY = r"\p{Nd}{1,2}"
_MONTHS = "(?:" + "|".join(MONTH_NAMES) + ")"

NUMERIC_DATE = rf"{_NO_WORD_BEFORE}{_DAY}[.\-/]{_DAY}[.\-/]\p{{Nd}}{{2,4}}{_NO_WORD_AFTER}"
MONTH_DATE = (
    rf"(?iu){_NO_WORD_BEFORE}{_DAY}{SPACE_CLASS}+{_MONTHS}"
    rf"(?:{SPACE_CLASS}+\p{{Nd}}{{2,4}})?{_NO_WORD_AFTER}"
)
DOTTED_MONTH_DATE = MONTH_DATE.replace(_DAY + SPACE_CLASS, _DAY + r"\." + SPACE_CLASS, 1)
BIRTH_DATE = (
    rf"(?iu){_NO_WORD_BEFORE}(?:{'|'.join(BIRTH_LABELS)}){SPACE_CLASS}*[:\-]?{SPACE_CLASS}*"
    rf"{NON_SPACE_CLASS}[^\n]{{0,{BIRTH_REACH}}}{_EDGE}"
)


def redact_dates(text: Column, day_dot_month: bool = False) -> Column:
    """Numeric dates, then day and month name, then birth labels become a placeholder.

    The order matters: a birth label may swallow a placeholder put in by an earlier
    rule. ``15. Januar`` is left alone unless ``day_dot_month`` is set. Numbers shaped
    like dates, such as part of an IP address, are redacted as well.
    """
    rules = [NUMERIC_DATE, MONTH_DATE, BIRTH_DATE]
    if day_dot_month:
        rules.insert(2, DOTTED_MONTH_DATE)
    for rule in rules:
        text = F.regexp_replace(text, rule, DATE_PLACEHOLDER)
    return text


def is_person_label(label: Column) -> Column:
    """Whether an entity label names a person; null does not."""
    return F.coalesce(F.upper(label).rlike("|".join(PERSON_LABELS)), F.lit(False))


def redact_spans(text: Column, spans: Column, placeholder: str = NAME_PLACEHOLDER) -> Column:
    """Replace ``array<struct<start,end>>`` spans from the last to the first.

    A span that does not fit the text as it stands at that point is ignored.
    """
    backwards = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"], s["end"])), asc=False)

    def replace(t: Column, s: Column) -> Column:
        start, end = s["start"].cast("int"), s["end"].cast("int")
        fits = (start >= 0) & (start < end) & (end <= F.length(t))
        cut = F.concat(t.substr(F.lit(1), start), F.lit(placeholder), t.substr(end + 1, F.length(t)))
        return F.when(fits, cut).otherwise(t)

    return F.when(spans.isNull(), text).otherwise(F.aggregate(backwards, text, replace))
