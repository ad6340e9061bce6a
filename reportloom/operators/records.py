"""Record steps: required fields, routing, output columns and rewriting of open records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

RECORD = "_record"


def with_record_id(df: DataFrame) -> DataFrame:
    """Adds ``_record``, an id of the row itself, whatever keys it carries.

    The rows are written once, so that every later read sees the same ids.
    """
    return materialize(df.withColumn(RECORD, F.monotonically_increasing_id()), "records")


def field(record: Column, name: str, kind: str = "string") -> Column:
    """A field of a variant object by its name, whatever quotes the name holds; null if it is absent."""
    if "'" not in name:
        return F.try_variant_get(record, f"$['{name}']", kind)
    if '"' not in name:
        return F.try_variant_get(record, f'$["{name}"]', kind)
    return F.try_variant_get(F.element_at(record.cast("map<string,variant>"), F.lit(name)), "$", kind)


def require_key_text(df: DataFrame, key: str = "report_key", text: str = "text") -> DataFrame:
    """Rows with key and text, both as strings; other columns are dropped."""
    return df.dropna(subset=[key, text]).select(
        F.col(key).cast("string").alias("report_key"), F.col(text).cast("string").alias("text")
    )


def route(text: Column, empty_passes: bool) -> Column:
    """``pass`` for rows emitted unchanged, ``process`` for rows a stage works on."""
    passes = text.isNull() | (text == "") if empty_passes else text.isNull()
    return F.when(passes, "pass").otherwise("process")


def put_result(
    df: DataFrame,
    result: Column,
    text: str = "text",
    output: str | None = None,
    preserve_suffix: str | None = None,
) -> DataFrame:
    """Write ``result`` to ``output`` (else over ``text``), with the old text kept on request.

    The old text goes to ``text`` plus the suffix: ``_de`` after anonymising,
    ``_original`` after hosted translation.
    """
    added = {output or text: result}
    if preserve_suffix:
        added[text + preserve_suffix] = F.col(text)
    return df.withColumns(added)


def rewrite_record(
    record: Column,
    result: Column,
    key: str,
    output_key: str | None = None,
    preserve_suffix: str | None = None,
) -> Column:
    """JSON text of a variant object with one field replaced and all others kept."""
    fields = record.cast("map<string,variant>")
    written = {output_key or key: result}
    if preserve_suffix:
        written[key + preserve_suffix] = field(record, key)
    names = list(written)
    entries = [x for name in names for x in (F.lit(name), written[name].cast("variant"))]
    kept = F.map_filter(fields, lambda name, _: ~name.isin(*names))
    return F.to_json(F.map_concat(kept, F.create_map(*entries)))


def to_rewrite(empty_passes: bool = False) -> Column:
    """Whether a line is a record whose text a stage works on."""
    return (F.col("status") == "record") & (route(F.col("text"), empty_passes) == "process")


def without_field(record: Column, key: str) -> Column:
    """JSON text of a variant object without one field, for ``with_field``."""
    return F.to_json(F.map_filter(record.cast("map<string,variant>"), lambda name, _: name != key))


def with_field(line: Column, key: str, result: Column) -> Column:
    """JSON text of an object that lacks a field, with that field: what ``rewrite_record`` makes of the whole record.

    The text is not parsed again, as numbers may then be written in another way.
    """
    last = F.to_json(F.create_map(F.lit(key), result.cast("variant")))
    spliced = F.concat(line.substr(F.lit(1), F.length(line) - 1), F.lit(","), last.substr(F.lit(2), F.length(last)))
    return F.when(line == "{}", last).otherwise(spliced)


def rewrite_lines(
    records: DataFrame,
    result: Column,
    key: str = "text",
    output_key: str | None = None,
    preserve_suffix: str | None = None,
    empty_passes: bool = False,
    value: str = "value",
    changed: Column | None = None,
) -> DataFrame:
    """Replace ``value`` by the rewritten record; malformed and passed lines stay raw.

    ``changed`` tells the lines to rewrite where ``text`` no longer does.
    """
    changed = to_rewrite(empty_passes) if changed is None else changed
    rewritten = rewrite_record(F.col("record"), result, key, output_key, preserve_suffix)
    return records.withColumn(value, F.when(changed, rewritten).otherwise(F.col(value)))
