"""Comparison of report versions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.compare import (
    line_difference,
    multi_version,
    search_reports,
    top_of_index,
    version_index,
    version_pairs,
)
from ..operators.difference import ordered_difference


@dataclass
class Comparison:
    """The index of keys, the first two versions of each and how their lines differ.

    ``lines`` counts, ``changes`` says where lines were removed, added or moved to.
    """

    index: DataFrame
    pairs: DataFrame
    lines: DataFrame
    changes: DataFrame


def compare_versions(
    records: DataFrame,
    order: list[str],
    key: str = "report_key",
    text: str = "text",
    min_unique: int | None = 2,
    query: str | None = None,
) -> Comparison:
    """Compare all listed reports: those with enough versions that match the query."""
    if query:
        index = search_reports(records, query, key, text, min_unique)
    else:
        index = multi_version(version_index(records, key, text), min_unique)
    listed = records.join(index.select(key), key, "left_semi")
    pairs = version_pairs(listed, order, key, text)
    return Comparison(top_of_index(index, key), pairs, line_difference(pairs, key), ordered_difference(pairs, key))
