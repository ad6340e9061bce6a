"""All registered queries and their SQL twins."""

from __future__ import annotations

from . import compare, decode, files, jobs, models, spans, topics, vectors

CHECKS: dict[str, tuple] = {}
for _module in (decode, files, spans, models, vectors, topics, compare, jobs):
    CHECKS.update(_module.QUERIES)
