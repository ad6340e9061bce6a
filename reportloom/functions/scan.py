"""Building blocks inside one row: a local name, and a left-to-right pass with state.

``aggregate`` can carry state but has to copy its output array at each append. Appends
go to a small open block that is closed when full, so a pass over n elements copies
about n * BLOCK / 2 references instead of n * n / 2.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold_emit(
    items: Column,
    state: Column,
    step: Callable[[Column, Column], Column],
    emits: Callable[[Column, Column], Column],
    value: Callable[[Column, Column], Column],
    value_type: str,
    finish: Callable[[Column], Column] | None = None,
) -> Column:
    """Values emitted while folding ``items``.

    ``emits(state, item)`` says whether ``value(state, item)`` is appended before the
    state becomes ``step(state, item)``; ``finish(state)`` appends a last value.
    """
    zero = F.struct(
        F.array().cast(f"array<array<{value_type}>>").alias("closed"),
        F.array().cast(f"array<{value_type}>").alias("open"),
        state.alias("state"),
    )

    def merge(acc: Column, item: Column) -> Column:
        closed, open_, current = acc["closed"], acc["open"], acc["state"]
        one = F.array(value(current, item).cast(value_type))
        full = F.size(open_) >= BLOCK
        emit = emits(current, item)
        return F.struct(
            F.when(emit & full, F.concat(closed, F.array(open_))).otherwise(closed).alias("closed"),
            F.when(emit & full, one).when(emit, F.concat(open_, one)).otherwise(open_).alias("open"),
            step(current, item).alias("state"),
        )

    def close(acc: Column) -> Column:
        tail = acc["open"]
        if finish is not None:
            tail = F.concat(tail, F.array(finish(acc["state"]).cast(value_type)))
        return F.concat(F.flatten(acc["closed"]), tail)

    return F.aggregate(items, zero, merge, close)
