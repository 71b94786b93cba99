"""Data-quality helpers: ordered reason chains (C10, C11) and JSON row snapshots (C14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """C11: the text of the first failing rule, NULL when every rule passes.

    ``rules`` are (failure condition, reason) pairs in evaluation order; a
    NULL condition counts as "not failing", as in SQL CASE.
    """
    out = None
    for cond, reason in rules:
        out = F.when(cond, F.lit(reason)) if out is None else out.when(cond, F.lit(reason))
    return out if out is not None else F.lit(None).cast("string")


def row_json(cols: Sequence[str]) -> Column:
    """C14: JSON object of the named columns, NULL fields kept (as JSON_OBJECT)."""
    return F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})


def distinct_list(c: Column | str, sep: str = " | ") -> Column:
    """Distinct values, sorted, joined with ``sep`` (no length cap)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.concat_ws(sep, F.array_sort(F.collect_set(col)))
