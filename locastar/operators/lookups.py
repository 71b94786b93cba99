"""Join-shaped lookups.

Correlated subqueries of the reference are rewritten set-wise: aggregate the
child side once per key, then one equi-join (J5); pick one row per key with a
partitioned window and an explicit total order (J6, J10, W2).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locastar.operators.merge import latest_per_key


def lookup_agg(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
               aggs: dict[str, Column], defaults: dict[str, object] | None = None) -> DataFrame:
    """Left + per-key aggregates of right (pre-aggregated: partial aggregation
    happens before the shuffle), missing keys -> ``defaults``."""
    agg = right.groupBy(*[F.col(r).alias(f"_k{i}") for i, r in enumerate(right_on)]) \
        .agg(*[c.alias(n) for n, c in aggs.items()])
    cond = [F.col(l) == F.col(f"_k{i}") for i, l in enumerate(left_on)]
    out = left.join(agg, cond, "left").drop(*[f"_k{i}" for i in range(len(right_on))])
    for n, v in (defaults or {}).items():
        out = out.withColumn(n, F.coalesce(F.col(n), F.lit(v)))
    return out


def lookup_first(left: DataFrame, right: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                 order: Sequence[tuple[str, bool]], cols: Sequence[str]) -> DataFrame:
    """LIMIT 1 lookup made deterministic: the first right row per key by
    ``order`` ((column, descending) pairs)."""
    extra: list[str] = []
    for c in [*(c for c, _ in order), *cols]:
        if c not in right_on and c not in extra:
            extra.append(c)
    pick = latest_per_key(right.select(*right_on, *extra), right_on, order).select(
        *[F.col(r).alias(f"_k{i}") for i, r in enumerate(right_on)], *cols)
    cond = [F.col(l) == F.col(f"_k{i}") for i, l in enumerate(left_on)]
    return left.join(pick, cond, "left").drop(*[f"_k{i}" for i in range(len(right_on))])


def not_in(left: DataFrame, right: DataFrame, left_col: str, right_col: str) -> DataFrame:
    """``left_col NOT IN (SELECT right_col FROM right)`` with SQL NULL rules.

    One NULL in the subquery empties the result; a NULL ``left_col`` never
    qualifies. The NULL test is an EXISTS subquery, the rest a left anti join.
    """
    has_null = right.where(F.col(right_col).isNull()).exists()
    keys = right.where(F.col(right_col).isNotNull()).select(F.col(right_col).alias("_nin")).distinct()
    return (left.join(keys, F.col(left_col) == F.col("_nin"), "left_anti")
            .where(F.col(left_col).isNotNull() & ~has_null))


def latest_as_of(df: DataFrame, key: Sequence[str], ts: str, as_of: dt.date | Column,
                 tie: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """Per key, the latest row with ``ts`` not after ``as_of``."""
    a = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return latest_per_key(df.where(F.col(ts) <= a), key, [(ts, True), *tie])
