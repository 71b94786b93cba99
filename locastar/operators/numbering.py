"""Consecutive numbers over a whole table without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_numbers(df: DataFrame, order: Sequence[Column | str], name: str, start: int = 0) -> DataFrame:
    """``df`` with ``name`` = start + 1, start + 2, ... in ``order``.

    Ranges of the order are numbered each in a task of their own and offset by
    the rows of the ranges before them; the driver gets one count for each range.
    """
    dealt = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).checkpoint(eager=True)
    sizes = {r["_range"]: r["count"] for r in dealt.groupBy("_range").count().collect()}
    before, offsets = start, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    spark = df.sparkSession
    offset = spark.createDataFrame(offsets, "_range int, _before long")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn(name, within).join(F.broadcast(offset), "_range") \
        .withColumn(name, (F.col(name) + F.col("_before")).cast("long")).drop("_range", "_before")


def positions(ordered: DataFrame, ties: Sequence[Column | str], name: str) -> DataFrame:
    """``ordered`` with the place of each row in the order that it really has,
    rows alike in ``ties`` at the place of their first. The order is read off
    the sorted partitions, not made again: ``monotonically_increasing_id`` holds
    the partition and the row's number in it. Rows alike are not brought together
    (a tie may hold most rows): the first place of each tie is aggregated, then joined."""
    at = F.col("_at")
    held = ordered.withColumn("_at", F.monotonically_increasing_id()) \
        .withColumn("_part", F.shiftright(at, 33)).checkpoint(eager=True)
    sizes = {r["_part"]: r["count"] for r in held.groupBy("_part").count().collect()}
    before, offsets = 0, []
    for part in sorted(sizes):
        offsets.append((part, before))
        before += sizes[part]
    offset = ordered.sparkSession.createDataFrame(offsets, "_part long, _before long")
    numbered = held.join(F.broadcast(offset), "_part") \
        .withColumn("_n", (F.col("_before") + at.bitwiseAND((1 << 33) - 1) + 1).cast("long"))
    columns = [F.expr(t) if isinstance(t, str) else t for t in ties]
    first = numbered.groupBy(*[c.alias(f"_t{i}") for i, c in enumerate(columns)]).agg(F.min("_n").alias(name))
    alike = reduce(and_, [c.eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(columns)])
    return numbered.join(first, alike).select(*ordered.columns, name)
