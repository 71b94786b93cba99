"""Write-mode operators (S3, S4, S5, S6, S7, S8) without a lakehouse table format.

The pure parts (``merge_upsert``, ``insert_ignore``) return the new table
version as a DataFrame; the writers put it in place with dynamic partition
overwrite or append, never overwriting a path that the same plan reads.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from locastar.operators import commits


def _flip(c, dtype):
    """An expression whose DESCENDING order is ``c``'s ascending order."""
    name = dtype.typeName()
    if name == "date":
        return -F.datediff(c, F.lit("1970-01-01").cast("date"))
    if name in ("timestamp", "timestamp_ntz"):
        return -F.unix_micros(c.cast("timestamp"))
    if name in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        return -c
    raise TypeError(f"ascending pick on a {name} column is not supported")


def numbers_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys with texts last: rows are sorted by them, and a fleet's name tells few rows apart."""
    schema = df.schema
    return sorted(keys, key=lambda k: schema[k].dataType.typeName() == "string")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """One row per key -- the first by ``order`` ((column, descending) pairs).

    Computed as ONE aggregation, ``max(struct(sort fields..., row...))``, not
    as a ``row_number`` window: the maximum combines map-side, so a key
    holding a third of all rows is reduced before the shuffle instead of
    landing whole in one task. Ties on the sort fields are broken by the row
    values themselves (deterministic). NULL sort values lose against any
    value, in both directions.
    """
    payload = [c for c in df.columns if c not in keys]
    sort = []
    for i, (c, desc) in enumerate(order):
        col = F.col(c) if desc else _flip(F.col(c), df.schema[c].dataType)
        sort.append(col.alias(f"_o{i}"))
    best = df.groupBy(*numbers_first(df, keys)).agg(F.max(F.struct(*sort, *[F.col(c) for c in payload])).alias("_p"))
    return best.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in payload])


def merge_upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str] | None = None,
                 order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """S3: INSERT ... ON DUPLICATE KEY UPDATE <update_cols>.

    New keys are inserted with all their columns; existing keys take only
    ``update_cols`` from ``source`` (None = every non-key column) and keep the
    rest. A key repeated in ``source`` is applied once (the first by ``order``,
    ties by the row that sorts last over all columns -- deterministic); repeated keys already in
    ``target`` are each updated, so a re-run never multiplies rows. One full
    outer join on the key: the dedup window and the join share one shuffle
    of each side.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    if any(c not in keys for c in source.columns):
        source = latest_per_key(source, keys, order)
    else:
        source = source.distinct()
    upd = set(cols if update_cols is None else update_cols)
    t = target.withColumn("_t", F.lit(True))
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in cols if c in source.columns],
                      F.lit(True).alias("_s"))
    j = t.join(s, numbers_first(target, keys), "full")
    out = []
    for c in cols:
        sc = f"_s_{c}"
        if sc not in s.columns:
            out.append(F.col(c))
        elif c in upd:
            out.append(F.when(F.col("_s"), F.col(sc)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_t"), F.col(c)).otherwise(F.col(sc)).alias(c))
    return j.select(*keys, *out).select(*target.columns)


def update_only(target: DataFrame, source: DataFrame, keys: Sequence[str],
                update_cols: Sequence[str]) -> DataFrame:
    """ST4/ST6: update existing keys only; unknown keys in ``source`` are ignored."""
    s = source.join(target.select(*keys), list(keys), "left_semi")
    return merge_upsert(target, s, keys, update_cols)


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add only rows whose key is not in ``target`` (first row per new key)."""
    new = source.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(new.select(*target.columns))


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows S8 would append."""
    return source.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")


def replace_slice(df: DataFrame, path: str, part_cols: Sequence[str], fmt: str = "parquet",
                  slices: Sequence[tuple] = ()) -> None:
    """Replace the partitions present in ``df`` (one fleet, one day).

    ``slices`` names slices by values of the leading partition columns; one of
    which ``df`` has no row is removed, as delete and insert of nothing would.
    Rows are counted while they are written. Dynamic partition overwrite:
    other fleets' and other days' folders are not touched, so F2's whole-table
    truncate (S4b) cannot happen.
    """
    seen = Observation()
    if slices:
        of = [reduce(and_, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(part_cols, s)]) for s in slices]
        df = df.observe(seen, *[F.count(F.when(c, 1)).alias(f"n{k}") for k, c in enumerate(of)])
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*part_cols).format(fmt).save(path))
    for k, s in enumerate(slices):
        if not seen.get.get(f"n{k}"):
            commits.delete(df.sparkSession, path + "".join(f"/{c}={v}" for c, v in zip(part_cols, s)))


def append_rejects(df: DataFrame, path: str, run: str, step: str) -> None:
    """Append to the reject log; a run that is repeated replaces its own rows."""
    (df.withColumn("run_id", F.lit(run)).withColumn("run_step", F.lit(step)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "run_step").parquet(path))


def seed_if_empty(target: DataFrame | None, seed: DataFrame) -> DataFrame:
    """The seed when the table is missing or empty, else the table."""
    if target is None or target.isEmpty():
        return seed
    return target
