"""Change-data capture with Structured Streaming (ST1-ST7).

The reference propagates row changes with AFTER INSERT/UPDATE triggers. Here
a change feed (a parquet folder; on a cluster any streaming source) is read
with ``readStream`` and every micro-batch is prepared (conformed, enriched)
and written once, in ``foreachBatch``, to a folder of its own::

    <target>/base/                                 rows that the target began with, if any
    <target>/changes/query=<id>/batch=<number>/    what a batch of a streaming query brought

The state is what readers make of them: the last change of each key by its
sequence, one aggregation that combines before the shuffle. A batch delivered
again replaces its own folder, a new checkpoint has a query id of its own, and
an older change that arrives late loses by its sequence, so no order of
batches, queries or replays changes the state. ``Target.compact`` writes the
state as the base of a new plain folder, for a stream to go on from.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.operators import commits
from locastar.operators.merge import latest_per_key

#: Of update-only targets: the sequence of the change that a compaction applied last.
APPLIED = "_applied_seq"


def change_feed(spark: SparkSession, folder: str, file_glob: str = "events.parquet",
                max_files_per_trigger: int = 1) -> DataFrame:
    """Streaming read of the change files in ``folder`` (schema from one footer)."""
    schema = spark.read.parquet(os.path.join(folder, file_glob)).schema
    return (spark.readStream.schema(schema).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder))


def start_cdc(feed: DataFrame, step: Callable[[DataFrame, int], object], checkpoint: str,
              processing_time: str | None = None):
    """Start the change-feed query: ``step(batch, batch_id)`` per micro-batch.

    ``processing_time`` (e.g. "1 minute") runs continuously; None processes
    what is available and stops (``availableNow``). Returns the StreamingQuery.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        step(batch, batch_id)
    w = feed.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)
    return w.start()


def run_stream(feed: DataFrame, step: Callable[[DataFrame, int], object], checkpoint: str) -> None:
    """Drive ``step(batch, batch_id)`` over everything available, then stop."""
    start_cdc(feed, step, checkpoint).awaitTermination()


def query_id(batch: DataFrame) -> str:
    """The id of the streaming query that delivers ``batch``: one for each checkpoint; "direct" outside a stream."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


@dataclass(frozen=True)
class Target:
    """A keyed target: changes in plain folders, the state by the largest ``seq`` of each key."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    seq: str

    def begin(self, rows: DataFrame) -> None:
        """The rows of a target before its first change."""
        rows.write.parquet(f"{self.path}/base")

    def append(self, changes: DataFrame, batch: DataFrame, batch_id: int) -> DataFrame:
        """Write what ``batch`` brings, once, and read it back."""
        folder = f"{self.path}/changes/query={query_id(batch)}/batch={batch_id}"
        changes.write.mode("overwrite").parquet(folder)
        return self.spark.read.schema(changes.schema).parquet(folder)

    def _read(self, part: str) -> DataFrame | None:
        folder = f"{self.path}/{part}"
        return self.spark.read.parquet(folder).drop("query", "batch") if commits.names(self.spark, folder) else None

    def changes(self) -> DataFrame | None:
        """Every change so far, or None before the first batch. A failing read is raised."""
        return self._read("changes")

    def latest(self) -> DataFrame:
        """ST1: the last row of each key, base rows included."""
        base, changes = self._read("base"), self.changes()
        if base is None and changes is None:
            raise ValueError(f"{self.path}: neither rows nor changes")
        rows = changes if base is None else base if changes is None else base.unionByName(changes, allowMissingColumns=True)
        return latest_per_key(rows, self.keys, [(self.seq, True)]).select(*rows.columns)

    def updated(self, columns: Sequence[str], applied: bool = False) -> DataFrame:
        """ST4/ST6: the base rows with ``columns`` as the last change set them; unknown keys are ignored."""
        base, changes = self._read("base"), self.changes()
        rows = [c for c in base.columns if c != APPLIED]
        if changes is None:
            return base if applied else base.select(*rows)
        last = latest_per_key(changes.select(*self.keys, *columns, self.seq), self.keys, [(self.seq, True)])
        named = last.select(*[F.col(c).alias(f"_c_{c}") for c in (*self.keys, *columns)], F.col(self.seq).alias("_seq"))
        on = reduce(and_, [F.col(k) == F.col(f"_c_{k}") for k in self.keys])
        newer = F.col("_seq").isNotNull()
        if APPLIED in base.columns:
            newer = newer & (F.col(APPLIED).isNull() | (F.col("_seq") > F.col(APPLIED)))
        kinds = {f.name: f.dataType for f in base.schema}
        out = [F.when(newer, F.col(f"_c_{c}")).otherwise(F.col(c)).cast(kinds[c]).alias(c) if c in columns else F.col(c) for c in rows]
        if applied:
            held = F.col(APPLIED) if APPLIED in base.columns else F.lit(None)
            out.append(F.when(newer, F.col("_seq")).otherwise(held).alias(APPLIED))
        return base.join(named, on, "left").select(*out)

    def compact(self, path: str, columns: Sequence[str] | None = None) -> "Target":
        """The state as the base of a new target at ``path``; the old one stays as it is.

        Run it while no stream writes to the target. Changes that come again
        afterwards are harmless: the base keeps every key's sequence.
        ``columns``: those of an update-only target.
        """
        rows = self.latest() if columns is None else self.updated(columns, applied=True)
        new = Target(self.spark, path, self.keys, self.seq)
        new.begin(rows)
        return new


def upsert(target: Target, prepare: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
    """A step that keeps each batch's last change of a key (ST1, and the changes of ST4 to ST7)."""
    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        return target.append(latest_per_key(prepare(batch), target.keys, [(target.seq, True)]), batch, batch_id)
    return step


def append_all(target: Target, prepare: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], DataFrame]:
    """A step that keeps every prepared row of a batch (ST2 outcomes, ST3 enriched rows)."""
    def step(batch: DataFrame, batch_id: int) -> DataFrame:
        return target.append(prepare(batch), batch, batch_id)
    return step


def child_totals(parents: DataFrame, children: DataFrame, parent_key: str, child_key: str, amount: str, total: str,
                 counted: str = "true") -> DataFrame:
    """ST5: ``total`` of each parent with stored children, over those that meet
    ``counted``; a changed child counts once and a cancelled one no more.
    ``children`` is the state of a target keyed by (child_key, id)."""
    sums = children.groupBy(F.col(child_key).alias("_parent")).agg(
        F.coalesce(F.sum(F.when(F.expr(counted), F.col(amount))), F.lit(0)).alias("_total"))
    kind = parents.schema[total].dataType
    return parents.join(sums, F.col(parent_key) == F.col("_parent"), "left").select(
        *[F.coalesce(F.col("_total").cast(kind), F.col(c)).alias(c) if c == total else F.col(c) for c in parents.columns])


# ST2: what became of a change, in the column "outcome".
ACCEPTED, REJECTED, IGNORED = "accepted", "rejected", "ignored"


def outcomes(log: DataFrame, keys: Sequence[str], seq: str, silent_updates: bool = False) -> DataFrame:
    """ST2 (+ST2b): the changes with their outcomes. ``log`` has the rows that
    passed the rules as accepted, the others as rejected; with
    ``silent_updates`` (the reference's update path) a rejected change of a
    key that an earlier change brought in is ignored instead."""
    if not silent_updates:
        return log
    first = log.where(F.col("outcome") == ACCEPTED).groupBy(*keys).agg(F.min(seq).alias("_first"))
    failed = log.where(F.col("outcome") == REJECTED).join(first, list(keys), "left")
    late = failed.withColumn("outcome", F.when(F.col("_first") < F.col(seq), IGNORED).otherwise(REJECTED)).drop("_first")
    return log.where(F.col("outcome") == ACCEPTED).unionByName(late)


def conformed(log: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """ST2: the last accepted change of each key; a rejected one leaves the stored row as it was."""
    accepted = log.where(F.col("outcome") == ACCEPTED)
    return latest_per_key(accepted, keys, [(seq, True)]).select(*log.columns)


def cascaded(log: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """ST7: the last change of each key, where it was accepted: a key whose
    current raw row fails the rules leaves the conformed layer."""
    return latest_per_key(log, keys, [(seq, True)]).select(*log.columns).where(F.col("outcome") == ACCEPTED)
