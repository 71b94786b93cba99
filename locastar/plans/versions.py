"""Versions of the written warehouse: which folders of which partitions a night published.

Layout under ``<out_dir>/dw``::

    <dimension>/v=<id>/                 rows of a dimension, written by the night <id>
    <fact>/<partition>=<value>/v=<id>/  rows of one month or day of a fact, written by the night <id>
    _late/<conformed table>/v=<id>/     rows to be tried again (late keys)
    _published/c=<number>               one record per night: its id, the cuts and the folders of every table

A night writes new folders and publishes one record; partitions that it does
not touch are carried into the new record by name. Published folders never
change, so a reader of any version sees it whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.operators import commits
from locastar.plans.warehouse import TABLES
from locastar.schemas import DW_SCHEMAS

#: Partition column of each fact and what gives a row's value. A row's month never
#: changes: the dates behind it are not among the columns that an upsert updates.
FACT_PARTITION = {
    "fato_inventario_patio": ("sk_tempo_referencia", "sk_tempo_referencia"),
    "fato_locacao": ("mes", "coalesce(sk_tempo_retirada div 100, 0)"),
    "fato_reserva": ("mes", "coalesce(sk_tempo_prev_retirada div 100, 0)"),
}


@dataclass
class Version:
    """``tables``: table -> partition value ("" for a table in one folder) -> the night that wrote it."""

    id: str
    cuts: dict[str, dt.date] = field(default_factory=dict)
    tables: dict[str, dict[str, str]] = field(default_factory=dict)

    def record(self) -> dict:
        return {"version": self.id, "cuts": {f: d.isoformat() for f, d in self.cuts.items()}, "tables": self.tables}

    @staticmethod
    def of(record: dict) -> "Version":
        return Version(record["version"], {f: dt.date.fromisoformat(d) for f, d in record["cuts"].items()}, record["tables"])


def published(spark: SparkSession, out_dir: str, version: str | None = None) -> tuple[int, Version] | None:
    """(number, the version of that id, or the last one); None before the first night. Read errors are raised."""
    folder = f"{out_dir}/dw/_published"
    last = commits.latest(spark, folder)
    while last and version and last[1]["version"] != version:
        last = commits.read(spark, folder, last[0] - 1) if last[0] else None
    if last is None and version:
        raise ValueError(f"{out_dir}: no version {version}")
    return (last[0], Version.of(last[1])) if last else None


def cuts_before(spark: SparkSession, out_dir: str, last: tuple[int, Version], night: str) -> dict[str, dt.date]:
    """The cuts of the last version that no run of this night (ids that begin with ``night``) published."""
    number, version = last
    while version.id.startswith(night):
        if number == 0:
            return {}
        number, version = number - 1, Version.of(commits.read(spark, f"{out_dir}/dw/_published", number - 1)[1])
    return version.cuts


def publish(spark: SparkSession, out_dir: str, number: int, version: Version) -> None:
    commits.commit(spark, f"{out_dir}/dw/_published", number, version.record())


def folder_of(table: str, part: str, night: str) -> str:
    """Folder of a partition below ``dw``."""
    column = FACT_PARTITION[table][0] if table in FACT_PARTITION else ""
    return f"{table}/" + (f"{column}={part}/" if column else "") + f"v={night}"


def read(spark: SparkSession, out_dir: str, version: Version, table: str, parts: Sequence[str] | None = None) -> DataFrame:
    """A table of a version, or some of its partitions, with its declared schema.

    A fact by months has the partition column ``mes`` too, so a bound on it prunes folders.
    """
    schema = DW_SCHEMAS[table]
    if table in FACT_PARTITION and FACT_PARTITION[table][0] not in schema:
        schema += f", {FACT_PARTITION[table][0]} int"
    held = version.tables.get(table, {})
    wanted = {p: n for p, n in held.items() if parts is None or p in parts}
    if not wanted:
        return spark.createDataFrame([], schema)
    paths = [f"{out_dir}/dw/{folder_of(table, p, n)}" for p, n in wanted.items()]
    return spark.read.schema(schema + ", v string").option("basePath", f"{out_dir}/dw/{table}").parquet(*paths).drop("v")


def write(spark: SparkSession, out_dir: str, night: str, table: str, rows: DataFrame) -> None:
    """Rows of a table, with its partition column, in folders of this night. A fact's rows are
    dealt by partition first, large ones over several tasks: else every task writes a file of each."""
    column = [FACT_PARTITION[table][0]] if table in FACT_PARTITION else []
    if column:
        rows = rows.hint("rebalance", *column)
    rows.withColumn("v", F.lit(night)).write.mode("append").partitionBy(*column, "v").parquet(f"{out_dir}/dw/{table}")


def carried(spark: SparkSession, out_dir: str, previous: dict[str, str], table: str, night: str, touched: Sequence[str]) -> dict[str, str]:
    """The partitions after ``touched`` ones were written anew; those left without rows go."""
    out = {p: n for p, n in previous.items() if p not in touched}
    for p in touched:
        folder = f"{out_dir}/dw/{folder_of(table, p, night)}"
        if any(n.startswith("part-") for n in commits.names(spark, folder)):
            out[p] = night
    return out


def drop_unnamed(spark: SparkSession, out_dir: str, number: int, keep: int) -> None:
    """Delete the folders that only the record ``number - keep`` names: readers have
    the last ``keep`` versions. Folders of nights that failed stay until removed by hand."""
    if number < keep:
        return
    folder = f"{out_dir}/dw/_published"
    old = Version.of(commits.read(spark, folder, number - keep)[1])
    named = {(t, p, n) for k in range(number - keep + 1, number + 1)
             for t, parts in commits.read(spark, folder, k)[1]["tables"].items() for p, n in parts.items()}
    for t, parts in old.tables.items():
        for p, n in parts.items():
            if (t, p, n) not in named:
                commits.delete(spark, f"{out_dir}/dw/{folder_of(t, p, n)}")


def read_warehouse(spark: SparkSession, out_dir: str, version: str | None = None) -> dict[str, DataFrame]:
    """The tables of the version of that id, or of the last one; none before the first night."""
    found = published(spark, out_dir, version)
    return {t: read(spark, out_dir, found[1], t) for t in TABLES} if found else {}


