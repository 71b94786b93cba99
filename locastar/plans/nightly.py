"""The nightly job -- extract, conform, load dimensions and facts, log rejects.

Layout under ``out_dir``::

    raw/<entity>/nk_frota_origem=<fleet>/...        (S1/S2: what the night extracted)
    conformed/<table>/nk_frota_origem=<fleet>/...   (S4: one fleet's slice replaced)
    .../snapshot.../nk_frota_origem=<f>/data_snapshot=<d>/  (S5: one day replaced, also by nothing)
    rejects/                                        (S6: one slice per run and step)
    _aside/<night>/                                 (rows between two steps; gone when a table is loaded)
    dw/                                             (versions, see plans.versions)

A night reads what changed since the cut that the last published record names
for each fleet (S2); sources without a change date are read whole. The load
finds the rows that differ from what is stored, rewrites the partitions that
hold them, and carries all others into the new version by name. Rows with late
keys are kept beside the version and tried again the next night.

Large tables are staged and loaded one fleet at a time, and merged some months
at a time; what a pass shuffles is gone before the next, so the disk that a
night needs besides its tables is a share of the largest one.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.functions.dates import calendar, date_key_of
from locastar.operators import commits
from locastar.operators import dims as D
from locastar.operators import facts as FL
from locastar.operators.merge import append_rejects, latest_per_key, merge_upsert, numbers_first, replace_slice
from locastar.plans import versions as V
from locastar.plans.versions import Version, read_warehouse  # noqa: F401  (read_warehouse: for callers)
from locastar.plans.warehouse import CONFORMED, DIMENSION_SOURCES, calendar_dates, conform_sources
from locastar.session import LEAN_DISK, settings, together
from locastar.sources.analogue import AS_OF, Analogue
from locastar.sources.fleets import FLEETS, KEY_SPACE, SOURCES

PARTITIONS = {
    "stg_conf_snapshot_patio": ["nk_frota_origem", "data_snapshot"],
    "raw_snapshot": ["nk_frota_origem", "data_snapshot"],
}
RAW_ENTITIES = ("patio", "grupo", "veiculo", "cliente", "reserva", "locacao", "snapshot")
#: Published versions that readers can rely on.
KEEP_VERSIONS = 7
#: A table of more bytes is staged and loaded one fleet at a time; months of so many
#: are merged together, or of more so that PASSES do.
PASS_BYTES = 64 * 1024 * 1024
PASSES = 8


class _Staged:
    """Raw staging tables exposed with the source interface conform expects."""

    def __init__(self, raw: dict[str, DataFrame]):
        self.raw = raw

    def __getattr__(self, name: str):
        if name.startswith("raw_") and name[4:] in self.raw:
            return lambda: self.raw[name[4:]]
        raise AttributeError(name)


def current_version(spark: SparkSession, out_dir: str) -> str | None:
    """Id of the version published last; None before the first. Read errors are raised."""
    last = V.published(spark, out_dir)
    return last[1].id if last else None


def known_fleets(spark: SparkSession, folder: str) -> None:
    """Fleets outside the registry share one key space: refuse them (by the partition folders, no scan)."""
    found = {n.split("=", 1)[1] for n in commits.names(spark, folder) if n.startswith("nk_frota_origem=")}
    if found - {*FLEETS}:
        raise ValueError(f"{folder}: fleets outside the registry: {sorted(found - {*FLEETS})}")


def run_nightly(spark: SparkSession, sf_dir: str, out_dir: str, as_of: dt.date = AS_OF,
                run_ts: dt.datetime | None = None, incremental: bool = True,
                sources: str = "analogue", fleets: list[str] | None = None,
                known_before: dt.date | None = None, keep: int = KEEP_VERSIONS) -> str:
    """Run extract -> conform -> load for all fleets at once; returns the version's id.

    ``sources="analogue"`` loads the role-mapped test tables (the oracle-checked
    warehouse); ``sources="per_source"`` runs the four source pipelines (per-fleet
    extract mappings and conform configurations, plans.per_source).
    ``fleets`` restricts extract and conform to those fleets: only their slices
    of the raw and conformed tables are replaced (S4) and only their cuts move.
    ``incremental=False`` reads everything and begins the warehouse anew.
    ``known_before`` (analogue only) runs the night on the sources as they were before that day.
    """
    with settings(spark, LEAN_DISK):
        return _night(spark, sf_dir, out_dir, as_of, run_ts or dt.datetime.now().replace(microsecond=0),
                      incremental, sources, fleets, known_before, keep)


def _night(spark, sf_dir, out_dir, as_of, run_ts, incremental, sources, fleets, known_before, keep) -> str:
    run = f"{run_ts:%Y%m%d%H%M%S}" + "".join(f"-{f}" for f in fleets or [])
    last = V.published(spark, out_dir)
    number = last[0] + 1 if last else 0
    before = last[1] if last and incremental else Version("")
    night = f"v{run_ts:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"
    # a night run again reads from the cuts that it began with: its log replaces the first one's
    cuts = V.cuts_before(spark, out_dir, last, night.split("-")[0] + "-") if before.id else {}

    # 1. extract what changed since the cuts; 2. conform it (all fleets together)
    if sources == "per_source":
        from locastar.plans.per_source import StagedSources, conform_per_source
        src, conform_fn = StagedSources(spark, sf_dir, as_of, cuts), conform_per_source
    else:
        src, conform_fn = Analogue(spark, sf_dir, as_of, cuts, known_before), conform_sources
    days = [(f, d) for f, d in src.snapshot_slices() if f in (fleets or FLEETS)]
    raw = _staged(spark, out_dir, "raw", {e: getattr(src, "raw_" + e)() for e in RAW_ENTITIES}, "raw_", fleets, days)
    conf, rejects = conform_fn(_Staged(raw), run_ts)
    conf = _staged(spark, out_dir, "conformed", {n: conf[n] for n in CONFORMED}, "", fleets, days)
    log = os.path.join(out_dir, "rejects")
    append_rejects(reduce(DataFrame.unionByName, rejects), log, run, "conform")
    # rows with late keys of the last night come again, unless the source brought them anew
    conf = {n: _with_late(spark, out_dir, before, n, df, days) for n, df in conf.items()}

    # 3. dimensions, then facts: only what differs is written
    after = Version(night, {**before.cuts, **{f: known_before or as_of for f in fleets or FLEETS}})
    dims = _load_dimensions(spark, out_dir, conf, before, after)
    resolved = {t: [FL.FACT_LOADS[t][1](slice_, dims) for slice_ in _by_fleet(
        conf[source], commits.size(spark, f"{out_dir}/conformed/{source}"))] for t, (source, *_) in FL.FACT_LOADS.items()}
    together(spark, {t: lambda t=t: _load_fact(spark, out_dir, t, resolved[t], conf[FL.FACT_LOADS[t][0]].columns,
                                               before, after, days) for t in resolved})
    warned = [f for f in FLEETS if SOURCES[f].return_yard_warning]
    late = [FL.FACT_LOADS[t][3](tagged, run_ts, warned) if t == "fato_locacao" else FL.FACT_LOADS[t][3](tagged, run_ts)
            for t in resolved for tagged in resolved[t]]
    append_rejects(reduce(DataFrame.unionByName, late), log, run, "load")

    # 4. publish
    V.publish(spark, out_dir, number, after)
    V.drop_unnamed(spark, out_dir, number, keep)
    _drop_aside(spark, out_dir, night)
    return night


def _by_fleet(df: DataFrame, size: int, fleets: list[str] | None = None) -> list[DataFrame]:
    """``df``, or its rows of one fleet after the other where ``size`` bytes are more than a pass takes;
    the last part has what is no other's, so each row is in one (``known_fleets`` refuses fleets that no one knows)."""
    *others, _ = fleets or FLEETS
    if size <= PASS_BYTES or not others:
        return [df]
    fleet = F.col("nk_frota_origem")
    return [*[df.where(fleet == f) for f in others], df.where(F.coalesce(~fleet.isin(*others), F.lit(True)))]


def _source_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))


def _aside(spark: SparkSession, out_dir: str, night: str, name: str, frames: list[DataFrame]) -> DataFrame:
    """Rows written once, frame by frame, and read back. Unlike a checkpoint they are written in columns,
    computed once, and go by ``_drop_aside``."""
    path = f"{out_dir}/_aside/{night}/{name}"
    for df in frames:
        df.write.mode("append").parquet(path)
    return spark.read.schema(frames[0].schema).parquet(path)


def _drop_aside(spark: SparkSession, out_dir: str, night: str, name: str = "") -> None:
    commits.delete(spark, f"{out_dir}/_aside/{night}/{name}".rstrip("/"))


def _staged(spark: SparkSession, out_dir: str, layer: str, frames: dict[str, DataFrame], prefix: str,
            fleets: list[str] | None, days: list[tuple]) -> dict[str, DataFrame]:
    """A layer written once and read back: the rows of this night's fleets. S4 by
    fleets, S5 by days; a slice without rows is removed."""
    def stage(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(out_dir, layer, name)
        by = PARTITIONS.get(prefix + name, ["nk_frota_origem"])
        if fleets:
            df = df.where(F.col("nk_frota_origem").isin(*fleets))
        slices = days if len(by) > 1 else [(f,) for f in fleets or FLEETS]
        passes = _by_fleet(df, _source_bytes(df), fleets)
        if len(passes) == 1:
            replace_slice(df, path, by, slices=slices)
        else:
            for f, own in zip(fleets or FLEETS, passes):
                replace_slice(own, path, by, slices=[x for x in slices if x[0] == f])
        known_fleets(spark, path)
        back = spark.read.schema(df.schema).parquet(path)
        return back.where(F.col("nk_frota_origem").isin(*fleets)) if fleets else back
    staged = together(spark, {n: lambda n=n, df=df: stage(n, df) for n, df in frames.items()})
    # of the snapshot only the days of this night; older ones are loaded already
    for n in staged:
        if len(PARTITIONS.get(prefix + n, [])) > 1 and days:
            tonight = spark.createDataFrame(days, "nk_frota_origem string, data_snapshot date")
            staged[n] = staged[n].join(F.broadcast(tonight), ["nk_frota_origem", "data_snapshot"], "left_semi")
    return staged


#: Conformed tables of the facts, and the key by which a new row takes the place of a late one.
LATE_KEYS = {"stg_conf_reserva": ["nk_frota_origem", "nk_id_reserva"], "stg_conf_locacao": ["nk_frota_origem", "nk_id_locacao"],
             "stg_conf_snapshot_patio": ["nk_frota_origem", "data_snapshot"]}


def _with_late(spark, out_dir, before: Version, name: str, df: DataFrame, days: list[tuple]) -> DataFrame:
    night = before.tables.get(f"_late/{name}", {}).get("")
    if night is None:
        return df
    late = spark.read.schema(df.schema).parquet(f"{out_dir}/dw/_late/{name}/v={night}")
    if name == "stg_conf_snapshot_patio":   # a day that the night replaces is replaced whole
        replaced = spark.createDataFrame(days, "nk_frota_origem string, data_snapshot date")
        return df.unionByName(late.join(F.broadcast(replaced), LATE_KEYS[name], "left_anti"))
    return df.unionByName(late.join(df.select(*LATE_KEYS[name]), LATE_KEYS[name], "left_anti"))


def _load_dimensions(spark, out_dir, conf, before: Version, after: Version) -> dict[str, DataFrame]:
    """Each dimension from its changed rows; one without any is carried over."""
    def keep(table: str, rows: DataFrame | None) -> DataFrame:
        if rows is None:
            after.tables[table] = before.tables[table]
        else:
            V.write(spark, out_dir, after.id, table, rows)
            after.tables[table] = {"": after.id}
        return V.read(spark, out_dir, after, table)

    def addresses():
        old = V.read(spark, out_dir, before, "dim_endereco")
        new = D.new_addresses(old, conf["stg_conf_patio"], conf["stg_conf_cliente"]).checkpoint(eager=True)
        if "dim_endereco" in before.tables and new.isEmpty():
            return keep("dim_endereco", None)
        return keep("dim_endereco", old.unionByName(new))

    def dates():
        first = "dim_tempo" not in before.tables
        old = calendar(spark) if first else V.read(spark, out_dir, before, "dim_tempo")
        new = D.missing_dates(calendar_dates(conf), old).checkpoint(eager=True)
        return keep("dim_tempo", None if not first and new.isEmpty() else old.unionByName(new))

    def dimension(table: str):
        nk, attrs, sk = D.DIM_SPECS[table]
        incoming = D.dim_rows(table, conf[DIMENSION_SOURCES[table]], made["dim_endereco"])
        if table not in before.tables:
            return keep(table, latest_per_key(incoming, [sk, *nk]))
        old = V.read(spark, out_dir, before, table)
        changed = _aside(spark, out_dir, after.id, table, [D.changed_rows(old, incoming, [sk, *nk], attrs)])
        kept = keep(table, None if changed.isEmpty() else D.with_changes(old, changed, [sk, *nk]))
        _drop_aside(spark, out_dir, after.id, table)
        return kept

    made = together(spark, {"dim_endereco": addresses, "dim_tempo": dates})
    return made | together(spark, {t: lambda t=t: dimension(t) for t in DIMENSION_SOURCES})


def _load_fact(spark, out_dir, table: str, resolved: list[DataFrame], staged_columns: list[str],
               before: Version, after: Version, days: list[tuple]) -> None:
    """FL1-FL3 by partitions, and the late rows set aside for the next night."""
    source = FL.FACT_LOADS[table][0]
    again = F.col("_reason").isNotNull()
    if "_warning" in resolved[0].columns:
        again = again | F.col("_warning").isNotNull()
    for tagged in resolved:
        tagged.where(again).select(*staged_columns).write.mode("append").parquet(f"{out_dir}/dw/_late/{source}/v={after.id}")
    loaded = [FL.FACT_LOADS[table][2](tagged) for tagged in resolved]
    after.tables[f"_late/{source}"] = {"": after.id}

    column, part = V.FACT_PARTITION[table][0], F.expr(V.FACT_PARTITION[table][1]).cast("int")
    keys, updates = FL.FACT_KEYS[table], FL.FACT_UPDATES[table]
    rows = [latest_per_key(df, keys) for df in loaded]
    held = before.tables.get(table, {})
    if table == "fato_inventario_patio":
        _replace_days(spark, out_dir, table, rows, before, after, days)
        return
    if not held:   # the first load: every row is new
        for df in rows:
            V.write(spark, out_dir, after.id, table, df.withColumn(column, part))
        made = [n.split("=")[1] for n in commits.names(spark, f"{out_dir}/dw/{table}") if n.startswith(f"{column}=")]
        after.tables[table] = V.carried(spark, out_dir, {}, table, after.id, made)
        return
    span = reduce(DataFrame.unionByName, loaded).agg(F.min(keys[1]), F.max(keys[1])).first()
    if span[0] is None:
        after.tables[table] = held
        return
    # the months that hold the incoming keys, from the key and update columns alone; old
    # row groups are passed over by the span of ids
    stored = V.read(spark, out_dir, before, table).where(F.col(keys[1]).between(span[0], span[1])) \
        .select(*keys, F.struct(*updates).alias("_old"), F.col(column).alias("_part"))
    changed = _aside(spark, out_dir, after.id, table, [
        df.join(stored, numbers_first(df, keys), "left")
        .where(F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.struct(*updates)))
        .withColumn(column, F.coalesce("_part", part)).drop("_old", "_part") for df in rows])
    touched = {str(r[0]): r[1] for r in changed.groupBy(column).count().collect()}
    # a stored key has its month, so months are merged apart
    for months in _months_together(spark, out_dir, table, before, after, touched):
        current = V.read(spark, out_dir, before, table, months)
        own = changed.where(F.col(column).isin(*[int(m) for m in months]))
        V.write(spark, out_dir, after.id, table, merge_upsert(current, own, keys, updates))
    after.tables[table] = V.carried(spark, out_dir, held, table, after.id, list(touched)) if touched else held
    _drop_aside(spark, out_dir, after.id, table)


def _months_together(spark, out_dir, table: str, before: Version, after: Version, touched: dict[str, int]) -> Iterator[list[str]]:
    """The touched months (with their changed rows) in groups of about equal bytes, stored and changed."""
    held = before.tables.get(table, {})
    each = commits.size(spark, f"{out_dir}/_aside/{after.id}/{table}") / max(1, sum(touched.values()))
    weight = {m: n * each + (commits.size(spark, f"{out_dir}/dw/{V.folder_of(table, m, held[m])}") if m in held else 0)
              for m, n in touched.items()}
    most, months = max(PASS_BYTES, sum(weight.values()) / PASSES), []
    for m in sorted(touched):
        if months and sum(weight[x] for x in months) + weight[m] > most:
            yield months
            months = []
        months = [*months, m]
    if months:
        yield months


def _replace_days(spark, out_dir, table, rows, before: Version, after: Version, days: list[tuple]) -> None:
    """FL1: the night's (fleet, day) slices are replaced, also by nothing; late rows of other days join theirs."""
    rows = _aside(spark, out_dir, after.id, table, rows)
    held = before.tables.get(table, {})
    brought = {str(r[0]) for r in rows.select("sk_tempo_referencia").distinct().collect()}
    replaced = {(str(date_key_of(d)), FLEETS.index(f) + 1) for f, d in days}
    touched = sorted(brought | {d for d, _ in replaced if d in held})
    kept = V.read(spark, out_dir, before, table, [d for d in touched if d in held])
    if replaced:
        slices = spark.createDataFrame([(int(d), f) for d, f in sorted(replaced)], "_day int, _fleet long")
        kept = kept.join(F.broadcast(slices), (F.col("sk_tempo_referencia") == F.col("_day"))
                         & (F.floor(F.col("sk_patio") / KEY_SPACE) == F.col("_fleet")), "left_anti")
    V.write(spark, out_dir, after.id, table, D.with_changes(kept, rows, FL.FACT_KEYS[table]))
    after.tables[table] = V.carried(spark, out_dir, held, table, after.id, touched)
    _drop_aside(spark, out_dir, after.id, table)
