"""Warehouse build: raw staging -> conformed (+ rejects) -> dimensions -> facts.

Everything is lazy: ``build_warehouse`` returns DataFrames whose plans read
the input tables. The nightly job (plans.nightly) materialises them; the
marts can run on either the lazy frames or the written tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from locastar.functions.dates import calendar
from locastar.operators import conform as C
from locastar.operators import dims as D
from locastar.operators import facts as FL
from locastar.session import scratch_path, together
from locastar.sources.analogue import AS_OF, Analogue

DIMENSIONS = ("dim_tempo", "dim_patio", "dim_grupo", "dim_veiculo", "dim_cliente", "dim_endereco")
FACTS = ("fato_inventario_patio", "fato_locacao", "fato_reserva")
TABLES = DIMENSIONS + FACTS
CONFORMED = ("stg_conf_patio", "stg_conf_grupo", "stg_conf_veiculo", "stg_conf_cliente",
             "stg_conf_reserva", "stg_conf_locacao", "stg_conf_snapshot_patio")

# Dimension -> conformed table.
DIMENSION_SOURCES = {"dim_patio": "stg_conf_patio", "dim_grupo": "stg_conf_grupo",
                     "dim_veiculo": "stg_conf_veiculo", "dim_cliente": "stg_conf_cliente"}

RESERVATION_DATES = ["data_reserva", "data_retirada_prevista", "data_devolucao_prevista"]
RENTAL_DATES = ["data_retirada", "data_prev_devolucao", "data_real_devolucao"]


def calendar_dates(conf: dict[str, DataFrame]) -> list[tuple[DataFrame, list[str]]]:
    """The date columns whose values the calendar must have."""
    return [(conf["stg_conf_reserva"], RESERVATION_DATES), (conf["stg_conf_locacao"], RENTAL_DATES),
            (conf["stg_conf_snapshot_patio"], ["data_snapshot"])]


@dataclass
class Warehouse:
    conformed: dict[str, DataFrame] = field(default_factory=dict)
    tables: dict[str, DataFrame] = field(default_factory=dict)
    rejects: list[DataFrame] = field(default_factory=list)

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def reject_log(self) -> DataFrame:
        out = self.rejects[0]
        for r in self.rejects[1:]:
            out = out.unionByName(r)
        return out


def conform_sources(src: Analogue, run_ts: dt.datetime | None = None) -> tuple[dict, list]:
    """Apply the conform rules to every raw entity."""
    grupo, w = C.conform_grupo(src.raw_grupo(), run_ts=run_ts)
    veic, r1 = C.conform_veiculo(src.raw_veiculo(), run_ts=run_ts)
    cli, r2 = C.conform_cliente(src.raw_cliente(), run_ts=run_ts)
    res, r3 = C.conform_reserva(src.raw_reserva(), run_ts=run_ts)
    loc, r4 = C.conform_locacao(src.raw_locacao(), run_ts=run_ts)
    snap, r5 = C.conform_snapshot(src.raw_snapshot(), run_ts=run_ts)
    conf = {"stg_conf_patio": C.conform_patio(src.raw_patio()), "stg_conf_grupo": grupo,
            "stg_conf_veiculo": veic, "stg_conf_cliente": cli, "stg_conf_reserva": res,
            "stg_conf_locacao": loc, "stg_conf_snapshot_patio": snap}
    return conf, [w, r1, r2, r3, r4, r5]


def _identity(name: str, df: DataFrame) -> DataFrame:
    return df


def checkpointed(name: str, df: DataFrame) -> DataFrame:
    """Cut the lineage: reliable checkpoint into the shared ``spark.checkpoint.dir``."""
    return df.checkpoint(eager=True)


def stored(name: str, df: DataFrame) -> DataFrame:
    """Write once to the shared folder and read back, as the nightly job does."""
    path = scratch_path(df.sparkSession, f"warehouse-{uuid.uuid4().hex}/{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _each(spark: SparkSession, frames: dict[str, DataFrame],
          materialize: Callable[[str, DataFrame], DataFrame]) -> dict[str, DataFrame]:
    """Frames that do not read each other, materialised side by side."""
    return together(spark, {k: lambda k=k, v=v: materialize(k, v) for k, v in frames.items()})


def load_dims(spark: SparkSession, conf: dict[str, DataFrame],
              current: dict[str, DataFrame] | None = None,
              materialize: Callable[[str, DataFrame], DataFrame] = _identity) -> dict[str, DataFrame]:
    """Conformed tables -> the 6 dimensions."""
    current = current or {}
    address = D.address_dim(current.get("dim_endereco") or D.empty_address(spark),
                            conf["stg_conf_patio"], conf["stg_conf_cliente"])
    cal = D.ensure_calendar(current.get("dim_tempo") or calendar(spark), calendar_dates(conf))
    address = materialize("dim_endereco", address)
    dims = {"dim_tempo": cal,
            **{d: D.load_dim(d, conf[c], address, current.get(d)) for d, c in DIMENSION_SOURCES.items()}}
    return {"dim_endereco": address, **_each(spark, dims, materialize)}


def load_facts(conf: dict[str, DataFrame], dims: dict[str, DataFrame],
               current: dict[str, DataFrame] | None = None,
               run_ts: dt.datetime | None = None) -> tuple[dict, list]:
    """Conformed tables + (materialised) dimensions -> 3 facts + late-key rejects.

    Key resolution runs small jobs on the distinct keys (facts._resolve), so
    ``dims`` should be written or checkpointed tables.
    """
    current = current or {}
    loads = {"fato_inventario_patio": FL.load_inventory, "fato_locacao": FL.load_rental, "fato_reserva": FL.load_reservation}
    spark = dims["dim_tempo"].sparkSession
    made = together(spark, {f: lambda f=f, load=load: load(conf[FL.FACT_LOADS[f][0]], dims, current.get(f), run_ts)
                            for f, load in loads.items()})
    return {f: made[f][0] for f in loads}, [made[f][1] for f in loads]


def load_warehouse(spark: SparkSession, conf: dict[str, DataFrame],
                   current: dict[str, DataFrame] | None = None,
                   run_ts: dt.datetime | None = None,
                   materialize: Callable[[str, DataFrame], DataFrame] = _identity) -> tuple[dict, list]:
    """Conformed tables -> 6 dimensions + 3 facts (+ late-key rejects)."""
    dims = load_dims(spark, conf, current, materialize)
    facts, late = load_facts(conf, dims, current, run_ts)
    return dict(dims, **facts), late


def build_warehouse(spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF,
                    run_ts: dt.datetime | None = None, materialize: bool | str = True) -> Warehouse:
    """Warehouse frames; ``materialize``: True writes every conformed table,
    dimension and fact to the shared folder and reads them back, "checkpoint"
    checkpoints them there, False leaves them lazy."""
    src = Analogue(spark, sf_dir, as_of)
    conf, rej = conform_sources(src, run_ts)
    m = {True: stored, "checkpoint": checkpointed}.get(materialize, _identity)
    conf = _each(spark, conf, m)
    tables, late = load_warehouse(spark, conf, run_ts=run_ts, materialize=m)
    if m is not _identity:
        tables.update(_each(spark, {k: tables[k] for k in FACTS}, m))
    return Warehouse(conf, tables, rej + late)
