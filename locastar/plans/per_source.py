"""The four source pipelines end to end: source tables -> extract (X) ->
raw staging -> conform with each fleet's configuration -> (warehouse load).

``staged_sources`` returns the same ``raw_<entity>()`` interface as
``sources.analogue.Analogue``, so ``plans.nightly.run_nightly`` can load the
warehouse from either.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.operators import conform as C
from locastar.operators import snapshot as SN
from locastar.sources import oltp
from locastar.sources.analogue import AS_OF, Analogue
from locastar.sources.extract import extract
from locastar.sources.fleets import FLEETS, SOURCES

ENTITIES = ("patio", "grupo", "veiculo", "cliente", "reserva", "locacao")


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def snapshot_inputs(fleet: str, t: dict[str, DataFrame], raw_veiculo: DataFrame, as_of: dt.date) -> DataFrame:
    """SN1-SN4 with each fleet's own inputs and default date."""
    F1, F2, F3, F4 = FLEETS
    if fleet == F1:
        slots = t["Vaga"].select(F.col("Id_vaga").alias("id_vaga"), F.col("Id_patio").alias("id_patio"),
                                 F.col("Id_veiculo").alias("id_veiculo"))
        return SN.yard_snapshot(fleet, raw_veiculo.select("nk_id_veiculo", "nk_id_grupo"), slots=slots, as_of=as_of)
    if fleet == F2:
        rentals = t["locacao"].select("id_locacao", "veiculo_id", "status", "data_retirada_real",
                                      "data_devolucao_real", "patio_devolucao_id")
        return SN.yard_snapshot(fleet, raw_veiculo.select("nk_id_veiculo", "nk_id_grupo", "nk_id_patio_origem",
                                                          "situacao"), rentals=rentals, as_of=as_of)
    if fleet == F3:
        v = t["Veiculo"].select(F.col("Id_veiculo").alias("nk_id_veiculo"), F.col("Id_categoria").alias("nk_id_grupo"),
                                F.col("Id_vaga").alias("id_vaga"))
        slots = t["Vaga"].select(F.col("Id_vaga").alias("id_vaga"), F.col("Id_patio").alias("id_patio"))
        return SN.yard_snapshot(fleet, v, slots=slots, as_of=as_of)
    v = t["VEICULO"].select(F.col("id_veiculo").alias("nk_id_veiculo"), F.col("id_grupo").alias("nk_id_grupo"),
                            "id_patio_atual", "status")
    return SN.yard_snapshot(fleet, v, as_of=as_of)


class StagedSources:
    """raw_<entity>() = union over fleets of that fleet's extract."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = AS_OF,
                 cuts: dict[str, dt.date] | None = None):
        a = Analogue(spark, sf_dir, as_of)
        self.as_of = as_of
        self.raw: dict[str, DataFrame] = {}
        per_fleet = {}
        for fleet in FLEETS:
            t = oltp.TABLES[fleet](a)
            per_fleet[fleet] = {e: extract(t, fleet, e, (cuts or {}).get(fleet)) for e in ENTITIES}
            per_fleet[fleet]["snapshot"] = snapshot_inputs(fleet, t, per_fleet[fleet]["veiculo"], as_of)
        for e in (*ENTITIES, "snapshot"):
            self.raw[e] = _union([per_fleet[f][e] for f in FLEETS])

    def snapshot_slices(self) -> list[tuple[str, dt.date]]:
        """The (fleet, day) slices that the snapshot replaces."""
        return [(f, self.as_of - dt.timedelta(days=SOURCES[f].snapshot_offset_days)) for f in FLEETS]

    def __getattr__(self, name: str):
        if name.startswith("raw_") and name[4:] in self.raw:
            return lambda: self.raw[name[4:]]
        raise AttributeError(name)


def conform_per_source(src, run_ts: dt.datetime | None = None) -> tuple[dict, list]:
    """Conform each fleet's slice with its own configuration, then union."""
    out: dict[str, list[DataFrame]] = {}
    rejects: list[DataFrame] = []
    raw = {e: getattr(src, "raw_" + e)() for e in (*ENTITIES, "snapshot")}
    for fleet in FLEETS:
        cfg = SOURCES[fleet]

        def part(e):
            return raw[e].where(F.col("nk_frota_origem") == fleet)
        grupo, w = C.conform_grupo(part("grupo"), cfg, run_ts)
        rates = grupo.select("nk_frota_origem", "nk_id_grupo", "valor_diaria")
        results = {
            "stg_conf_patio": (C.conform_patio(part("patio"), cfg), None),
            "stg_conf_grupo": (grupo, w),
            "stg_conf_veiculo": C.conform_veiculo(part("veiculo"), cfg, run_ts),
            "stg_conf_cliente": C.conform_cliente(part("cliente"), cfg, run_ts),
            "stg_conf_reserva": C.conform_reserva(part("reserva"), cfg, rates, run_ts),
            "stg_conf_locacao": C.conform_locacao(part("locacao"), cfg, run_ts),
            "stg_conf_snapshot_patio": C.conform_snapshot(part("snapshot"), run_ts, cfg),
        }
        for name, (conf, rej) in results.items():
            out.setdefault(name, []).append(conf)
            if rej is not None:
                rejects.append(rej)
    return {k: _union(v) for k, v in out.items()}, rejects
