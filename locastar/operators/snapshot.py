"""Yard-inventory snapshot builders (SN1-SN4): which vehicle is in which yard on a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.operators.lookups import latest_as_of, not_in

SNAPSHOT_COLUMNS = ["nk_frota_origem", "nk_id_patio", "nk_id_veiculo", "nk_id_grupo", "data_snapshot"]


def _out(df: DataFrame, fleet: str, day: dt.date) -> DataFrame:
    return df.select(F.lit(fleet).alias("nk_frota_origem"), "nk_id_patio", "nk_id_veiculo",
                     "nk_id_grupo", F.lit(day).alias("data_snapshot"))


def slot_snapshot(fleet: str, slots: DataFrame, vehicles: DataFrame, day: dt.date) -> DataFrame:
    """SN1: vehicles occupying a slot (slots: id_vaga, id_patio, id_veiculo)."""
    s = slots.where(F.col("id_veiculo").isNotNull())
    j = s.join(vehicles, s.id_veiculo == vehicles.nk_id_veiculo)
    return _out(j.withColumnRenamed("id_patio", "nk_id_patio"), fleet, day)


def slot_id_snapshot(fleet: str, vehicles: DataFrame, slots: DataFrame, day: dt.date) -> DataFrame:
    """SN3: vehicles that carry a slot id; yard of that slot (vehicles: id_vaga)."""
    v = vehicles.where(F.col("id_vaga").isNotNull())
    j = v.join(slots.select(F.col("id_vaga").alias("_vaga"), F.col("id_patio").alias("nk_id_patio")),
               F.col("id_vaga") == F.col("_vaga"))
    return _out(j, fleet, day)


def status_snapshot(fleet: str, vehicles: DataFrame, day: dt.date, rented: str = "ALUGADO") -> DataFrame:
    """SN4: current yard of vehicles whose status is not rented (NULL status drops, as <>)."""
    v = vehicles.where(F.col("status") != rented).withColumnRenamed("id_patio_atual", "nk_id_patio")
    return _out(v, fleet, day)


def asof_snapshot(fleet: str, vehicles: DataFrame, rentals: DataFrame, day: dt.date,
                  retired: str = "BAIXADO") -> DataFrame:
    """SN2: yard on ``day`` reconstructed from the rental history.

    vehicles: nk_id_veiculo, nk_id_grupo, nk_id_patio_origem, situacao
    rentals:  id_locacao, veiculo_id, status, data_retirada_real, data_devolucao_real,
              patio_devolucao_id
    Yard = return yard of the latest completed return not after ``day``
    (ties: higher rental id, then higher yard id), else the home yard. Vehicles
    retired or on an open rental covering ``day`` are left out; the open-rental
    test keeps NOT IN's NULL semantics (J7).
    """
    done = rentals.where((F.col("status") == "CONCLUIDA")).withColumn(
        "_ret", F.to_date("data_devolucao_real"))
    last = latest_as_of(done, ["veiculo_id"], "_ret", day,
                        tie=[("id_locacao", True), ("patio_devolucao_id", True)])
    last = last.select(F.col("veiculo_id").alias("_v"), F.col("patio_devolucao_id").alias("_y"))
    open_ = rentals.where((F.col("status") == "EM_ANDAMENTO")
                          & (F.to_date("data_retirada_real") <= F.lit(day))
                          & (F.col("data_devolucao_real").isNull()
                             | (F.to_date("data_devolucao_real") > F.lit(day)))).select("veiculo_id")
    pos = (vehicles.where(F.col("situacao") != retired)
           .join(last, F.col("nk_id_veiculo") == F.col("_v"), "left")
           .withColumn("nk_id_patio", F.coalesce(F.col("_y"), F.col("nk_id_patio_origem"))))
    return _out(not_in(pos, open_, "nk_id_veiculo", "veiculo_id"), fleet, day)


def yard_snapshot(fleet: str, vehicles: DataFrame, slots: DataFrame | None = None,
                  rentals: DataFrame | None = None, as_of: dt.date | None = None,
                  day: dt.date | None = None) -> DataFrame:
    """SN1-SN4 by source: the rule and the default date (yesterday for F1/F2,
    today for F3/F4) come from the fleet's configuration."""
    from locastar.sources.fleets import FLEETS, SOURCES
    if day is None:
        day = as_of - dt.timedelta(days=SOURCES[fleet].snapshot_offset_days)
    if fleet == FLEETS[0]:
        return slot_snapshot(fleet, slots, vehicles, day)
    if fleet == FLEETS[1]:
        return asof_snapshot(fleet, vehicles, rentals, day)
    if fleet == FLEETS[2]:
        return slot_id_snapshot(fleet, vehicles, slots, day)
    return status_snapshot(fleet, vehicles, day)
