"""Conform operators: raw staging -> conformed rows + reject log rows.

Every rule is a Column expression; the reason for rejecting a row is one
ordered ``when`` chain evaluated once per row (C11), and the split into
valid and rejected rows is two filters over that single tagged frame (C12).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locastar.functions import domain, text
from locastar.functions.dates import days_between
from locastar.functions.money import MONEY_12, MONEY_14, clamp_non_negative, planned_value
from locastar.functions.quality import first_reason, row_json
from locastar.sources.fleets import RENTAL_FIELDS, RESERVATION_FIELDS, SourceConfig

# The country stored for every conformed address.
COUNTRY = "Brasil"

# Reject reasons, in evaluation order.
RESERVATION_REASONS = (
    "Reserva sem cliente",
    "Reserva sem grupo",
    "Reserva sem pátio de retirada",
    "Reserva sem pátio de fim",
    "Reserva sem data de reserva",
    "Reserva sem data de retirada prevista",
    "Reserva sem data de devolução prevista",
    "Data devolução <= data retirada",
    "Duração prevista inválida (< 1 dia)",
)
RENTAL_REASONS = (
    "Locação sem cliente",
    "Locação sem veículo",
    "Locação sem grupo",
    "Locação sem pátio de retirada",
    "Locação sem data de retirada",
    "Locação sem data prev. devolução",
    "Data devolução real anterior à retirada",
)
CLASS_WARNING = "Grupo sem valor_diaria vigente; será carregado com valor 0,00"
VEHICLE_REASON = "Veículo sem nk_id_grupo"
VEHICLE_REASON_HOME_YARD = "Veículo sem nk_id_grupo ou sem nk_id_patio_origem"
CUSTOMER_REASON = "Cliente sem tipo_cliente válido"
SNAPSHOT_REASON = "Snapshot sem chaves válidas"

REJECT_COLUMNS = ("tabela_origem", "nk_frota_origem", "nk_id_registro", "motivo_rejeito",
                  "dados_json", "dt_rejeito")

DEFAULT = SourceConfig("*")


def source_table(entity: str) -> Column:
    """Name of the raw staging table of the row's fleet ('stg_frota_1_reserva')."""
    return F.concat(F.lit("stg_"), F.regexp_replace(F.col("nk_frota_origem"), "-", "_"),
                    F.lit("_" + entity))


def reject_rows(tagged: DataFrame, entity: str, id_col: str, reason: str = "_reason",
                payload: Sequence[str] | None = None, run_ts: dt.datetime | None = None) -> DataFrame:
    """Shape tagged rows into the reject log schema (S6 input)."""
    ts = F.lit(run_ts) if run_ts else F.current_timestamp()
    return tagged.select(
        source_table(entity).alias("tabela_origem"), "nk_frota_origem",
        F.col(id_col).cast("long").alias("nk_id_registro"),
        F.col(reason).alias("motivo_rejeito"),
        (row_json(payload) if payload else F.lit(None).cast("string")).alias("dados_json"),
        ts.cast("timestamp_ntz").alias("dt_rejeito"))


def split_valid(df: DataFrame, reason: Column, entity: str, id_col: str,
                payload: Sequence[str] | None = None,
                run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid rows, reject rows). Valid = reason is NULL; the two are disjoint
    and together cover the input."""
    tagged = df.withColumn("_reason", reason)
    valid = tagged.where(F.col("_reason").isNull()).drop("_reason")
    rejects = reject_rows(tagged.where(F.col("_reason").isNotNull()), entity, id_col,
                          payload=payload, run_ts=run_ts)
    return valid, rejects


def warn(df: DataFrame, rule: Column, text_: str, entity: str, id_col: str,
         run_ts: dt.datetime | None = None) -> DataFrame:
    """Reject-log rows for rows matching ``rule``; the rows themselves are kept."""
    return reject_rows(df.where(rule).withColumn("_reason", F.lit(text_)), entity, id_col,
                       run_ts=run_ts)


# --------------------------------------------------------------------- yard
def conform_patio(raw: DataFrame, cfg: SourceConfig = DEFAULT) -> DataFrame:
    """C1 name, C3 capacity -1, C2 address sentinels, fixed country."""
    if cfg.yard_address_sentinel:
        city, uf = F.lit(text.NOT_INFORMED), F.lit(text.UNKNOWN_UF)
    else:
        city, uf = text.blank_to("end_cidade", text.NOT_INFORMED), text.blank_to("end_uf", text.UNKNOWN_UF)
    name = text.name_or("nome_patio", prefix="PATIO ", id="nk_id_patio")
    return raw.select(
        "nk_frota_origem", F.col("nk_id_patio").cast("long").alias("nk_id_patio"),
        text.capitalise(name).alias("nome_patio"),
        text.null_to("capacidade_vagas", -1).cast("int").alias("capacidade_vagas"),
        city.alias("end_cidade"), uf.alias("end_uf"), F.lit(COUNTRY).alias("end_pais"))


# -------------------------------------------------------------------- class
def conform_grupo(raw: DataFrame, cfg: SourceConfig = DEFAULT,
                  run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """C15 name fallback, C1, rate NULL -> 0; C13 warning for NULL/0 rate."""
    names = ["nome_grupo", "codigo"] if cfg.group_name_uses_code else ["nome_grupo"]
    names = [n for n in names if n in raw.columns]
    warnings = warn(raw, F.col("valor_diaria").isNull() | (F.col("valor_diaria") == 0),
                    CLASS_WARNING, "grupo", "nk_id_grupo", run_ts)
    conf = raw.select(
        "nk_frota_origem", F.col("nk_id_grupo").cast("long").alias("nk_id_grupo"),
        text.capitalise(text.name_or(*names, prefix="GRUPO ", id="nk_id_grupo")).alias("nome_grupo"),
        text.null_to("valor_diaria", 0).cast(MONEY_12).alias("valor_diaria"))
    return conf, warnings


# ------------------------------------------------------------------ vehicle
def conform_veiculo(raw: DataFrame, cfg: SourceConfig = DEFAULT,
                    run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """C11 (class required; F2 also home yard), C16 plate, C1 brand/model, C5, C17."""
    if cfg.vehicle_requires_home_yard:
        reason = first_reason([(F.col("nk_id_grupo").isNull() | F.col("nk_id_patio_origem").isNull(),
                                cfg.vehicle_reason or VEHICLE_REASON_HOME_YARD)])
    else:
        reason = first_reason([(F.col("nk_id_grupo").isNull(), cfg.vehicle_reason or VEHICLE_REASON)])
    valid, rejects = split_valid(raw, reason, "veiculo", "nk_id_veiculo", run_ts=run_ts)
    home = F.col("nk_id_patio_origem").cast("long")
    if cfg.home_yard_default is not None:
        home = F.coalesce(home, F.lit(cfg.home_yard_default).cast("long"))
    conf = valid.select(
        "nk_frota_origem", F.col("nk_id_veiculo").cast("long").alias("nk_id_veiculo"),
        F.col("nk_id_grupo").cast("long").alias("nk_id_grupo"), home.alias("nk_id_patio_origem"),
        text.plate("placa", cfg.plate_default).alias("placa"),
        text.capitalise_or("marca", text.NOT_INFORMED).alias("marca"),
        text.capitalise_or("modelo", text.NOT_INFORMED).alias("modelo"),
        domain.transmission("mecanizacao").alias("mecanizacao"),
        F.coalesce(F.col("tem_ar_condicionado").cast("boolean"), F.lit(False)).alias("tem_ar_condicionado"))
    return conf, rejects


# ----------------------------------------------------------------- customer
def conform_cliente(raw: DataFrame, cfg: SourceConfig = DEFAULT,
                    run_ts: dt.datetime | None = None,
                    legacy_null_drop: bool = False) -> tuple[DataFrame, DataFrame]:
    """C4: type normalised then checked (NULL rejected); C1 name, C2 address.

    ``legacy_null_drop`` reproduces F1-F3 batch, where a NULL type is neither
    rejected nor loaded (NOT IN with NULL).
    """
    tipo = domain.customer_type("tipo_cliente")
    bad = tipo.isNull()
    for c in ("end_cidade", "end_uf"):
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    if legacy_null_drop:
        raw = raw.where(F.col("tipo_cliente").isNotNull())
    valid, rejects = split_valid(raw, first_reason([(bad, cfg.customer_reason or CUSTOMER_REASON)]), "cliente",
                                 "nk_id_cliente", run_ts=run_ts)
    conf = valid.select(
        "nk_frota_origem", F.col("nk_id_cliente").cast("long").alias("nk_id_cliente"),
        tipo.alias("tipo_cliente"),
        text.capitalise_or("nome", text.NOT_IDENTIFIED).alias("nome"),
        text.blank_to("end_cidade", text.NOT_INFORMED).alias("end_cidade"),
        text.blank_to("end_uf", text.UNKNOWN_UF).alias("end_uf"),
        F.lit(COUNTRY).alias("end_pais"))
    return conf, rejects


# -------------------------------------------------------------- reservation
def reservation_reason(cfg: SourceConfig = DEFAULT) -> Column:
    """The first rule of the source that a reservation fails. The last
    one tests the source's own duration (F1-F3); F4 has none, and without a
    source's column (``own_duration`` unset) the dates give it."""
    c = F.col
    rules = [
        (c("nk_id_cliente").isNull(), RESERVATION_REASONS[0]),
        (c("nk_id_grupo").isNull(), RESERVATION_REASONS[1]),
        (c("nk_id_patio_retirada").isNull(), RESERVATION_REASONS[2]),
        (c("nk_id_patio_fim").isNull(), RESERVATION_REASONS[3]),
        (c("data_reserva").isNull(), RESERVATION_REASONS[4]),
        (c("data_retirada_prevista").isNull(), RESERVATION_REASONS[5]),
        (c("data_devolucao_prevista").isNull(), RESERVATION_REASONS[6]),
        (c("data_devolucao_prevista") <= c("data_retirada_prevista"), cfg.date_order_reason or RESERVATION_REASONS[7]),
    ]
    if cfg.own_duration:
        rules.append((F.coalesce("duracao_prevista_dias", F.lit(0)) < 1, RESERVATION_REASONS[8]))
    elif cfg.own_duration is None:
        rules.append((days_between("data_retirada_prevista", "data_devolucao_prevista") < 1, RESERVATION_REASONS[8]))
    return first_reason(rules)


def conform_reserva(raw: DataFrame, cfg: SourceConfig = DEFAULT, rates: DataFrame | None = None,
                    run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """C6 status, C7 duration, C8 planned value, C10/C11 reasons, C14 JSON payload.

    ``rates`` (nk_frota_origem, nk_id_grupo, valor_diaria) is needed only when
    the source computes the planned value (F4).
    """
    valid, rejects = split_valid(raw, reservation_reason(cfg), "reserva", "nk_id_reserva",
                                 payload=cfg.reservation_payload or RESERVATION_FIELDS, run_ts=run_ts)
    days = days_between("data_retirada_prevista", "data_devolucao_prevista", cfg.duration_floor)
    if cfg.compute_planned_value:
        if rates is None:
            raise ValueError("planned value needs the class rates")
        valid = valid.join(rates.select("nk_frota_origem", "nk_id_grupo",
                                        F.col("valor_diaria").alias("_rate")),
                           ["nk_frota_origem", "nk_id_grupo"], "left")
        value = planned_value(days, F.col("_rate"))
    else:
        value = text.null_to("valor_previsto_reserva", 0).cast(MONEY_12)
    conf = valid.select(
        "nk_frota_origem", *[F.col(k).cast("long").alias(k) for k in (
            "nk_id_reserva", "nk_id_cliente", "nk_id_grupo", "nk_id_patio_retirada", "nk_id_patio_fim")],
        F.to_date("data_reserva").alias("data_reserva"),
        F.to_date("data_retirada_prevista").alias("data_retirada_prevista"),
        F.to_date("data_devolucao_prevista").alias("data_devolucao_prevista"),
        days.cast("int").alias("duracao_prevista_dias"),
        value.alias("valor_previsto_reserva"),
        domain.reservation_status("status_reserva", cfg.status_synonyms).alias("status_reserva"))
    return conf, rejects


# ------------------------------------------------------------------- rental
def rental_reason() -> Column:
    c = F.col
    return first_reason([
        (c("nk_id_cliente").isNull(), RENTAL_REASONS[0]),
        (c("nk_id_veiculo").isNull(), RENTAL_REASONS[1]),
        (c("nk_id_grupo").isNull(), RENTAL_REASONS[2]),
        (c("nk_id_patio_retirada").isNull(), RENTAL_REASONS[3]),
        (c("data_retirada").isNull(), RENTAL_REASONS[4]),
        (c("data_prev_devolucao").isNull(), RENTAL_REASONS[5]),
        (c("data_real_devolucao").isNotNull() & (c("data_real_devolucao") < c("data_retirada")),
         RENTAL_REASONS[6]),
    ])


def rental_columns() -> list[Column]:
    """C9 value clamp; the conformed columns of a rental."""
    return ["nk_frota_origem", *[F.col(k).cast("long").alias(k) for k in (
                "nk_id_locacao", "nk_id_cliente", "nk_id_veiculo", "nk_id_grupo",
                "nk_id_patio_retirada", "nk_id_patio_devolucao")],
            F.to_date("data_retirada").alias("data_retirada"),
            F.to_date("data_prev_devolucao").alias("data_prev_devolucao"),
            F.to_date("data_real_devolucao").alias("data_real_devolucao"),
            clamp_non_negative("valor_final").cast(MONEY_14).alias("valor_final")]


def conform_locacao(raw: DataFrame, cfg: SourceConfig = DEFAULT,
                    run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """C9 value clamp, C10/C11 reasons, C14 payload."""
    valid, rejects = split_valid(raw, rental_reason(), "locacao", "nk_id_locacao",
                                 payload=cfg.rental_payload or RENTAL_FIELDS, run_ts=run_ts)
    return valid.select(*rental_columns()), rejects


def tagged_locacao(raw: DataFrame, *more: str) -> DataFrame:
    """Every rental once, conformed, with its first reason (NULL: valid), the
    payload of the failing ones and the columns ``more``: valid rows and
    rejects of one pass."""
    return raw.withColumn("motivo_rejeito", rental_reason()).select(
        *rental_columns(), "motivo_rejeito",
        F.when(F.col("motivo_rejeito").isNotNull(), row_json(RENTAL_FIELDS)).alias("dados_json"), *more)


# ----------------------------------------------------------------- snapshot
def conform_snapshot(raw: DataFrame, run_ts: dt.datetime | None = None,
                     cfg: SourceConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """C11: yard, vehicle, class and date are all required."""
    c = F.col
    bad = (c("nk_id_patio").isNull() | c("nk_id_veiculo").isNull() | c("nk_id_grupo").isNull()
           | c("data_snapshot").isNull())
    valid, rejects = split_valid(raw, first_reason([(bad, cfg.snapshot_reason or SNAPSHOT_REASON)]), "snapshot_patio",
                                 "nk_id_veiculo", run_ts=run_ts)
    cols = ["nk_frota_origem", "nk_id_patio", "nk_id_veiculo", "nk_id_grupo", "data_snapshot"]
    extra = [c("nk_frota_veiculo")] if "nk_frota_veiculo" in raw.columns else []
    conf = valid.select(*[c(x).cast("long").alias(x) if x.startswith("nk_id") else c(x) for x in cols],
                        *extra)
    return conf, rejects
