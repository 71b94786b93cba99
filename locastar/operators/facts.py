"""Fact load (FL1-FL5): resolve dimension keys, log late keys, upsert.

One left-joined frame per fact carries every resolved key; the first missing
key gives the late-key reason (FL4). The fact rows are the ones with no
reason, so facts and rejects come from the same joins.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locastar.operators.merge import latest_per_key, merge_upsert
from locastar.sources.fleets import surrogate_key

# Late-key reasons (prefix, then the offending value).
INV_REASONS = ("DATA NÃO ENCONTRADA EM DIM_TEMPO: ", "PÁTIO NÃO ENCONTRADO EM DIM_PATIO: nk=",
               "VEÍCULO NÃO ENCONTRADO EM DIM_VEICULO: nk=", "GRUPO NÃO ENCONTRADO EM DIM_GRUPO: nk=")
RENTAL_REASONS = ("DATA RETIRADA NÃO EM DIM_TEMPO: ", "CLIENTE NÃO EM DIM_CLIENTE: nk=",
                  "VEÍCULO NÃO EM DIM_VEICULO: nk=", "GRUPO NÃO EM DIM_GRUPO: nk=",
                  "PÁTIO RETIRADA NÃO EM DIM_PATIO: nk=")
RESERVATION_REASONS = ("DATA RESERVA NÃO EM DIM_TEMPO: ", "CLIENTE NÃO EM DIM_CLIENTE: nk=",
                       "GRUPO NÃO EM DIM_GRUPO: nk=", "PÁTIO RETIRADA NÃO EM DIM_PATIO: nk=",
                       "PÁTIO FIM NÃO EM DIM_PATIO: nk=")
RETURN_YARD_WARNING = "PÁTIO DEVOLUÇÃO NÃO EM DIM_PATIO: nk="

# The declared key of each fact, and the columns that a repeated key updates.
FACT_KEYS = {
    "fato_inventario_patio": ["sk_tempo_referencia", "sk_patio", "sk_veiculo"],
    "fato_locacao": ["nk_frota_origem", "nk_id_locacao"],
    "fato_reserva": ["nk_frota_origem", "nk_id_reserva"],
}
FACT_UPDATES = {
    "fato_inventario_patio": ["sk_grupo", "qtde_veiculos_presentes"],
    "fato_locacao": ["sk_tempo_real_devolucao", "sk_patio_devolucao_real", "valor_final"],
    "fato_reserva": ["dd_status_reserva", "valor_previsto_reserva", "duracao_prevista_dias"],
}


# A set of missing keys is broadcast only up to this many rows (8 bytes each);
# beyond it the join back to the fact is a regular (sort-merge) join.
BROADCAST_MISSING_KEYS = 2_000_000


def _resolve(df: DataFrame, roles: list[tuple[DataFrame, str, Column, str, str]]) -> DataFrame:
    """Resolve dimension roles (dim, dim key, fleet, natural id column, output key).

    Dimension keys are the stable composite of (fleet, natural id)
    (sources.fleets.surrogate_key), so each key VALUE is computed in place;
    the dimensions are only needed to find the keys they lack (late keys).
    That check is ONE pass over the fact for all roles: the distinct
    (role, key) pairs (partially aggregated before the shuffle) are anti-joined
    with the role-tagged dimension keys; the fact rows themselves are never
    shuffled. The missing pairs are checkpointed and counted per role: none
    (the normal case) -> no join; up to ``BROADCAST_MISSING_KEYS`` -> broadcast
    join; more (a whole dimension missing) -> regular join. A missing key
    resolves to NULL.
    """
    base = df
    for _, _, fleet, nk, out in roles:
        base = base.withColumn(out, surrogate_key(fleet, F.col(nk)))
    pairs = base.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("_r"), F.col(out).alias("_m")) for i, (_, _, _, _, out) in enumerate(roles)
    ])).alias("_x")).select("_x.*").where(F.col("_m").isNotNull()).distinct()
    known = None
    for i, (dim, sk, _, _, _) in enumerate(roles):
        d = dim.select(F.lit(i).alias("_r"), F.col(sk).alias("_m"))
        known = d if known is None else known.unionByName(d)
    missing = pairs.join(known, ["_r", "_m"], "left_anti").checkpoint(eager=True)
    counts = {r["_r"]: r["n"] for r in missing.groupBy("_r").agg(F.count(F.lit(1)).alias("n")).collect()}
    out_df = base
    for i, (_, _, _, _, out) in enumerate(roles):
        n = counts.get(i, 0)
        if n == 0:
            continue
        flag = f"_miss{i}"
        side = missing.where(F.col("_r") == i).select(F.col("_m").alias(f"_m{i}"), F.lit(True).alias(flag))
        side = F.broadcast(side) if n <= BROADCAST_MISSING_KEYS else side
        out_df = (out_df.join(side, F.col(out) == F.col(f"_m{i}"), "left").drop(f"_m{i}")
                  .withColumn(out, F.when(F.col(flag).isNull(), F.col(out))).drop(flag))
    return out_df


def _date(df: DataFrame, calendar: DataFrame, col: str, out: str) -> DataFrame:
    """Calendar key of a date column (broadcast: one row per day)."""
    cal = calendar.select(F.col("data").alias(f"_d_{out}"), F.col("sk_tempo").alias(out))
    return df.join(F.broadcast(cal), F.col(col) == F.col(f"_d_{out}"), "left").drop(f"_d_{out}")


def _msg(prefix: str, c: str) -> Column:
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def _rejects(tagged: DataFrame, table: str, id_col: str, run_ts, warned: Sequence[str] = ()) -> DataFrame:
    """FL4: the rows without all keys, and of the fleets ``warned`` the loaded rows with a warning (FL4b)."""
    ts = F.lit(run_ts) if run_ts else F.current_timestamp()
    if warned:
        tagged = tagged.withColumn("_reason", F.coalesce(
            "_reason", F.when(F.col("nk_frota_origem").isin(*warned), F.col("_warning"))))
    return tagged.where(F.col("_reason").isNotNull()).select(
        F.lit(table).alias("tabela_origem"), "nk_frota_origem",
        F.col(id_col).cast("long").alias("nk_id_registro"), F.col("_reason").alias("motivo_rejeito"),
        F.lit(None).cast("string").alias("dados_json"), ts.cast("timestamp_ntz").alias("dt_rejeito"))


def resolve_inventory(snap: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """FL1 keys. The vehicle (and its class) are resolved in the vehicle's own fleet
    when the snapshot names one (``nk_frota_veiculo``), else in the yard's fleet."""
    vf = (F.coalesce(F.col("nk_frota_veiculo"), F.col("nk_frota_origem"))
          if "nk_frota_veiculo" in snap.columns else F.col("nk_frota_origem"))
    df = snap.withColumn("_vf", vf)
    df = _date(df, dims["dim_tempo"], "data_snapshot", "sk_tempo_referencia")
    df = _resolve(df, [
        (dims["dim_patio"], "sk_patio", F.col("nk_frota_origem"), "nk_id_patio", "sk_patio"),
        (dims["dim_veiculo"], "sk_veiculo", F.col("_vf"), "nk_id_veiculo", "sk_veiculo"),
        (dims["dim_grupo"], "sk_grupo", F.col("_vf"), "nk_id_grupo", "sk_grupo")])
    return df.withColumn("_reason", (
        F.when(F.col("sk_tempo_referencia").isNull(), _msg(INV_REASONS[0], "data_snapshot"))
        .when(F.col("sk_patio").isNull(), _msg(INV_REASONS[1], "nk_id_patio"))
        .when(F.col("sk_veiculo").isNull(), _msg(INV_REASONS[2], "nk_id_veiculo"))
        .when(F.col("sk_grupo").isNull(), _msg(INV_REASONS[3], "nk_id_grupo"))))


def load_inventory(snap: DataFrame, dims: dict[str, DataFrame], current: DataFrame | None = None,
                   run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """FL1 + FL4: (fato_inventario_patio, late-key rejects)."""
    return split_inventory(resolve_inventory(snap, dims), current, run_ts)


def inventory_rows(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("_reason").isNull()).select(
        "sk_tempo_referencia", "sk_patio", "sk_veiculo", "sk_grupo",
        F.lit(1).alias("qtde_veiculos_presentes"))


def inventory_rejects(tagged: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return _rejects(tagged, "stg_conf_snapshot_patio", "nk_id_veiculo", run_ts)


def split_inventory(tagged: DataFrame, current: DataFrame | None = None,
                    run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    return (first_or_merged("fato_inventario_patio", inventory_rows(tagged), current),
            inventory_rejects(tagged, run_ts))


def resolve_rental(loc: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    f = F.col("nk_frota_origem")
    df = loc
    df = _date(df, dims["dim_tempo"], "data_retirada", "sk_tempo_retirada")
    df = _date(df, dims["dim_tempo"], "data_prev_devolucao", "sk_tempo_prev_devolucao")
    df = _date(df, dims["dim_tempo"], "data_real_devolucao", "sk_tempo_real_devolucao")
    df = _resolve(df, [
        (dims["dim_cliente"], "sk_cliente", f, "nk_id_cliente", "sk_cliente"),
        (dims["dim_veiculo"], "sk_veiculo", f, "nk_id_veiculo", "sk_veiculo"),
        (dims["dim_grupo"], "sk_grupo", f, "nk_id_grupo", "sk_grupo"),
        (dims["dim_patio"], "sk_patio", f, "nk_id_patio_retirada", "sk_patio_retirada"),
        (dims["dim_patio"], "sk_patio", f, "nk_id_patio_devolucao", "sk_patio_devolucao_real")])
    reason = (F.when(F.col("sk_tempo_retirada").isNull(), _msg(RENTAL_REASONS[0], "data_retirada"))
              .when(F.col("sk_cliente").isNull(), _msg(RENTAL_REASONS[1], "nk_id_cliente"))
              .when(F.col("sk_veiculo").isNull(), _msg(RENTAL_REASONS[2], "nk_id_veiculo"))
              .when(F.col("sk_grupo").isNull(), _msg(RENTAL_REASONS[3], "nk_id_grupo"))
              .when(F.col("sk_patio_retirada").isNull(), _msg(RENTAL_REASONS[4], "nk_id_patio_retirada")))
    warning = F.when(F.col("nk_id_patio_devolucao").isNotNull() & F.col("sk_patio_devolucao_real").isNull(),
                     _msg(RETURN_YARD_WARNING, "nk_id_patio_devolucao"))
    return df.withColumn("_reason", reason).withColumn("_warning", warning)


RENTAL_COLUMNS = ["nk_frota_origem", "nk_id_locacao", "sk_tempo_retirada", "sk_tempo_prev_devolucao",
                  "sk_tempo_real_devolucao", "sk_cliente", "sk_veiculo", "sk_grupo",
                  "sk_patio_retirada", "sk_patio_devolucao_real", "valor_final", "qtde_locacoes"]


def first_or_merged(name: str, fact: DataFrame, current: DataFrame | None) -> DataFrame:
    """The declared key holds from the first load on: a repeated key is loaded once,
    as the row that sorts last over the fact's columns (the later dates first)."""
    if current is None:
        return latest_per_key(fact, FACT_KEYS[name]).select(*fact.columns)
    return merge_upsert(current, fact, FACT_KEYS[name], FACT_UPDATES[name])


def load_rental(loc: DataFrame, dims: dict[str, DataFrame], current: DataFrame | None = None,
                run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """FL2 + FL4 (+ FL5: no pick-up date key, no row)."""
    return split_rental(resolve_rental(loc, dims), current, run_ts)


def rental_rows(tagged: DataFrame) -> DataFrame:
    return (tagged.where(F.col("_reason").isNull()).withColumn("qtde_locacoes", F.lit(1))
            .select(*RENTAL_COLUMNS))


def rental_rejects(tagged: DataFrame, run_ts: dt.datetime | None = None, warned: Sequence[str] = ()) -> DataFrame:
    return _rejects(tagged, "stg_conf_locacao", "nk_id_locacao", run_ts, warned)


def split_rental(tagged: DataFrame, current: DataFrame | None = None, run_ts: dt.datetime | None = None,
                 warned: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """FL2 rows, and FL4 rejects with the FL4b warnings of the fleets ``warned``: three ways from one tagged frame."""
    return first_or_merged("fato_locacao", rental_rows(tagged), current), rental_rejects(tagged, run_ts, warned)


def return_yard_warnings(loc: DataFrame, dims: dict[str, DataFrame],
                         run_ts: dt.datetime | None = None) -> DataFrame:
    """FL4b: return yard not in the dimension -> warning row; the fact row still loads."""
    tagged = resolve_rental(loc, dims).withColumn("_reason", F.col("_warning"))
    return _rejects(tagged, "stg_conf_locacao", "nk_id_locacao", run_ts)


def resolve_reservation(res: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    f = F.col("nk_frota_origem")
    df = res
    df = _date(df, dims["dim_tempo"], "data_reserva", "sk_tempo_reserva")
    df = _date(df, dims["dim_tempo"], "data_retirada_prevista", "sk_tempo_prev_retirada")
    df = _date(df, dims["dim_tempo"], "data_devolucao_prevista", "sk_tempo_prev_devolucao")
    df = _resolve(df, [
        (dims["dim_cliente"], "sk_cliente", f, "nk_id_cliente", "sk_cliente"),
        (dims["dim_grupo"], "sk_grupo", f, "nk_id_grupo", "sk_grupo"),
        (dims["dim_patio"], "sk_patio", f, "nk_id_patio_retirada", "sk_patio_retirada"),
        (dims["dim_patio"], "sk_patio", f, "nk_id_patio_fim", "sk_patio_fim")])
    reason = (F.when(F.col("sk_tempo_reserva").isNull(), _msg(RESERVATION_REASONS[0], "data_reserva"))
              .when(F.col("sk_cliente").isNull(), _msg(RESERVATION_REASONS[1], "nk_id_cliente"))
              .when(F.col("sk_grupo").isNull(), _msg(RESERVATION_REASONS[2], "nk_id_grupo"))
              .when(F.col("sk_patio_retirada").isNull(), _msg(RESERVATION_REASONS[3], "nk_id_patio_retirada"))
              .when(F.col("sk_patio_fim").isNull(), _msg(RESERVATION_REASONS[4], "nk_id_patio_fim")))
    return df.withColumn("_reason", reason)


RESERVATION_COLUMNS = ["nk_frota_origem", "nk_id_reserva", "sk_tempo_reserva", "sk_tempo_prev_retirada",
                       "sk_tempo_prev_devolucao", "sk_cliente", "sk_grupo", "sk_patio_retirada",
                       "sk_patio_fim", "duracao_prevista_dias", "valor_previsto_reserva",
                       "dd_status_reserva", "qtde_reservas"]


def load_reservation(res: DataFrame, dims: dict[str, DataFrame], current: DataFrame | None = None,
                     run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """FL3 + FL4."""
    return split_reservation(resolve_reservation(res, dims), current, run_ts)


def reservation_rows(tagged: DataFrame) -> DataFrame:
    return (tagged.where(F.col("_reason").isNull())
            .withColumn("dd_status_reserva", F.col("status_reserva"))
            .withColumn("qtde_reservas", F.lit(1)).select(*RESERVATION_COLUMNS))


def reservation_rejects(tagged: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    return _rejects(tagged, "stg_conf_reserva", "nk_id_reserva", run_ts)


def split_reservation(tagged: DataFrame, current: DataFrame | None = None,
                      run_ts: dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    return first_or_merged("fato_reserva", reservation_rows(tagged), current), reservation_rejects(tagged, run_ts)


#: Fact -> its conformed table, key resolution, rows, and rejects.
FACT_LOADS = {
    "fato_inventario_patio": ("stg_conf_snapshot_patio", resolve_inventory, inventory_rows, inventory_rejects),
    "fato_locacao": ("stg_conf_locacao", resolve_rental, rental_rows, rental_rejects),
    "fato_reserva": ("stg_conf_reserva", resolve_reservation, reservation_rows, reservation_rejects),
}
