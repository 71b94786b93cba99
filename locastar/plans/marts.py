"""The 13 analytical queries (Q1.1-Q5.2) over the star schema.

Each takes the warehouse tables (``dw[name] -> DataFrame``) and an explicit
``as_of`` date (the reference's CURRENT_DATE). Averages and percentages are
rounded half away from zero in exact integer arithmetic
(``functions.money.round_ratio``), so results do not depend on the order in
which partial sums arrive.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locastar.functions.dates import date_key_of, month_name
from locastar.functions.money import cents, pct, round_ratio

# Output labels.
OWN_FLEET, PARTNER_FLEET = "FROTA PRÓPRIA", "FROTA ASSOCIADA"
NEXT_WEEK, NEXT_MONTH, LONG_TERM = "Próxima Semana", "Próximo Mês", "Longo Prazo"
SURPLUS, DEFICIT, BALANCED = "ACÚMULO", "DÉFICIT", "EQUILIBRADO"
STALE_DAYS = 90


def _cal(dw, alias: str, sk_out: str, date_out: str) -> DataFrame:
    """Role-playing calendar (J2). One row per day: broadcast."""
    return F.broadcast(dw["dim_tempo"].select(F.col("sk_tempo").alias(sk_out),
                                              F.col("data").alias(date_out)))


def _grupo(dw) -> DataFrame:
    return dw["dim_grupo"].select("sk_grupo", "nome_grupo", "valor_diaria")


def _months(fact: DataFrame, bound) -> Column:
    """The bound on the month folders of a written fact (plans.versions), where it has them."""
    return bound(F.col("mes")) if "mes" in fact.columns else F.lit(True)


def q1_1_yard_inventory(dw, as_of: dt.date) -> DataFrame:
    """Vehicles in yards yesterday by class, own/partner fleet, brand, model, transmission."""
    day = as_of - dt.timedelta(days=1)
    # the date key is a function of the date: filtering the fact on it lets the
    # scan prune (partition/row-group) before the calendar join confirms it.
    f = dw["fato_inventario_patio"].where(F.col("sk_tempo_referencia") == date_key_of(day))
    t = _cal(dw, "t", "sk_tempo_referencia", "data").where(F.col("data") == F.lit(day))
    p = dw["dim_patio"].select("sk_patio", F.col("nk_frota_origem").alias("frota_patio"))
    v = dw["dim_veiculo"].select("sk_veiculo", F.col("nk_frota_origem").alias("frota_veiculo"),
                                 "marca", "modelo", "mecanizacao")
    g = dw["dim_grupo"].select("sk_grupo", "nome_grupo")
    j = f.join(t, "sk_tempo_referencia").join(p, "sk_patio").join(v, "sk_veiculo").join(g, "sk_grupo")
    origem = F.when(F.col("frota_veiculo") == F.col("frota_patio"), F.lit(OWN_FLEET)) \
        .otherwise(F.lit(PARTNER_FLEET))
    return (j.groupBy("nome_grupo", origem.alias("origem_frota"), "marca", "modelo", "mecanizacao")
            .agg(F.sum("qtde_veiculos_presentes").cast("long").alias("total_veiculos"))
            .orderBy(F.desc("total_veiculos")))


def q1_2_open_rentals(dw, as_of: dt.date) -> DataFrame:
    f = dw["fato_locacao"].where(F.col("sk_tempo_real_devolucao").isNull())
    j = (f.join(_grupo(dw), "sk_grupo")
         .join(_cal(dw, "t_ret", "sk_tempo_retirada", "d_ret"), "sk_tempo_retirada")
         .join(_cal(dw, "t_prev", "sk_tempo_prev_devolucao", "d_prev"), "sk_tempo_prev_devolucao"))
    a = F.lit(as_of)
    return (j.groupBy("nome_grupo",
                      F.datediff(a, F.col("d_ret")).cast("long").alias("dias_transcorridos"),
                      F.datediff(F.col("d_prev"), a).cast("long").alias("dias_restantes_previstos"))
            .agg(F.sum("qtde_locacoes").cast("long").alias("veiculos_alugados"))
            .orderBy("nome_grupo", "dias_restantes_previstos"))


def _customer_city(dw) -> DataFrame:
    c = dw["dim_cliente"].select("sk_cliente", "sk_endereco")
    e = dw["dim_endereco"].select("sk_endereco", F.col("cidade").alias("cidade_origem_cliente"))
    return c.join(e, "sk_endereco").drop("sk_endereco")


def q1_3_reservation_horizon(dw, as_of: dt.date) -> DataFrame:
    """Future active reservations by class, yard, horizon, duration, customer city.

    Eager aggregation: the reservations are first counted per (class, yard,
    horizon, duration, customer) with the small dimensions broadcast, so only
    those partial counts -- not the fact rows -- are shuffled to meet the
    (possibly large) customer dimension.
    """
    f = dw["fato_reserva"].where((F.col("dd_status_reserva") == "ATIVA")
                                 & (F.col("sk_tempo_prev_retirada") >= date_key_of(as_of))
                                 & _months(dw["fato_reserva"], lambda m: m >= date_key_of(as_of) // 100))
    t = _cal(dw, "t_ret", "sk_tempo_prev_retirada", "d_ret").where(F.col("d_ret") >= F.lit(as_of))
    p = dw["dim_patio"].select(F.col("sk_patio").alias("sk_patio_retirada"),
                               F.col("nome_patio").alias("patio_retirada"))
    ahead = F.datediff(F.col("d_ret"), F.lit(as_of))
    horizon = (F.when(ahead <= 7, F.lit(NEXT_WEEK)).when(ahead <= 30, F.lit(NEXT_MONTH))
               .otherwise(F.lit(LONG_TERM)))
    keys = ["nome_grupo", "patio_retirada", "horizonte_retirada", "duracao_prevista_dias"]
    partial = (f.join(t, "sk_tempo_prev_retirada").join(_grupo(dw), "sk_grupo").join(p, "sk_patio_retirada")
               .groupBy("nome_grupo", "patio_retirada", horizon.alias("horizonte_retirada"),
                        F.col("duracao_prevista_dias").cast("long").alias("duracao_prevista_dias"), "sk_cliente")
               .agg(F.sum("qtde_reservas").alias("n")))
    return (partial.join(_customer_city(dw), "sk_cliente")
            .groupBy(*keys, "cidade_origem_cliente")
            .agg(F.sum("n").cast("long").alias("total_reservas"))
            .orderBy(F.desc("total_reservas")))


def _completed(dw) -> DataFrame:
    return dw["fato_locacao"].where(F.col("sk_tempo_real_devolucao").isNotNull())


def q1_4_consumption(dw, as_of: dt.date) -> DataFrame:
    """Completed rentals by class and customer city (eager aggregation per
    customer and class before the customer join, as in Q1.3)."""
    partial = (_completed(dw).join(_grupo(dw), "sk_grupo")
               .groupBy("sk_cliente", "nome_grupo").agg(F.sum("qtde_locacoes").alias("n")))
    return (partial.join(_customer_city(dw), "sk_cliente")
            .groupBy("nome_grupo", "cidade_origem_cliente")
            .agg(F.sum("n").cast("long").alias("volume_locacoes"))
            .orderBy(F.desc("volume_locacoes")))


def q2_1_transition_matrix(dw, as_of: dt.date) -> DataFrame:
    p = dw["dim_patio"]
    o = p.select(F.col("sk_patio").alias("sk_patio_retirada"), F.col("nome_patio").alias("patio_origem"))
    d = p.select(F.col("sk_patio").alias("sk_patio_devolucao_real"),
                 F.col("nome_patio").alias("patio_destino"))
    agg = (_completed(dw).join(o, "sk_patio_retirada").join(d, "sk_patio_devolucao_real")
           .groupBy("patio_origem", "patio_destino")
           .agg(F.count(F.lit(1)).alias("total_movimentacoes")))
    # W1 over the aggregated rows: share of the origin's total (by yard name).
    tot = F.sum("total_movimentacoes").over(Window.partitionBy("patio_origem"))
    return (agg.withColumn("percentual_movimentacao", pct(F.col("total_movimentacoes"), tot, 2))
            .orderBy("patio_origem", F.desc("percentual_movimentacao")))


def q2_1_transition_matrix_by_key(dw, as_of: dt.date) -> DataFrame:
    """W1 by key: Q2.1 with shares per origin YARD (fleet + yard), so yards of
    different fleets that share a name are not merged."""
    p = dw["dim_patio"]
    o = p.select(F.col("sk_patio").alias("sk_patio_retirada"), F.col("nome_patio").alias("patio_origem"),
                 F.col("nk_frota_origem").alias("empresa"))
    d = p.select(F.col("sk_patio").alias("sk_patio_devolucao_real"), F.col("nome_patio").alias("patio_destino"))
    agg = (_completed(dw).groupBy("sk_patio_retirada", "sk_patio_devolucao_real")
           .agg(F.count(F.lit(1)).alias("total_movimentacoes"))
           .join(o, "sk_patio_retirada").join(d, "sk_patio_devolucao_real"))
    tot = F.sum("total_movimentacoes").over(Window.partitionBy("sk_patio_retirada"))
    return (agg.withColumn("percentual_movimentacao", pct(F.col("total_movimentacoes"), tot, 2))
            .select("empresa", "patio_origem", "patio_destino", "total_movimentacoes", "percentual_movimentacao")
            .orderBy("empresa", "patio_origem", F.desc("percentual_movimentacao")))


def q2_2_yard_balance(dw, as_of: dt.date) -> DataFrame:
    """Inflow/outflow per yard from ONE scan of the rental fact: each returned
    rental emits (return yard, in) and (pick-up yard, out), then one group-by."""
    f = dw["fato_locacao"].where(F.col("sk_patio_devolucao_real").isNotNull())
    flows = f.select(F.explode(F.array(
        F.struct(F.col("sk_patio_devolucao_real").alias("sk_patio"), F.lit(1).alias("i"), F.lit(0).alias("o")),
        F.struct(F.col("sk_patio_retirada").alias("sk_patio"), F.lit(0).alias("i"), F.lit(1).alias("o")),
    )).alias("x")).select("x.*")
    per_yard = flows.groupBy("sk_patio").agg(F.sum("i").alias("e"), F.sum("o").alias("s"))
    p = dw["dim_patio"].select("sk_patio", "nome_patio", F.col("nk_frota_origem").alias("empresa"))
    j = p.join(per_yard, "sk_patio", "left")
    e = F.coalesce(F.col("e"), F.lit(0)).cast("long")
    s = F.coalesce(F.col("s"), F.lit(0)).cast("long")
    return (j.select("nome_patio", "empresa", e.alias("total_entradas"), s.alias("total_saidas"),
                     (e - s).alias("saldo_liquido"),
                     F.when(e > s, F.lit(SURPLUS)).when(e < s, F.lit(DEFICIT))
                     .otherwise(F.lit(BALANCED)).alias("situacao"))
            .orderBy("saldo_liquido"))


def q3_1_monthly_revenue(dw, as_of: dt.date) -> DataFrame:
    j = _completed(dw).join(_cal(dw, "t", "sk_tempo_retirada", "d"), "sk_tempo_retirada")
    agg = (j.groupBy(F.col("nk_frota_origem").alias("empresa"), F.year("d").cast("long").alias("ano"),
                     F.month("d").cast("long").alias("mes"), month_name("d").alias("nome_mes"))
           .agg(F.sum("qtde_locacoes").cast("long").alias("total_locacoes"),
                F.sum("valor_final").alias("receita_total"),
                F.sum(cents("valor_final")).alias("_c"), F.count("valor_final").alias("_n")))
    return (agg.withColumn("ticket_medio", round_ratio(F.col("_c"), F.col("_n") * 100, 2))
            .drop("_c", "_n").orderBy("empresa", "ano", "mes"))


def q3_2_revenue_share(dw, as_of: dt.date) -> DataFrame:
    j = _completed(dw).join(_grupo(dw), "sk_grupo")
    agg = (j.groupBy(F.col("nk_frota_origem").alias("empresa"), F.col("nome_grupo").alias("grupo"),
                     F.col("valor_diaria").alias("diaria_atual"))
           .agg(F.sum("qtde_locacoes").cast("long").alias("total_locacoes"),
                F.sum("valor_final").alias("receita_total"),
                F.sum(cents("valor_final")).alias("_c")))
    tot = F.sum("_c").over(Window.partitionBy("empresa"))
    return (agg.withColumn("pct_receita_empresa", pct(F.col("_c"), tot, 2)).drop("_c")
            .orderBy("empresa", F.desc("receita_total")))


def q3_3_pipeline(dw, as_of: dt.date) -> DataFrame:
    f = dw["fato_reserva"].where((F.col("dd_status_reserva") == "ATIVA")
                                 & (F.col("sk_tempo_prev_retirada") >= date_key_of(as_of))
                                 & _months(dw["fato_reserva"], lambda m: m >= date_key_of(as_of) // 100))
    t = _cal(dw, "t_ret", "sk_tempo_prev_retirada", "d").where(F.col("d") >= F.lit(as_of))
    j = f.join(t, "sk_tempo_prev_retirada").join(_grupo(dw), "sk_grupo")
    agg = (j.groupBy(F.col("nk_frota_origem").alias("empresa"),
                     F.year("d").cast("long").alias("ano_retirada"),
                     F.quarter("d").cast("long").alias("trimestre_retirada"),
                     F.col("nome_grupo").alias("grupo"))
           .agg(F.sum("qtde_reservas").cast("long").alias("total_reservas_ativas"),
                F.sum("valor_previsto_reserva").alias("receita_potencial"),
                F.sum("duracao_prevista_dias").alias("_d"), F.count("duracao_prevista_dias").alias("_n")))
    return (agg.withColumn("duracao_media_prevista", round_ratio(F.col("_d"), F.col("_n"), 1))
            .drop("_d", "_n").orderBy(F.desc("receita_potencial")))


def q4_1_return_sla(dw, as_of: dt.date) -> DataFrame:
    j = (_completed(dw).join(_grupo(dw), "sk_grupo")
         .join(_cal(dw, "t_prev", "sk_tempo_prev_devolucao", "d_prev"), "sk_tempo_prev_devolucao")
         .join(_cal(dw, "t_real", "sk_tempo_real_devolucao", "d_real"), "sk_tempo_real_devolucao"))
    late = F.col("d_real") > F.col("d_prev")
    agg = (j.groupBy(F.col("nk_frota_origem").alias("empresa"), F.col("nome_grupo").alias("grupo"))
           .agg(F.count(F.lit(1)).alias("total_concluidas"),
                F.sum(F.when(late, 1).otherwise(0)).cast("long").alias("devolvidas_em_atraso"),
                F.sum(F.when(late, F.datediff("d_real", "d_prev"))).alias("_days")))
    return (agg.withColumn("pct_atraso", pct(F.col("devolvidas_em_atraso"), F.col("total_concluidas"), 2))
            .withColumn("atraso_medio_dias",
                        round_ratio(F.col("_days"), F.col("devolvidas_em_atraso"), 1))
            .drop("_days").orderBy(F.desc("pct_atraso")))


def q4_2_duration_deviation(dw, as_of: dt.date) -> DataFrame:
    j = (_completed(dw).join(_grupo(dw), "sk_grupo")
         .join(_cal(dw, "t_ret", "sk_tempo_retirada", "d_ret"), "sk_tempo_retirada")
         .join(_cal(dw, "t_prev", "sk_tempo_prev_devolucao", "d_prev"), "sk_tempo_prev_devolucao")
         .join(_cal(dw, "t_real", "sk_tempo_real_devolucao", "d_real"), "sk_tempo_real_devolucao"))
    planned = F.datediff("d_prev", "d_ret")
    real = F.datediff("d_real", "d_ret")
    agg = (j.groupBy(F.col("nk_frota_origem").alias("empresa"), F.col("nome_grupo").alias("grupo"))
           .agg(F.sum(planned).alias("_p"), F.sum(real).alias("_r"), F.sum(real - planned).alias("_d"),
                F.count(F.lit(1)).alias("_n")))
    dev = round_ratio(F.col("_d"), F.col("_n"), 1)
    return (agg.select("empresa", "grupo",
                       round_ratio(F.col("_p"), F.col("_n"), 1).alias("duracao_prevista_media"),
                       round_ratio(F.col("_r"), F.col("_n"), 1).alias("duracao_real_media"),
                       dev.alias("desvio_medio_dias"))
            .orderBy(F.abs(F.col("desvio_medio_dias")).desc()))


def q5_1_volume_audit(dw, as_of: dt.date) -> DataFrame:
    """U-1: one count per table, unioned (nine independent scans in one plan)."""
    names = ["dim_tempo", "dim_patio", "dim_grupo", "dim_veiculo", "dim_cliente", "dim_endereco",
             "fato_inventario_patio", "fato_locacao", "fato_reserva"]
    parts = [dw[n].agg(F.count(F.lit(1)).alias("registros")).select(F.lit(n).alias("tabela"), "registros")
             for n in names]
    return reduce(DataFrame.unionByName, parts).orderBy(F.desc("registros"))


def q5_2_stale_rentals(dw, as_of: dt.date) -> DataFrame:
    oldest = date_key_of(as_of - dt.timedelta(days=STALE_DAYS))
    f = dw["fato_locacao"].where(F.col("sk_tempo_real_devolucao").isNull() & (F.col("sk_tempo_retirada") < oldest)
                                 & _months(dw["fato_locacao"], lambda m: m <= oldest // 100))
    a = F.lit(as_of)
    t = _cal(dw, "t_ret", "sk_tempo_retirada", "data_retirada").where(
        F.datediff(a, F.col("data_retirada")) > STALE_DAYS)
    j = f.join(t, "sk_tempo_retirada").join(_grupo(dw), "sk_grupo")
    return (j.select(F.col("nk_frota_origem").alias("empresa"), "nk_id_locacao", "data_retirada",
                     F.datediff(a, F.col("data_retirada")).cast("long").alias("dias_em_andamento"),
                     F.col("nome_grupo").alias("grupo"))
            .orderBy(F.desc("dias_em_andamento")))


MARTS = {
    "q1_1_yard_inventory": q1_1_yard_inventory,
    "q1_2_open_rentals": q1_2_open_rentals,
    "q1_3_reservation_horizon": q1_3_reservation_horizon,
    "q1_4_consumption": q1_4_consumption,
    "q2_1_transition_matrix": q2_1_transition_matrix,
    "q2_1_transition_matrix_by_key": q2_1_transition_matrix_by_key,
    "q2_2_yard_balance": q2_2_yard_balance,
    "q3_1_monthly_revenue": q3_1_monthly_revenue,
    "q3_2_revenue_share": q3_2_revenue_share,
    "q3_3_pipeline": q3_3_pipeline,
    "q4_1_return_sla": q4_1_return_sla,
    "q4_2_duration_deviation": q4_2_duration_deviation,
    "q5_1_volume_audit": q5_1_volume_audit,
    "q5_2_stale_rentals": q5_2_stale_rentals,
}
