"""Operator-level queries: each SURVEY §2 operator applied to the input tables.

Every function is (spark, sf_dir) -> DataFrame and reads whole tables from
``sf_dir``. Where a rule needs inputs the test tables do not contain (blank
texts, missing keys, synonyms), the raw value is derived from the row's own
key (``key mod n`` picks one of a few spellings); every row is processed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.functions import domain, text
from locastar.functions.dates import as_date, date_key, days_between
from locastar.functions.money import MONEY_12, MONEY_14, clamp_non_negative, planned_value
from locastar.operators import audit, conform as C, dims as D, facts as FL, lookups as L
from locastar.operators import merge as M, snapshot as SN
from locastar.session import scratch_path
from locastar.sources.analogue import AS_OF, Analogue
from locastar.sources.fleets import FLEETS, SOURCES

# Fixed run timestamp so reject logs are reproducible.
RUN_TS = dt.datetime(2000, 1, 1, 2, 0, 0)
# Raw spellings used to exercise the domain maps.
RAW_TRANSMISSION_7 = ("manual", "AUTOMATICA", "Automático", " automatico ", "automática", "CVT", None)
RAW_STATUS_16 = ("ativo", "Ativa", "ACTIVE", "aberta", "cancelado", "CANCELADA", "cancel", "convertido",
                 "Convertida", "concluido", "CONCLUIDA", "finalizado", "Finalizada", "pendente", "  ", None)
RAW_TYPES_5 = (" pf ", "PJ", "pj", "XX", None)
INCREMENTAL_CUT = dt.date(1999, 6, 1)
SNAPSHOT_DAY = AS_OF - dt.timedelta(days=1)


def _once(build):
    """One build for each session and input folder: what it returns reads written tables."""
    made: dict[tuple[str, str], object] = {}

    def run(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = build(spark, sf_dir)
        return made[key]
    return run


def _pick(k, values):
    """values[k mod len(values)] as a Column (NULL entries allowed)."""
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (k % len(values) + 1).cast("int"))


def _a(spark, sf_dir) -> Analogue:
    return Analogue(spark, sf_dir, AS_OF)


# ------------------------------------------------------------ text / domain
def c1_capitalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _a(spark, sf_dir).t("part", "p_partkey", "p_name", "p_type")
    return p.select("p_partkey", text.capitalise("p_name").alias("modelo"),
                    text.capitalise("p_type").alias("grupo"))


def c2_blank_sentinel(spark, sf_dir):
    a = _a(spark, sf_dir)
    c = a.t("customer", "c_custkey", "c_nationkey").join(a.addresses(), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    city = F.when(k % 4 == 0, F.lit("   ")).when(k % 4 == 1, F.lit(None)) \
        .otherwise(F.concat(F.lit("  "), F.col("cidade"), F.lit(" ")))
    uf = F.when(k % 3 == 0, F.lit("")).otherwise(F.lit("sp"))
    return c.select("c_custkey", text.blank_to(city, text.NOT_INFORMED).alias("end_cidade"),
                    text.blank_to(uf, text.UNKNOWN_UF).alias("end_uf"))


def c3_capacity_sentinel(spark, sf_dir):
    a = _a(spark, sf_dir)
    s = a.t("supplier", "s_suppkey").join(a.slot_counts(), F.col("s_suppkey") == F.col("nk_id_patio"), "left")
    raw = F.when(F.col("s_suppkey") % 5 != 0, F.col("n_slots"))
    return s.select(F.col("s_suppkey").alias("nk_id_patio"),
                    text.null_to(raw, -1).cast("long").alias("capacidade_vagas"))


def c4_customer_type(spark, sf_dir):
    a = _a(spark, sf_dir)
    raw = a.t("customer", "c_custkey", "c_name").select(
        F.lit(FLEETS[3]).alias("nk_frota_origem"), F.col("c_custkey").alias("nk_id_cliente"),
        _pick(F.col("c_custkey"), RAW_TYPES_5).alias("tipo_cliente"), F.col("c_name").alias("nome"),
        F.lit("x").alias("end_cidade"), F.lit("x").alias("end_uf"), F.lit(None).cast("string").alias("end_pais"))
    conf, rej = C.conform_cliente(raw, SOURCES[FLEETS[3]], run_ts=RUN_TS)
    return (conf.select("nk_id_cliente", "tipo_cliente", F.lit(None).cast("string").alias("motivo_rejeito"))
            .unionByName(rej.select(F.col("nk_id_registro").alias("nk_id_cliente"),
                                    F.lit(None).cast("string").alias("tipo_cliente"), "motivo_rejeito")))


def c5_transmission_map(spark, sf_dir):
    p = _a(spark, sf_dir).t("part", "p_partkey", "p_size")
    raw = _pick(F.col("p_size"), RAW_TRANSMISSION_7)
    return p.select("p_partkey", raw.alias("mecanizacao_origem"), domain.transmission(raw).alias("mecanizacao"))


def c6_status_map(spark, sf_dir):
    o = _a(spark, sf_dir).t("orders", "o_orderkey")
    raw = _pick(F.col("o_orderkey"), RAW_STATUS_16)
    extracted = domain.map_domain(raw, domain.STATUS_SYNONYMS_F3, domain.STATUS_DEFAULT, passthrough=True)
    return o.select(F.col("o_orderkey").alias("nk_id_reserva"), extracted.alias("status_extraido"),
                    domain.reservation_status(extracted).alias("status_reserva"))


def c7_duration(spark, sf_dir):
    o = _a(spark, sf_dir).t("orders", "o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    ret = F.date_add(as_date("o_orderdate"), (k % 30).cast("int"))
    dev = F.date_add(ret, (k % 12 - 2).cast("int"))
    return o.select(k.alias("nk_id_reserva"), days_between(ret, dev).cast("long").alias("duracao_prevista_dias"),
                    days_between(ret, dev, floor=1).cast("long").alias("duracao_minima_1"))


def _rates_with_gaps(a: Analogue) -> DataFrame:
    return a.classes().select("nk_id_grupo", F.when(F.col("nk_id_grupo") % 4 != 0, F.col("valor_diaria"))
                              .alias("valor_diaria"))


def c8_planned_value(spark, sf_dir):
    a = _a(spark, sf_dir)
    o = a.t("orders", "o_orderkey")
    k = F.col("o_orderkey")
    res = o.select(k.alias("nk_id_reserva"), (k % a.n_classes() + 1).alias("gid"), (k % 12).alias("dias"))
    j = res.join(_rates_with_gaps(a), F.col("gid") == F.col("nk_id_grupo"), "left")
    return j.select("nk_id_reserva", planned_value(F.col("dias"), F.col("valor_diaria")).alias("valor_previsto_reserva"))


def c9_clamp_value(spark, sf_dir):
    li = _a(spark, sf_dir).t("lineitem", "l_orderkey", "l_linenumber", "l_extendedprice")
    raw = F.when(F.col("l_linenumber") != 7,
                 F.col("l_extendedprice").cast(MONEY_14) - F.lit(50000).cast("decimal(14,2)"))
    return li.select("l_orderkey", "l_linenumber", clamp_non_negative(raw).cast(MONEY_14).alias("valor_final"))


def c15_name_fallback(spark, sf_dir):
    s = _a(spark, sf_dir).t("supplier", "s_suppkey", "s_name")
    k = F.col("s_suppkey")
    nome = F.when(k % 3 != 0, F.col("s_name"))
    codigo = F.when(k % 2 != 0, F.concat(F.lit("cod-"), k.cast("string")))
    return s.select(k.alias("nk_id_patio"),
                    text.capitalise(text.name_or(nome, codigo, prefix="PATIO ", id=k)).alias("nome_patio"))


def c16_plate(spark, sf_dir):
    p = _a(spark, sf_dir).t("part", "p_partkey")
    k = F.col("p_partkey")
    raw = F.when(k % 4 == 0, F.lit("  ")).when(k % 4 == 1, F.lit(None)) \
        .otherwise(F.concat(F.lit(" ab"), k.cast("string"), F.lit(" ")))
    return p.select(k.alias("p_partkey"), text.plate(raw).alias("placa"),
                    text.plate(raw, text.NO_PLATE).alias("placa_f4"))


def c17_text_defaults(spark, sf_dir):
    p = _a(spark, sf_dir).t("part", "p_partkey", "p_brand", "p_size")
    k = F.col("p_partkey")
    brand = F.when(k % 5 != 0, F.col("p_brand"))
    ac = F.when(F.col("p_size") % 3 != 0, F.col("p_size") % 2 == 0)
    return p.select(k.alias("p_partkey"), text.capitalise_or(brand, text.NOT_INFORMED).alias("marca"),
                    F.coalesce(ac, F.lit(False)).alias("tem_ar_condicionado"))


# --------------------------------------------------------------- quality
def faulty_reservations(a: Analogue) -> DataFrame:
    """Raw reservations with missing keys/dates and bad date orders."""
    o = a.t("orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderstatus")
    k = F.col("o_orderkey")
    ny, nc = a.n_yards(), a.n_classes()
    ret = F.date_add(as_date("o_orderdate"), (k % 30).cast("int"))

    def unless(m, v):
        return F.when(k % m != 0, v)
    return o.select(
        F.element_at(F.array(*[F.lit(f) for f in FLEETS]), (k % 4 + 1).cast("int")).alias("nk_frota_origem"),
        k.alias("nk_id_reserva"), unless(17, F.col("o_custkey")).alias("nk_id_cliente"),
        unless(19, k % nc + 1).alias("nk_id_grupo"), unless(23, k % ny).alias("nk_id_patio_retirada"),
        unless(29, F.col("o_custkey") % ny).alias("nk_id_patio_fim"),
        unless(31, as_date("o_orderdate")).alias("data_reserva"),
        unless(37, ret).alias("data_retirada_prevista"),
        unless(41, F.date_add(ret, (k % 12 - 1).cast("int"))).alias("data_devolucao_prevista"),
        F.col("o_totalprice").cast(MONEY_12).alias("valor_previsto_reserva"),
        F.col("o_orderstatus").alias("status_reserva"))


def faulty_rentals(a: Analogue) -> DataFrame:
    li = a.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus",
             "l_shipdate", "l_extendedprice")
    k = F.col("l_orderkey")
    ship = as_date("l_shipdate")
    return li.select(
        F.element_at(F.array(*[F.lit(f) for f in FLEETS]), (k % 4 + 1).cast("int")).alias("nk_frota_origem"),
        (k * 8 + F.col("l_linenumber")).alias("nk_id_locacao"), k.alias("nk_id_cliente"),
        F.col("l_partkey").alias("nk_id_veiculo"), F.lit(1).alias("nk_id_grupo"),
        F.col("l_suppkey").alias("nk_id_patio_retirada"), F.lit(None).cast("long").alias("nk_id_patio_devolucao"),
        ship.alias("data_retirada"), F.date_add(ship, F.col("l_linenumber")).alias("data_prev_devolucao"),
        F.when(F.col("l_linestatus") == "F", F.date_add(ship, (k % 10 - 3).cast("int"))).alias("data_real_devolucao"),
        F.col("l_extendedprice").cast(MONEY_14).alias("valor_final"))


def c10_date_order(spark, sf_dir):
    r = faulty_rentals(_a(spark, sf_dir))
    bad = F.col("data_real_devolucao").isNotNull() & (F.col("data_real_devolucao") < F.col("data_retirada"))
    return r.select("nk_id_locacao", (~bad).alias("data_valida"))


def c11_first_reason(spark, sf_dir):
    r = faulty_reservations(_a(spark, sf_dir))
    return r.select("nk_id_reserva", C.reservation_reason().alias("motivo_rejeito"))


def _by_fleet(raw: DataFrame, conform) -> DataFrame:
    """Rejects of each fleet's rows under its own rules, texts and payloads."""
    parts = [conform(raw.where(F.col("nk_frota_origem") == f), SOURCES[f]) for f in FLEETS]
    return reduce(DataFrame.unionByName, parts)


def _own_durations(a: Analogue) -> DataFrame:
    """Faulty reservations with the duration that the source states: missing or 0 on some."""
    k = F.col("nk_id_reserva")
    days = F.datediff("data_devolucao_prevista", "data_retirada_prevista")
    return faulty_reservations(a).withColumn(
        "duracao_prevista_dias", F.when(k % 43 == 0, F.lit(None)).when(k % 47 == 0, F.lit(0)).otherwise(days).cast("int"))


def c11_fleet_reasons(spark, sf_dir):
    """C10/C11 under each source's rules: nine for F1-F3, the last on the source's own duration, eight for F4."""
    r = _own_durations(_a(spark, sf_dir))
    return _by_fleet(r, lambda part, cfg: part.select("nk_frota_origem", "nk_id_reserva", C.reservation_reason(cfg).alias("motivo_rejeito")))


def c14_fleet_payloads(spark, sf_dir):
    """C14: rejected reservations with each source's payload."""
    a = _a(spark, sf_dir)
    rates = a.raw_grupo().select("nk_frota_origem", "nk_id_grupo", "valor_diaria")
    rej = _by_fleet(_own_durations(a), lambda part, cfg: C.conform_reserva(part, cfg, rates, RUN_TS)[1])
    return rej.select("tabela_origem", "nk_id_registro", "motivo_rejeito", "dados_json")


def c14_rental_payloads(spark, sf_dir):
    """C14: rejected rentals of the four sources, the final value included."""
    rej = _by_fleet(faulty_rentals(_a(spark, sf_dir)), lambda part, cfg: C.conform_locacao(part, cfg, RUN_TS)[1])
    return rej.select("tabela_origem", "nk_id_registro", "motivo_rejeito", "dados_json")


def c4_fleet_reasons(spark, sf_dir):
    """C4/C11: customers of four fleets without a valid type, vehicles without class (F2: or home yard),
    snapshots without keys, in each source's words."""
    a = _a(spark, sf_dir)
    k = F.col("nk_id_cliente")
    customers = a.raw_cliente().withColumn("tipo_cliente", _pick(k, RAW_TYPES_5))
    v = F.col("nk_id_veiculo")
    vehicles = a.raw_veiculo().withColumn("nk_id_grupo", F.when(v % 5 != 0, F.col("nk_id_grupo"))) \
        .withColumn("nk_id_patio_origem", F.when(v % 7 != 0, F.col("nk_id_patio_origem")))
    snaps = a.raw_snapshot().withColumn("nk_id_patio", F.when(v % 11 != 0, F.col("nk_id_patio")))
    found = [_by_fleet(customers, lambda part, cfg: C.conform_cliente(part, cfg, RUN_TS)[1]),
             _by_fleet(vehicles, lambda part, cfg: C.conform_veiculo(part, cfg, RUN_TS)[1]),
             _by_fleet(snaps, lambda part, cfg: C.conform_snapshot(part, RUN_TS, cfg)[1])]
    return reduce(DataFrame.unionByName, found).select("tabela_origem", "nk_id_registro", "motivo_rejeito")


def c12_accept_reject_split(spark, sf_dir):
    r = faulty_reservations(_a(spark, sf_dir))
    valid, rej = C.conform_reserva(r, run_ts=RUN_TS)
    flags = (valid.select("nk_frota_origem", F.lit(1).alias("a"), F.lit(0).alias("r"))
             .unionByName(rej.select("nk_frota_origem", F.lit(0).alias("a"), F.lit(1).alias("r"))))
    return flags.groupBy("nk_frota_origem").agg(F.sum("a").cast("long").alias("aceitas"),
                                                F.sum("r").cast("long").alias("rejeitadas"))


def c13_warn_and_load(spark, sf_dir):
    a = _a(spark, sf_dir)
    raw = a.raw_grupo().withColumn(
        "valor_diaria", F.when(F.col("nk_id_grupo") % 3 == 0, F.lit(None))
        .when(F.col("nk_id_grupo") % 3 == 1, F.lit(0).cast(MONEY_12)).otherwise(F.col("valor_diaria")))
    conf, warn = C.conform_grupo(raw, run_ts=RUN_TS)
    w = warn.select("nk_frota_origem", F.col("nk_id_registro").alias("nk_id_grupo"), F.col("motivo_rejeito").alias("aviso"))
    return conf.join(w, ["nk_frota_origem", "nk_id_grupo"], "left").select(
        "nk_frota_origem", "nk_id_grupo", "nome_grupo", "valor_diaria", "aviso")


def c14_reject_json(spark, sf_dir):
    _, rej = C.conform_reserva(faulty_reservations(_a(spark, sf_dir)), run_ts=RUN_TS)
    return rej.select("tabela_origem", "nk_id_registro", "motivo_rejeito", "dados_json")


def reject_log(a: Analogue) -> DataFrame:
    _, r1 = C.conform_reserva(faulty_reservations(a), run_ts=RUN_TS)
    _, r2 = C.conform_locacao(faulty_rentals(a), run_ts=RUN_TS)
    return r1.unionByName(r2)


def g9_reject_summary(spark, sf_dir):
    return audit.reject_summary(reject_log(_a(spark, sf_dir)))


def _whole_log(spark, sf_dir) -> DataFrame:
    """Conform rejects and late keys together, as a night logs them."""
    return reduce(DataFrame.unionByName, _late_dims(spark, sf_dir)[2], reject_log(_a(spark, sf_dir)))


def g8_reject_reasons(spark, sf_dir):
    """G8 with late keys in the log: one row per table and template."""
    return audit.reject_reasons(_whole_log(spark, sf_dir))


def g9_summary_with_late_keys(spark, sf_dir):
    return audit.reject_summary(_whole_log(spark, sf_dir))


def g9_fleet_summary(spark, sf_dir):
    """G9 with its fleet filter."""
    return audit.reject_summary(_whole_log(spark, sf_dir), FLEETS[1])


def o6_latest_rejects(spark, sf_dir):
    return audit.latest_rejects(reject_log(_a(spark, sf_dir)), 50).select(
        "tabela_origem", "nk_frota_origem", "nk_id_registro", "motivo_rejeito")


def qc_constraint_audit(spark, sf_dir):
    from locastar.plans.registry import warehouse_for
    return audit.audit_constraints(warehouse_for(spark, sf_dir).tables)


# --------------------------------------------------------------- extract
def s1_full_extract(spark, sf_dir):
    """X patio (F2 shape): plain copy, capacity column, address cut to 150 chars."""
    a = _a(spark, sf_dir)
    s = a.t("supplier", "s_suppkey", "s_name").join(a.slot_counts(), F.col("s_suppkey") == F.col("nk_id_patio"), "left")
    addr = F.concat_ws(" ", *[F.col("s_name")] * 12)
    return s.select(F.lit(FLEETS[1]).alias("nk_frota_origem"), F.col("s_suppkey").alias("nk_id_patio"),
                    F.col("s_name").alias("nome_patio"), F.col("n_slots").cast("long").alias("capacidade_vagas"),
                    text.truncate(addr, 150).alias("endereco"), F.lit(None).cast("string").alias("end_cidade"),
                    F.lit(None).cast("string").alias("end_uf"))


def s2_incremental_cut(spark, sf_dir):
    """Rentals changed since the cut (pick-up OR return on/after it)."""
    r = _a(spark, sf_dir).raw_locacao()
    cut = F.lit(INCREMENTAL_CUT)
    return r.where((F.col("data_retirada") >= cut) | (F.col("data_real_devolucao") >= cut)).select(
        "nk_frota_origem", "nk_id_locacao", "data_retirada", "data_real_devolucao")


def x_subclass_merge(spark, sf_dir):
    """Customer LEFT JOIN PF subclass LEFT JOIN PJ subclass; name by type."""
    c = _a(spark, sf_dir).t("customer", "c_custkey", "c_name")
    k = F.col("c_custkey")
    pf = c.where(k % 3 != 0).select(k.alias("pf_id"), F.concat(F.lit("CPF"), k.cast("string")).alias("cpf"),
                                     F.col("c_name").alias("pf_nome"))
    pj = c.where(k % 3 == 0).select(k.alias("pj_id"), F.concat(F.lit("CNPJ"), k.cast("string")).alias("cnpj"),
                                     F.concat(F.lit("NF "), F.col("c_name")).alias("nome_fantasia"))
    j = c.join(pf, k == F.col("pf_id"), "left").join(pj, k == F.col("pj_id"), "left")
    tipo = F.when(F.col("pf_id").isNotNull(), F.lit("PF")).when(F.col("pj_id").isNotNull(), F.lit("PJ"))
    return j.select(k.alias("nk_id_cliente"), tipo.alias("tipo_cliente"),
                    F.when(tipo == "PF", F.col("pf_nome")).otherwise(F.col("nome_fantasia")).alias("nome"),
                    F.coalesce(F.col("cpf"), F.col("cnpj")).alias("documento"))


def x_slot_count(spark, sf_dir):
    a = _a(spark, sf_dir)
    s = a.t("supplier", "s_suppkey")
    out = L.lookup_agg(s, a.slots(), ["s_suppkey"], ["id_patio"], {"capacidade_vagas": F.count(F.lit(1))},
                       {"capacidade_vagas": 0})
    return out.select(F.col("s_suppkey").alias("nk_id_patio"), F.col("capacidade_vagas").cast("long"))


def x_extension_sum(spark, sf_dir):
    """planned return = agreed end + sum of extension days (none -> unchanged)."""
    a = _a(spark, sf_dir)
    o = a.t("orders", "o_orderkey", "o_orderdate")
    out = L.lookup_agg(o, a.extensions(), ["o_orderkey"], ["id_locacao"], {"dias_ext": F.sum("qtd_dias")},
                       {"dias_ext": 0})
    return out.select(F.col("o_orderkey").alias("nk_id_locacao"),
                      F.date_add(F.date_add(as_date("o_orderdate"), 7), F.col("dias_ext").cast("int"))
                      .alias("data_prev_devolucao"))


def x_charge_sum(spark, sf_dir):
    """final value = sum of charges PAGA/PENDENTE of the rental, 0 without any."""
    a = _a(spark, sf_dir)
    o = a.t("orders", "o_orderkey")
    ch = a.charges().where(F.col("status").isin("PAGA", "PENDENTE"))
    out = L.lookup_agg(o, ch, ["o_orderkey"], ["locacao_id"], {"valor_final": F.sum("valor_total")},
                       {"valor_final": 0})
    return out.select(F.col("o_orderkey").alias("nk_id_locacao"), F.col("valor_final").cast("decimal(22,2)"))


def x_return_chain(spark, sf_dir):
    """J12 + J6: rental -> its return (first by date desc, slot asc) -> slot -> yard."""
    a = _a(spark, sf_dir)
    o = a.t("orders", "o_orderkey")
    li = a.t("lineitem", "l_orderkey", "l_partkey", "l_linestatus", "l_shipdate")
    ret = li.where(F.col("l_linestatus") == "F").select(
        F.col("l_orderkey").alias("id_locacao"), F.col("l_partkey").alias("id_vaga"),
        F.date_add(as_date("l_shipdate"), (F.col("l_orderkey") % 10).cast("int")).alias("data_devolucao"))
    first = L.lookup_first(o, ret, ["o_orderkey"], ["id_locacao"],
                           [("data_devolucao", True), ("id_vaga", False)], ["id_vaga", "data_devolucao"])
    slots = a.slots().select(F.col("id_vaga").alias("_vaga"), F.col("id_patio").alias("patio_devolucao"))
    return first.join(slots, F.col("id_vaga") == F.col("_vaga"), "left").select(
        F.col("o_orderkey").alias("nk_id_locacao"), "data_devolucao", "patio_devolucao")


# -------------------------------------------------------------- snapshots
def _vehicles(a: Analogue) -> DataFrame:
    p = a.t("part", "p_partkey", "p_size")
    return p.join(a.part_class(), "p_partkey").select(
        F.col("p_partkey").alias("nk_id_veiculo"), "nk_id_grupo", "p_size",
        (F.col("p_partkey") % a.n_yards()).alias("nk_id_patio_origem"))


def sn1_slot_snapshot(spark, sf_dir):
    a = _a(spark, sf_dir)
    return SN.slot_snapshot(FLEETS[0], a.slots(), _vehicles(a), SNAPSHOT_DAY)


def sn2_asof_yard(spark, sf_dir):
    a = _a(spark, sf_dir)
    v = _vehicles(a).withColumn("situacao", F.when(F.col("p_size") % 10 == 0, F.lit("BAIXADO"))
                                .otherwise(F.lit("ATIVO")))
    li = a.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_shipdate")
    k = F.col("l_orderkey")
    done = F.col("l_linestatus") == "F"
    rentals = li.select((k * 8 + F.col("l_linenumber")).alias("id_locacao"), F.col("l_partkey").alias("veiculo_id"),
                        F.when(done, F.lit("CONCLUIDA")).otherwise(F.lit("EM_ANDAMENTO")).alias("status"),
                        F.col("l_shipdate").alias("data_retirada_real"),
                        F.when(done, F.date_add(as_date("l_shipdate"), (k % 10).cast("int"))).alias("data_devolucao_real"),
                        ((F.col("l_suppkey") + F.col("l_linenumber")) % a.n_yards()).alias("patio_devolucao_id"))
    return SN.asof_snapshot(FLEETS[1], v, rentals, dt.date(1995, 3, 1))


def sn3_slot_id_snapshot(spark, sf_dir):
    a = _a(spark, sf_dir)
    v = _vehicles(a).withColumn("id_vaga", F.when(F.col("nk_id_veiculo") % 4 != 0, F.col("nk_id_veiculo")))
    return SN.slot_id_snapshot(FLEETS[2], v, a.slots(), AS_OF)


def sn4_status_snapshot(spark, sf_dir):
    a = _a(spark, sf_dir)
    v = _vehicles(a).select("nk_id_veiculo", "nk_id_grupo", F.col("nk_id_patio_origem").alias("id_patio_atual"),
                            _pick(F.col("p_size"), ("DISPONIVEL", "ALUGADO", "MANUTENCAO", None)).alias("status"))
    return SN.status_snapshot(FLEETS[3], v, AS_OF)


def j7_null_aware_anti(spark, sf_dir):
    a = _a(spark, sf_dir)
    c = a.t("customer", "c_custkey")
    pending = a.t("orders", "o_custkey", "o_orderstatus").where(F.col("o_orderstatus") == "P")
    return L.not_in(c, pending, "c_custkey", "o_custkey")


# ------------------------------------------------------------ keys / load
def _conformed(a: Analogue) -> dict[str, DataFrame]:
    from locastar.plans.warehouse import conform_sources
    return conform_sources(a, RUN_TS)[0]


def d1_address_dim(spark, sf_dir):
    a = _a(spark, sf_dir)
    conf = _conformed(a)
    return D.address_dim(D.empty_address(spark), conf["stg_conf_patio"], conf["stg_conf_cliente"])


def d2_scd1_upsert(spark, sf_dir):
    """Existing dimension (even keys, old names) upserted with every customer."""
    a = _a(spark, sf_dir)
    c = a.t("customer", "c_custkey", "c_name")
    inc = c.select(F.lit(FLEETS[0]).alias("nk_frota_origem"), F.col("c_custkey").alias("nk_id_cliente"),
                   F.lit("PF").alias("tipo_cliente"), F.col("c_name").alias("nome"))
    old = inc.where(F.col("nk_id_cliente") % 2 == 0).withColumn("nome", F.concat(F.lit("OLD "), F.col("nome")))
    nk, attrs = ["nk_frota_origem", "nk_id_cliente"], ["tipo_cliente", "nome"]
    current = D.scd1(None, old, nk, attrs, "sk_cliente")
    return D.scd1(current, inc, nk, attrs, "sk_cliente")


def d3_address_lookup(spark, sf_dir):
    a = _a(spark, sf_dir)
    conf = _conformed(a)
    address = D.address_dim(D.empty_address(spark), conf["stg_conf_patio"], conf["stg_conf_cliente"])
    return D.with_address_key(conf["stg_conf_cliente"], address).select("nk_frota_origem", "nk_id_cliente",
                                                                         "sk_endereco")


def calendar_span(df: DataFrame, col: str) -> DataFrame:
    """D4 over the span of a date column: one sequence of days, exploded."""
    d = df.select(as_date(col).alias("d")).agg(F.min("d").alias("a"), F.max("d").alias("b"))
    return (d.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("data"))
            .select(date_key("data").alias("sk_tempo"), "data"))


def d4_calendar(spark, sf_dir):
    return calendar_span(_a(spark, sf_dir).t("orders", "o_orderdate"), "o_orderdate")


def s7_seed_if_empty(spark, sf_dir):
    """A calendar goes in only when the table is empty. An empty table gets the
    days spanned by the orders; the table so filled then keeps its rows against
    the default calendar (2015-2035)."""
    from locastar.functions.dates import calendar
    span = calendar_span(_a(spark, sf_dir).t("orders", "o_orderdate"), "o_orderdate")
    return M.seed_if_empty(M.seed_if_empty(span.limit(0), span), calendar(spark))


def d5_missing_dates(spark, sf_dir):
    from locastar.functions.dates import calendar
    a = _a(spark, sf_dir)
    conf = _conformed(a)
    from locastar.plans.warehouse import RENTAL_DATES, RESERVATION_DATES
    return D.missing_dates([(conf["stg_conf_reserva"], RESERVATION_DATES),
                            (conf["stg_conf_locacao"], RENTAL_DATES)], calendar(spark))


def s3_merge_subset(spark, sf_dir):
    """S3: upsert updating only status and value; other columns keep the target's.
    Even keys are stored, odd keys arrive new, and every third key arrives as a change."""
    r = _a(spark, sf_dir).raw_reserva().select("nk_frota_origem", "nk_id_reserva", "data_reserva",
                                              "valor_previsto_reserva", "status_reserva")
    k = F.col("nk_id_reserva")
    target = r.where(k % 2 == 0).withColumn("status_reserva", F.lit("ATIVA"))
    source = (r.where((k % 3 == 0) | (k % 2 != 0)).withColumn("data_reserva", F.date_add("data_reserva", 1))
              .withColumn("valor_previsto_reserva", (F.col("valor_previsto_reserva") * 2).cast(MONEY_12)))
    return M.merge_upsert(target, source, ["nk_frota_origem", "nk_id_reserva"],
                          ["status_reserva", "valor_previsto_reserva"])


def s4_replace_slice(spark, sf_dir):
    """Write every fleet's conformed reservations, then replace one fleet's slice."""
    r = C.conform_reserva(_a(spark, sf_dir).raw_reserva(), run_ts=RUN_TS)[0]
    path = scratch_path(spark, "s4-" + uuid.uuid4().hex)
    M.replace_slice(r, path, ["nk_frota_origem"])
    M.replace_slice(r.where((F.col("nk_frota_origem") == FLEETS[1]) & (F.col("status_reserva") == "CANCELADA")),
                    path, ["nk_frota_origem"])
    return spark.read.parquet(path).select("nk_frota_origem", "nk_id_reserva", "status_reserva")


def s5_replace_day(spark, sf_dir):
    """Day snapshots written by (fleet, day); re-running one day replaces only it."""
    a = _a(spark, sf_dir)
    snap = C.conform_snapshot(a.raw_snapshot(), run_ts=RUN_TS)[0].drop("nk_frota_veiculo")
    path = scratch_path(spark, "s5-" + uuid.uuid4().hex)
    M.replace_slice(snap, path, ["nk_frota_origem", "data_snapshot"])
    day = AS_OF - dt.timedelta(days=1)
    again = snap.where((F.col("data_snapshot") == F.lit(day)) & (F.col("nk_id_veiculo") % 3 == 1))
    M.replace_slice(again, path, ["nk_frota_origem", "data_snapshot"])
    return spark.read.parquet(path).select("nk_frota_origem", "nk_id_patio", "nk_id_veiculo",
                                           F.col("data_snapshot").cast("date").alias("data_snapshot"))


def s8_insert_ignore(spark, sf_dir):
    a = _a(spark, sf_dir)
    addr = a.addresses()
    ys = a.t("supplier", "s_nationkey").join(addr, F.col("s_nationkey") == F.col("n_nationkey")).select("cidade", "uf")
    cs = a.t("customer", "c_nationkey").join(addr, F.col("c_nationkey") == F.col("n_nationkey")).select("cidade", "uf")
    target = ys.distinct()
    return M.insert_ignore(target, cs, ["cidade", "uf"])


def u1_date_key(spark, sf_dir):
    a = _a(spark, sf_dir)
    li = a.t("lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    cal = calendar_span(li, "l_shipdate")
    df = li.select("l_orderkey", "l_linenumber", as_date("l_shipdate").alias("data_retirada"))
    return D.with_date_key(df, "data_retirada", cal, "sk_tempo_retirada")


def u2_unpivot_dates(spark, sf_dir):
    r = _a(spark, sf_dir).raw_locacao()
    return D.unpivot_dates(r, ["data_retirada", "data_prev_devolucao", "data_real_devolucao"])


def _wh(spark, sf_dir):
    from locastar.plans.registry import warehouse_for
    return warehouse_for(spark, sf_dir)


def fl1_inventory_fact(spark, sf_dir):
    return _wh(spark, sf_dir)["fato_inventario_patio"]


def fl2_rental_fact(spark, sf_dir):
    return _wh(spark, sf_dir)["fato_locacao"]


def fl3_reservation_fact(spark, sf_dir):
    return _wh(spark, sf_dir)["fato_reserva"]


# The day before which the first of two nights knows the sources.
FIRST_NIGHT = dt.date(1997, 6, 1)


@_once
def _second_night(spark, sf_dir):
    """P1 with U2: a night on the sources as they were, then one that reads what changed since."""
    from locastar.plans.nightly import read_warehouse, run_nightly
    out = scratch_path(spark, f"nights-{uuid.uuid4().hex}")
    run_nightly(spark, sf_dir, out, FIRST_NIGHT, dt.datetime(1997, 6, 1, 2), known_before=FIRST_NIGHT)
    run_nightly(spark, sf_dir, out, AS_OF, RUN_TS)
    return read_warehouse(spark, out)


def p1_second_night_rentals(spark, sf_dir):
    """FL2 after two nights: the same rows as a full load."""
    return _second_night(spark, sf_dir)["fato_locacao"].drop("mes")


def p1_second_night_reservations(spark, sf_dir):
    """FL3 after two nights: the same rows as a full load."""
    return _second_night(spark, sf_dir)["fato_reserva"].drop("mes")


def p1_second_night_inventory(spark, sf_dir):
    """FL1 after two nights: the days of both."""
    return _second_night(spark, sf_dir)["fato_inventario_patio"]


@_once
def _late_dims(spark, sf_dir):
    """Dimensions where some customers and yards have not arrived yet."""
    from locastar.plans.warehouse import checkpointed, conform_sources, load_warehouse
    a = _a(spark, sf_dir)
    conf, _ = conform_sources(a, RUN_TS)
    conf = {k: checkpointed(k, v) for k, v in conf.items()}
    conf["stg_conf_cliente"] = conf["stg_conf_cliente"].where(F.col("nk_id_cliente") % 10 != 0)
    conf["stg_conf_patio"] = conf["stg_conf_patio"].where(F.col("nk_id_patio") % 7 != 0)
    tables, late = load_warehouse(spark, conf, run_ts=RUN_TS, materialize=checkpointed)
    return conf, tables, late


def fl4_late_key_reject(spark, sf_dir):
    _, _, late = _late_dims(spark, sf_dir)
    out = late[0].unionByName(late[1]).unionByName(late[2])
    return out.select("tabela_origem", "nk_frota_origem", "nk_id_registro", "motivo_rejeito")


def fl4b_return_yard_warning(spark, sf_dir):
    conf, tables, _ = _late_dims(spark, sf_dir)
    w = FL.return_yard_warnings(conf["stg_conf_locacao"], tables, RUN_TS)
    return w.select("tabela_origem", "nk_frota_origem", "nk_id_registro", "motivo_rejeito")


OPERATOR_QUERIES = {f.__name__: f for f in [
    c1_capitalise, c2_blank_sentinel, c3_capacity_sentinel, c4_customer_type, c5_transmission_map,
    c6_status_map, c7_duration, c8_planned_value, c9_clamp_value, c15_name_fallback, c16_plate,
    c17_text_defaults, c10_date_order, c11_first_reason, c12_accept_reject_split, c13_warn_and_load,
    c14_reject_json, c4_fleet_reasons, c11_fleet_reasons, c14_fleet_payloads, c14_rental_payloads, g8_reject_reasons,
    g9_summary_with_late_keys, g9_fleet_summary, g9_reject_summary, o6_latest_rejects, qc_constraint_audit,
    s1_full_extract, s2_incremental_cut, x_subclass_merge, x_slot_count, x_extension_sum, x_charge_sum,
    x_return_chain, sn1_slot_snapshot, sn2_asof_yard, sn3_slot_id_snapshot, sn4_status_snapshot,
    j7_null_aware_anti, d1_address_dim, d2_scd1_upsert, d3_address_lookup, d4_calendar, s7_seed_if_empty,
    d5_missing_dates,
    s3_merge_subset, s4_replace_slice, s5_replace_day, s8_insert_ignore, u1_date_key, u2_unpivot_dates,
    fl1_inventory_fact, fl2_rental_fact, fl3_reservation_fact, fl4_late_key_reject, fl4b_return_yard_warning,
    p1_second_night_rentals, p1_second_night_reservations, p1_second_night_inventory,
]}


# ----------------------------------------------------- per-source extracts (X)
def _extract_query(fleet: str, entity: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from locastar.sources import oltp
        from locastar.sources.extract import extract
        return extract(oltp.TABLES[fleet](_a(spark, sf_dir)), fleet, entity)
    run.__name__ = f"x_f{FLEETS.index(fleet) + 1}_{entity}"
    return run


for _f in FLEETS:
    for _e in ("patio", "grupo", "veiculo", "cliente", "reserva", "locacao"):
        _q = _extract_query(_f, _e)
        OPERATOR_QUERIES[_q.__name__] = _q
