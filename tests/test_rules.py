"""Conform rules on hand-made rows (FIXTURES.md §4 edge cases)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from locastar.functions import domain, text
from locastar.functions.money import clamp_non_negative, pct, round_ratio
from locastar.operators import conform as C
from locastar.sources.fleets import SOURCES

D = dt.date


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_capitalise_first_letter_only(spark):
    assert one(spark, text.capitalise(F.col("x")), "  SÃO JOSÉ ") == "São josé"


def test_blank_and_null_sentinels(spark):
    assert one(spark, text.blank_to(F.col("x"), text.NOT_INFORMED), "   ") == "NÃO INFORMADO"
    assert one(spark, text.blank_to(F.col("x"), text.NOT_INFORMED), None) == "NÃO INFORMADO"
    assert one(spark, text.null_to(F.col("x"), -1), None, "x int") == -1


def test_name_fallback_and_plate(spark):
    df = spark.createDataFrame([(7, None, " cod ")], "id int, n string, c string")
    r = df.select(text.name_or("n", "c", prefix="GRUPO ", id="id").alias("a"),
                  text.name_or("n", prefix="GRUPO ", id="id").alias("b")).first()
    assert (r.a, r.b) == ("cod", "GRUPO 7")
    assert one(spark, text.plate(F.col("x"), text.NO_PLATE), "  ") == "SEM PLACA"
    assert one(spark, text.plate(F.col("x")), " abc1 ") == "ABC1"


def test_transmission_map(spark):
    for raw, exp in [("automática", "AUTOMATICO"), ("CVT", "NÃO INFORMADO"), (" manual", "MANUAL"),
                     (None, "NÃO INFORMADO"), ("AUTOMATICA", "AUTOMATICO")]:
        assert one(spark, domain.transmission(F.col("x")), raw) == exp


def test_status_map_f3_then_dw(spark):
    ext = domain.map_domain(F.col("x"), domain.STATUS_SYNONYMS_F3, "ATIVA", passthrough=True)
    for raw, exp in [(None, "ATIVA"), ("finalizada", "CONVERTIDA"), ("pendente", "ATIVA")]:
        assert one(spark, domain.reservation_status(ext), raw) == exp
    assert one(spark, ext, "pendente") == "pendente"


def test_customer_type_rule_rejects_null(spark):
    rows = [("f", 1, " pf ", "a"), ("f", 2, "XX", "b"), ("f", 3, None, "c")]
    raw = spark.createDataFrame(rows, "nk_frota_origem string, nk_id_cliente int, tipo_cliente string, nome string") \
        .withColumn("end_cidade", F.lit("x")).withColumn("end_uf", F.lit("y")).withColumn("end_pais", F.lit(None))
    conf, rej = C.conform_cliente(raw)
    assert [(r.nk_id_cliente, r.tipo_cliente) for r in conf.collect()] == [(1, "PF")]
    assert sorted(r.nk_id_registro for r in rej.collect()) == [2, 3]
    conf2, rej2 = C.conform_cliente(raw, legacy_null_drop=True)
    assert sorted(r.nk_id_registro for r in rej2.collect()) == [2]


def _res(spark, rows):
    schema = ("nk_frota_origem string, nk_id_reserva int, nk_id_cliente int, nk_id_grupo int, "
              "nk_id_patio_retirada int, nk_id_patio_fim int, data_reserva date, data_retirada_prevista date, "
              "data_devolucao_prevista date, valor_previsto_reserva decimal(12,2), status_reserva string")
    return spark.createDataFrame(rows, schema)


def test_reservation_first_reason_and_split(spark):
    d0, d1, d2 = D(2020, 1, 1), D(2020, 1, 5), D(2020, 1, 8)
    rows = [
        ("f", 1, None, None, 1, 1, d0, d1, d2, None, "x"),     # two faults -> first one
        ("f", 2, 1, 1, 1, 1, d0, d1, d1, None, "ATIVA"),       # same day -> rejected
        ("f", 3, 1, 1, 1, 1, d0, d1, d2, None, "cancelada"),   # valid
    ]
    conf, rej = C.conform_reserva(_res(spark, rows), run_ts=dt.datetime(2020, 1, 1))
    reasons = {r.nk_id_registro: r.motivo_rejeito for r in rej.collect()}
    assert reasons == {1: "Reserva sem cliente", 2: "Data devolução <= data retirada"}
    (v,) = conf.collect()
    assert (v.nk_id_reserva, v.duracao_prevista_dias, v.status_reserva, float(v.valor_previsto_reserva)) == \
        (3, 3, "CANCELADA", 0.0)
    js = [r.dados_json for r in rej.collect() if r.nk_id_registro == 1][0]
    assert '"nk_id_cliente":null' in js   # NULL fields kept, as JSON_OBJECT


def test_planned_value_f4_and_duration_floor(spark):
    d1, d2 = D(2020, 1, 5), D(2020, 1, 8)
    rows = [("frota-4", 1, 1, 7, 1, 1, d1, d1, d2, None, "ATIVA")]
    rates = spark.createDataFrame([("frota-4", 7, 100.5)], "nk_frota_origem string, nk_id_grupo int, valor_diaria double")
    conf, _ = C.conform_reserva(_res(spark, rows), SOURCES["frota-4"], rates=rates)
    assert float(conf.first().valor_previsto_reserva) == 301.5


def test_rental_return_same_day_accepted_and_value_clamped(spark):
    schema = ("nk_frota_origem string, nk_id_locacao int, nk_id_cliente int, nk_id_veiculo int, nk_id_grupo int, "
              "nk_id_patio_retirada int, nk_id_patio_devolucao int, data_retirada date, data_prev_devolucao date, "
              "data_real_devolucao date, valor_final decimal(14,2)")
    d = D(2020, 1, 1)
    rows = [("f", 1, 1, 1, 1, 1, None, d, d, d, Decimal("-10")),
            ("f", 2, 1, 1, 1, 1, None, d, d, D(2019, 12, 31), Decimal("5"))]
    conf, rej = C.conform_locacao(spark.createDataFrame(rows, schema))
    assert [(r.nk_id_locacao, float(r.valor_final)) for r in conf.collect()] == [(1, 0.0)]
    assert rej.first().motivo_rejeito == "Data devolução real anterior à retirada"


def test_class_without_rate_warned_and_loaded(spark):
    raw = spark.createDataFrame([("f", 1, None, None, None), ("f", 2, "x", None, 0.0), ("f", 3, "y", None, 10.0)],
                                "nk_frota_origem string, nk_id_grupo int, nome_grupo string, codigo string, valor_diaria double")
    conf, warn = C.conform_grupo(raw)
    assert conf.count() == 3
    assert sorted(r.nk_id_registro for r in warn.collect()) == [1, 2]
    assert {r.nk_id_grupo: r.nome_grupo for r in conf.collect()}[1] == "Grupo 1"


def test_exact_rounding(spark):
    df = spark.createDataFrame([(1, 8, 5, 3, -7, 2, 0)], "a long, b long, c long, d long, e long, f long, z long")
    r = df.select(round_ratio(F.col("a"), F.col("b"), 2).alias("x"),     # 0.125 -> 0.13
                  pct(F.col("c"), F.col("d"), 2).alias("y"),             # 166.666.. -> 166.67
                  round_ratio(F.col("e"), F.col("f"), 0).alias("w"),     # -3.5 -> -4
                  pct(F.col("a"), F.col("z")).alias("n")).first()
    assert (r.x, r.y, r.w, r.n) == (0.13, 166.67, -4.0, None)
    z = df.select(round_ratio(F.lit(-1), F.lit(100), 1).alias("z")).first().z   # -0.01 -> 0.0, not -0.0
    assert z == 0.0 and str(z) == "0.0"
    assert float(one(spark, clamp_non_negative(F.col("x")), -3, "x int")) == 0
