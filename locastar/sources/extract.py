"""Extract mappings (X, S1, S2): source-shaped tables -> raw staging rows.

One function per (fleet, entity) cell of SURVEY §2.3, registered in
``MAPPINGS``; ``extract`` dispatches. Correlated subqueries of the sources
become set operations (lookups.J5/J6/J12): counts and sums are aggregated
once per key and joined, LIMIT 1 lookups pick with an explicit order.
Incremental sources (F2) filter on the change date against ``cut`` (S2);
``cut=None`` means the full load (the reference's 1900-01-01 default).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locastar.functions import domain
from locastar.functions.text import truncate
from locastar.operators.lookups import lookup_agg, lookup_first
from locastar.sources.fleets import FLEETS

F1, F2, F3, F4 = FLEETS
FULL_LOAD_CUT = dt.date(1900, 1, 1)


def _lit_fleet(f: str) -> Column:
    return F.lit(f).alias("nk_frota_origem")


def _left_by(left: DataFrame, right: DataFrame, key: str, right_key: str, own: str) -> DataFrame:
    """Left join on ``key``; rows without one are dealt by their ``own`` id, not all to one task."""
    dealt = left.withColumn("_by", F.coalesce(F.col(key), F.col(own)))
    return dealt.join(right, (F.col(key) == F.col(right_key)) & (F.col("_by") == F.col(right_key)), "left").drop("_by", right_key)


def _year(c: Column) -> Column:
    """CAST(text AS UNSIGNED): leading digits of the trimmed text, NULL without any."""
    return F.nullif(F.regexp_extract(F.trim(c.cast("string")), r"^[0-9]+", 0), F.lit("")).cast("int")


# ------------------------------------------------------------------ F1
def f1_patio(t, cut=None):
    p, e = t["Patio"], t["Endereco"]
    j = p.join(e, "Id_endereco")   # inner: yards without an address are not extracted
    j = lookup_agg(j, t["Vaga"], ["Id_patio"], ["Id_patio"], {"capacidade_vagas": F.count(F.lit(1))},
                   {"capacidade_vagas": 0})
    return j.select(_lit_fleet(F1), F.col("Id_patio").alias("nk_id_patio"), F.col("Nome_patio").alias("nome_patio"),
                    F.col("capacidade_vagas").cast("int"), F.col("Cidade").alias("end_cidade"),
                    F.col("UF").alias("end_uf"), F.col("Rua_Avenida").alias("end_logradouro"))


def f1_grupo(t, cut=None):
    return t["Grupo"].select(_lit_fleet(F1), F.col("Id_grupo").alias("nk_id_grupo"), F.col("Nome").alias("nome_grupo"),
                             F.col("Descricao").alias("descricao_grupo"), F.col("Diaria_grupo").alias("valor_diaria"))


def f1_veiculo(t, cut=None):
    v = t["Veiculo"].join(t["Especificacoes_const"], "Id_spec_const")
    slots = t["Vaga"].where(F.col("Id_veiculo").isNotNull())
    v = lookup_first(v, slots, ["Id_veiculo"], ["Id_veiculo"], [("Id_vaga", False)], ["Id_patio"])
    return v.select(_lit_fleet(F1), F.col("Id_veiculo").alias("nk_id_veiculo"), F.col("Id_grupo").alias("nk_id_grupo"),
                    F.col("Id_patio").alias("nk_id_patio_origem"), F.col("Placa").alias("placa"),
                    F.col("Marca").alias("marca"), F.col("Modelo").alias("modelo"), F.col("Versao").alias("versao"),
                    domain.transmission_from_flag("Direcao_automatica").alias("mecanizacao"),
                    F.col("Ar_condicionado").cast("boolean").alias("tem_ar_condicionado"),
                    _year(F.col("Ano")).alias("ano_fabricacao"), F.lit("ATIVO").alias("situacao"))


def f1_cliente(t, cut=None):
    c = t["Cliente"].join(t["Endereco"], "Id_endereco").join(t["Documento_cliente"], "Id_documento")
    return c.select(_lit_fleet(F1), F.col("Id_cliente").alias("nk_id_cliente"), F.lit("PF").alias("tipo_cliente"),
                    F.col("Nome_completo").alias("nome"), F.col("Email").alias("email"), F.col("UF").alias("end_uf"),
                    F.col("Cidade").alias("end_cidade"), F.col("CPF").alias("cpf"))


def f1_reserva(t, cut=None):
    r = t["Reserva"]
    start, end = F.to_date("Data_inicio_combinada"), F.to_date("Data_fim_combinada")
    return r.select(_lit_fleet(F1), F.col("Id_reserva").alias("nk_id_reserva"), F.col("Id_cliente").alias("nk_id_cliente"),
                    F.col("Id_grupo").alias("nk_id_grupo"), F.col("Id_patio_origem").alias("nk_id_patio_retirada"),
                    F.col("Id_patio_fim").alias("nk_id_patio_fim"), F.col("Data_reserva").alias("data_reserva"),
                    start.alias("data_retirada_prevista"), end.alias("data_devolucao_prevista"),
                    F.datediff(end, start).alias("duracao_prevista_dias"),
                    F.col("Preco_final").alias("valor_previsto_reserva"),
                    domain.map_domain(F.col("Estado_reserva"), domain.STATUS_SYNONYMS_F1, "ATIVA").alias("status_reserva"))


def f1_locacao(t, cut=None):
    """Customer and class through the reservation; return date of the latest
    return, return yard via return -> slot -> yard (J12, latest return whose
    slot is known); planned return = agreed end +
    extension days of this rental and reservation (J5)."""
    l, r, g = t["Locacao"], t["Reserva"], t["Grupo"]
    j = (l.join(r.select("Id_reserva", "Id_cliente", "Id_grupo", "Data_fim_combinada", "Preco_final"), "Id_reserva")
         .join(g.select("Id_grupo", "Diaria_grupo"), "Id_grupo"))
    ret = t["Devolucao"].join(t["Vaga"].select("Id_vaga", "Id_patio").withColumnRenamed("Id_patio", "_yard"), "Id_vaga")
    j = lookup_first(j, ret, ["Id_locacao"], ["Id_locacao"], [("Data_devolucao", True), ("Id_vaga", False)], ["_yard"])
    j = lookup_first(j, t["Devolucao"], ["Id_locacao"], ["Id_locacao"], [("Data_devolucao", True)], ["Data_devolucao"])
    ext = t["Extensao_reserva"]
    j = lookup_agg(j, ext, ["Id_locacao", "Id_reserva"], ["Id_locacao", "Id_reserva"],
                   {"_ext": F.sum("Qtd_dias")}, {"_ext": 0})
    return j.select(_lit_fleet(F1), F.col("Id_locacao").alias("nk_id_locacao"), F.col("Id_cliente").alias("nk_id_cliente"),
                    F.col("Id_veiculo").alias("nk_id_veiculo"), F.col("Id_grupo").alias("nk_id_grupo"),
                    F.col("Id_patio").alias("nk_id_patio_retirada"), F.col("_yard").alias("nk_id_patio_devolucao"),
                    F.to_date("Data_locacao").alias("data_retirada"),
                    F.date_add(F.to_date("Data_fim_combinada"), F.col("_ext").cast("int")).alias("data_prev_devolucao"),
                    F.to_date("Data_devolucao").alias("data_real_devolucao"),
                    F.col("Diaria_grupo").alias("valor_diaria_aplicada"), F.col("Preco_final").alias("valor_final"))


# ------------------------------------------------------------------ F2
def f2_patio(t, cut=None):
    return t["patio"].select(_lit_fleet(F2), F.col("id_patio").alias("nk_id_patio"), F.col("nome").alias("nome_patio"),
                             F.col("capacidade_vagas"), F.lit(None).cast("string").alias("end_cidade"),
                             F.lit(None).cast("string").alias("end_uf"), truncate("endereco", 150).alias("end_logradouro"))


def f2_grupo(t, cut=None):
    return t["grupo"].select(_lit_fleet(F2), F.col("id_grupo").alias("nk_id_grupo"), F.col("nome").alias("nome_grupo"),
                             F.col("codigo"), F.coalesce(F.col("valor_diaria"), F.lit(0)).cast("decimal(12,2)").alias("valor_diaria"))


def f2_veiculo(t, cut=None):
    m = F.when(F.upper(F.trim("mecanizacao")) == "AUTOMATICA", F.lit("AUTOMATICO")).otherwise(F.col("mecanizacao"))
    return t["veiculo"].select(_lit_fleet(F2), F.col("id_veiculo").alias("nk_id_veiculo"),
                               F.col("grupo_id").alias("nk_id_grupo"), F.col("patio_origem_id").alias("nk_id_patio_origem"),
                               "placa", "marca", "modelo", m.alias("mecanizacao"),
                               F.col("tem_ar_condicionado").cast("boolean"), "ano_fabricacao", "situacao")


def f2_cliente(t, cut=None):
    """Parent LEFT JOIN PF and PJ subclasses (J9); incremental on registration date."""
    c = t["cliente"].where(F.to_date("data_cadastro") >= F.lit(cut or FULL_LOAD_CUT))
    j = (c.join(t["cliente_pf"], c.id_cliente == F.col("cliente_id"), "left").drop("cliente_id")
         .join(t["cliente_pj"], c.id_cliente == F.col("cliente_id"), "left").drop("cliente_id"))
    return j.select(_lit_fleet(F2), F.col("id_cliente").alias("nk_id_cliente"), F.col("tipo_pessoa").alias("tipo_cliente"),
                    "nome", "email", F.col("cidade_origem").alias("end_cidade"), "cpf", "cnpj", "nome_fantasia")


def f2_reserva(t, cut=None):
    """Incremental on reservation date; planned value = days x class rate."""
    r = t["reserva"].where(F.to_date("data_reserva") >= F.lit(cut or FULL_LOAD_CUT))
    j = r.join(t["grupo"].select(F.col("id_grupo").alias("grupo_id"), "valor_diaria"), "grupo_id", "left")
    start, end = F.to_date("data_retirada_prevista"), F.to_date("data_devolucao_prevista")
    days = F.datediff(end, start)
    return j.select(_lit_fleet(F2), F.col("id_reserva").alias("nk_id_reserva"), F.col("cliente_id").alias("nk_id_cliente"),
                    F.col("grupo_id").alias("nk_id_grupo"), F.col("patio_retirada_id").alias("nk_id_patio_retirada"),
                    F.col("patio_devolucao_id").alias("nk_id_patio_fim"), F.to_date("data_reserva").alias("data_reserva"),
                    start.alias("data_retirada_prevista"), end.alias("data_devolucao_prevista"),
                    days.alias("duracao_prevista_dias"),
                    (days.cast("decimal(10,0)") * F.coalesce(F.col("valor_diaria"), F.lit(0))).cast("decimal(12,2)")
                    .alias("valor_previsto_reserva"),
                    domain.map_domain(F.col("estado"), domain.STATUS_SYNONYMS_F2, "ATIVA").alias("status_reserva"))


def f2_locacao(t, cut=None):
    """Class via the vehicle; return yard only once returned; planned return =
    first non-NULL of (reservation's planned return, real return, pick-up);
    final value = sum of PAID/PENDING charges (J5); change cut on either date."""
    cut = F.lit(cut or FULL_LOAD_CUT).cast("timestamp_ntz")
    l = t["locacao"].where((F.col("data_retirada_real") >= cut) | (F.col("data_devolucao_real") >= cut))
    j = l.join(t["veiculo"].select(F.col("id_veiculo").alias("veiculo_id"), "grupo_id"), "veiculo_id")
    j = _left_by(j, t["reserva"].select("id_reserva", "data_devolucao_prevista"), "reserva_id", "id_reserva", "id_locacao")
    paid = t["cobranca"].where(F.col("status").isin("PAGA", "PENDENTE"))
    j = lookup_agg(j, paid, ["id_locacao"], ["locacao_id"], {"_total": F.sum("valor_total")}, {"_total": 0})
    returned = F.col("data_devolucao_real").isNotNull()
    return j.select(_lit_fleet(F2), F.col("id_locacao").alias("nk_id_locacao"), F.col("cliente_id").alias("nk_id_cliente"),
                    F.col("veiculo_id").alias("nk_id_veiculo"), F.col("grupo_id").alias("nk_id_grupo"),
                    F.col("patio_retirada_id").alias("nk_id_patio_retirada"),
                    F.when(returned, F.col("patio_devolucao_id")).alias("nk_id_patio_devolucao"),
                    F.to_date("data_retirada_real").alias("data_retirada"),
                    F.to_date(F.coalesce("data_devolucao_prevista", "data_devolucao_real", "data_retirada_real"))
                    .alias("data_prev_devolucao"),
                    F.to_date("data_devolucao_real").alias("data_real_devolucao"), "valor_diaria_aplicada",
                    F.col("_total").cast("decimal(14,2)").alias("valor_final"))


# ------------------------------------------------------------------ F3
def f3_patio(t, cut=None):
    j = t["Patio"].join(t["Endereco"], "Id_endereco", "left")
    return j.select(_lit_fleet(F3), F.col("Id_patio").alias("nk_id_patio"), F.col("Nome_patio").alias("nome_patio"),
                    F.col("Capacidade").alias("capacidade_vagas"), F.col("Cidade").alias("end_cidade"),
                    F.col("Uf").alias("end_uf"), F.col("Logradouro").alias("end_logradouro"))


def f3_grupo(t, cut=None):
    return t["Categoria"].select(_lit_fleet(F3), F.col("Id_categoria").alias("nk_id_grupo"),
                                 F.col("Nome_categoria").alias("nome_grupo"),
                                 F.coalesce(F.col("Valor_diaria_base"), F.lit(0)).cast("decimal(12,2)").alias("valor_diaria"))


F3_TRANSMISSION = {"MANUAL": "MANUAL", "AUTOMATICO": "AUTOMATICO", "AUTOMATICA": "AUTOMATICO"}


def f3_veiculo(t, cut=None):
    j = t["Veiculo"].join(t["Vaga"].select("Id_vaga", "Id_patio"), "Id_vaga", "left")
    return j.select(_lit_fleet(F3), F.col("Id_veiculo").alias("nk_id_veiculo"), F.col("Id_categoria").alias("nk_id_grupo"),
                    F.col("Id_patio").alias("nk_id_patio_origem"), F.col("Placa").alias("placa"),
                    F.col("Marca").alias("marca"), F.col("Modelo").alias("modelo"),
                    domain.map_domain(F.col("Tipo_cambio"), F3_TRANSMISSION, None, passthrough=True,
                                      trim_passthrough=False).alias("mecanizacao"),
                    F.coalesce(F.col("Possui_ar_condicionado"), F.lit(0)).cast("boolean").alias("tem_ar_condicionado"),
                    F.col("Ano").alias("ano_fabricacao"), F.col("Status_veiculo").alias("situacao"))


def f3_cliente(t, cut=None):
    c = t["Cliente"]
    j = (c.join(t["Cliente_pf"], "Id_cliente", "left").join(t["Cliente_pj"], "Id_cliente", "left")
         .join(t["Endereco"], "Id_endereco", "left"))
    kind = F.upper(F.trim("Tipo_cliente"))
    name = (F.when(kind == "PF", F.col("Nome_cliente")).when(kind == "PJ", F.col("Razao_social"))
            .otherwise(F.coalesce("Nome_cliente", "Razao_social", F.lit("NÃO INFORMADO"))))
    return j.select(_lit_fleet(F3), F.col("Id_cliente").alias("nk_id_cliente"), F.col("Tipo_cliente").alias("tipo_cliente"),
                    name.alias("nome"), F.col("Email_cliente").alias("email"), F.col("Uf").alias("end_uf"),
                    F.col("Cidade").alias("end_cidade"), F.col("Cpf_cliente").alias("cpf"),
                    F.col("Cnpj_cliente").alias("cnpj"), "Nome_fantasia")


def f3_reserva(t, cut=None):
    r = t["Reserva"]
    start, end = F.to_date("Data_previsao_retirada"), F.to_date("Data_previsao_devolucao")
    return r.select(_lit_fleet(F3), F.col("Id_reserva").alias("nk_id_reserva"), F.col("Id_cliente").alias("nk_id_cliente"),
                    F.col("Id_categoria").alias("nk_id_grupo"),
                    F.col("Id_patio_previsto_retirada").alias("nk_id_patio_retirada"),
                    F.col("Id_patio_previsto_devolucao").alias("nk_id_patio_fim"),
                    F.to_date("Data_hora_reserva").alias("data_reserva"), start.alias("data_retirada_prevista"),
                    end.alias("data_devolucao_prevista"), F.datediff(end, start).alias("duracao_prevista_dias"),
                    F.coalesce(F.col("Valor_previsto"), F.lit(0)).cast("decimal(12,2)").alias("valor_previsto_reserva"),
                    domain.map_domain(F.col("Status_reserva"), domain.STATUS_SYNONYMS_F3, "ATIVA", passthrough=True)
                    .alias("status_reserva"))


def f3_locacao(t, cut=None):
    """Customer via the reservation, class via the vehicle's category."""
    j = (t["Locacao"].join(t["Reserva"].select("Id_reserva", "Id_cliente", "Data_previsao_devolucao"), "Id_reserva", "left")
         .join(t["Veiculo"].select("Id_veiculo", "Id_categoria"), "Id_veiculo", "left")
         .join(t["Categoria"].select("Id_categoria", "Valor_diaria_base"), "Id_categoria", "left"))
    return j.select(_lit_fleet(F3), F.col("Id_locacao").alias("nk_id_locacao"), F.col("Id_cliente").alias("nk_id_cliente"),
                    F.col("Id_veiculo").alias("nk_id_veiculo"), F.col("Id_categoria").alias("nk_id_grupo"),
                    F.col("Id_patio_real_retirada").alias("nk_id_patio_retirada"),
                    F.col("Id_patio_real_devolucao").alias("nk_id_patio_devolucao"),
                    F.to_date("Data_hora_retirada_real").alias("data_retirada"),
                    F.to_date("Data_previsao_devolucao").alias("data_prev_devolucao"),
                    F.to_date("Data_hora_devolucao_real").alias("data_real_devolucao"),
                    F.col("Valor_diaria_base").alias("valor_diaria_aplicada"),
                    F.col("Valor_total_final").alias("valor_final"))


# ------------------------------------------------------------------ F4 (plain copies)
def f4_patio(t, cut=None):
    return t["PATIO"].select(_lit_fleet(F4), F.col("id_patio").alias("nk_id_patio"), "nome_patio",
                             F.lit(None).cast("int").alias("capacidade_vagas"), F.lit(None).cast("string").alias("end_cidade"),
                             F.lit(None).cast("string").alias("end_uf"), "localizacao", "codigo_patio")


def f4_grupo(t, cut=None):
    return t["GRUPO_VEICULO"].select(_lit_fleet(F4), F.col("id_grupo").alias("nk_id_grupo"), "nome_grupo",
                                     F.col("faixa_valor_diaria").alias("valor_diaria"))


def f4_veiculo(t, cut=None):
    return t["VEICULO"].select(_lit_fleet(F4), F.col("id_veiculo").alias("nk_id_veiculo"), F.col("id_grupo").alias("nk_id_grupo"),
                               F.col("id_patio_atual").alias("nk_id_patio_origem"), "placa", "marca", "modelo",
                               "mecanizacao", F.col("ar_condicionado").alias("tem_ar_condicionado"), "status")


def f4_cliente(t, cut=None):
    return t["CLIENTE"].select(_lit_fleet(F4), F.col("id_cliente").alias("nk_id_cliente"), "tipo_cliente",
                               F.col("nome_razao_social").alias("nome"), F.col("cidade").alias("end_cidade"),
                               F.col("estado").alias("end_uf"), "email")


def f4_reserva(t, cut=None):
    return t["RESERVA"].select(_lit_fleet(F4), F.col("id_reserva").alias("nk_id_reserva"), F.col("id_cliente").alias("nk_id_cliente"),
                               F.col("id_grupo").alias("nk_id_grupo"), F.col("id_patio_retirada").alias("nk_id_patio_retirada"),
                               F.col("id_patio_devolucao_previsto").alias("nk_id_patio_fim"), "data_reserva",
                               F.col("data_prev_retirada").alias("data_retirada_prevista"),
                               F.col("data_prev_devolucao").alias("data_devolucao_prevista"), "status_reserva")


def f4_locacao(t, cut=None):
    """Plain copy plus the class of the vehicle."""
    j = t["LOCACAO"].join(t["VEICULO"].select("id_veiculo", "id_grupo"), "id_veiculo", "left")
    return j.select(_lit_fleet(F4), F.col("id_locacao").alias("nk_id_locacao"), F.col("id_cliente").alias("nk_id_cliente"),
                    F.col("id_veiculo").alias("nk_id_veiculo"), F.col("id_grupo").alias("nk_id_grupo"),
                    F.col("id_patio_retirada").alias("nk_id_patio_retirada"),
                    F.col("id_patio_devolucao_real").alias("nk_id_patio_devolucao"),
                    F.to_date("data_hora_retirada").alias("data_retirada"),
                    F.to_date("data_hora_prev_devolucao").alias("data_prev_devolucao"),
                    F.to_date("data_hora_real_devolucao").alias("data_real_devolucao"), "valor_final")


MAPPINGS = {
    F1: {"patio": f1_patio, "grupo": f1_grupo, "veiculo": f1_veiculo, "cliente": f1_cliente,
         "reserva": f1_reserva, "locacao": f1_locacao},
    F2: {"patio": f2_patio, "grupo": f2_grupo, "veiculo": f2_veiculo, "cliente": f2_cliente,
         "reserva": f2_reserva, "locacao": f2_locacao},
    F3: {"patio": f3_patio, "grupo": f3_grupo, "veiculo": f3_veiculo, "cliente": f3_cliente,
         "reserva": f3_reserva, "locacao": f3_locacao},
    F4: {"patio": f4_patio, "grupo": f4_grupo, "veiculo": f4_veiculo, "cliente": f4_cliente,
         "reserva": f4_reserva, "locacao": f4_locacao},
}


def extract(tables: dict[str, DataFrame], fleet: str, entity: str, cut: dt.date | None = None) -> DataFrame:
    """X: the raw staging rows of ``entity`` for ``fleet`` from its source tables."""
    return MAPPINGS[fleet][entity](tables, cut)
