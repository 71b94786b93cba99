"""Source-shaped (OLTP) tables of the four fleets, derived from the test tables.

Each fleet's schema (FIXTURES.md §1) is the same set of roles under its own
table and column names: yards from ``supplier``, addresses from ``nation``,
vehicles and slots from ``part``, classes from ``p_type``, customers from
``customer``, reservations from ``orders``, rentals from ``lineitem`` (id =
order key * 8 + line number), returns from finished line items, extensions
and charges from the line items of an order. The extract mappings
(sources.extract) read these frames exactly as the reference reads its
source schemas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locastar.functions.dates import as_date
from locastar.sources.analogue import Analogue

# Year-of-manufacture texts (the bad one keeps its leading digits).
RAW_YEARS = ("2019", "2020", "2021a", " 2018")


def _pick(k, values):
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, (k % len(values) + 1).cast("int"))


def _common(a: Analogue):
    ny, nc = a.n_yards(), a.n_classes()
    p = a.t("part", "p_partkey", "p_brand", "p_name", "p_size", "p_type").join(
        a.classes().select("p_type", "nk_id_grupo"), "p_type").drop("p_type")
    li = a.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
             "l_returnflag", "l_linestatus", "l_shipdate")
    o = a.t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return ny, nc, p, li, o


def f1_tables(a: Analogue) -> dict[str, DataFrame]:
    ny, nc, p, li, o = _common(a)
    k, lk = F.col("o_orderkey"), F.col("l_orderkey")
    rid = lk * 8 + F.col("l_linenumber")
    ship = F.col("l_shipdate")
    return {
        "Endereco": a.t("nation", "n_nationkey", "n_name").select(
            F.col("n_nationkey").alias("Id_endereco"), F.col("n_name").alias("Cidade"), F.lit("SP").alias("UF"),
            F.concat(F.lit("Rua "), F.col("n_name")).alias("Rua_Avenida")),
        "Patio": a.t("supplier", "s_suppkey", "s_name", "s_nationkey").select(
            F.col("s_suppkey").alias("Id_patio"), F.col("s_name").alias("Nome_patio"),
            F.col("s_nationkey").alias("Id_endereco")),
        "Vaga": a.slots().select(F.col("id_vaga").alias("Id_vaga"), F.col("id_patio").alias("Id_patio"),
                                 F.col("id_veiculo").alias("Id_veiculo")),
        "Grupo": a.classes().select(F.col("nk_id_grupo").alias("Id_grupo"), F.col("p_type").alias("Nome"),
                                    F.lit(None).cast("string").alias("Descricao"),
                                    F.col("valor_diaria").alias("Diaria_grupo")),
        "Especificacoes_const": a.t("part", "p_size").distinct().select(
            F.col("p_size").alias("Id_spec_const"), (F.col("p_size") % 2).alias("Direcao_automatica"),
            (F.col("p_size") % 3 == 0).alias("Ar_condicionado")),
        "Veiculo": p.select(
            F.col("p_partkey").alias("Id_veiculo"), F.col("nk_id_grupo").alias("Id_grupo"),
            F.col("p_size").alias("Id_spec_const"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("Placa"),
            F.col("p_brand").alias("Marca"), F.col("p_name").alias("Modelo"), F.lit(None).cast("string").alias("Versao"),
            _pick(F.col("p_partkey"), RAW_YEARS).alias("Ano")),
        "Documento_cliente": a.t("customer", "c_custkey").select(
            F.col("c_custkey").alias("Id_documento"), F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("CPF")),
        "Cliente": a.t("customer", "c_custkey", "c_name", "c_nationkey").select(
            F.col("c_custkey").alias("Id_cliente"), F.col("c_name").alias("Nome_completo"),
            F.concat(F.lower(F.col("c_name")), F.lit("@mail")).alias("Email"),
            F.col("c_nationkey").alias("Id_endereco"), F.col("c_custkey").alias("Id_documento")),
        "Reserva": o.select(
            k.alias("Id_reserva"), F.col("o_custkey").alias("Id_cliente"), (k % nc + 1).alias("Id_grupo"),
            (k % ny).alias("Id_patio_origem"), (F.col("o_custkey") % ny).alias("Id_patio_fim"),
            as_date("o_orderdate").alias("Data_reserva"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(k % 30).cast("int"))).alias("Data_inicio_combinada"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(k % 30 + k % 12).cast("int"))).alias("Data_fim_combinada"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("Preco_final"), (k % 3).cast("int").alias("Estado_reserva")),
        "Locacao": li.select(rid.alias("Id_locacao"), lk.alias("Id_reserva"), F.col("l_partkey").alias("Id_veiculo"),
                             F.col("l_suppkey").alias("Id_patio"), ship.alias("Data_locacao")),
        "Devolucao": li.where(F.col("l_linestatus") == "F").select(
            rid.alias("Id_locacao"), F.col("l_partkey").alias("Id_vaga"),
            (ship + F.make_dt_interval(days=(lk % 10).cast("int"))).alias("Data_devolucao")),
        "Extensao_reserva": li.where(F.col("l_linenumber") >= 6).select(
            (lk * 8 + 1).alias("Id_locacao"), lk.alias("Id_reserva"), F.col("l_linenumber").alias("Qtd_dias")),
    }


def f2_tables(a: Analogue) -> dict[str, DataFrame]:
    ny, nc, p, li, o = _common(a)
    li = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    k, lk = F.col("o_orderkey"), F.col("l_orderkey")
    done = F.col("l_linestatus") == "F"
    cls = a.classes()
    return {
        "patio": a.t("supplier", "s_suppkey", "s_name").join(a.slot_counts(), F.col("s_suppkey") == F.col("nk_id_patio"), "left")
        .select(F.col("s_suppkey").alias("id_patio"), F.col("s_name").alias("nome"),
                F.col("n_slots").cast("int").alias("capacidade_vagas"),
                F.concat_ws(" ", *[F.col("s_name")] * 12).alias("endereco")),
        "grupo": cls.select(F.col("nk_id_grupo").alias("id_grupo"), F.col("p_type").alias("nome"),
                            F.concat(F.lit("G"), F.col("nk_id_grupo").cast("string")).alias("codigo"),
                            F.lit(None).cast("string").alias("classe_luxo"),
                            F.when(F.col("nk_id_grupo") % 4 != 0, F.col("valor_diaria")).alias("valor_diaria")),
        "veiculo": p.select(
            F.col("p_partkey").alias("id_veiculo"), F.col("nk_id_grupo").alias("grupo_id"),
            (F.col("p_partkey") % ny).alias("patio_origem_id"), F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("placa"),
            F.col("p_brand").alias("marca"), F.col("p_name").alias("modelo"),
            F.when(F.col("p_size") % 2 == 0, F.lit("MANUAL")).otherwise(F.lit("AUTOMATICA")).alias("mecanizacao"),
            (F.col("p_size") % 3 == 0).cast("int").alias("tem_ar_condicionado"), F.lit(2020).alias("ano_fabricacao"),
            F.when(F.col("p_size") % 10 == 0, F.lit("BAIXADO")).otherwise(F.lit("ATIVO")).alias("situacao")),
        "cliente": a.t("customer", "c_custkey", "c_name", "c_nationkey").select(
            F.col("c_custkey").alias("id_cliente"),
            F.when(F.col("c_custkey") % 3 == 0, F.lit("PJ")).otherwise(F.lit("PF")).alias("tipo_pessoa"),
            F.col("c_name").alias("nome"), F.concat(F.lower(F.col("c_name")), F.lit("@mail")).alias("email"),
            F.col("c_nationkey").cast("string").alias("cidade_origem"),
            F.date_add(F.lit("1995-01-01").cast("date"), (F.col("c_custkey") % 2000).cast("int")).alias("data_cadastro")),
        "cliente_pf": a.t("customer", "c_custkey").where(F.col("c_custkey") % 3 != 0).select(
            F.col("c_custkey").alias("cliente_id"), F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("cpf")),
        "cliente_pj": a.t("customer", "c_custkey", "c_name").where(F.col("c_custkey") % 3 == 0).select(
            F.col("c_custkey").alias("cliente_id"), F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("cnpj"),
            F.concat(F.lit("NF "), F.col("c_name")).alias("nome_fantasia")),
        "reserva": o.select(
            k.alias("id_reserva"), F.col("o_custkey").alias("cliente_id"), (k % nc + 1).alias("grupo_id"),
            (k % ny).alias("patio_retirada_id"), (F.col("o_custkey") % ny).alias("patio_devolucao_id"),
            F.col("o_orderdate").alias("data_reserva"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(k % 30).cast("int"))).alias("data_retirada_prevista"),
            F.when(k % 5 != 0, F.col("o_orderdate") + F.make_dt_interval(days=(k % 30 + k % 12).cast("int")))
            .alias("data_devolucao_prevista"),
            _pick(k, ("CONFIRMADA", "EM_FILA_ESPERA", "CANCELADA", "CONCRETIZADA", None)).alias("estado")),
        "locacao": li.select(
            (lk * 8 + F.col("l_linenumber")).alias("id_locacao"), F.col("o_custkey").alias("cliente_id"),
            F.col("l_partkey").alias("veiculo_id"), F.when(F.col("l_linenumber") != 7, lk).alias("reserva_id"),
            F.col("l_suppkey").alias("patio_retirada_id"),
            ((F.col("l_suppkey") + F.col("l_linenumber")) % ny).alias("patio_devolucao_id"),
            F.col("l_shipdate").alias("data_retirada_real"),
            F.when(done, F.col("l_shipdate") + F.make_dt_interval(days=(lk % 10).cast("int"))).alias("data_devolucao_real"),
            F.lit(None).cast("decimal(12,2)").alias("valor_diaria_aplicada"),
            F.when(done, F.lit("CONCLUIDA")).otherwise(F.lit("EM_ANDAMENTO")).alias("status")),
        "cobranca": li.select((lk * 8 + 1).alias("locacao_id"),
                              F.col("l_extendedprice").cast("decimal(12,2)").alias("valor_total"),
                              F.when(F.col("l_returnflag") == "A", F.lit("PAGA"))
                              .when(F.col("l_returnflag") == "N", F.lit("PENDENTE"))
                              .otherwise(F.lit("CANCELADA")).alias("status")),
    }


def f3_tables(a: Analogue) -> dict[str, DataFrame]:
    ny, nc, p, li, o = _common(a)
    k, lk = F.col("o_orderkey"), F.col("l_orderkey")
    from locastar.plans.operator_queries import RAW_STATUS_16, RAW_TRANSMISSION_7
    return {
        "Endereco": a.t("nation", "n_nationkey", "n_name").select(
            F.col("n_nationkey").alias("Id_endereco"), F.col("n_name").alias("Cidade"), F.lit("RJ").alias("Uf"),
            F.lit("Av").alias("Logradouro")),
        "Patio": a.t("supplier", "s_suppkey", "s_name", "s_nationkey").select(
            F.col("s_suppkey").alias("Id_patio"), F.col("s_name").alias("Nome_patio"),
            F.when(F.col("s_suppkey") % 5 != 0, F.lit(50)).alias("Capacidade"),
            F.when(F.col("s_suppkey") % 9 != 0, F.col("s_nationkey")).alias("Id_endereco")),
        "Categoria": a.classes().select(F.col("nk_id_grupo").alias("Id_categoria"), F.col("p_type").alias("Nome_categoria"),
                                        F.when(F.col("nk_id_grupo") % 3 != 0, F.col("valor_diaria")).alias("Valor_diaria_base")),
        "Vaga": a.slots().select(F.col("id_vaga").alias("Id_vaga"), F.col("id_patio").alias("Id_patio")),
        "Veiculo": p.select(
            F.col("p_partkey").alias("Id_veiculo"), F.col("nk_id_grupo").alias("Id_categoria"),
            F.when(F.col("p_partkey") % 4 != 0, F.col("p_partkey")).alias("Id_vaga"),
            F.col("p_partkey").cast("string").alias("Placa"), F.col("p_brand").alias("Marca"), F.col("p_name").alias("Modelo"),
            _pick(F.col("p_size"), RAW_TRANSMISSION_7).alias("Tipo_cambio"), F.lit("OK").alias("Status_veiculo"),
            F.when(F.col("p_size") % 3 != 0, (F.col("p_size") % 2).cast("int")).alias("Possui_ar_condicionado"),
            F.lit(2021).alias("Ano")),
        "Cliente": a.t("customer", "c_custkey", "c_nationkey").select(
            F.col("c_custkey").alias("Id_cliente"), F.col("c_nationkey").alias("Id_endereco"),
            _pick(F.col("c_custkey"), ("PF", "pj", " pf", "XX")).alias("Tipo_cliente"),
            F.lit(None).cast("string").alias("Email_cliente")),
        "Cliente_pf": a.t("customer", "c_custkey", "c_name").where(F.col("c_custkey") % 2 == 0).select(
            F.col("c_custkey").alias("Id_cliente"), F.col("c_name").alias("Nome_cliente"),
            F.col("c_custkey").cast("string").alias("Cpf_cliente")),
        "Cliente_pj": a.t("customer", "c_custkey", "c_name").where(F.col("c_custkey") % 2 == 1).select(
            F.col("c_custkey").alias("Id_cliente"), F.concat(F.lit("RS "), F.col("c_name")).alias("Razao_social"),
            F.col("c_custkey").cast("string").alias("Cnpj_cliente"), F.lit(None).cast("string").alias("Nome_fantasia")),
        "Reserva": o.select(
            k.alias("Id_reserva"), F.col("o_custkey").alias("Id_cliente"), (k % nc + 1).alias("Id_categoria"),
            (k % ny).alias("Id_patio_previsto_retirada"), (F.col("o_custkey") % ny).alias("Id_patio_previsto_devolucao"),
            F.col("o_orderdate").alias("Data_hora_reserva"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(k % 30).cast("int"))).alias("Data_previsao_retirada"),
            (F.col("o_orderdate") + F.make_dt_interval(days=(k % 30 + k % 12).cast("int"))).alias("Data_previsao_devolucao"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("Valor_previsto"),
            _pick(k, RAW_STATUS_16).alias("Status_reserva")),
        "Locacao": li.select(
            (lk * 8 + F.col("l_linenumber")).alias("Id_locacao"), lk.alias("Id_reserva"),
            F.col("l_partkey").alias("Id_veiculo"), F.col("l_suppkey").alias("Id_patio_real_retirada"),
            F.when(F.col("l_linestatus") == "F", (F.col("l_suppkey") + 1) % ny).alias("Id_patio_real_devolucao"),
            F.col("l_shipdate").alias("Data_hora_retirada_real"),
            F.when(F.col("l_linestatus") == "F", F.col("l_shipdate") + F.make_dt_interval(days=(lk % 10).cast("int")))
            .alias("Data_hora_devolucao_real"),
            F.col("l_extendedprice").cast("decimal(14,2)").alias("Valor_total_final")),
    }


def f4_tables(a: Analogue) -> dict[str, DataFrame]:
    ny, nc, p, li, o = _common(a)
    li = li.join(o.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    k, lk = F.col("o_orderkey"), F.col("l_orderkey")
    done = F.col("l_linestatus") == "F"
    return {
        "CLIENTE": a.t("customer", "c_custkey", "c_name", "c_nationkey").select(
            F.col("c_custkey").alias("id_cliente"), _pick(F.col("c_custkey"), ("PF", "PJ", None)).alias("tipo_cliente"),
            F.col("c_name").alias("nome_razao_social"), F.col("c_custkey").cast("string").alias("cpf_cnpj"),
            F.col("c_nationkey").cast("string").alias("cidade"), F.lit("MG").alias("estado"),
            F.lit(None).cast("string").alias("telefone"), F.lit(None).cast("string").alias("email")),
        "VEICULO": p.select(
            F.col("p_partkey").alias("id_veiculo"), F.when(F.col("p_partkey") % 11 != 0, F.lit(" ab1 ")).alias("placa"),
            F.lit(None).cast("string").alias("chassi"), F.col("p_brand").alias("marca"), F.col("p_name").alias("modelo"),
            F.lit(None).cast("string").alias("cor"), _pick(F.col("p_size"), ("Automática", "manual", "CVT")).alias("mecanizacao"),
            (F.col("p_size") % 2 == 0).alias("ar_condicionado"),
            _pick(F.col("p_partkey"), ("DISPONIVEL", "ALUGADO", "MANUTENCAO", "RESERVADO")).alias("status"),
            F.col("nk_id_grupo").alias("id_grupo"), F.lit(4).alias("id_empresa"),
            (F.col("p_partkey") % ny).alias("id_patio_atual")),
        "GRUPO_VEICULO": a.classes().select(F.col("nk_id_grupo").alias("id_grupo"), F.col("p_type").alias("nome_grupo"),
                                            F.lit(None).cast("string").alias("descricao"),
                                            F.col("valor_diaria").cast("decimal(10,2)").alias("faixa_valor_diaria")),
        "PATIO": a.t("supplier", "s_suppkey", "s_name").select(
            F.col("s_suppkey").alias("id_patio"), F.lit(4).alias("id_empresa"), F.col("s_name").alias("nome_patio"),
            F.lit(None).cast("string").alias("localizacao"), F.col("s_suppkey").cast("string").alias("codigo_patio")),
        "RESERVA": o.select(
            k.alias("id_reserva"), as_date("o_orderdate").alias("data_reserva"),
            F.date_add(as_date("o_orderdate"), (k % 30).cast("int")).alias("data_prev_retirada"),
            F.date_add(as_date("o_orderdate"), (k % 30 + k % 12).cast("int")).alias("data_prev_devolucao"),
            _pick(k, ("ativa", "CANCELADA", "Convertida", "outra")).alias("status_reserva"),
            F.col("o_custkey").alias("id_cliente"), (k % nc + 1).alias("id_grupo"), (k % ny).alias("id_patio_retirada"),
            (F.col("o_custkey") % ny).alias("id_patio_devolucao_previsto")),
        "LOCACAO": li.select(
            (lk * 8 + F.col("l_linenumber")).alias("id_locacao"), F.col("l_shipdate").alias("data_hora_retirada"),
            (F.col("l_shipdate") + F.make_dt_interval(days=F.col("l_linenumber"))).alias("data_hora_prev_devolucao"),
            F.when(done, F.col("l_shipdate") + F.make_dt_interval(days=(lk % 10).cast("int"))).alias("data_hora_real_devolucao"),
            F.lit(None).cast("decimal(10,2)").alias("valor_previsto"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("valor_final"),
            F.when(done, F.lit("FINALIZADA")).otherwise(F.lit("ABERTA")).alias("status_locacao"),
            lk.alias("id_reserva"), F.col("o_custkey").alias("id_cliente"), F.lit(None).cast("long").alias("id_condutor"),
            F.col("l_partkey").alias("id_veiculo"), F.col("l_suppkey").alias("id_patio_retirada"),
            F.col("l_suppkey").alias("id_patio_devolucao_previsto"),
            F.when(done, F.col("l_suppkey")).alias("id_patio_devolucao_real")),
    }


TABLES = {"frota-1": f1_tables, "frota-2": f2_tables, "frota-3": f3_tables, "frota-4": f4_tables}
