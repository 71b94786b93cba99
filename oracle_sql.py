"""DuckDB oracle SQL for every registered query (driver correctness gate).

Written independently of the Spark code: the warehouse is not rebuilt with
surrogate keys here; each query derives the same facts straight from the
input tables with the role mapping of SURVEY §7.3 and joins on natural keys.
Rounded averages/percentages use the same exact integer rounding
(half away from zero) as ``locastar.functions.money.round_ratio``.
"""

from __future__ import annotations

AS_OF = "DATE '2000-01-01'"


def rr(num: str, den: str, digits: int, scale: int = 1) -> str:
    """round(scale*num/den, digits), half away from zero, NULL when den = 0."""
    p = 10 ** digits
    return (f"(CASE WHEN ({den}) = 0 OR ({den}) IS NULL THEN NULL ELSE "
            f"sign({num}) * ((abs({num}) * {2 * p * scale} + ({den})) // (2 * ({den}))) / {p}.0 END)")


def cap(x: str) -> str:
    return f"(upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2)))"


BASE = f"""
fl(idx, fleet) AS (VALUES (0, 'frota-1'), (1, 'frota-2'), (2, 'frota-3'), (3, 'frota-4')),
ny AS (SELECT count(*) AS n FROM supplier),
cls AS (SELECT p_type, CAST(dense_rank() OVER (ORDER BY p_type) AS BIGINT) AS gid,
               CAST(max(p_retailprice) AS DECIMAL(12,2)) AS rate, {cap('p_type')} AS gname
        FROM part GROUP BY p_type),
nc AS (SELECT count(*) AS n FROM cls),
pc AS (SELECT p.p_partkey, c.gid, c.gname, c.rate FROM part p JOIN cls c USING (p_type)),
rent AS (
  SELECT fl.fleet AS empresa, fl.idx, l.l_orderkey AS k, l.l_linenumber AS ln,
         l.l_orderkey * 8 + l.l_linenumber AS rid, o.o_custkey AS cust,
         l.l_partkey AS veh, pc.gid, pc.gname, pc.rate, l.l_suppkey AS y_out,
         CASE WHEN l.l_linestatus = 'F' THEN (l.l_suppkey + l.l_linenumber) % (SELECT n FROM ny) END AS y_in,
         CAST(l.l_shipdate AS DATE) AS d_ret,
         CAST(l.l_shipdate AS DATE) + CAST(l.l_linenumber AS INTEGER) AS d_prev,
         CASE WHEN l.l_linestatus = 'F'
              THEN CAST(l.l_shipdate AS DATE) + CAST(l.l_orderkey % 10 AS INTEGER) END AS d_real,
         greatest(CAST(l.l_extendedprice AS DECIMAL(14,2)), 0) AS valor
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN pc ON pc.p_partkey = l.l_partkey JOIN fl ON fl.idx = l.l_orderkey % 4),
resv AS (
  SELECT fl.fleet AS empresa, fl.idx, o.o_orderkey AS rid, o.o_custkey AS cust,
         1 + o.o_orderkey % (SELECT n FROM nc) AS gid, o.o_orderkey % (SELECT n FROM ny) AS y_out,
         o.o_custkey % (SELECT n FROM ny) AS y_end,
         CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 AS INTEGER)
           + CAST(o.o_orderkey % 12 AS INTEGER) AS d_dev,
         CAST(o.o_orderdate AS DATE) AS d_res,
         CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 AS INTEGER) AS d_ret,
         CAST(o.o_orderkey % 12 AS BIGINT) AS dur,
         CAST(o.o_totalprice AS DECIMAL(12,2)) AS valor,
         CASE o.o_orderstatus WHEN 'F' THEN 'CONVERTIDA' WHEN 'O' THEN 'ATIVA'
              WHEN 'P' THEN 'CANCELADA' ELSE 'ATIVA' END AS status
  FROM orders o JOIN fl ON fl.idx = o.o_orderkey % 4
  WHERE o.o_orderkey % 12 >= 1),
rentf AS (
  -- the fact: a repeated key once, by its latest dates, then by the largest of the other columns
  SELECT * FROM rent QUALIFY row_number() OVER (PARTITION BY empresa, rid ORDER BY d_ret DESC, d_prev DESC,
    d_real DESC NULLS LAST, cust DESC, veh DESC, gid DESC, y_out DESC, y_in DESC NULLS LAST, valor DESC) = 1),
cust AS (SELECT c.c_custkey, trim(n.n_name) AS city FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""


def with_base(body: str) -> str:
    return "WITH " + BASE + body


MARTS = {
    "q1_1_yard_inventory": f"""
SELECT pc.gname AS nome_grupo,
       CASE WHEN p.p_partkey % 3 = (p.p_partkey % (SELECT n FROM ny)) % 4
            THEN 'FROTA PRÓPRIA' ELSE 'FROTA ASSOCIADA' END AS origem_frota,
       {cap('p.p_brand')} AS marca, {cap('p.p_name')} AS modelo,
       CASE p.p_size % 5 WHEN 0 THEN 'MANUAL' WHEN 1 THEN 'AUTOMATICO' WHEN 2 THEN 'AUTOMATICO'
            WHEN 3 THEN 'AUTOMATICO' ELSE 'NÃO INFORMADO' END AS mecanizacao,
       CAST(count(*) AS BIGINT) AS total_veiculos
FROM part p JOIN pc USING (p_partkey)
WHERE p.p_partkey % 3 <> 0
GROUP BY ALL""",
    "q1_2_open_rentals": f"""
SELECT gname AS nome_grupo,
       CAST(date_diff('day', d_ret, {AS_OF}) AS BIGINT) AS dias_transcorridos,
       CAST(date_diff('day', {AS_OF}, d_prev) AS BIGINT) AS dias_restantes_previstos,
       CAST(count(*) AS BIGINT) AS veiculos_alugados
FROM rentf WHERE d_real IS NULL GROUP BY ALL""",
    "q1_3_reservation_horizon": f"""
SELECT c.gname AS nome_grupo, {cap('s.s_name')} AS patio_retirada,
       CASE WHEN date_diff('day', {AS_OF}, r.d_ret) <= 7 THEN 'Próxima Semana'
            WHEN date_diff('day', {AS_OF}, r.d_ret) <= 30 THEN 'Próximo Mês'
            ELSE 'Longo Prazo' END AS horizonte_retirada,
       r.dur AS duracao_prevista_dias, cu.city AS cidade_origem_cliente,
       CAST(count(*) AS BIGINT) AS total_reservas
FROM resv r JOIN cls c ON c.gid = r.gid JOIN supplier s ON s.s_suppkey = r.y_out
JOIN cust cu ON cu.c_custkey = r.cust
WHERE r.status = 'ATIVA' AND r.d_ret >= {AS_OF}
GROUP BY ALL""",
    "q1_4_consumption": """
SELECT r.gname AS nome_grupo, cu.city AS cidade_origem_cliente, CAST(count(*) AS BIGINT) AS volume_locacoes
FROM rentf r JOIN cust cu ON cu.c_custkey = r.cust
WHERE r.d_real IS NOT NULL GROUP BY ALL""",
    "q2_1_transition_matrix": f"""
, m AS (SELECT {cap('so.s_name')} AS patio_origem, {cap('sd.s_name')} AS patio_destino, count(*) AS n
       FROM rentf r JOIN supplier so ON so.s_suppkey = r.y_out JOIN supplier sd ON sd.s_suppkey = r.y_in
       WHERE r.d_real IS NOT NULL GROUP BY ALL),
mt AS (SELECT *, sum(n) OVER (PARTITION BY patio_origem) AS t FROM m)
SELECT patio_origem, patio_destino, CAST(n AS BIGINT) AS total_movimentacoes,
       {rr('n', 't', 2, 100)} AS percentual_movimentacao
FROM mt""",
    "q2_1_transition_matrix_by_key": f"""
, m AS (SELECT r.empresa, r.y_out, {cap('so.s_name')} AS patio_origem, {cap('sd.s_name')} AS patio_destino,
              count(*) AS n
       FROM rentf r JOIN supplier so ON so.s_suppkey = r.y_out JOIN supplier sd ON sd.s_suppkey = r.y_in
       WHERE r.d_real IS NOT NULL GROUP BY r.empresa, r.y_out, r.y_in, so.s_name, sd.s_name),
mt AS (SELECT *, sum(n) OVER (PARTITION BY empresa, y_out) AS t FROM m)
SELECT empresa, patio_origem, patio_destino, CAST(n AS BIGINT) AS total_movimentacoes,
       {rr('n', 't', 2, 100)} AS percentual_movimentacao
FROM mt""",
    "q2_2_yard_balance": f"""
, fy AS (SELECT fl.fleet AS empresa, s.s_suppkey, {cap('s.s_name')} AS nome_patio FROM supplier s CROSS JOIN fl),
ent AS (SELECT empresa, y_in AS y, count(*) AS n FROM rentf WHERE y_in IS NOT NULL GROUP BY ALL),
sai AS (SELECT empresa, y_out AS y, count(*) AS n FROM rentf WHERE y_in IS NOT NULL GROUP BY ALL),
b AS (SELECT fy.nome_patio, fy.empresa, CAST(coalesce(e.n, 0) AS BIGINT) AS total_entradas,
             CAST(coalesce(s.n, 0) AS BIGINT) AS total_saidas
      FROM fy LEFT JOIN ent e ON e.empresa = fy.empresa AND e.y = fy.s_suppkey
              LEFT JOIN sai s ON s.empresa = fy.empresa AND s.y = fy.s_suppkey)
SELECT nome_patio, empresa, total_entradas, total_saidas, total_entradas - total_saidas AS saldo_liquido,
       CASE WHEN total_entradas > total_saidas THEN 'ACÚMULO'
            WHEN total_entradas < total_saidas THEN 'DÉFICIT' ELSE 'EQUILIBRADO' END AS situacao
FROM b""",
    "q3_1_monthly_revenue": f"""
SELECT empresa, CAST(year(d_ret) AS BIGINT) AS ano, CAST(month(d_ret) AS BIGINT) AS mes,
       monthname(d_ret) AS nome_mes, CAST(count(*) AS BIGINT) AS total_locacoes,
       sum(valor) AS receita_total,
       {rr('sum(CAST(valor * 100 AS BIGINT))', 'count(*) * 100', 2)} AS ticket_medio
FROM rentf WHERE d_real IS NOT NULL GROUP BY ALL""",
    "q3_2_revenue_share": f"""
, a AS (SELECT empresa, gname AS grupo, rate AS diaria_atual, count(*) AS n, sum(valor) AS receita,
               sum(CAST(valor * 100 AS BIGINT)) AS c
        FROM rentf WHERE d_real IS NOT NULL GROUP BY ALL),
a2 AS (SELECT *, sum(c) OVER (PARTITION BY empresa) AS t FROM a)
SELECT empresa, grupo, diaria_atual, CAST(n AS BIGINT) AS total_locacoes, receita AS receita_total,
       {rr('c', 't', 2, 100)} AS pct_receita_empresa
FROM a2""",
    "q3_3_pipeline": f"""
SELECT r.empresa, CAST(year(r.d_ret) AS BIGINT) AS ano_retirada,
       CAST(quarter(r.d_ret) AS BIGINT) AS trimestre_retirada, c.gname AS grupo,
       CAST(count(*) AS BIGINT) AS total_reservas_ativas, sum(r.valor) AS receita_potencial,
       {rr('sum(r.dur)', 'count(*)', 1)} AS duracao_media_prevista
FROM resv r JOIN cls c ON c.gid = r.gid
WHERE r.status = 'ATIVA' AND r.d_ret >= {AS_OF}
GROUP BY ALL""",
    "q4_1_return_sla": f"""
, a AS (SELECT empresa, gname AS grupo, count(*) AS n,
               sum(CASE WHEN d_real > d_prev THEN 1 ELSE 0 END) AS late,
               sum(CASE WHEN d_real > d_prev THEN date_diff('day', d_prev, d_real) END) AS late_days
        FROM rentf WHERE d_real IS NOT NULL GROUP BY ALL)
SELECT empresa, grupo, CAST(n AS BIGINT) AS total_concluidas, CAST(late AS BIGINT) AS devolvidas_em_atraso,
       {rr('late', 'n', 2, 100)} AS pct_atraso, {rr('late_days', 'late', 1)} AS atraso_medio_dias
FROM a""",
    "q4_2_duration_deviation": f"""
, a AS (SELECT empresa, gname AS grupo, count(*) AS n,
               sum(date_diff('day', d_ret, d_prev)) AS p, sum(date_diff('day', d_ret, d_real)) AS r,
               sum(date_diff('day', d_ret, d_real) - date_diff('day', d_ret, d_prev)) AS d
        FROM rentf WHERE d_real IS NOT NULL GROUP BY ALL)
SELECT empresa, grupo, {rr('p', 'n', 1)} AS duracao_prevista_media, {rr('r', 'n', 1)} AS duracao_real_media,
       {rr('d', 'n', 1)} AS desvio_medio_dias
FROM a""",
    "q5_1_volume_audit": f"""
, dates AS (SELECT d_res AS d FROM resv UNION SELECT d_ret FROM resv
            UNION SELECT d_ret + CAST(dur AS INTEGER) FROM resv
            UNION SELECT d_ret FROM rent UNION SELECT d_prev FROM rent
            UNION SELECT d_real FROM rent WHERE d_real IS NOT NULL
            UNION SELECT {AS_OF} - 1 UNION SELECT {AS_OF} - 2),
cities AS (SELECT DISTINCT n.n_name FROM nation n
           WHERE n.n_nationkey IN (SELECT s_nationkey FROM supplier)
              OR n.n_nationkey IN (SELECT c_nationkey FROM customer))
SELECT * FROM (VALUES
  ('dim_tempo', CAST(7670 + (SELECT count(*) FROM dates
                              WHERE d < DATE '2015-01-01' OR d > DATE '2035-12-31') AS BIGINT)),
  ('dim_patio', CAST(4 * (SELECT count(*) FROM supplier) AS BIGINT)),
  ('dim_grupo', CAST(4 * (SELECT count(*) FROM cls) AS BIGINT)),
  ('dim_veiculo', CAST(4 * (SELECT count(*) FROM part) AS BIGINT)),
  ('dim_cliente', CAST(4 * (SELECT count(*) FROM customer) AS BIGINT)),
  ('dim_endereco', CAST((SELECT count(*) FROM cities) AS BIGINT)),
  ('fato_inventario_patio', CAST(2 * (SELECT count(*) FROM part WHERE p_partkey % 3 <> 0) AS BIGINT)),
  ('fato_locacao', CAST((SELECT count(*) FROM rentf) AS BIGINT)),
  ('fato_reserva', CAST((SELECT count(*) FROM resv) AS BIGINT))
) AS t(tabela, registros)""",
    "q5_2_stale_rentals": f"""
SELECT empresa, rid AS nk_id_locacao, d_ret AS data_retirada,
       CAST(date_diff('day', d_ret, {AS_OF}) AS BIGINT) AS dias_em_andamento, gname AS grupo
FROM rentf WHERE d_real IS NULL AND date_diff('day', d_ret, {AS_OF}) > 90""",
}


def _full(body: str) -> str:
    body = body.strip("\n")
    if body.startswith(","):
        return "WITH " + BASE + body
    return "WITH " + BASE + body




FLEET_LIST = "['frota-1', 'frota-2', 'frota-3', 'frota-4']"
K32 = 4294967296


def pick(k: str, values) -> str:
    items = ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values)
    return f"(CAST([{items}] AS VARCHAR[]))[({k}) % {len(values)} + 1]"


def fleet(k: str) -> str:
    return f"({FLEET_LIST})[({k}) % 4 + 1]"


def blank_to(x: str, d: str) -> str:
    return f"coalesce(nullif(trim({x}), ''), '{d}')"


def dkey(d: str) -> str:
    return f"CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER)"


def s(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


RUN_TS = "TIMESTAMP '2000-01-01 02:00:00'"
SLOTS = "slots AS (SELECT p_partkey % (SELECT n FROM ny) AS y, count(*) AS n FROM part GROUP BY 1)"
TRANS = ("CASE upper(trim({x})) WHEN 'MANUAL' THEN 'MANUAL' WHEN 'AUTOMATICO' THEN 'AUTOMATICO' "
         "WHEN 'AUTOMÁTICO' THEN 'AUTOMATICO' WHEN 'AUTOMATICA' THEN 'AUTOMATICO' "
         "WHEN 'AUTOMÁTICA' THEN 'AUTOMATICO' ELSE 'NÃO INFORMADO' END")
F3_STATUS = ("CASE upper(trim(coalesce({x}, ''))) WHEN 'ATIVO' THEN 'ATIVA' WHEN 'ATIVA' THEN 'ATIVA' "
             "WHEN 'ACTIVE' THEN 'ATIVA' WHEN 'ABERTA' THEN 'ATIVA' WHEN 'CANCELADO' THEN 'CANCELADA' "
             "WHEN 'CANCELADA' THEN 'CANCELADA' WHEN 'CANCEL' THEN 'CANCELADA' "
             "WHEN 'CONVERTIDO' THEN 'CONVERTIDA' WHEN 'CONVERTIDA' THEN 'CONVERTIDA' "
             "WHEN 'CONCLUIDO' THEN 'CONVERTIDA' WHEN 'CONCLUIDA' THEN 'CONVERTIDA' "
             "WHEN 'FINALIZADO' THEN 'CONVERTIDA' WHEN 'FINALIZADA' THEN 'CONVERTIDA' "
             "ELSE coalesce(trim({x}), 'ATIVA') END")
DW_STATUS = ("CASE upper(trim(coalesce({x}, ''))) WHEN 'ATIVA' THEN 'ATIVA' WHEN 'CANCELADA' THEN 'CANCELADA' "
             "WHEN 'CONVERTIDA' THEN 'CONVERTIDA' ELSE 'ATIVA' END")
RAW_T7 = ("manual", "AUTOMATICA", "Automático", " automatico ", "automática", "CVT", None)
RAW_S16 = ("ativo", "Ativa", "ACTIVE", "aberta", "cancelado", "CANCELADA", "cancel", "convertido",
           "Convertida", "concluido", "CONCLUIDA", "finalizado", "Finalizada", "pendente", "  ", None)

FAULTY_RES = f"""
fr0 AS (SELECT o_orderkey AS k, {fleet('o_orderkey')} AS f,
               CASE WHEN o_orderkey % 17 <> 0 THEN o_custkey END AS cust,
               CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey % (SELECT n FROM nc) + 1 END AS gid,
               CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % (SELECT n FROM ny) END AS y1,
               CASE WHEN o_orderkey % 29 <> 0 THEN o_custkey % (SELECT n FROM ny) END AS y2,
               CASE WHEN o_orderkey % 31 <> 0 THEN CAST(o_orderdate AS DATE) END AS d0,
               CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS ret_full
        FROM orders),
fr AS (SELECT *, CASE WHEN k % 37 <> 0 THEN ret_full END AS ret,
              CASE WHEN k % 41 <> 0 THEN ret_full + CAST(k % 12 - 1 AS INTEGER) END AS dev FROM fr0),
frr AS (SELECT *, CASE WHEN cust IS NULL THEN 'Reserva sem cliente'
                       WHEN gid IS NULL THEN 'Reserva sem grupo'
                       WHEN y1 IS NULL THEN 'Reserva sem pátio de retirada'
                       WHEN y2 IS NULL THEN 'Reserva sem pátio de fim'
                       WHEN d0 IS NULL THEN 'Reserva sem data de reserva'
                       WHEN ret IS NULL THEN 'Reserva sem data de retirada prevista'
                       WHEN dev IS NULL THEN 'Reserva sem data de devolução prevista'
                       WHEN dev <= ret THEN 'Data devolução <= data retirada'
                       WHEN date_diff('day', ret, dev) < 1 THEN 'Duração prevista inválida (< 1 dia)' END AS motivo
        FROM fr),
flr AS (SELECT l_orderkey * 8 + l_linenumber AS rid, {fleet('l_orderkey')} AS f, CAST(l_shipdate AS DATE) AS ship,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 - 3 AS INTEGER) END AS rl
        FROM lineitem)
"""
REJECT_LOG = f"""
rlog AS (SELECT 'stg_' || replace(f, '-', '_') || '_reserva' AS tabela_origem, f AS nk_frota_origem,
                k AS nk_id_registro, motivo AS motivo_rejeito, {RUN_TS} AS dt_rejeito
         FROM frr WHERE motivo IS NOT NULL
         UNION ALL
         SELECT 'stg_' || replace(f, '-', '_') || '_locacao', f, rid,
                'Data devolução real anterior à retirada', {RUN_TS}
         FROM flr WHERE rl IS NOT NULL AND rl < ship)
"""
ADDR = f"""
cities AS (SELECT DISTINCT trim(n.n_name) AS cidade, 'XX' AS estado, 'Brasil' AS pais FROM nation n
           WHERE n.n_nationkey IN (SELECT s_nationkey FROM supplier)
              OR n.n_nationkey IN (SELECT c_nationkey FROM customer)),
addr AS (SELECT CAST(row_number() OVER (ORDER BY cidade, estado, pais) AS BIGINT) AS sk_endereco, * FROM cities)
"""
# constraint names in the order the audit emits them: row checks per table, then key checks
QC_ROW = {
    "dim_cliente": ["ck_tipo", "nn_sk_cliente", "nn_nk_frota_origem", "nn_nk_id_cliente",
                    "len_nk_frota_origem", "len_tipo_cliente", "len_nome"],
    "dim_veiculo": ["ck_mecanizacao", "nn_sk_veiculo", "nn_nk_frota_origem", "nn_nk_id_veiculo",
                    "len_nk_frota_origem", "len_placa", "len_marca", "len_modelo", "len_mecanizacao"],
    "dim_grupo": ["ck_valor_diaria", "nn_sk_grupo", "nn_nk_frota_origem", "nn_nk_id_grupo",
                  "len_nk_frota_origem", "len_nome_grupo"],
    "fato_inventario_patio": ["ck_qtde", "nn_sk_tempo_referencia", "nn_sk_patio", "nn_sk_veiculo", "nn_sk_grupo"],
    "fato_locacao": ["ck_valor", "ck_qtde", "nn_nk_frota_origem", "nn_nk_id_locacao", "nn_sk_tempo_retirada",
                     "nn_sk_tempo_prev_devolucao", "nn_sk_cliente", "nn_sk_veiculo", "nn_sk_grupo",
                     "nn_sk_patio_retirada"],
    "fato_reserva": ["ck_status", "ck_duracao", "ck_valor", "ck_qtde", "nn_nk_frota_origem", "nn_nk_id_reserva",
                     "nn_sk_tempo_reserva", "nn_sk_tempo_prev_retirada", "nn_sk_tempo_prev_devolucao",
                     "nn_sk_cliente", "nn_sk_grupo", "nn_sk_patio_retirada", "nn_sk_patio_fim"],
    "dim_endereco": ["nn_sk_endereco", "nn_cidade", "nn_estado", "nn_pais", "len_cidade", "len_estado", "len_pais"],
    "dim_patio": ["nn_sk_patio", "nn_nk_frota_origem", "nn_nk_id_patio", "len_nk_frota_origem", "len_nome_patio"],
    "dim_tempo": ["nn_sk_tempo", "nn_data"],
}
QC = [(t, c) for t, cs in QC_ROW.items() for c in cs] + [
    ("dim_endereco", "uk_endereco"), ("dim_endereco", "pk"), ("dim_cliente", "pk"), ("dim_cliente", "uk_nk"),
    ("dim_cliente", "fk_endereco"), ("dim_veiculo", "pk"), ("dim_veiculo", "uk_nk"), ("dim_grupo", "pk"),
    ("dim_grupo", "uk_nk"), ("dim_patio", "pk"), ("dim_patio", "uk_nk"), ("dim_patio", "fk_endereco"),
    ("dim_tempo", "pk"), ("dim_tempo", "uk_data"), ("fato_inventario_patio", "pk"),
    ("fato_inventario_patio", "fk_patio"), ("fato_locacao", "pk"), ("fato_locacao", "fk_cliente"),
    ("fato_locacao", "fk_patio_devolucao"), ("fato_reserva", "pk"), ("fato_reserva", "fk_grupo")]
QC_VALUES = ",\n".join(
    f"('{t}', '{c}', CAST(0 AS BIGINT))"
    for t, c in QC)

OPS = {
    "c1_capitalise": f"SELECT p_partkey, {cap('p_name')} AS modelo, {cap('p_type')} AS grupo FROM part",
    "c2_blank_sentinel": f"""
SELECT c.c_custkey,
       {blank_to("CASE c.c_custkey % 4 WHEN 0 THEN '   ' WHEN 1 THEN NULL ELSE '  ' || n.n_name || ' ' END", 'NÃO INFORMADO')} AS end_cidade,
       {blank_to("CASE WHEN c.c_custkey % 3 = 0 THEN '' ELSE 'sp' END", 'XX')} AS end_uf
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "c3_capacity_sentinel": f"""WITH ny AS (SELECT count(*) AS n FROM supplier), {SLOTS}
SELECT s.s_suppkey AS nk_id_patio,
       CAST(coalesce(CASE WHEN s.s_suppkey % 5 <> 0 THEN sl.n END, -1) AS BIGINT) AS capacidade_vagas
FROM supplier s LEFT JOIN slots sl ON sl.y = s.s_suppkey""",
    "c4_customer_type": f"""
SELECT c_custkey AS nk_id_cliente,
       CASE WHEN upper(trim(t)) IN ('PF', 'PJ') THEN upper(trim(t)) END AS tipo_cliente,
       CASE WHEN upper(trim(t)) IN ('PF', 'PJ') THEN NULL ELSE 'Cliente sem tipo_cliente válido (PF/PJ)' END AS motivo_rejeito
FROM (SELECT c_custkey, {pick('c_custkey', (' pf ', 'PJ', 'pj', 'XX', None))} AS t FROM customer)""",
    "c5_transmission_map": f"""
SELECT p_partkey, t AS mecanizacao_origem, {TRANS.format(x='t')} AS mecanizacao
FROM (SELECT p_partkey, {pick('p_size', RAW_T7)} AS t FROM part)""",
    "c6_status_map": f"""
SELECT k AS nk_id_reserva, e AS status_extraido, {DW_STATUS.format(x='e')} AS status_reserva
FROM (SELECT k, {F3_STATUS.format(x='r')} AS e
      FROM (SELECT o_orderkey AS k, {pick('o_orderkey', RAW_S16)} AS r FROM orders))""",
    "c7_duration": """
SELECT k AS nk_id_reserva, CAST(date_diff('day', ret, dev) AS BIGINT) AS duracao_prevista_dias,
       CAST(greatest(date_diff('day', ret, dev), 1) AS BIGINT) AS duracao_minima_1
FROM (SELECT k, ret, ret + CAST(k % 12 - 2 AS INTEGER) AS dev
      FROM (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS ret FROM orders))""",
    "c8_planned_value": with_base(""",
rates AS (SELECT gid, CASE WHEN gid % 4 <> 0 THEN rate END AS rate FROM cls)
SELECT o.o_orderkey AS nk_id_reserva,
       CAST(CAST(o.o_orderkey % 12 AS DECIMAL(10,0)) * coalesce(r.rate, 0) AS DECIMAL(12,2)) AS valor_previsto_reserva
FROM orders o LEFT JOIN rates r ON r.gid = o.o_orderkey % (SELECT n FROM nc) + 1"""),
    "c9_clamp_value": """
SELECT l_orderkey, l_linenumber,
       CAST(greatest(coalesce(CASE WHEN l_linenumber <> 7
                                   THEN CAST(l_extendedprice AS DECIMAL(14,2)) - 50000 END, 0), 0) AS DECIMAL(14,2)) AS valor_final
FROM lineitem""",
    "c15_name_fallback": f"""
SELECT s_suppkey AS nk_id_patio,
       {cap("coalesce(nullif(trim(CASE WHEN s_suppkey % 3 <> 0 THEN s_name END), ''), nullif(trim(CASE WHEN s_suppkey % 2 <> 0 THEN 'cod-' || CAST(s_suppkey AS VARCHAR) END), ''), 'PATIO ' || CAST(s_suppkey AS VARCHAR))")} AS nome_patio
FROM supplier""",
    "c16_plate": """
SELECT p_partkey, upper(trim(r)) AS placa, coalesce(nullif(upper(trim(r)), ''), 'SEM PLACA') AS placa_f4
FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN NULL
                             ELSE ' ab' || CAST(p_partkey AS VARCHAR) || ' ' END AS r FROM part)""",
    "c17_text_defaults": f"""
SELECT p_partkey, {cap("coalesce(CASE WHEN p_partkey % 5 <> 0 THEN p_brand END, 'NÃO INFORMADO')")} AS marca,
       coalesce(CASE WHEN p_size % 3 <> 0 THEN p_size % 2 = 0 END, false) AS tem_ar_condicionado
FROM part""",
    "c10_date_order": with_base(f", {FAULTY_RES} SELECT rid AS nk_id_locacao, NOT (rl IS NOT NULL AND rl < ship) AS data_valida FROM flr"),
    "c11_first_reason": with_base(f", {FAULTY_RES} SELECT k AS nk_id_reserva, motivo AS motivo_rejeito FROM frr"),
    "c12_accept_reject_split": with_base(f""", {FAULTY_RES}
SELECT f AS nk_frota_origem, CAST(count(*) FILTER (WHERE motivo IS NULL) AS BIGINT) AS aceitas,
       CAST(count(*) FILTER (WHERE motivo IS NOT NULL) AS BIGINT) AS rejeitadas
FROM frr GROUP BY ALL"""),
    "c13_warn_and_load": with_base(f""",
g AS (SELECT fl.fleet AS nk_frota_origem, c.gid AS nk_id_grupo, c.p_type,
             CASE c.gid % 3 WHEN 0 THEN NULL WHEN 1 THEN CAST(0 AS DECIMAL(12,2)) ELSE c.rate END AS v
      FROM cls c CROSS JOIN fl)
SELECT nk_frota_origem, nk_id_grupo,
       {cap("coalesce(nullif(trim(p_type), ''), 'GRUPO ' || CAST(nk_id_grupo AS VARCHAR))")} AS nome_grupo,
       CAST(coalesce(v, 0) AS DECIMAL(12,2)) AS valor_diaria,
       CASE WHEN v IS NULL OR v = 0 THEN 'Grupo sem valor_diaria vigente; será carregado com valor 0,00' END AS aviso
FROM g"""),
    "c14_reject_json": with_base(f""", {FAULTY_RES}
SELECT 'stg_' || replace(f, '-', '_') || '_reserva' AS tabela_origem, k AS nk_id_registro, motivo AS motivo_rejeito,
       json_object('nk_id_reserva', k, 'nk_id_cliente', cust, 'nk_id_grupo', gid, 'nk_id_patio_retirada', y1,
                   'nk_id_patio_fim', y2, 'data_reserva', d0, 'data_retirada_prevista', ret,
                   'data_devolucao_prevista', dev)::VARCHAR AS dados_json
FROM frr WHERE motivo IS NOT NULL"""),
    "g9_reject_summary": with_base(f""", {FAULTY_RES}, {REJECT_LOG}
SELECT tabela_origem, CAST(count(*) AS BIGINT) AS total_rejeitos, min(dt_rejeito) AS primeiro_rejeito,
       max(dt_rejeito) AS ultimo_rejeito,
       string_agg(DISTINCT motivo_rejeito, ' | ' ORDER BY motivo_rejeito) AS motivos
FROM rlog GROUP BY tabela_origem"""),
    "o6_latest_rejects": with_base(f""", {FAULTY_RES}, {REJECT_LOG}
SELECT tabela_origem, nk_frota_origem, nk_id_registro, motivo_rejeito FROM rlog
ORDER BY dt_rejeito DESC, tabela_origem, nk_frota_origem, nk_id_registro DESC, motivo_rejeito LIMIT 50"""),
    "qc_constraint_audit": with_base(f"""
SELECT * FROM (VALUES {QC_VALUES}) AS t(tabela, restricao, violacoes)"""),
    "s1_full_extract": f"""WITH ny AS (SELECT count(*) AS n FROM supplier), {SLOTS}
SELECT 'frota-2' AS nk_frota_origem, s.s_suppkey AS nk_id_patio, s.s_name AS nome_patio,
       CAST(sl.n AS BIGINT) AS capacidade_vagas,
       left(concat_ws(' ', {", ".join(["s.s_name"] * 12)}), 150) AS endereco,
       CAST(NULL AS VARCHAR) AS end_cidade, CAST(NULL AS VARCHAR) AS end_uf
FROM supplier s LEFT JOIN slots sl ON sl.y = s.s_suppkey""",
    "s2_incremental_cut": with_base("""
SELECT empresa AS nk_frota_origem, rid AS nk_id_locacao, d_ret AS data_retirada, d_real AS data_real_devolucao
FROM rent WHERE d_ret >= DATE '1999-06-01' OR d_real >= DATE '1999-06-01'"""),
    "x_subclass_merge": """
SELECT c_custkey AS nk_id_cliente, CASE WHEN c_custkey % 3 <> 0 THEN 'PF' ELSE 'PJ' END AS tipo_cliente,
       CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE 'NF ' || c_name END AS nome,
       CASE WHEN c_custkey % 3 <> 0 THEN 'CPF' ELSE 'CNPJ' END || CAST(c_custkey AS VARCHAR) AS documento
FROM customer""",
    "x_slot_count": f"""WITH ny AS (SELECT count(*) AS n FROM supplier), {SLOTS}
SELECT s.s_suppkey AS nk_id_patio, CAST(coalesce(sl.n, 0) AS BIGINT) AS capacidade_vagas
FROM supplier s LEFT JOIN slots sl ON sl.y = s.s_suppkey""",
    "x_extension_sum": """
SELECT o.o_orderkey AS nk_id_locacao,
       CAST(o.o_orderdate AS DATE) + 7 + CAST(coalesce(e.d, 0) AS INTEGER) AS data_prev_devolucao
FROM orders o LEFT JOIN (SELECT l_orderkey, sum(l_linenumber) AS d FROM lineitem WHERE l_linenumber >= 6
                         GROUP BY 1) e ON e.l_orderkey = o.o_orderkey""",
    "x_charge_sum": """
SELECT o.o_orderkey AS nk_id_locacao, CAST(coalesce(c.v, 0) AS DECIMAL(22,2)) AS valor_final
FROM orders o LEFT JOIN (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS v FROM lineitem
                         WHERE l_returnflag IN ('A', 'N') GROUP BY 1) c ON c.l_orderkey = o.o_orderkey""",
    "x_return_chain": """WITH ny AS (SELECT count(*) AS n FROM supplier),
r AS (SELECT l_orderkey, l_partkey AS slot,
             CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 AS INTEGER) AS d FROM lineitem WHERE l_linestatus = 'F'),
r1 AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY d DESC, slot ASC) AS rn FROM r)
SELECT o.o_orderkey AS nk_id_locacao, r1.d AS data_devolucao, r1.slot % (SELECT n FROM ny) AS patio_devolucao
FROM orders o LEFT JOIN r1 ON r1.l_orderkey = o.o_orderkey AND r1.rn = 1""",
    "sn1_slot_snapshot": with_base("""
SELECT 'frota-1' AS nk_frota_origem, p_partkey % (SELECT n FROM ny) AS nk_id_patio, p_partkey AS nk_id_veiculo,
       gid AS nk_id_grupo, DATE '1999-12-31' AS data_snapshot
FROM pc WHERE p_partkey % 3 <> 0"""),
    "sn2_asof_yard": with_base(""",
v AS (SELECT p.p_partkey, pc.gid, p.p_partkey % (SELECT n FROM ny) AS home FROM part p JOIN pc USING (p_partkey)
      WHERE p.p_size % 10 <> 0),
lr AS (SELECT l_orderkey * 8 + l_linenumber AS rid, l_partkey AS veh, l_linestatus AS st, CAST(l_shipdate AS DATE) AS ship,
              CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 AS INTEGER) END AS rl,
              (l_suppkey + l_linenumber) % (SELECT n FROM ny) AS y FROM lineitem),
last AS (SELECT veh, y FROM (SELECT veh, y, row_number() OVER (PARTITION BY veh ORDER BY rl DESC, rid DESC, y DESC) AS rn
                             FROM lr WHERE st = 'F' AND rl <= DATE '1995-03-01') WHERE rn = 1),
opn AS (SELECT veh FROM lr WHERE st <> 'F' AND ship <= DATE '1995-03-01')
SELECT 'frota-2' AS nk_frota_origem, coalesce(last.y, v.home) AS nk_id_patio, v.p_partkey AS nk_id_veiculo,
       v.gid AS nk_id_grupo, DATE '1995-03-01' AS data_snapshot
FROM v LEFT JOIN last ON last.veh = v.p_partkey
WHERE v.p_partkey NOT IN (SELECT veh FROM opn)"""),
    "sn3_slot_id_snapshot": with_base("""
SELECT 'frota-3' AS nk_frota_origem, p_partkey % (SELECT n FROM ny) AS nk_id_patio, p_partkey AS nk_id_veiculo,
       gid AS nk_id_grupo, DATE '2000-01-01' AS data_snapshot
FROM pc WHERE p_partkey % 4 <> 0"""),
    "sn4_status_snapshot": with_base(f"""
SELECT 'frota-4' AS nk_frota_origem, p.p_partkey % (SELECT n FROM ny) AS nk_id_patio, p.p_partkey AS nk_id_veiculo,
       pc.gid AS nk_id_grupo, DATE '2000-01-01' AS data_snapshot
FROM part p JOIN pc USING (p_partkey)
WHERE {pick('p.p_size', ('DISPONIVEL', 'ALUGADO', 'MANUTENCAO', None))} <> 'ALUGADO'"""),
    "j7_null_aware_anti": """
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
    "d1_address_dim": f"WITH {ADDR} SELECT sk_endereco, cidade, estado, pais FROM addr",
    "d2_scd1_upsert": f"""
SELECT CAST({K32} + c_custkey AS BIGINT) AS sk_cliente, 'frota-1' AS nk_frota_origem, c_custkey AS nk_id_cliente,
       'PF' AS tipo_cliente, c_name AS nome FROM customer""",
    "d3_address_lookup": with_base(f""", {ADDR}
SELECT fl.fleet AS nk_frota_origem, c.c_custkey AS nk_id_cliente, a.sk_endereco
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN addr a ON a.cidade = trim(n.n_name)
CROSS JOIN fl"""),
    "d4_calendar": f"""
SELECT {dkey('data')} AS sk_tempo, data FROM (
  SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE),
                                     INTERVAL 1 DAY)) AS DATE) AS data FROM orders)""",
    "d5_missing_dates": with_base(f""",
dd AS (SELECT d_res AS d FROM resv UNION SELECT d_ret FROM resv UNION SELECT d_dev FROM resv
       UNION SELECT d_ret FROM rent UNION SELECT d_prev FROM rent UNION SELECT d_real FROM rent)
SELECT {dkey('d')} AS sk_tempo, d AS data FROM dd
WHERE d IS NOT NULL AND (d < DATE '2015-01-01' OR d > DATE '2035-12-31')"""),
    "s3_merge_subset": f"""
SELECT {fleet('o_orderkey')} AS nk_frota_origem, o_orderkey AS nk_id_reserva,
       CASE WHEN o_orderkey % 2 <> 0 THEN CAST(o_orderdate AS DATE) + 1
            ELSE CAST(o_orderdate AS DATE) END AS data_reserva,
       CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 <> 0 THEN CAST(CAST(o_totalprice AS DECIMAL(12,2)) * 2 AS DECIMAL(12,2))
            ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS valor_previsto_reserva,
       CASE WHEN o_orderkey % 3 = 0 OR o_orderkey % 2 <> 0 THEN CASE o_orderstatus WHEN 'F' THEN 'CONVERTIDA' WHEN 'O' THEN 'ATIVA'
                                                             WHEN 'P' THEN 'CANCELADA' END
            ELSE 'ATIVA' END AS status_reserva
FROM orders""",
    "s4_replace_slice": with_base("""
SELECT empresa AS nk_frota_origem, rid AS nk_id_reserva, status AS status_reserva FROM resv
WHERE empresa <> 'frota-2' OR status = 'CANCELADA'"""),
    "s5_replace_day": with_base(f""",
snap AS (SELECT {fleet('p_partkey % (SELECT n FROM ny)')} AS nk_frota_origem,
                p_partkey % (SELECT n FROM ny) AS nk_id_patio, p_partkey AS nk_id_veiculo, d.data_snapshot
         FROM part CROSS JOIN (VALUES (DATE '1999-12-30'), (DATE '1999-12-31')) AS d(data_snapshot)
         WHERE p_partkey % 3 <> 0),
again AS (SELECT * FROM snap WHERE data_snapshot = DATE '1999-12-31' AND nk_id_veiculo % 3 = 1),
parts AS (SELECT DISTINCT nk_frota_origem, data_snapshot FROM again)
SELECT * FROM snap s
WHERE NOT EXISTS (SELECT 1 FROM parts p WHERE p.nk_frota_origem = s.nk_frota_origem
                                          AND p.data_snapshot = s.data_snapshot)
UNION ALL SELECT * FROM again"""),
    "s8_insert_ignore": """
SELECT DISTINCT n.n_name AS cidade, 'XX' AS uf FROM nation n
WHERE n.n_nationkey IN (SELECT s_nationkey FROM supplier) OR n.n_nationkey IN (SELECT c_nationkey FROM customer)""",
    "u1_date_key": f"""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS data_retirada,
       {dkey('CAST(l_shipdate AS DATE)')} AS sk_tempo_retirada FROM lineitem""",
    "u2_unpivot_dates": with_base("""
SELECT d_ret AS data FROM rent UNION SELECT d_prev FROM rent UNION SELECT d_real FROM rent WHERE d_real IS NOT NULL"""),
    "fl1_inventory_fact": with_base(f""",
dd(d) AS (VALUES (DATE '1999-12-30'), (DATE '1999-12-31'))
SELECT {dkey('dd.d')} AS sk_tempo_referencia,
       CAST(((p_partkey % (SELECT n FROM ny)) % 4 + 1) * {K32} + p_partkey % (SELECT n FROM ny) AS BIGINT) AS sk_patio,
       CAST((p_partkey % 3 + 1) * {K32} + p_partkey AS BIGINT) AS sk_veiculo,
       CAST((p_partkey % 3 + 1) * {K32} + gid AS BIGINT) AS sk_grupo, 1 AS qtde_veiculos_presentes
FROM pc CROSS JOIN dd WHERE p_partkey % 3 <> 0"""),
    "fl2_rental_fact": with_base(f"""
SELECT empresa AS nk_frota_origem, rid AS nk_id_locacao, {dkey('d_ret')} AS sk_tempo_retirada,
       {dkey('d_prev')} AS sk_tempo_prev_devolucao, {dkey('d_real')} AS sk_tempo_real_devolucao,
       CAST((idx + 1) * {K32} + cust AS BIGINT) AS sk_cliente, CAST((idx + 1) * {K32} + veh AS BIGINT) AS sk_veiculo,
       CAST((idx + 1) * {K32} + gid AS BIGINT) AS sk_grupo, CAST((idx + 1) * {K32} + y_out AS BIGINT) AS sk_patio_retirada,
       CAST((idx + 1) * {K32} + y_in AS BIGINT) AS sk_patio_devolucao_real, valor AS valor_final, 1 AS qtde_locacoes
FROM rentf"""),
    "fl3_reservation_fact": with_base(f"""
SELECT empresa AS nk_frota_origem, rid AS nk_id_reserva, {dkey('d_res')} AS sk_tempo_reserva,
       {dkey('d_ret')} AS sk_tempo_prev_retirada, {dkey('d_dev')} AS sk_tempo_prev_devolucao,
       CAST((idx + 1) * {K32} + cust AS BIGINT) AS sk_cliente, CAST((idx + 1) * {K32} + gid AS BIGINT) AS sk_grupo,
       CAST((idx + 1) * {K32} + y_out AS BIGINT) AS sk_patio_retirada,
       CAST((idx + 1) * {K32} + y_end AS BIGINT) AS sk_patio_fim, CAST(dur AS INTEGER) AS duracao_prevista_dias,
       valor AS valor_previsto_reserva, status AS dd_status_reserva, 1 AS qtde_reservas
FROM resv"""),
    "fl4_late_key_reject": with_base(f""",
inv AS (SELECT p_partkey AS veh, p_partkey % (SELECT n FROM ny) AS y FROM part WHERE p_partkey % 3 <> 0),
dd(d) AS (VALUES (1), (2))
SELECT 'stg_conf_snapshot_patio' AS tabela_origem, {fleet('y')} AS nk_frota_origem, veh AS nk_id_registro,
       'PÁTIO NÃO ENCONTRADO EM DIM_PATIO: nk=' || {s('y')} AS motivo_rejeito
FROM inv CROSS JOIN dd WHERE y % 7 = 0
UNION ALL
SELECT 'stg_conf_locacao', empresa, rid,
       CASE WHEN cust % 10 = 0 THEN 'CLIENTE NÃO EM DIM_CLIENTE: nk=' || {s('cust')}
            ELSE 'PÁTIO RETIRADA NÃO EM DIM_PATIO: nk=' || {s('y_out')} END
FROM rent WHERE cust % 10 = 0 OR y_out % 7 = 0
UNION ALL
SELECT 'stg_conf_reserva', empresa, rid,
       CASE WHEN cust % 10 = 0 THEN 'CLIENTE NÃO EM DIM_CLIENTE: nk=' || {s('cust')}
            WHEN y_out % 7 = 0 THEN 'PÁTIO RETIRADA NÃO EM DIM_PATIO: nk=' || {s('y_out')}
            ELSE 'PÁTIO FIM NÃO EM DIM_PATIO: nk=' || {s('y_end')} END
FROM resv WHERE cust % 10 = 0 OR y_out % 7 = 0 OR y_end % 7 = 0"""),
    "fl4b_return_yard_warning": with_base(f"""
SELECT 'stg_conf_locacao' AS tabela_origem, empresa AS nk_frota_origem, rid AS nk_id_registro,
       'PÁTIO DEVOLUÇÃO NÃO EM DIM_PATIO: nk=' || {s('y_in')} AS motivo_rejeito
FROM rent WHERE y_in IS NOT NULL AND y_in % 7 = 0"""),
}

OPS["p1_second_night_reservations"] = OPS["fl3_reservation_fact"]
# two nights: of a repeated rental id the first night's row stays, and takes return and value of the second's
_PICK = """QUALIFY row_number() OVER (PARTITION BY empresa, rid ORDER BY d_ret DESC, d_prev DESC,
    d_real DESC NULLS LAST, cust DESC, veh DESC, gid DESC, y_out DESC, y_in DESC NULLS LAST, valor DESC) = 1"""
OPS["p1_second_night_rentals"] = OPS["fl2_rental_fact"].replace("FROM rentf", f"""FROM (
  SELECT coalesce(n1.empresa, n2.empresa) AS empresa, coalesce(n1.rid, n2.rid) AS rid, coalesce(n1.idx, n2.idx) AS idx,
         coalesce(n1.d_ret, n2.d_ret) AS d_ret, coalesce(n1.d_prev, n2.d_prev) AS d_prev, coalesce(n1.cust, n2.cust) AS cust,
         coalesce(n1.veh, n2.veh) AS veh, coalesce(n1.gid, n2.gid) AS gid, coalesce(n1.y_out, n2.y_out) AS y_out,
         CASE WHEN n2.rid IS NULL THEN n1.d_real ELSE n2.d_real END AS d_real,
         CASE WHEN n2.rid IS NULL THEN n1.y_in ELSE n2.y_in END AS y_in,
         CASE WHEN n2.rid IS NULL THEN n1.valor ELSE n2.valor END AS valor
  FROM (SELECT * FROM (SELECT * REPLACE (CASE WHEN d_real < DATE '1997-06-01' THEN d_real END AS d_real,
                                         CASE WHEN d_real < DATE '1997-06-01' THEN y_in END AS y_in)
                       FROM rent WHERE d_ret < DATE '1997-06-01') {_PICK}) n1
  FULL JOIN (SELECT * FROM rent WHERE d_ret >= DATE '1997-06-01' OR d_real >= DATE '1997-06-01' {_PICK}) n2
    ON n1.empresa = n2.empresa AND n1.rid = n2.rid)""")
OPS["p1_second_night_inventory"] = OPS["fl1_inventory_fact"].replace(
    "(DATE '1999-12-31')", "(DATE '1999-12-31'), (DATE '1997-05-30'), (DATE '1997-05-31')")

# ------------------------------------------------------------ rules of each source
FLEET_RES = f"""{FAULTY_RES},
own AS (SELECT fr.*, o_orderstatus AS st, CASE WHEN k % 43 = 0 THEN NULL WHEN k % 47 = 0 THEN 0 ELSE CAST(date_diff('day', ret, dev) AS INTEGER) END AS dur
        FROM fr JOIN orders ON o_orderkey = k),
ownr AS (SELECT *, CASE WHEN cust IS NULL THEN 'Reserva sem cliente'
                        WHEN gid IS NULL THEN 'Reserva sem grupo'
                        WHEN y1 IS NULL THEN 'Reserva sem pátio de retirada'
                        WHEN y2 IS NULL THEN 'Reserva sem pátio de fim'
                        WHEN d0 IS NULL THEN 'Reserva sem data de reserva'
                        WHEN ret IS NULL THEN 'Reserva sem data de retirada prevista'
                        WHEN dev IS NULL THEN 'Reserva sem data de devolução prevista'
                        WHEN dev <= ret AND f = 'frota-4' THEN 'Data devolução <= data retirada (duração < 1)'
                        WHEN dev <= ret THEN 'Data devolução <= data retirada'
                        WHEN coalesce(dur, 0) < 1 AND f <> 'frota-4' THEN 'Duração prevista inválida (< 1 dia)' END AS motivo
         FROM own)
"""
TEMPLATE = "CASE WHEN regexp_matches(motivo_rejeito, 'DIM_[A-Z]+: ') THEN regexp_extract(motivo_rejeito, '^(.*DIM_[A-Z]+: (?:nk=)?)', 1) ELSE motivo_rejeito END"


def whole_log(body: str) -> str:
    return with_base(f""", {FAULTY_RES}, {REJECT_LOG},
wlog AS (SELECT *, {TEMPLATE} AS motivo, nullif(substr(motivo_rejeito, length({TEMPLATE}) + 1), '') AS v
         FROM (SELECT * FROM rlog UNION ALL SELECT *, {RUN_TS} FROM ({OPS['fl4_late_key_reject']})))
{body}""")


SUMMARY = """SELECT tabela_origem, CAST(count(*) AS BIGINT) AS total_rejeitos, min(dt_rejeito) AS primeiro_rejeito,
       max(dt_rejeito) AS ultimo_rejeito, string_agg(DISTINCT motivo, ' | ' ORDER BY motivo) AS motivos
FROM wlog {where} GROUP BY tabela_origem"""
RULES = {
    "c11_fleet_reasons": with_base(f", {FLEET_RES} SELECT f AS nk_frota_origem, k AS nk_id_reserva, motivo AS motivo_rejeito FROM ownr"),
    "c14_fleet_payloads": with_base(f""", {FLEET_RES}
SELECT 'stg_' || replace(f, '-', '_') || '_reserva' AS tabela_origem, k AS nk_id_registro, motivo AS motivo_rejeito,
       CASE WHEN f = 'frota-4' THEN json_object('nk_id_reserva', k, 'nk_id_cliente', cust, 'nk_id_grupo', gid, 'nk_id_patio_retirada', y1,
                'nk_id_patio_fim', y2, 'data_reserva', d0, 'data_retirada_prevista', ret, 'data_devolucao_prevista', dev)::VARCHAR
            ELSE json_object('nk_id_reserva', k, 'nk_id_cliente', cust, 'nk_id_grupo', gid, 'nk_id_patio_retirada', y1,
                'nk_id_patio_fim', y2, 'data_reserva', d0, 'data_retirada_prevista', ret, 'data_devolucao_prevista', dev,
                'duracao_prevista_dias', dur, 'status_reserva', st)::VARCHAR END AS dados_json
FROM ownr WHERE motivo IS NOT NULL"""),
    "c14_rental_payloads": f"""
SELECT 'stg_' || replace(f, '-', '_') || '_locacao' AS tabela_origem, rid AS nk_id_registro,
       'Data devolução real anterior à retirada' AS motivo_rejeito,
       rtrim(json_object('nk_id_locacao', rid, 'nk_id_cliente', k, 'nk_id_veiculo', l_partkey, 'nk_id_grupo', 1, 'nk_id_patio_retirada', l_suppkey,
             'data_retirada', ship, 'data_prev_devolucao', CAST(ship + CAST(l_linenumber AS INTEGER) AS DATE), 'data_real_devolucao', rl)::VARCHAR, '}}')
       || ',"valor_final":' || CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) || '}}' AS dados_json
FROM (SELECT *, l_orderkey AS k, l_orderkey * 8 + l_linenumber AS rid, {fleet('l_orderkey')} AS f, CAST(l_shipdate AS DATE) AS ship,
             CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 - 3 AS INTEGER) AS rl
      FROM lineitem WHERE l_linestatus = 'F') WHERE rl < ship""",
    "c4_fleet_reasons": with_base(f""",
rules(fleet, customer, vehicle, snap) AS (VALUES
  ('frota-1', 'Cliente sem tipo_cliente válido', 'Veículo sem nk_id_grupo', 'Snapshot sem chaves válidas'),
  ('frota-2', 'Cliente sem tipo_cliente (PF/PJ)', 'Veículo sem nk_id_grupo ou sem nk_id_patio_origem', 'Snapshot sem pátio, veículo ou grupo válidos'),
  ('frota-3', 'Cliente sem tipo_cliente (PF/PJ)', 'Veículo sem nk_id_grupo (Id_categoria)', 'Snapshot sem pátio, veículo ou grupo válidos'),
  ('frota-4', 'Cliente sem tipo_cliente válido (PF/PJ)', 'Veículo sem id_grupo', 'Snapshot sem chaves válidas (patio/veiculo/grupo/data)')),
found AS (
  SELECT fleet, 'cliente' AS e, c_custkey AS id, customer AS motivo FROM customer CROSS JOIN rules WHERE c_custkey % 5 >= 3
  UNION ALL
  SELECT fleet, 'veiculo', p_partkey, vehicle FROM part CROSS JOIN rules WHERE p_partkey % 5 = 0 OR (fleet = 'frota-2' AND p_partkey % 7 = 0)
  UNION ALL
  SELECT r.fleet, 'snapshot_patio', p_partkey, snap
  FROM part JOIN rules r ON r.fleet = {fleet('(p_partkey % (SELECT n FROM ny))')} CROSS JOIN (VALUES (1), (2)) days(d)
  WHERE p_partkey % 3 <> 0 AND p_partkey % 11 = 0)
SELECT 'stg_' || replace(fleet, '-', '_') || '_' || e AS tabela_origem, id AS nk_id_registro, motivo AS motivo_rejeito FROM found"""),
    "g8_reject_reasons": whole_log("""SELECT tabela_origem, motivo, CAST(count(*) AS BIGINT) AS total_rejeitos, min(dt_rejeito) AS primeiro_rejeito,
       max(dt_rejeito) AS ultimo_rejeito, min(v) AS menor_valor, max(v) AS maior_valor FROM wlog GROUP BY tabela_origem, motivo"""),
    "g9_summary_with_late_keys": whole_log(SUMMARY.format(where="")),
    "g9_fleet_summary": whole_log(SUMMARY.format(where="WHERE nk_frota_origem = 'frota-2'")),
}

ORACLES: dict[str, str] = {k: _full(v) for k, v in MARTS.items()}
ORACLES.update(OPS)

LATEST_EVENT = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
                                FROM events) WHERE rn = 1)"""


def _event_rental(src: str, key: str) -> str:
    return f"""SELECT {fleet('user_id')} AS nk_frota_origem, {key} AS nk_id_locacao, user_id AS nk_id_cliente,
       CAST(ts AS DATE) AS data_retirada,
       CASE WHEN event_type = 'error' THEN CAST(ts AS DATE) - 1
            WHEN event_type = 'purchase' THEN CAST(ts AS DATE) + 2 END AS data_real_devolucao,
       CAST(greatest(coalesce(CAST(value AS DECIMAL(14,2)), 0), 0) AS DECIMAL(14,2)) AS valor_final, event_type, event_id
FROM {src}"""


STREAMS = {
    "st1_latest_upsert": f"WITH {LATEST_EVENT} SELECT user_id, event_id, event_type, value, ts FROM latest",
    "st2_conform_stream": f"""
SELECT nk_frota_origem, nk_id_locacao, nk_id_cliente, data_retirada, data_real_devolucao, valor_final
FROM ({_event_rental('events', 'event_id')}) WHERE event_type <> 'error'""",
    "st2_outcomes": f"""
SELECT nk_frota_origem, nk_id_locacao, CASE WHEN bad THEN 'rejected' ELSE 'accepted' END AS outcome, valor_final,
       CASE WHEN bad THEN 'Data devolução real anterior à retirada' END AS motivo_rejeito,
       CASE WHEN bad THEN json_object('nk_id_locacao', nk_id_locacao, 'nk_id_cliente', nk_id_cliente, 'nk_id_veiculo', nk_id_cliente,
            'nk_id_grupo', 1, 'nk_id_patio_retirada', nk_id_cliente % 10, 'data_retirada', data_retirada,
            'data_prev_devolucao', CAST(data_retirada + 1 AS DATE), 'data_real_devolucao', data_real_devolucao)::VARCHAR END AS dados_json
FROM (SELECT *, event_type = 'error' AS bad FROM ({_event_rental('events', 'event_id')}))""",
    "st2b_silent_updates": f"""
SELECT nk_frota_origem, nk_id_locacao, event_id,
       CASE WHEN NOT bad THEN 'accepted' WHEN first_ok < event_id THEN 'ignored' ELSE 'rejected' END AS outcome,
       CASE WHEN bad THEN 'Data devolução real anterior à retirada' END AS motivo_rejeito
FROM (SELECT *, event_type = 'error' AS bad,
             min(CASE WHEN event_type <> 'error' THEN event_id END) OVER (PARTITION BY nk_id_locacao) AS first_ok
      FROM ({_event_rental('events', 'user_id')}))""",
    "st3_enrich_stream": """
SELECT e.event_id, e.user_id, c.c_name, trim(n.n_name) AS end_cidade
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "st4_close_out": """WITH p AS (
  SELECT * FROM (SELECT user_id, CAST(ts AS DATE) AS d,
                        row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
                 FROM events WHERE event_type = 'purchase') WHERE rn = 1)
SELECT o.o_orderkey AS nk_id_locacao, p.d AS data_real_devolucao,
       CASE WHEN p.user_id IS NOT NULL THEN p.user_id % 10 END AS nk_id_patio_devolucao
FROM orders o LEFT JOIN p ON p.user_id = o.o_orderkey""",
    "st5_child_total": """
SELECT c.c_custkey, CAST(coalesce(s.v, 0) AS DECIMAL(22,2)) AS valor_total
FROM customer c LEFT JOIN (SELECT user_id, sum(CAST(value AS DECIMAL(12,2))) AS v FROM events
                           WHERE event_type IN ('purchase', 'click') GROUP BY 1) s ON s.user_id = c.c_custkey""",
    "st6_update_only": f"""WITH {LATEST_EVENT}
SELECT o.o_orderkey AS nk_id_reserva,
       CASE WHEN l.user_id IS NULL THEN CASE o.o_orderstatus WHEN 'F' THEN 'CONVERTIDA' WHEN 'O' THEN 'ATIVA'
                                                          WHEN 'P' THEN 'CANCELADA' END
            WHEN l.event_type = 'purchase' THEN 'CONVERTIDA' WHEN l.event_type = 'error' THEN 'CANCELADA'
            ELSE 'ATIVA' END AS status_reserva
FROM orders o LEFT JOIN latest l ON l.user_id = o.o_orderkey""",
    "st7_cascade": f"""WITH {LATEST_EVENT}
SELECT nk_frota_origem, nk_id_locacao, nk_id_cliente, data_retirada, data_real_devolucao, valor_final
FROM ({_event_rental('latest', 'user_id')}) WHERE event_type <> 'error'""",
}
ORACLES.update(RULES)
for _n, _m, _o in (("o1_order_by_alias", "q1_1_yard_inventory", "total_veiculos DESC NULLS LAST"),
                   ("o2_order_by_several", "q2_1_transition_matrix", "patio_origem ASC NULLS FIRST, percentual_movimentacao DESC NULLS LAST"),
                   ("o3_order_by_expression", "q4_2_duration_deviation", "abs(desvio_medio_dias) DESC NULLS LAST"),
                   ("o4_order_of_union", "q5_1_volume_audit", "registros DESC NULLS LAST")):
    ORACLES[_n] = f"SELECT *, CAST(rank() OVER (ORDER BY {_o}) AS BIGINT) AS posicao FROM ({ORACLES[_m]})"
ORACLES.update(STREAMS)

YEAR4 = ("2019", "2020", "2021a", " 2018")
EXTRACT_BASE = BASE + """,
slots AS (SELECT p_partkey % (SELECT n FROM ny) AS y, count(*) AS n FROM part GROUP BY 1)
"""


def xb(body: str) -> str:
    return "WITH " + EXTRACT_BASE + body


EXTRACTS = {
    "x_f1_patio": xb("""
SELECT 'frota-1' AS nk_frota_origem, s.s_suppkey AS nk_id_patio, s.s_name AS nome_patio,
       CAST(coalesce(sl.n, 0) AS INTEGER) AS capacidade_vagas, n.n_name AS end_cidade, 'SP' AS end_uf,
       'Rua ' || n.n_name AS end_logradouro
FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey LEFT JOIN slots sl ON sl.y = s.s_suppkey"""),
    "x_f1_grupo": xb("""
SELECT 'frota-1' AS nk_frota_origem, gid AS nk_id_grupo, p_type AS nome_grupo,
       CAST(NULL AS VARCHAR) AS descricao_grupo, rate AS valor_diaria FROM cls"""),
    "x_f1_veiculo": xb(f"""
SELECT 'frota-1' AS nk_frota_origem, p.p_partkey AS nk_id_veiculo, pc.gid AS nk_id_grupo,
       CASE WHEN p.p_partkey % 3 <> 0 THEN p.p_partkey % (SELECT n FROM ny) END AS nk_id_patio_origem,
       'p' || CAST(p.p_partkey AS VARCHAR) AS placa, p.p_brand AS marca, p.p_name AS modelo,
       CAST(NULL AS VARCHAR) AS versao,
       CASE WHEN p.p_size % 2 = 1 THEN 'AUTOMATICO' ELSE 'MANUAL' END AS mecanizacao,
       p.p_size % 3 = 0 AS tem_ar_condicionado,
       CAST(nullif(regexp_extract(trim({pick('p.p_partkey', YEAR4)}), '^[0-9]+', 0), '') AS INTEGER) AS ano_fabricacao,
       'ATIVO' AS situacao
FROM part p JOIN pc USING (p_partkey)"""),
    "x_f1_cliente": """
SELECT 'frota-1' AS nk_frota_origem, c.c_custkey AS nk_id_cliente, 'PF' AS tipo_cliente, c.c_name AS nome,
       lower(c.c_name) || '@mail' AS email, 'SP' AS end_uf, n.n_name AS end_cidade,
       lpad(CAST(c.c_custkey AS VARCHAR), 11, '0') AS cpf
FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "x_f1_reserva": xb("""
SELECT 'frota-1' AS nk_frota_origem, o.o_orderkey AS nk_id_reserva, o.o_custkey AS nk_id_cliente,
       o.o_orderkey % (SELECT n FROM nc) + 1 AS nk_id_grupo, o.o_orderkey % (SELECT n FROM ny) AS nk_id_patio_retirada,
       o.o_custkey % (SELECT n FROM ny) AS nk_id_patio_fim, CAST(o.o_orderdate AS DATE) AS data_reserva,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 AS INTEGER) AS data_retirada_prevista,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 + o.o_orderkey % 12 AS INTEGER) AS data_devolucao_prevista,
       CAST(o.o_orderkey % 12 AS INTEGER) AS duracao_prevista_dias,
       CAST(o.o_totalprice AS DECIMAL(12,2)) AS valor_previsto_reserva,
       CASE o.o_orderkey % 3 WHEN 0 THEN 'ATIVA' WHEN 1 THEN 'CANCELADA' ELSE 'CONVERTIDA' END AS status_reserva
FROM orders o"""),
    "x_f1_locacao": xb(""",
dev AS (SELECT rid, slot % (SELECT n FROM ny) AS yard, d FROM (
          SELECT l_orderkey * 8 + l_linenumber AS rid, l_partkey AS slot,
                 CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 AS INTEGER) AS d,
                 row_number() OVER (PARTITION BY l_orderkey * 8 + l_linenumber
                                    ORDER BY CAST(l_shipdate AS DATE) + CAST(l_orderkey % 10 AS INTEGER) DESC,
                                             l_partkey ASC) AS rn
          FROM lineitem WHERE l_linestatus = 'F') WHERE rn = 1),
ext AS (SELECT l_orderkey * 8 + 1 AS rid, l_orderkey AS res, sum(l_linenumber) AS e FROM lineitem
        WHERE l_linenumber >= 6 GROUP BY 1, 2)
SELECT 'frota-1' AS nk_frota_origem, l.l_orderkey * 8 + l.l_linenumber AS nk_id_locacao, o.o_custkey AS nk_id_cliente,
       l.l_partkey AS nk_id_veiculo, c.gid AS nk_id_grupo, l.l_suppkey AS nk_id_patio_retirada,
       dev.yard AS nk_id_patio_devolucao, CAST(l.l_shipdate AS DATE) AS data_retirada,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 + o.o_orderkey % 12 + coalesce(ext.e, 0) AS INTEGER)
         AS data_prev_devolucao,
       dev.d AS data_real_devolucao, c.rate AS valor_diaria_aplicada,
       CAST(o.o_totalprice AS DECIMAL(12,2)) AS valor_final
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN cls c ON c.gid = o.o_orderkey % (SELECT n FROM nc) + 1
LEFT JOIN dev ON dev.rid = l.l_orderkey * 8 + l.l_linenumber
LEFT JOIN ext ON ext.rid = l.l_orderkey * 8 + l.l_linenumber AND ext.res = l.l_orderkey"""),
    "x_f2_patio": xb(f"""
SELECT 'frota-2' AS nk_frota_origem, s.s_suppkey AS nk_id_patio, s.s_name AS nome_patio,
       CAST(sl.n AS INTEGER) AS capacidade_vagas, CAST(NULL AS VARCHAR) AS end_cidade, CAST(NULL AS VARCHAR) AS end_uf,
       left(concat_ws(' ', {", ".join(["s.s_name"] * 12)}), 150) AS end_logradouro
FROM supplier s LEFT JOIN slots sl ON sl.y = s.s_suppkey"""),
    "x_f2_grupo": xb("""
SELECT 'frota-2' AS nk_frota_origem, gid AS nk_id_grupo, p_type AS nome_grupo, 'G' || CAST(gid AS VARCHAR) AS codigo,
       CAST(coalesce(CASE WHEN gid % 4 <> 0 THEN rate END, 0) AS DECIMAL(12,2)) AS valor_diaria FROM cls"""),
    "x_f2_veiculo": xb("""
SELECT 'frota-2' AS nk_frota_origem, p.p_partkey AS nk_id_veiculo, pc.gid AS nk_id_grupo,
       p.p_partkey % (SELECT n FROM ny) AS nk_id_patio_origem, 'Q' || CAST(p.p_partkey AS VARCHAR) AS placa,
       p.p_brand AS marca, p.p_name AS modelo,
       CASE WHEN p.p_size % 2 = 0 THEN 'MANUAL' ELSE 'AUTOMATICO' END AS mecanizacao,
       p.p_size % 3 = 0 AS tem_ar_condicionado, 2020 AS ano_fabricacao,
       CASE WHEN p.p_size % 10 = 0 THEN 'BAIXADO' ELSE 'ATIVO' END AS situacao
FROM part p JOIN pc USING (p_partkey)"""),
    "x_f2_cliente": """
SELECT 'frota-2' AS nk_frota_origem, c_custkey AS nk_id_cliente,
       CASE WHEN c_custkey % 3 = 0 THEN 'PJ' ELSE 'PF' END AS tipo_cliente, c_name AS nome,
       lower(c_name) || '@mail' AS email, CAST(c_nationkey AS VARCHAR) AS end_cidade,
       CASE WHEN c_custkey % 3 <> 0 THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS cpf,
       CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_custkey AS VARCHAR), 14, '0') END AS cnpj,
       CASE WHEN c_custkey % 3 = 0 THEN 'NF ' || c_name END AS nome_fantasia
FROM customer""",
    "x_f2_reserva": xb(f""",
r AS (SELECT o.*, CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 AS INTEGER) AS st,
             CASE WHEN o.o_orderkey % 5 <> 0
                  THEN CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 + o.o_orderkey % 12 AS INTEGER) END AS en,
             o.o_orderkey % (SELECT n FROM nc) + 1 AS g FROM orders o)
SELECT 'frota-2' AS nk_frota_origem, r.o_orderkey AS nk_id_reserva, r.o_custkey AS nk_id_cliente, r.g AS nk_id_grupo,
       r.o_orderkey % (SELECT n FROM ny) AS nk_id_patio_retirada, r.o_custkey % (SELECT n FROM ny) AS nk_id_patio_fim,
       CAST(r.o_orderdate AS DATE) AS data_reserva, r.st AS data_retirada_prevista, r.en AS data_devolucao_prevista,
       CAST(date_diff('day', r.st, r.en) AS INTEGER) AS duracao_prevista_dias,
       CAST(CAST(date_diff('day', r.st, r.en) AS DECIMAL(10,0)) * coalesce(CASE WHEN c.gid % 4 <> 0 THEN c.rate END, 0)
            AS DECIMAL(12,2)) AS valor_previsto_reserva,
       CASE {pick('r.o_orderkey', ('CONFIRMADA', 'EM_FILA_ESPERA', 'CANCELADA', 'CONCRETIZADA', None))}
            WHEN 'CANCELADA' THEN 'CANCELADA' WHEN 'CONCRETIZADA' THEN 'CONVERTIDA' ELSE 'ATIVA' END AS status_reserva
FROM r LEFT JOIN cls c ON c.gid = r.g"""),
    "x_f2_locacao": xb(""",
paid AS (SELECT l_orderkey * 8 + 1 AS rid, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS v FROM lineitem
         WHERE l_returnflag IN ('A', 'N') GROUP BY 1),
l AS (SELECT li.*, o.o_custkey, li.l_orderkey * 8 + li.l_linenumber AS rid,
             CASE WHEN li.l_linestatus = 'F' THEN li.l_shipdate + to_days(CAST(li.l_orderkey % 10 AS INTEGER)) END AS real_ts,
             CASE WHEN li.l_linenumber <> 7 AND li.l_orderkey % 5 <> 0
                  THEN o.o_orderdate + to_days(CAST(li.l_orderkey % 30 + li.l_orderkey % 12 AS INTEGER)) END AS planned_ts
      FROM lineitem li JOIN orders o ON o.o_orderkey = li.l_orderkey)
SELECT 'frota-2' AS nk_frota_origem, l.rid AS nk_id_locacao, l.o_custkey AS nk_id_cliente, l.l_partkey AS nk_id_veiculo,
       pc.gid AS nk_id_grupo, l.l_suppkey AS nk_id_patio_retirada,
       CASE WHEN l.real_ts IS NOT NULL THEN (l.l_suppkey + l.l_linenumber) % (SELECT n FROM ny) END AS nk_id_patio_devolucao,
       CAST(l.l_shipdate AS DATE) AS data_retirada,
       CAST(coalesce(l.planned_ts, l.real_ts, l.l_shipdate) AS DATE) AS data_prev_devolucao,
       CAST(l.real_ts AS DATE) AS data_real_devolucao, CAST(NULL AS DECIMAL(12,2)) AS valor_diaria_aplicada,
       CAST(coalesce(paid.v, 0) AS DECIMAL(14,2)) AS valor_final
FROM l JOIN pc ON pc.p_partkey = l.l_partkey LEFT JOIN paid ON paid.rid = l.rid"""),
    "x_f3_patio": """
SELECT 'frota-3' AS nk_frota_origem, s.s_suppkey AS nk_id_patio, s.s_name AS nome_patio,
       CASE WHEN s.s_suppkey % 5 <> 0 THEN 50 END AS capacidade_vagas,
       CASE WHEN s.s_suppkey % 9 <> 0 THEN n.n_name END AS end_cidade,
       CASE WHEN s.s_suppkey % 9 <> 0 THEN 'RJ' END AS end_uf,
       CASE WHEN s.s_suppkey % 9 <> 0 THEN 'Av' END AS end_logradouro
FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "x_f3_grupo": xb("""
SELECT 'frota-3' AS nk_frota_origem, gid AS nk_id_grupo, p_type AS nome_grupo,
       CAST(coalesce(CASE WHEN gid % 3 <> 0 THEN rate END, 0) AS DECIMAL(12,2)) AS valor_diaria FROM cls"""),
    "x_f3_veiculo": xb(f""",
v AS (SELECT p.*, pc.gid, {pick('p.p_size', RAW_T7)} AS tc FROM part p JOIN pc USING (p_partkey))
SELECT 'frota-3' AS nk_frota_origem, p_partkey AS nk_id_veiculo, gid AS nk_id_grupo,
       CASE WHEN p_partkey % 4 <> 0 THEN p_partkey % (SELECT n FROM ny) END AS nk_id_patio_origem,
       CAST(p_partkey AS VARCHAR) AS placa, p_brand AS marca, p_name AS modelo,
       CASE upper(trim(coalesce(tc, ''))) WHEN 'MANUAL' THEN 'MANUAL' WHEN 'AUTOMATICO' THEN 'AUTOMATICO'
            WHEN 'AUTOMATICA' THEN 'AUTOMATICO' ELSE tc END AS mecanizacao,
       CAST(coalesce(CASE WHEN p_size % 3 <> 0 THEN p_size % 2 END, 0) AS BOOLEAN) AS tem_ar_condicionado,
       2021 AS ano_fabricacao, 'OK' AS situacao
FROM v"""),
    "x_f3_cliente": f"""
WITH c AS (SELECT c_custkey, c_name, c_nationkey, {pick('c_custkey', ('PF', 'pj', ' pf', 'XX'))} AS t FROM customer)
SELECT 'frota-3' AS nk_frota_origem, c.c_custkey AS nk_id_cliente, c.t AS tipo_cliente,
       CASE WHEN upper(trim(c.t)) = 'PF' THEN CASE WHEN c.c_custkey % 2 = 0 THEN c.c_name END
            WHEN upper(trim(c.t)) = 'PJ' THEN CASE WHEN c.c_custkey % 2 = 1 THEN 'RS ' || c.c_name END
            ELSE coalesce(CASE WHEN c.c_custkey % 2 = 0 THEN c.c_name END,
                          CASE WHEN c.c_custkey % 2 = 1 THEN 'RS ' || c.c_name END, 'NÃO INFORMADO') END AS nome,
       CAST(NULL AS VARCHAR) AS email, 'RJ' AS end_uf, n.n_name AS end_cidade,
       CASE WHEN c.c_custkey % 2 = 0 THEN CAST(c.c_custkey AS VARCHAR) END AS cpf,
       CASE WHEN c.c_custkey % 2 = 1 THEN CAST(c.c_custkey AS VARCHAR) END AS cnpj,
       CAST(NULL AS VARCHAR) AS Nome_fantasia
FROM c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "x_f3_reserva": xb(f""",
r AS (SELECT o.*, {pick('o.o_orderkey', RAW_S16)} AS st FROM orders o)
SELECT 'frota-3' AS nk_frota_origem, o_orderkey AS nk_id_reserva, o_custkey AS nk_id_cliente,
       o_orderkey % (SELECT n FROM nc) + 1 AS nk_id_grupo, o_orderkey % (SELECT n FROM ny) AS nk_id_patio_retirada,
       o_custkey % (SELECT n FROM ny) AS nk_id_patio_fim, CAST(o_orderdate AS DATE) AS data_reserva,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS data_retirada_prevista,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 + o_orderkey % 12 AS INTEGER) AS data_devolucao_prevista,
       CAST(o_orderkey % 12 AS INTEGER) AS duracao_prevista_dias,
       CAST(o_totalprice AS DECIMAL(12,2)) AS valor_previsto_reserva, {F3_STATUS.format(x='st')} AS status_reserva
FROM r"""),
    "x_f3_locacao": xb("""
SELECT 'frota-3' AS nk_frota_origem, l.l_orderkey * 8 + l.l_linenumber AS nk_id_locacao, o.o_custkey AS nk_id_cliente,
       l.l_partkey AS nk_id_veiculo, pc.gid AS nk_id_grupo, l.l_suppkey AS nk_id_patio_retirada,
       CASE WHEN l.l_linestatus = 'F' THEN (l.l_suppkey + 1) % (SELECT n FROM ny) END AS nk_id_patio_devolucao,
       CAST(l.l_shipdate AS DATE) AS data_retirada,
       CAST(o.o_orderdate AS DATE) + CAST(o.o_orderkey % 30 + o.o_orderkey % 12 AS INTEGER) AS data_prev_devolucao,
       CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_shipdate AS DATE) + CAST(l.l_orderkey % 10 AS INTEGER) END
         AS data_real_devolucao,
       CASE WHEN pc.gid % 3 <> 0 THEN pc.rate END AS valor_diaria_aplicada,
       CAST(l.l_extendedprice AS DECIMAL(14,2)) AS valor_final
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN pc ON pc.p_partkey = l.l_partkey"""),
    "x_f4_patio": """
SELECT 'frota-4' AS nk_frota_origem, s_suppkey AS nk_id_patio, s_name AS nome_patio,
       CAST(NULL AS INTEGER) AS capacidade_vagas, CAST(NULL AS VARCHAR) AS end_cidade, CAST(NULL AS VARCHAR) AS end_uf,
       CAST(NULL AS VARCHAR) AS localizacao, CAST(s_suppkey AS VARCHAR) AS codigo_patio FROM supplier""",
    "x_f4_grupo": xb("""
SELECT 'frota-4' AS nk_frota_origem, gid AS nk_id_grupo, p_type AS nome_grupo,
       CAST(rate AS DECIMAL(10,2)) AS valor_diaria FROM cls"""),
    "x_f4_veiculo": xb(f"""
SELECT 'frota-4' AS nk_frota_origem, p.p_partkey AS nk_id_veiculo, pc.gid AS nk_id_grupo,
       p.p_partkey % (SELECT n FROM ny) AS nk_id_patio_origem,
       CASE WHEN p.p_partkey % 11 <> 0 THEN ' ab1 ' END AS placa, p.p_brand AS marca, p.p_name AS modelo,
       {pick('p.p_size', ('Automática', 'manual', 'CVT'))} AS mecanizacao, p.p_size % 2 = 0 AS tem_ar_condicionado,
       {pick('p.p_partkey', ('DISPONIVEL', 'ALUGADO', 'MANUTENCAO', 'RESERVADO'))} AS status
FROM part p JOIN pc USING (p_partkey)"""),
    "x_f4_cliente": f"""
SELECT 'frota-4' AS nk_frota_origem, c_custkey AS nk_id_cliente,
       {pick('c_custkey', ('PF', 'PJ', None))} AS tipo_cliente, c_name AS nome,
       CAST(c_nationkey AS VARCHAR) AS end_cidade, 'MG' AS end_uf, CAST(NULL AS VARCHAR) AS email FROM customer""",
    "x_f4_reserva": xb(f"""
SELECT 'frota-4' AS nk_frota_origem, o_orderkey AS nk_id_reserva, o_custkey AS nk_id_cliente,
       o_orderkey % (SELECT n FROM nc) + 1 AS nk_id_grupo, o_orderkey % (SELECT n FROM ny) AS nk_id_patio_retirada,
       o_custkey % (SELECT n FROM ny) AS nk_id_patio_fim, CAST(o_orderdate AS DATE) AS data_reserva,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 AS INTEGER) AS data_retirada_prevista,
       CAST(o_orderdate AS DATE) + CAST(o_orderkey % 30 + o_orderkey % 12 AS INTEGER) AS data_devolucao_prevista,
       {pick('o_orderkey', ('ativa', 'CANCELADA', 'Convertida', 'outra'))} AS status_reserva
FROM orders"""),
    "x_f4_locacao": xb("""
SELECT 'frota-4' AS nk_frota_origem, l.l_orderkey * 8 + l.l_linenumber AS nk_id_locacao, o.o_custkey AS nk_id_cliente,
       l.l_partkey AS nk_id_veiculo, pc.gid AS nk_id_grupo, l.l_suppkey AS nk_id_patio_retirada,
       CASE WHEN l.l_linestatus = 'F' THEN l.l_suppkey END AS nk_id_patio_devolucao,
       CAST(l.l_shipdate AS DATE) AS data_retirada,
       CAST(l.l_shipdate AS DATE) + CAST(l.l_linenumber AS INTEGER) AS data_prev_devolucao,
       CASE WHEN l.l_linestatus = 'F' THEN CAST(l.l_shipdate AS DATE) + CAST(l.l_orderkey % 10 AS INTEGER) END
         AS data_real_devolucao,
       CAST(l.l_extendedprice AS DECIMAL(10,2)) AS valor_final
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey LEFT JOIN pc ON pc.p_partkey = l.l_partkey"""),
}
ORACLES.update(EXTRACTS)
ORACLES["s7_seed_if_empty"] = OPS["d4_calendar"]
