"""Audits: reject summary (G9), latest rejects (O6), table counts (U-1),
constraint audit (Q-C) -- the checks Spark does not enforce on write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locastar.functions.quality import distinct_list
from locastar.operators.facts import INV_REASONS, RENTAL_REASONS, RESERVATION_REASONS, RETURN_YARD_WARNING


#: Beginnings of reasons that end with the missing value.
VALUE_REASONS = (*INV_REASONS, *RENTAL_REASONS, *RESERVATION_REASONS, RETURN_YARD_WARNING)


def reason_parts(reason: Column) -> tuple[Column, Column]:
    """(template, value): a reason without its value, and the value where it has one."""
    template = reduce(lambda out, p: F.when(reason.startswith(p), F.lit(p)).otherwise(out), VALUE_REASONS, reason)
    return template, F.when(F.length(reason) > F.length(template), F.substring(reason, F.length(template) + 1, F.length(reason)))


def reject_reasons(rejects: DataFrame, fleet: str | None = None) -> DataFrame:
    """One row per source table and reason template, with its rejects, their
    times, and the smallest and the largest value: no cell grows with the values."""
    r = rejects if fleet is None else rejects.where(F.col("nk_frota_origem") == fleet)
    template, value = reason_parts(F.col("motivo_rejeito"))
    return (r.select("tabela_origem", template.alias("motivo"), value.alias("_v"), "dt_rejeito")
            .groupBy("tabela_origem", "motivo")
            .agg(F.count(F.lit(1)).alias("total_rejeitos"), F.min("dt_rejeito").alias("primeiro_rejeito"),
                 F.max("dt_rejeito").alias("ultimo_rejeito"), F.min("_v").alias("menor_valor"), F.max("_v").alias("maior_valor")))


def reject_summary(rejects: DataFrame, fleet: str | None = None) -> DataFrame:
    """Per source table: count, first/last reject time, distinct reasons. The
    list is made of one row per template, so it is as long as the rules are many."""
    return (reject_reasons(rejects, fleet).groupBy("tabela_origem")
            .agg(F.sum("total_rejeitos").alias("total_rejeitos"), F.min("primeiro_rejeito").alias("primeiro_rejeito"),
                 F.max("ultimo_rejeito").alias("ultimo_rejeito"), distinct_list("motivo").alias("motivos")))


def latest_rejects(rejects: DataFrame, n: int = 50) -> DataFrame:
    """The newest ``n`` rejects (a top-k report: the limit is the feature)."""
    return rejects.orderBy(F.col("dt_rejeito").desc(), F.col("tabela_origem"),
                           F.col("nk_frota_origem"), F.col("nk_id_registro").desc(),
                           F.col("motivo_rejeito")).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """U-1: (table, rows) for every table, one plan."""
    parts = [df.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(n).alias("tabela"), "registros")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _dup(df: DataFrame, keys) -> DataFrame:
    """Rows beyond the first per key (0 when the key is unique)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("v")))


def _fk(df: DataFrame, col: str, dim: DataFrame, dim_col: str) -> DataFrame:
    """Rows whose (non-NULL) key is missing in the dimension: rows are first
    counted per key (map-side combined), then the per-key counts are
    anti-joined with the dimension keys -- fact rows are never shuffled."""
    per_key = (df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_fk"))
               .agg(F.count(F.lit(1)).alias("n")))
    miss = per_key.join(dim.select(F.col(dim_col).alias("_k")), F.col("_fk") == F.col("_k"), "left_anti")
    return miss.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v"))


# Declared widths of the warehouse text columns (VARCHAR(n)).
WIDTHS = {
    "dim_endereco": {"cidade": 100, "estado": 100, "pais": 100},
    "dim_cliente": {"nk_frota_origem": 100, "tipo_cliente": 2, "nome": 150},
    "dim_veiculo": {"nk_frota_origem": 100, "placa": 10, "marca": 50, "modelo": 60, "mecanizacao": 20},
    "dim_grupo": {"nk_frota_origem": 100, "nome_grupo": 80},
    "dim_patio": {"nk_frota_origem": 100, "nome_patio": 100},
}
# NOT NULL columns per table.
NOT_NULL = {
    "dim_endereco": ["sk_endereco", "cidade", "estado", "pais"],
    "dim_cliente": ["sk_cliente", "nk_frota_origem", "nk_id_cliente"],
    "dim_veiculo": ["sk_veiculo", "nk_frota_origem", "nk_id_veiculo"],
    "dim_grupo": ["sk_grupo", "nk_frota_origem", "nk_id_grupo"],
    "dim_patio": ["sk_patio", "nk_frota_origem", "nk_id_patio"],
    "dim_tempo": ["sk_tempo", "data"],
    "fato_inventario_patio": ["sk_tempo_referencia", "sk_patio", "sk_veiculo", "sk_grupo"],
    "fato_locacao": ["nk_frota_origem", "nk_id_locacao", "sk_tempo_retirada", "sk_tempo_prev_devolucao",
                     "sk_cliente", "sk_veiculo", "sk_grupo", "sk_patio_retirada"],
    "fato_reserva": ["nk_frota_origem", "nk_id_reserva", "sk_tempo_reserva", "sk_tempo_prev_retirada",
                     "sk_tempo_prev_devolucao", "sk_cliente", "sk_grupo", "sk_patio_retirada", "sk_patio_fim"],
}


def _row_checks() -> dict[str, list[tuple[str, object]]]:
    """Row-level checks (CHECK, NOT NULL, width) per table: (name, failing condition)."""
    c = F.col
    checks: dict[str, list] = {
        "dim_cliente": [("ck_tipo", ~c("tipo_cliente").isin("PF", "PJ"))],
        "dim_veiculo": [("ck_mecanizacao", ~c("mecanizacao").isin("MANUAL", "AUTOMATICO", "NÃO INFORMADO"))],
        "dim_grupo": [("ck_valor_diaria", c("valor_diaria") < 0)],
        "fato_inventario_patio": [("ck_qtde", c("qtde_veiculos_presentes") != 1)],
        "fato_locacao": [("ck_valor", c("valor_final") < 0), ("ck_qtde", c("qtde_locacoes") != 1)],
        "fato_reserva": [
            ("ck_status", ~c("dd_status_reserva").isin("ATIVA", "CANCELADA", "CONVERTIDA")),
            ("ck_duracao", c("duracao_prevista_dias") < 1), ("ck_valor", c("valor_previsto_reserva") < 0),
            ("ck_qtde", c("qtde_reservas") != 1)],
    }
    for t, cols in NOT_NULL.items():
        checks.setdefault(t, []).extend((f"nn_{x}", c(x).isNull()) for x in cols)
    for t, widths in WIDTHS.items():
        checks.setdefault(t, []).extend((f"len_{x}", F.length(x) > n) for x, n in widths.items())
    return checks


def audit_constraints(dw: dict[str, DataFrame]) -> DataFrame:
    """Q-C: one row per declared constraint with its violation count.

    Row-level checks of a table run as ONE aggregation (one scan of the
    table, every check a conditional count); key uniqueness is a group-by on
    the key and foreign keys an anti join on distinct keys.
    """
    parts = []
    for t, checks in _row_checks().items():
        agg = dw[t].agg(*[F.count(F.when(bad, 1)).alias(f"_c{i}") for i, (_, bad) in enumerate(checks)])
        pairs = F.explode(F.array(*[F.struct(F.lit(name).alias("restricao"), F.col(f"_c{i}").alias("v"))
                                    for i, (name, _) in enumerate(checks)])).alias("x")
        parts.append(agg.select(pairs).select(F.lit(t).alias("tabela"), "x.restricao",
                                              F.col("x.v").cast("long").alias("violacoes")))
    keyed = [
        ("dim_endereco", "uk_endereco", _dup(dw["dim_endereco"], ["cidade", "estado", "pais"])),
        ("dim_endereco", "pk", _dup(dw["dim_endereco"], ["sk_endereco"])),
        ("dim_cliente", "pk", _dup(dw["dim_cliente"], ["sk_cliente"])),
        ("dim_cliente", "uk_nk", _dup(dw["dim_cliente"], ["nk_frota_origem", "nk_id_cliente"])),
        ("dim_cliente", "fk_endereco", _fk(dw["dim_cliente"], "sk_endereco", dw["dim_endereco"], "sk_endereco")),
        ("dim_veiculo", "pk", _dup(dw["dim_veiculo"], ["sk_veiculo"])),
        ("dim_veiculo", "uk_nk", _dup(dw["dim_veiculo"], ["nk_frota_origem", "nk_id_veiculo"])),
        ("dim_grupo", "pk", _dup(dw["dim_grupo"], ["sk_grupo"])),
        ("dim_grupo", "uk_nk", _dup(dw["dim_grupo"], ["nk_frota_origem", "nk_id_grupo"])),
        ("dim_patio", "pk", _dup(dw["dim_patio"], ["sk_patio"])),
        ("dim_patio", "uk_nk", _dup(dw["dim_patio"], ["nk_frota_origem", "nk_id_patio"])),
        ("dim_patio", "fk_endereco", _fk(dw["dim_patio"], "sk_endereco", dw["dim_endereco"], "sk_endereco")),
        ("dim_tempo", "pk", _dup(dw["dim_tempo"], ["sk_tempo"])),
        ("dim_tempo", "uk_data", _dup(dw["dim_tempo"], ["data"])),
        ("fato_inventario_patio", "pk",
         _dup(dw["fato_inventario_patio"], ["sk_tempo_referencia", "sk_patio", "sk_veiculo"])),
        ("fato_inventario_patio", "fk_patio",
         _fk(dw["fato_inventario_patio"], "sk_patio", dw["dim_patio"], "sk_patio")),
        ("fato_locacao", "pk", _dup(dw["fato_locacao"], ["nk_frota_origem", "nk_id_locacao"])),
        ("fato_locacao", "fk_cliente", _fk(dw["fato_locacao"], "sk_cliente", dw["dim_cliente"], "sk_cliente")),
        ("fato_locacao", "fk_patio_devolucao",
         _fk(dw["fato_locacao"], "sk_patio_devolucao_real", dw["dim_patio"], "sk_patio")),
        ("fato_reserva", "pk", _dup(dw["fato_reserva"], ["nk_frota_origem", "nk_id_reserva"])),
        ("fato_reserva", "fk_grupo", _fk(dw["fato_reserva"], "sk_grupo", dw["dim_grupo"], "sk_grupo")),
    ]
    parts += [v.select(F.lit(t).alias("tabela"), F.lit(k).alias("restricao"),
                       F.col("v").cast("long").alias("violacoes")) for t, k, v in keyed]
    return reduce(DataFrame.unionByName, parts)
