"""Declared schemas of the warehouse tables (S9: read with a declared schema,
no inference). DDL types: INT keys are LongType (composite surrogate keys),
money is DECIMAL, calendar keys are yyyymmdd INT."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DW_SCHEMAS = {
    "dim_tempo": "sk_tempo int, data date",
    "dim_endereco": "sk_endereco bigint, cidade string, estado string, pais string",
    "dim_patio": "sk_patio bigint, nk_frota_origem string, nk_id_patio bigint, nome_patio string, "
                 "capacidade_vagas_patio int, sk_endereco bigint",
    "dim_grupo": "sk_grupo bigint, nk_frota_origem string, nk_id_grupo bigint, nome_grupo string, "
                 "valor_diaria decimal(12,2)",
    "dim_veiculo": "sk_veiculo bigint, nk_frota_origem string, nk_id_veiculo bigint, placa string, marca string, "
                   "modelo string, mecanizacao string, tem_ar_condicionado boolean",
    "dim_cliente": "sk_cliente bigint, nk_frota_origem string, nk_id_cliente bigint, tipo_cliente string, "
                   "nome string, sk_endereco bigint",
    "fato_inventario_patio": "sk_patio bigint, sk_veiculo bigint, sk_grupo bigint, qtde_veiculos_presentes int, "
                             "sk_tempo_referencia int",
    "fato_locacao": "nk_id_locacao bigint, sk_tempo_retirada int, sk_tempo_prev_devolucao int, "
                    "sk_tempo_real_devolucao int, sk_cliente bigint, sk_veiculo bigint, sk_grupo bigint, "
                    "sk_patio_retirada bigint, sk_patio_devolucao_real bigint, valor_final decimal(14,2), "
                    "qtde_locacoes int, nk_frota_origem string",
    "fato_reserva": "nk_id_reserva bigint, sk_tempo_reserva int, sk_tempo_prev_retirada int, "
                    "sk_tempo_prev_devolucao int, sk_cliente bigint, sk_grupo bigint, sk_patio_retirada bigint, "
                    "sk_patio_fim bigint, duracao_prevista_dias int, valor_previsto_reserva decimal(12,2), "
                    "dd_status_reserva string, qtde_reservas int, nk_frota_origem string",
}


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A warehouse table read with its declared schema (partition columns included)."""
    return spark.read.schema(DW_SCHEMAS[name]).parquet(path)
