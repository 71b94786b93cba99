"""Domain maps (C4, C5, C6): normalise a code and map synonyms to the DW vocabulary.

Each map is data; ``map_domain`` turns it into one map-literal lookup that
stays inside whole-stage code generation.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transmission synonyms (union of the four source maps) -> DW value.
TRANSMISSION_SYNONYMS = {
    "MANUAL": "MANUAL",
    "AUTOMATICO": "AUTOMATICO",
    "AUTOMÁTICO": "AUTOMATICO",
    "AUTOMATICA": "AUTOMATICO",
    "AUTOMÁTICA": "AUTOMATICO",
}
TRANSMISSION_DEFAULT = "NÃO INFORMADO"

# Reservation status vocabulary of the DW and its default.
STATUS_VALUES = ("ATIVA", "CANCELADA", "CONVERTIDA")
STATUS_DEFAULT = "ATIVA"

# Reservation status synonyms per source system.
STATUS_SYNONYMS_F1 = {"0": "ATIVA", "1": "CANCELADA", "2": "CONVERTIDA"}
STATUS_SYNONYMS_F2 = {
    "CONFIRMADA": "ATIVA",
    "EM_FILA_ESPERA": "ATIVA",
    "CANCELADA": "CANCELADA",
    "CONCRETIZADA": "CONVERTIDA",
}
STATUS_SYNONYMS_F3 = {
    "ATIVO": "ATIVA",
    "ATIVA": "ATIVA",
    "ACTIVE": "ATIVA",
    "ABERTA": "ATIVA",
    "CANCELADO": "CANCELADA",
    "CANCELADA": "CANCELADA",
    "CANCEL": "CANCELADA",
    "CONVERTIDO": "CONVERTIDA",
    "CONVERTIDA": "CONVERTIDA",
    "CONCLUIDO": "CONVERTIDA",
    "CONCLUIDA": "CONVERTIDA",
    "FINALIZADO": "CONVERTIDA",
    "FINALIZADA": "CONVERTIDA",
}
STATUS_SYNONYMS_DW = {"ATIVA": "ATIVA", "CANCELADA": "CANCELADA", "CONVERTIDA": "CONVERTIDA"}

# Customer type domain.
CUSTOMER_TYPES = ("PF", "PJ")


def normalise(c: Column | str) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.upper(F.trim(col.cast("string")))


def map_domain(c: Column | str, synonyms: dict[str, str], default: str | None = None,
               passthrough: bool = False, trim_passthrough: bool = True) -> Column:
    """Map ``upper(trim(c))`` through ``synonyms``.

    Unmatched values become ``default``; with ``passthrough`` they keep the
    raw text (trimmed unless ``trim_passthrough`` is False), falling back to
    ``default`` for NULL.
    """
    col = F.col(c) if isinstance(c, str) else c
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(synonyms.items())])
    mapped = lookup[normalise(col)]
    if passthrough:
        raw = F.trim(col.cast("string")) if trim_passthrough else col.cast("string")
        return F.coalesce(mapped, raw, F.lit(default))
    return F.coalesce(mapped, F.lit(default)) if default is not None else mapped


def transmission(c: Column | str) -> Column:
    """Transmission text -> MANUAL / AUTOMATICO / NÃO INFORMADO."""
    return map_domain(c, TRANSMISSION_SYNONYMS, TRANSMISSION_DEFAULT)


def transmission_from_flag(flag: Column | str) -> Column:
    """F1 extract: automatic-steering flag 1 -> AUTOMATICO, anything else MANUAL."""
    f = F.col(flag) if isinstance(flag, str) else flag
    return F.when(f == 1, F.lit("AUTOMATICO")).otherwise(F.lit("MANUAL"))


def reservation_status(c: Column | str, synonyms: dict[str, str] | None = None) -> Column:
    """Status -> ATIVA / CANCELADA / CONVERTIDA, default ATIVA."""
    return map_domain(c, synonyms or STATUS_SYNONYMS_DW, STATUS_DEFAULT)


def customer_type(c: Column | str) -> Column:
    """C4 (normalise first, as F4): ' pf ' -> 'PF'; anything outside PF/PJ -> NULL."""
    n = normalise(c)
    return F.when(n.isin(*CUSTOMER_TYPES), n)
