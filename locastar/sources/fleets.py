"""Fleet registry and per-source configuration.

The four source systems implement the same semantics with small differences;
those differences live here as data, and every operator is written once.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from locastar.functions import domain

# Fleet codes stored in nk_frota_origem, in source order F1..F4. Neutral
# codes: deployments set their own labels here (the registry order is what
# the surrogate-key rule depends on, never the text).
FLEETS = ("frota-1", "frota-2", "frota-3", "frota-4")

# Surrogate keys are fleet_index * KEY_SPACE + natural id. Natural ids are
# non-negative integers below 2**32 in every source, so the composite is unique, needs no global
# counter or ordering step, and is identical on every re-run.
KEY_SPACE = 1 << 32


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def fleet_index(fleet: Column | str) -> Column:
    """1-based position of the fleet in the registry (0 when unknown)."""
    return F.array_position(F.array(*[F.lit(f) for f in FLEETS]), _c(fleet))


def fleet_by_position(k: Column | str) -> Column:
    """Fleet name for a non-negative integer: FLEETS[k mod 4]."""
    return F.element_at(F.array(*[F.lit(f) for f in FLEETS]),
                        (_c(k) % len(FLEETS) + 1).cast("int"))


def surrogate_key(fleet: Column | str, nk: Column | str) -> Column:
    """Stable surrogate key of (fleet, natural id); NULL when the id is NULL.

    An id beyond 32 bits would share its key with another row: the job ends
    instead. Fleets outside the registry have position 0; the nightly job
    refuses them (plans.nightly.known_fleets).
    """
    n = _c(nk).cast("long")
    what = F.concat(F.lit("no surrogate key for id "), n.cast("string"))
    return F.when((n < 0) | (n >= KEY_SPACE), F.raise_error(what).cast("long")) \
        .otherwise(fleet_index(fleet).cast("long") * F.lit(KEY_SPACE) + n)


@dataclass(frozen=True)
class SourceConfig:
    """Per-source deltas of the conform rules."""

    fleet: str
    status_synonyms: dict = field(default_factory=lambda: dict(domain.STATUS_SYNONYMS_DW))
    duration_floor: int | None = None          # F3 floors planned duration at 1
    compute_planned_value: bool = False        # F4: days x class rate
    group_name_uses_code: bool = False         # F2, F3: name -> code -> 'GRUPO id'
    vehicle_requires_home_yard: bool = False   # F2 rejects vehicles without home yard
    plate_default: str | None = None           # F4: blank plate -> 'SEM PLACA'
    home_yard_default: int | None = None       # F3: NULL home yard -> 0
    yard_address_sentinel: bool = False        # F4: yard city/UF always sentinels
    snapshot_offset_days: int = 1              # F1/F2 snapshot yesterday, F3/F4 today
    return_yard_warning: bool = False          # F3: unknown return yard is a warning
    # C4, C11, C14: texts, rules and payloads that differ (None: operators.conform's own)
    customer_reason: str | None = None
    vehicle_reason: str | None = None
    snapshot_reason: str | None = None
    date_order_reason: str | None = None
    own_duration: bool | None = None           # F1-F3: the source's own duration must be a day; F4: no such rule
    reservation_payload: tuple[str, ...] | None = None
    rental_payload: tuple[str, ...] | None = None


# Fields of the reject payloads (C14).
RESERVATION_FIELDS = ("nk_id_reserva", "nk_id_cliente", "nk_id_grupo", "nk_id_patio_retirada", "nk_id_patio_fim",
                      "data_reserva", "data_retirada_prevista", "data_devolucao_prevista")
OWN_RESERVATION_FIELDS = (*RESERVATION_FIELDS, "duracao_prevista_dias", "status_reserva")
RENTAL_FIELDS = ("nk_id_locacao", "nk_id_cliente", "nk_id_veiculo", "nk_id_grupo", "nk_id_patio_retirada",
                 "data_retirada", "data_prev_devolucao", "data_real_devolucao")
OWN_RENTAL_FIELDS = (*RENTAL_FIELDS, "valor_final")

# Each source's reject texts.
SOURCES = {
    FLEETS[0]: SourceConfig(FLEETS[0], own_duration=True,
                            customer_reason="Cliente sem tipo_cliente válido",
                            vehicle_reason="Veículo sem nk_id_grupo",
                            snapshot_reason="Snapshot sem chaves válidas",
                            reservation_payload=OWN_RESERVATION_FIELDS, rental_payload=OWN_RENTAL_FIELDS),
    FLEETS[1]: SourceConfig(FLEETS[1], group_name_uses_code=True,
                            vehicle_requires_home_yard=True, own_duration=True,
                            customer_reason="Cliente sem tipo_cliente (PF/PJ)",
                            vehicle_reason="Veículo sem nk_id_grupo ou sem nk_id_patio_origem",
                            snapshot_reason="Snapshot sem pátio, veículo ou grupo válidos",
                            reservation_payload=OWN_RESERVATION_FIELDS, rental_payload=OWN_RENTAL_FIELDS),
    FLEETS[2]: SourceConfig(FLEETS[2], duration_floor=1, group_name_uses_code=True,
                            home_yard_default=0, snapshot_offset_days=0,
                            return_yard_warning=True, own_duration=True,
                            customer_reason="Cliente sem tipo_cliente (PF/PJ)",
                            vehicle_reason="Veículo sem nk_id_grupo (Id_categoria)",
                            snapshot_reason="Snapshot sem pátio, veículo ou grupo válidos",
                            reservation_payload=OWN_RESERVATION_FIELDS, rental_payload=OWN_RENTAL_FIELDS),
    FLEETS[3]: SourceConfig(FLEETS[3], compute_planned_value=True, plate_default="SEM PLACA",
                            yard_address_sentinel=True, snapshot_offset_days=0, own_duration=False,
                            customer_reason="Cliente sem tipo_cliente válido (PF/PJ)",
                            vehicle_reason="Veículo sem id_grupo",
                            snapshot_reason="Snapshot sem chaves válidas (patio/veiculo/grupo/data)",
                            date_order_reason="Data devolução <= data retirada (duração < 1)",
                            rental_payload=OWN_RENTAL_FIELDS),
}
