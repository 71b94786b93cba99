"""Text conform rules (C1, C2, C15, C16, C17) as Column -> Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinel texts stored by the conform rules.
NOT_INFORMED = "NÃO INFORMADO"
NOT_IDENTIFIED = "NÃO IDENTIFICADO"
UNKNOWN_UF = "XX"
NO_PLATE = "SEM PLACA"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def capitalise(c: Column | str) -> Column:
    """Trim, first character upper, the rest lower ('  SÃO JOSÉ ' -> 'São josé').

    Not ``initcap``: only the first character of the whole value is upper.
    """
    t = F.trim(_c(c))
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(t.substr(F.lit(2), F.length(t))))


def blank_to(c: Column | str, default: str) -> Column:
    """NULL or blank (after trim) -> ``default``; otherwise the trimmed value."""
    return F.coalesce(F.nullif(F.trim(_c(c)), F.lit("")), F.lit(default))


def null_to(c: Column | str, value) -> Column:
    """NULL -> ``value``."""
    return F.coalesce(_c(c), F.lit(value))


def name_or(*cs: Column | str, prefix: str, id: Column | str) -> Column:
    """First non-blank name, else ``prefix + id`` ('GRUPO 7')."""
    parts = [F.nullif(F.trim(_c(c)), F.lit("")) for c in cs]
    return F.coalesce(*parts, F.concat(F.lit(prefix), _c(id).cast("string")))


def plate(c: Column | str, default: str | None = None) -> Column:
    """upper/trim; blank -> ``default`` when one is given (F4 uses 'SEM PLACA')."""
    p = F.upper(F.trim(_c(c)))
    if default is None:
        return p
    return F.coalesce(F.nullif(p, F.lit("")), F.lit(default))


def capitalise_or(c: Column | str, default: str) -> Column:
    """C1 applied after a NULL default (brand/model: NULL -> 'NÃO INFORMADO')."""
    return capitalise(F.coalesce(_c(c), F.lit(default)))


def truncate(c: Column | str, n: int) -> Column:
    """LEFT(s, n)."""
    return F.substring(_c(c), 1, n)
