"""Dimension load (D1-D5, U1, U-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.functions.dates import date_key
from locastar.operators.merge import latest_per_key, new_rows
from locastar.operators.numbering import row_numbers
from locastar.sources.fleets import surrogate_key

ADDRESS_KEY = ["cidade", "estado", "pais"]


def address_dim(current: DataFrame, yards: DataFrame, customers: DataFrame,
                collation: str | None = None) -> DataFrame:
    """The stored addresses and the new ones."""
    return current.select("sk_endereco", *ADDRESS_KEY).unionByName(new_addresses(current, yards, customers, collation))


def new_addresses(current: DataFrame, yards: DataFrame, customers: DataFrame,
                  collation: str | None = None) -> DataFrame:
    """Distinct (city, UF, country) of yards then customers; insert only new.

    New rows get ``max(sk) + n`` in natural-key order, numbered range by range
    (free-text cities make the dimension grow).

    ``collation`` (e.g. "UNICODE_CI_AI", the reference database's case- and
    accent-insensitive comparison) makes 'São Paulo' and 'SAO PAULO' one
    address; the stored spelling is the smallest one. Default: binary.
    """
    def pick(df, a, b, c):
        return df.select(F.col(a).alias("cidade"), F.col(b).alias("estado"), F.col(c).alias("pais"))
    inc = (pick(yards, "end_cidade", "end_uf", "end_pais")
           .unionByName(pick(customers, "end_cidade", "end_uf", "end_pais")))
    if collation:
        inc = (inc.groupBy(*[F.collate(F.col(c), collation).alias(f"_k_{c}") for c in ADDRESS_KEY])
               .agg(*[F.min(c).alias(c) for c in ADDRESS_KEY]).select(*ADDRESS_KEY))
        cur = current.select(*[F.collate(F.col(c), collation).alias(f"_k_{c}") for c in ADDRESS_KEY])
        cond = [F.collate(F.col(c), collation) == F.col(f"_k_{c}") for c in ADDRESS_KEY]
        add = inc.join(cur, cond, "left_anti")
    else:
        add = new_rows(current, inc.distinct(), ADDRESS_KEY)
    base = current.agg(F.coalesce(F.max("sk_endereco"), F.lit(0)).cast("long")).first()[0]
    return row_numbers(add.select(*ADDRESS_KEY), ADDRESS_KEY, "sk_endereco", base).select("sk_endereco", *ADDRESS_KEY)


def empty_address(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "sk_endereco long, cidade string, estado string, pais string")


def with_address_key(df: DataFrame, address: DataFrame, collation: str | None = None) -> DataFrame:
    """D3: sk_endereco by (city, UF, country); unmatched -> NULL. Free-text cities make the
    dimension grow, so its size at run time chooses the join.
    With ``collation`` the three texts are compared under it (see address_dim)."""
    a = address.select("sk_endereco", F.col("cidade").alias("_c"), F.col("estado").alias("_e"),
                       F.col("pais").alias("_p"))
    pairs = [("end_cidade", "_c"), ("end_uf", "_e"), ("end_pais", "_p")]
    if collation:
        cond = [F.collate(F.col(x), collation) == F.collate(F.col(y), collation) for x, y in pairs]
    else:
        cond = [F.col(x) == F.col(y) for x, y in pairs]
    return df.join(a, cond, "left").drop("_c", "_e", "_p")


def changed_rows(current: DataFrame, incoming: DataFrame, keys: Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """The incoming rows (one for each key) that ``current`` lacks or holds with other attributes."""
    old = current.select(*keys, F.struct(*attrs).alias("_old"))
    new = latest_per_key(incoming.select(*keys, *attrs), keys)
    return new.join(old, list(keys), "left") \
        .where(F.col("_old").isNull() | ~F.col("_old").eqNullSafe(F.struct(*attrs))).drop("_old")


def with_changes(current: DataFrame, changed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``current`` with ``changed`` in place of the rows of their keys: only the
    changed keys take part in the join."""
    return current.join(changed.select(*keys), list(keys), "left_anti").unionByName(changed.select(*current.columns))


def scd1(current: DataFrame | None, incoming: DataFrame, nk: Sequence[str], attrs: Sequence[str],
         sk: str) -> DataFrame:
    """Type-1 upsert on the natural key; the surrogate key of a row never changes.

    ``sk`` is the stable composite of (fleet, natural id) (sources.fleets), so a
    re-run or an update produces the same key and no global counter is read.
    """
    fleet, nid = nk
    inc = incoming.select(surrogate_key(fleet, nid).alias(sk), *nk, *attrs)
    if current is None:
        return inc
    current = current.select(sk, *nk, *attrs)
    return with_changes(current, changed_rows(current, inc, [sk, *nk], attrs), [sk, *nk])


def unpivot_dates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """U-2: the distinct non-NULL dates of several columns, one scan."""
    return (df.select(F.explode(F.array(*[F.col(c).cast("date") for c in cols])).alias("data"))
            .where(F.col("data").isNotNull()).distinct())


def missing_dates(frames: Sequence[tuple[DataFrame, Sequence[str]]], calendar: DataFrame) -> DataFrame:
    """Dates used by facts that the calendar lacks, as calendar rows."""
    dates = None
    for df, cols in frames:
        u = unpivot_dates(df, cols)
        dates = u if dates is None else dates.unionByName(u)
    dates = dates.distinct()
    return (dates.join(F.broadcast(calendar.select("data")), "data", "left_anti")
            .select(date_key("data").alias("sk_tempo"), "data"))


def ensure_calendar(calendar: DataFrame, frames) -> DataFrame:
    """Calendar plus every missing fact date (D5 applied)."""
    return calendar.unionByName(missing_dates(frames, calendar))


def with_date_key(df: DataFrame, date_col: str, calendar: DataFrame, out: str) -> DataFrame:
    """Calendar key of ``date_col`` (NULL when absent) via a broadcast lookup.

    The calendar is one row per day, so its size is bounded by the date range.
    """
    cal = calendar.select(F.col("data").alias(date_col), F.col("sk_tempo").alias(out))
    return df.join(F.broadcast(cal), date_col, "left")


# Natural key, attributes and surrogate key of each dimension.
DIM_SPECS = {
    "dim_patio": (["nk_frota_origem", "nk_id_patio"],
                  ["nome_patio", "capacidade_vagas_patio", "sk_endereco"], "sk_patio"),
    "dim_grupo": (["nk_frota_origem", "nk_id_grupo"], ["nome_grupo", "valor_diaria"], "sk_grupo"),
    "dim_veiculo": (["nk_frota_origem", "nk_id_veiculo"],
                    ["placa", "marca", "modelo", "mecanizacao", "tem_ar_condicionado"], "sk_veiculo"),
    "dim_cliente": (["nk_frota_origem", "nk_id_cliente"], ["tipo_cliente", "nome", "sk_endereco"],
                    "sk_cliente"),
}


def dim_rows(name: str, conformed: DataFrame, address: DataFrame | None = None) -> DataFrame:
    """Conformed rows as rows of the dimension (D3 for yard/customer), surrogate key first."""
    nk, attrs, sk = DIM_SPECS[name]
    inc = conformed
    if name == "dim_patio":
        inc = inc.withColumnRenamed("capacidade_vagas", "capacidade_vagas_patio")
    if "sk_endereco" in attrs:
        inc = with_address_key(inc, address)
    return inc.select(surrogate_key(*nk).alias(sk), *nk, *attrs)


def load_dim(name: str, conformed: DataFrame, address: DataFrame | None = None,
             current: DataFrame | None = None) -> DataFrame:
    """Conformed rows -> dimension (D2 with D3 for yard/customer)."""
    nk, attrs, sk = DIM_SPECS[name]
    return scd1(current, dim_rows(name, conformed, address), nk, attrs, sk)
