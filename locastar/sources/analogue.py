"""Source-shaped raw staging frames derived from the driver's test tables.

The reference reads four OLTP schemas that are not shipped. The test tables
(TPC-H-like) stand in for them with the role mapping of SURVEY §7.3:

=============  ============================================================
role           derivation
=============  ============================================================
address        nation: city = n_name, UF 'XX'
yard           supplier (one row per fleet)
class          distinct p_type, id = rank of p_type, rate = max(p_retailprice)
vehicle        part; transmission text from p_size; home yard = key mod #yards
slot           part: slot id = p_partkey, yard = p_partkey mod #yards,
               occupied by vehicle p_partkey when p_partkey mod 3 <> 0
customer       customer; PF/PJ from the key
reservation    orders
rental         lineitem, customer through its order, class through its part
charges        lineitem per order (return flag -> charge status)
extensions     lineitem per order (days = l_linenumber when >= 6)
=============  ============================================================

Dimensions exist in every fleet (one row per fleet), facts belong to the
fleet ``FLEETS[key mod 4]``. Counts used as moduli (#yards, #classes) are
scalar subqueries, so every frame stays one lazy plan that grows with the
input. Everything here is raw (pre-conform) data: the conform operators
apply the data-quality rules.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.functions.dates import as_date
from locastar.sources.fleets import FLEETS, fleet_by_position
from locastar.sources.testdata import read_table

# The as-of date the test mapping is built around.
AS_OF = dt.date(2000, 1, 1)

# Raw transmission spellings, chosen by p_size mod 5.
RAW_TRANSMISSIONS = ("manual", "AUTOMATICA", "Automático", " automatico ", None)

# Order status -> raw reservation status, return flag -> charge status.
ORDER_STATUS = {"F": "CONVERTIDA", "O": "ATIVA", "P": "CANCELADA"}
CHARGE_STATUS = {"A": "PAGA", "N": "PENDENTE", "R": "CANCELADA"}


def _all_fleets():
    return F.explode(F.array(*[F.lit(f) for f in FLEETS])).alias("nk_frota_origem")


def _case(col, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        out = F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v))
    return out.otherwise(F.lit(default)) if default is not None else out


@dataclass
class Analogue:
    spark: SparkSession
    sf_dir: str
    as_of: dt.date = AS_OF
    #: The date from which each fleet's reservations and rentals are read; a fleet without one is read whole.
    cuts: dict[str, dt.date] = field(default_factory=dict)
    #: The sources as they were before this day (None: as they are): later bookings,
    #: pick-ups and returns are not known yet.
    known_before: dt.date | None = None

    def since_cut(self, fleet: Column, *dates: Column) -> Column:
        """Whether one of the change dates is on or after the fleet's cut."""
        if not self.cuts:
            return F.lit(True)
        if set(self.cuts) == set(FLEETS) and len(set(self.cuts.values())) == 1:
            cut = F.lit(next(iter(self.cuts.values())))   # one cut reaches the scan
        else:
            cut = F.coalesce(_case(fleet, {f: F.lit(d) for f, d in self.cuts.items()}), F.lit(dt.date(1900, 1, 1)))
        return reduce(or_, [F.coalesce(d >= cut, F.lit(False)) for d in dates])

    def is_known(self, date: Column) -> Column:
        return F.lit(True) if self.known_before is None else date < F.lit(self.known_before)

    def snapshot_slices(self) -> list[tuple[str, dt.date]]:
        """The (fleet, day) slices that ``raw_snapshot`` replaces."""
        return [(f, self.as_of - dt.timedelta(days=k)) for f in FLEETS for k in (1, 2)]

    def t(self, name: str, *cols: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name, *cols)

    # -- scalars -----------------------------------------------------------
    def n_yards(self):
        return self.t("supplier", "s_suppkey").agg(F.count(F.lit(1))).scalar()

    def n_classes(self):
        return self.classes().agg(F.count(F.lit(1))).scalar()

    # -- reference data ----------------------------------------------------
    def addresses(self) -> DataFrame:
        """nation -> (nationkey, city, UF); one row per nation (bounded, broadcast).

        The country is not taken from the source: the conform rule stores the
        fixed country of the consortium.
        """
        n = self.t("nation", "n_nationkey", "n_name")
        return n.select("n_nationkey", F.col("n_name").alias("cidade"),
                        F.lit("XX").alias("uf"), F.lit(None).cast("string").alias("pais"))

    def classes(self) -> DataFrame:
        """Distinct p_type with a dense id and the highest retail price as rate.

        The id is a rank over the (few) distinct types: the window runs on the
        aggregated rows only, never on part itself.
        """
        agg = (self.t("part", "p_type", "p_retailprice").groupBy("p_type")
               .agg(F.max("p_retailprice").alias("rate")))
        return agg.select(
            F.dense_rank().over(_order_all("p_type")).cast("long").alias("nk_id_grupo"),
            "p_type", F.col("rate").cast("decimal(12,2)").alias("valor_diaria"))

    def part_class(self) -> DataFrame:
        """p_partkey -> class id (part joined to the small class table)."""
        p = self.t("part", "p_partkey", "p_type")
        c = self.classes().select("p_type", "nk_id_grupo")
        return p.join(c, "p_type").select("p_partkey", "nk_id_grupo")

    # -- raw staging per entity -------------------------------------------
    def raw_patio(self) -> DataFrame:
        s = self.t("supplier", "s_suppkey", "s_name", "s_nationkey")
        a = self.addresses()
        cap = self.slot_counts()
        return (s.join(a, s.s_nationkey == a.n_nationkey, "left")
                .join(cap, s.s_suppkey == cap.nk_id_patio, "left")
                .select(_all_fleets(), s.s_suppkey.alias("nk_id_patio"),
                        F.col("s_name").alias("nome_patio"),
                        F.col("n_slots").cast("int").alias("capacidade_vagas"),
                        F.col("cidade").alias("end_cidade"), F.col("uf").alias("end_uf"),
                        F.col("pais").alias("end_pais")))

    def raw_grupo(self) -> DataFrame:
        return self.classes().select(
            _all_fleets(), "nk_id_grupo", F.col("p_type").alias("nome_grupo"),
            F.lit(None).cast("string").alias("codigo"), "valor_diaria")

    def raw_veiculo(self) -> DataFrame:
        p = self.t("part", "p_partkey", "p_brand", "p_name", "p_size", "p_type")
        n = self.n_yards()
        trans = _case(F.col("p_size") % 5, {i: v for i, v in enumerate(RAW_TRANSMISSIONS) if v})
        return (p.join(self.classes().select("p_type", "nk_id_grupo"), "p_type")
                .select(_all_fleets(), F.col("p_partkey").alias("nk_id_veiculo"),
                        "nk_id_grupo", (F.col("p_partkey") % n).alias("nk_id_patio_origem"),
                        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("placa"),
                        F.col("p_brand").alias("marca"), F.col("p_name").alias("modelo"),
                        trans.alias("mecanizacao"),
                        ((F.col("p_size") % 2) == 0).alias("tem_ar_condicionado")))

    def raw_cliente(self) -> DataFrame:
        c = self.t("customer", "c_custkey", "c_name", "c_nationkey")
        a = self.addresses()
        tipo = (F.when(F.col("c_custkey") % 3 == 0, F.lit("PJ"))
                .when(F.col("c_custkey") % 3 == 1, F.lit("PF")).otherwise(F.lit(" pf ")))
        return (c.join(a, c.c_nationkey == a.n_nationkey, "left")
                .select(_all_fleets(), F.col("c_custkey").alias("nk_id_cliente"),
                        tipo.alias("tipo_cliente"), F.col("c_name").alias("nome"),
                        F.col("cidade").alias("end_cidade"), F.col("uf").alias("end_uf"),
                        F.col("pais").alias("end_pais")))

    def raw_reserva(self) -> DataFrame:
        o = self.t("orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate")
        ny, nc = self.n_yards(), self.n_classes()
        k = F.col("o_orderkey")
        d0 = as_date("o_orderdate")
        pick = F.date_add(d0, (k % 30).cast("int"))
        return o.where(self.is_known(d0) & self.since_cut(fleet_by_position(k), d0)).select(
            fleet_by_position(k).alias("nk_frota_origem"), k.alias("nk_id_reserva"),
            F.col("o_custkey").alias("nk_id_cliente"), (k % nc + 1).alias("nk_id_grupo"),
            (k % ny).alias("nk_id_patio_retirada"), (F.col("o_custkey") % ny).alias("nk_id_patio_fim"),
            d0.alias("data_reserva"), pick.alias("data_retirada_prevista"),
            F.date_add(pick, (k % 12).cast("int")).alias("data_devolucao_prevista"),
            F.col("o_totalprice").cast("decimal(12,2)").alias("valor_previsto_reserva"),
            _case(F.col("o_orderstatus"), ORDER_STATUS).alias("status_reserva"))

    def raw_locacao(self) -> DataFrame:
        li = self.t("lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                    "l_extendedprice", "l_linestatus", "l_shipdate")
        o = self.t("orders", "o_orderkey", "o_custkey")
        pc = self.part_class()
        ny = self.n_yards()
        k = F.col("l_orderkey")
        ship = as_date("l_shipdate")
        back = F.date_add(ship, (k % 10).cast("int"))
        returned = (F.col("l_linestatus") == "F") & self.is_known(back)
        li = li.where(self.is_known(ship) & self.since_cut(fleet_by_position(k), ship, F.when(returned, back)))
        # hash joins on the narrow sides: rentals are dealt to all tasks (however few files
        # the source has) and never sorted
        return (li.join(o.hint("shuffle_hash"), li.l_orderkey == o.o_orderkey)
                .join(pc.hint("shuffle_hash"), li.l_partkey == pc.p_partkey)
                .select(fleet_by_position(k).alias("nk_frota_origem"),
                        (k * 8 + F.col("l_linenumber")).alias("nk_id_locacao"),
                        F.col("o_custkey").alias("nk_id_cliente"),
                        F.col("l_partkey").alias("nk_id_veiculo"), "nk_id_grupo",
                        F.col("l_suppkey").alias("nk_id_patio_retirada"),
                        F.when(returned, (F.col("l_suppkey") + F.col("l_linenumber")) % ny)
                        .alias("nk_id_patio_devolucao"),
                        ship.alias("data_retirada"),
                        F.date_add(ship, F.col("l_linenumber")).alias("data_prev_devolucao"),
                        F.when(returned, back).alias("data_real_devolucao"),
                        F.col("l_extendedprice").cast("decimal(14,2)").alias("valor_final")))

    def slots(self) -> DataFrame:
        """(slot id, yard id, vehicle id or NULL)."""
        n = self.n_yards()
        p = self.t("part", "p_partkey")
        return p.select(F.col("p_partkey").alias("id_vaga"),
                        (F.col("p_partkey") % n).alias("id_patio"),
                        F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey")).alias("id_veiculo"))

    def slot_counts(self) -> DataFrame:
        """Capacity of a yard = number of its slots (pre-aggregated, then joined)."""
        return (self.slots().groupBy(F.col("id_patio").alias("nk_id_patio"))
                .agg(F.count(F.lit(1)).alias("n_slots")))

    def raw_snapshot(self) -> DataFrame:
        """Occupied slots on as_of-1 and as_of-2.

        The snapshot row belongs to the yard's fleet (yard mod 4); the vehicle
        belongs to fleet (vehicle mod 3), so partner-fleet vehicles parked in
        another fleet's yard occur (Q1.1's two branches).
        """
        s = self.slots().where(F.col("id_veiculo").isNotNull())
        pc = self.part_class()
        days = F.explode(F.array(F.lit(self.as_of - dt.timedelta(days=1)),
                                 F.lit(self.as_of - dt.timedelta(days=2)))).alias("data_snapshot")
        return (s.join(pc, s.id_veiculo == pc.p_partkey)
                .select(fleet_by_position("id_patio").alias("nk_frota_origem"),
                        F.col("id_patio").alias("nk_id_patio"),
                        F.col("id_veiculo").alias("nk_id_veiculo"), "nk_id_grupo",
                        fleet_by_position(F.col("id_veiculo") % 3).alias("nk_frota_veiculo"),
                        days))

    def charges(self) -> DataFrame:
        """(rental parent = order key, amount, status)."""
        li = self.t("lineitem", "l_orderkey", "l_extendedprice", "l_returnflag")
        return li.select(F.col("l_orderkey").alias("locacao_id"),
                         F.col("l_extendedprice").cast("decimal(12,2)").alias("valor_total"),
                         _case(F.col("l_returnflag"), CHARGE_STATUS).alias("status"))

    def extensions(self) -> DataFrame:
        li = self.t("lineitem", "l_orderkey", "l_linenumber")
        return (li.where(F.col("l_linenumber") >= 6)
                .select(F.col("l_orderkey").alias("id_locacao"),
                        F.col("l_linenumber").alias("qtd_dias")))


def _order_all(*cols):
    from pyspark.sql import Window
    return Window.orderBy(*cols)
