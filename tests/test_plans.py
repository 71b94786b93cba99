"""Physical plans: what is pruned and pushed down, and that no task or broadcast holds a whole table."""

import datetime as dt
import os
import re

import pytest

from locastar.operators import dims as D
from locastar.operators.numbering import row_numbers
from locastar.plans.marts import MARTS
from locastar.plans.nightly import read_warehouse, run_nightly
from locastar.schemas import DW_SCHEMAS
from locastar.sources.analogue import AS_OF, Analogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.fixture(scope="module")
def dw(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("plans"))
    run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, 2, 2))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # filters in full
    return read_warehouse(spark, out)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scan_of(text: str, column: str) -> str:
    """The file scans of the plan that have ``column`` as a partition."""
    return "\n".join(line for line in text.splitlines() if "FileScan" in line and re.search(rf"PartitionFilters: \[[^\]]*{column}", line))


@pytest.mark.parametrize("mart,column", [("q1_1_yard_inventory", "sk_tempo_referencia"), ("q1_3_reservation_horizon", "mes"),
                                         ("q3_3_pipeline", "mes"), ("q5_2_stale_rentals", "mes")])
def test_partitions_are_pruned(dw, mart, column):
    """P-6: the date bound names folders, not only rows."""
    assert scan_of(plan(MARTS[mart](dw, AS_OF)), column)


@pytest.mark.parametrize("mart,pushed", [("q1_2_open_rentals", "IsNull(sk_tempo_real_devolucao)"),
                                         ("q1_3_reservation_horizon", "EqualTo(dd_status_reserva,ATIVA)"),
                                         ("q5_2_stale_rentals", "LessThan(sk_tempo_retirada")])
def test_filters_reach_the_scan(dw, mart, pushed):
    filters = re.findall(r"PushedFilters: \[.*?\], ReadSchema", plan(MARTS[mart](dw, AS_OF)))
    assert any(pushed in f for f in filters)


def test_marts_read_only_their_columns(dw):
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan(MARTS["q5_2_stale_rentals"](dw, AS_OF)))
    assert not any("valor_final" in r or "sk_cliente" in r for r in read)


def test_tables_have_their_declared_schema(spark, dw):
    """Read without inference, so also an empty table has its columns and types."""
    for t, df in dw.items():
        declared = spark.createDataFrame([], DW_SCHEMAS[t]).schema
        got = {f.name: f.dataType for f in df.schema if f.name != "mes"}
        assert got == {f.name: f.dataType for f in declared}, t


def test_numbers_are_given_without_one_task(spark):
    """No window over the whole table; the numbers are those of the order."""
    df = row_numbers(spark.range(3000).selectExpr("cast(id * 7919 % 3001 as string) as k"), ["k"], "n", 10)
    assert "SinglePartition" not in plan(df)
    got = df.orderBy("n").collect()
    assert [r["n"] for r in got] == list(range(11, 3011)) and [r["k"] for r in got] == sorted(r["k"] for r in got)
    assert row_numbers(spark.range(0).selectExpr("cast(id as string) as k"), ["k"], "n").collect() == []


def test_dimension_merge_joins_no_whole_rows_outer(spark):
    """Changed rows take the place of stored ones by an anti-join, never a full outer join."""
    old = spark.createDataFrame([(1, "f", 1, "a"), (2, "f", 2, None)], "sk long, nk_frota_origem string, nk long, v string")
    new = spark.createDataFrame([("frota-1", 5, "x")], "nk_frota_origem string, nk long, v string")
    df = D.scd1(old, new, ["nk_frota_origem", "nk"], ["v"], "sk")
    assert "FullOuter" not in plan(df) and df.count() == 3
    keys = ["sk", "nk_frota_origem", "nk"]
    same = D.changed_rows(old, old, keys, ["v"])
    assert same.isEmpty()
    changed = D.changed_rows(old, spark.createDataFrame([(2, "f", 2, "b"), (1, "f", 1, "a")], old.schema), keys, ["v"])
    assert [tuple(r) for r in changed.collect()] == [(2, "f", 2, "b")]


def test_sources_force_no_broadcast(spark):
    """Join sides that grow with the data carry no broadcast hint: their size at run time decides."""
    a = Analogue(spark, SF)
    for entity in ("patio", "grupo", "veiculo", "cliente", "reserva", "locacao", "snapshot"):
        logical = getattr(a, "raw_" + entity)()._jdf.queryExecution().logical().toString()
        assert "Hint" not in logical, entity


def test_positions_tell_a_wrong_order(spark):
    """The place of a row is read off the order that a query has, so a wrong order gives wrong places."""
    from locastar.operators.numbering import positions
    df = spark.createDataFrame([(k, k % 5) for k in range(40)], "k long, v long").repartition(4)
    place = lambda d: {r["k"]: r["p"] for r in positions(d, ["v"], "p").collect()}
    right = {k: 1 + 8 * (4 - k % 5) for k in range(40)}
    assert place(df.orderBy(df["v"].desc())) == right
    assert place(df.orderBy("v")) != right
