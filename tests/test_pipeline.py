"""End-to-end jobs at sf0.001: nightly re-run is idempotent; the four source
pipelines load a consistent warehouse."""

import os
import tempfile

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _counts(dw):
    from locastar.operators.audit import table_counts
    return {r.tabela: r.registros for r in table_counts(dw).collect()}


def test_nightly_rerun_is_idempotent(spark):
    import datetime as dt

    from locastar.plans.nightly import read_warehouse, run_nightly
    out = tempfile.mkdtemp(prefix="locastar-nightly-")
    v1 = run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, 2, 2, 0))
    first = read_warehouse(spark, out, v1)
    c1 = _counts(first)
    keys1 = sorted(tuple(r) for r in first["dim_cliente"].select("sk_cliente", "nk_frota_origem", "nk_id_cliente").collect())
    v2 = run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, 3, 2, 0))   # upserts into v1
    second = read_warehouse(spark, out, v2)
    assert v2 != v1
    assert _counts(second) == c1
    keys2 = sorted(tuple(r) for r in second["dim_cliente"].select("sk_cliente", "nk_frota_origem", "nk_id_cliente").collect())
    assert keys2 == keys1   # surrogate keys stable across runs


def test_per_source_pipelines(spark):
    from locastar.operators.audit import audit_constraints
    from locastar.plans.nightly import read_warehouse, run_nightly
    out = tempfile.mkdtemp(prefix="locastar-persource-")
    dw = read_warehouse(spark, out, run_nightly(spark, SF, out, sources="per_source"))
    assert all(n > 0 for n in _counts(dw).values())
    bad = {(r.tabela, r.restricao): r.violacoes for r in audit_constraints(dw).collect() if r.violacoes}
    assert not bad
    rejects = spark.read.parquet(os.path.join(out, "rejects"))
    from locastar.sources.fleets import SOURCES
    found = {(r.nk_frota_origem, r.motivo_rejeito) for r in rejects.select("nk_frota_origem", "motivo_rejeito").distinct().collect()
             if r.motivo_rejeito.startswith("Cliente sem tipo")}
    assert found and all(reason == SOURCES[fleet].customer_reason for fleet, reason in found)   # in each source's words


def test_fleet_slice_rerun_leaves_other_fleets(spark):
    """Re-running one fleet replaces only that fleet's conformed slice."""
    import datetime as dt

    from locastar.plans.nightly import run_nightly
    out = tempfile.mkdtemp(prefix="locastar-slice-")
    run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, 2, 2, 0))
    path = os.path.join(out, "conformed", "stg_conf_reserva")
    before = {r.nk_frota_origem: r["count"] for r in spark.read.parquet(path).groupBy("nk_frota_origem").count().collect()}
    run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, 3, 2, 0), fleets=["frota-2"])
    after = {r.nk_frota_origem: r["count"] for r in spark.read.parquet(path).groupBy("nk_frota_origem").count().collect()}
    # the night's own fleet holds what it extracted since its cut, the others what they held
    others = lambda d: {f: n for f, n in d.items() if f != "frota-2"}
    assert others(after) == others(before) and len(before) == 4 and 0 < after["frota-2"] < before["frota-2"]


def test_retry_of_a_night(spark, tmp_path):
    """A second attempt with the same run_ts leaves the live version readable and the tables as they were."""
    import datetime as dt
    from locastar.plans.nightly import current_version, read_warehouse, run_nightly
    out, night = str(tmp_path), dt.datetime(2024, 1, 2)
    first = run_nightly(spark, "/root/testdata/sf0.001", out, run_ts=night)
    before = {t: d.count() for t, d in read_warehouse(spark, out).items()}
    rejects = spark.read.parquet(f"{out}/rejects").count()
    second = run_nightly(spark, "/root/testdata/sf0.001", out, run_ts=night)
    assert first != second == current_version(spark, out)
    assert {t: d.count() for t, d in read_warehouse(spark, out).items()} == before
    assert {t: d.count() for t, d in read_warehouse(spark, out, first).items()} == before
    assert spark.read.parquet(f"{out}/rejects").count() == rejects
