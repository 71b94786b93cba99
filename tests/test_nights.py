"""Nights that read what changed since the cut: equal to a full load, and only what changed is written."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from locastar.operators import commits
from locastar.plans import nightly, versions
from locastar.plans.nightly import read_warehouse, run_nightly
from locastar.sources.analogue import AS_OF, Analogue

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
NIGHT_1, NIGHT_2 = dt.datetime(2000, 1, 2, 2), dt.datetime(2000, 1, 3, 2)


def rows(df):
    return sorted(repr(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


def single(spark, fact):
    """The rows of a fact whose rental id stands for one source row: an upsert of a
    repeated id keeps columns of the row that came first, whichever night brought it."""
    ids = spark.read.parquet(f"{SF}/lineitem.parquet").groupBy((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("nk_id_locacao")).count()
    return fact.join(ids.where("count = 1"), "nk_id_locacao", "left_semi") if "nk_id_locacao" in fact.columns else fact


@pytest.fixture(scope="module")
def full(spark, tmp_path_factory):
    """A first load of everything; tests read it and copy nothing."""
    out = str(tmp_path_factory.mktemp("full"))
    return out, run_nightly(spark, SF, out, run_ts=NIGHT_1)


def test_two_nights_equal_one_full_load(spark, full, tmp_path):
    cut, out = dt.date(1997, 6, 1), str(tmp_path)
    run_nightly(spark, SF, out, cut, dt.datetime(1997, 6, 1, 2), known_before=cut)
    first = versions.published(spark, out)[1]
    early = read_warehouse(spark, out)["fato_locacao"]
    assert 0 < early.count() < read_warehouse(spark, full[0])["fato_locacao"].count()
    assert set(first.cuts.values()) == {cut}
    run_nightly(spark, SF, out, AS_OF, NIGHT_1)
    second = versions.published(spark, out)[1]
    got, want = read_warehouse(spark, out), read_warehouse(spark, full[0])
    for t in ("fato_locacao", "fato_reserva", "dim_cliente", "dim_patio", "dim_endereco"):
        assert rows(single(spark, got[t])) == rows(single(spark, want[t])) and got[t].count() == want[t].count(), t
    assert set(second.cuts.values()) == {AS_OF}
    # months that nothing changed in are the first night's folders (rental ids repeat over all months)
    parts = second.tables["fato_reserva"]
    assert {p for p, n in parts.items() if n == first.id} == {p for p in parts if int(p) < 199706}
    assert all(n == second.id for p, n in parts.items() if int(p) > 199707)
    assert second.tables["dim_cliente"] == first.tables["dim_cliente"]
    # the stage held the rows since the cut alone
    staged = spark.read.parquet(f"{out}/raw/reserva")
    assert staged.where(F.col("data_reserva") < F.lit(cut)).isEmpty() and not staged.isEmpty()


def test_unchanged_night_writes_two_days_of_inventory(spark, full, tmp_path):
    out = str(tmp_path)
    run_nightly(spark, SF, out, run_ts=NIGHT_1)
    before = versions.published(spark, out)[1]
    run_nightly(spark, SF, out, run_ts=NIGHT_2)
    after = versions.published(spark, out)[1]
    for t in before.tables:
        if not t.startswith("_late/") and t != "fato_inventario_patio":
            assert after.tables[t] == before.tables[t], t
    assert {n for n in after.tables["fato_inventario_patio"].values()} == {after.id}
    assert rows(read_warehouse(spark, out)["fato_inventario_patio"]) == rows(read_warehouse(spark, full[0])["fato_inventario_patio"])
    # only what lies on or after the cut was read
    assert spark.read.schema("data_reserva date").parquet(f"{out}/raw/reserva").agg(F.min("data_reserva")).first()[0] >= AS_OF


def test_late_keys_come_again(spark, full, tmp_path, monkeypatch):
    """FL4: a fact whose customer or yard is missing is logged, kept, and loaded when the key has arrived; FL4b warns."""
    out, customers, yards = str(tmp_path), Analogue.raw_cliente, Analogue.raw_patio
    with monkeypatch.context() as m:
        m.setattr(Analogue, "raw_cliente", lambda self: customers(self).where("nk_id_cliente % 10 <> 0"))
        m.setattr(Analogue, "raw_patio", lambda self: yards(self).where("nk_id_patio % 7 <> 0"))
        run_nightly(spark, SF, out, run_ts=NIGHT_1)
    want = read_warehouse(spark, full[0])
    assert read_warehouse(spark, out)["fato_locacao"].count() < want["fato_locacao"].count()
    log = spark.read.parquet(f"{out}/rejects").where("run_step = 'load'")
    warned = log.where(F.col("motivo_rejeito").startswith("PÁTIO DEVOLUÇÃO"))
    assert {r[0] for r in warned.select("nk_frota_origem").distinct().collect()} == {"frota-3"}
    run_nightly(spark, SF, out, run_ts=NIGHT_2)   # nothing changed at the source since the cut
    got = read_warehouse(spark, out)
    for t in ("fato_locacao", "fato_reserva", "fato_inventario_patio"):
        assert rows(single(spark, got[t])) == rows(single(spark, want[t])) and got[t].count() == want[t].count(), t
    again = spark.read.parquet(f"{out}/rejects").where("run_step = 'load' and run_id = '20000103020000'")
    assert again.isEmpty()


def test_empty_snapshot_day_leaves_no_rows(spark, full, tmp_path, monkeypatch):
    """S5/FL1: a day that the night's snapshot has no rows for is replaced by nothing, of that night's fleets alone."""
    out, snapshot = str(tmp_path), Analogue.raw_snapshot
    run_nightly(spark, SF, out, run_ts=NIGHT_1)
    with monkeypatch.context() as m:
        m.setattr(Analogue, "raw_snapshot", lambda self: snapshot(self).where("false"))
        run_nightly(spark, SF, out, run_ts=NIGHT_2, fleets=["frota-2"])
        left = read_warehouse(spark, out)["fato_inventario_patio"]
        own = F.floor(F.col("sk_patio") / (1 << 32)) == 2
        all_rows = read_warehouse(spark, full[0])["fato_inventario_patio"]
        assert left.where(own).isEmpty() and rows(left) == rows(all_rows.where(~own)) and not left.isEmpty()
        run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, 4, 2))
    assert read_warehouse(spark, out)["fato_inventario_patio"].isEmpty()
    assert versions.published(spark, out)[1].tables["fato_inventario_patio"] == {}


def test_night_of_one_fleet_moves_its_cut_alone(spark, tmp_path):
    out = str(tmp_path)
    run_nightly(spark, SF, out, AS_OF, NIGHT_1, known_before=dt.date(1996, 1, 1))
    run_nightly(spark, SF, out, AS_OF, NIGHT_2, fleets=["frota-3"])
    cuts = versions.published(spark, out)[1].cuts
    assert cuts["frota-3"] == AS_OF and {d for f, d in cuts.items() if f != "frota-3"} == {dt.date(1996, 1, 1)}
    fact = read_warehouse(spark, out)["fato_reserva"]
    late = F.col("sk_tempo_reserva") >= 19960101
    assert {r[0] for r in fact.where(late).select("nk_frota_origem").distinct().collect()} == {"frota-3"}


def test_old_versions_go_and_named_ones_stay(spark, tmp_path):
    out = str(tmp_path)
    first = run_nightly(spark, SF, out, run_ts=NIGHT_1, keep=2)
    for day in (3, 4, 5):
        last = run_nightly(spark, SF, out, run_ts=dt.datetime(2000, 1, day, 2), keep=2)
    day = f"{out}/dw/fato_inventario_patio/sk_tempo_referencia=19991231"
    assert len(commits.names(spark, day)) == 2   # the last two nights' folders
    assert f"v={first}" in commits.names(spark, f"{out}/dw/dim_cliente")   # carried, so still named
    assert all(df.count() > 0 for df in read_warehouse(spark, out, last).values())


def test_second_writer_of_a_version_fails(spark, tmp_path):
    folder = str(tmp_path)
    commits.commit(spark, folder, 0, {"a": 1})
    with pytest.raises(FileExistsError):
        commits.commit(spark, folder, 0, {"a": 2})
    assert commits.latest(spark, folder) == (0, {"a": 1})
    commits.commit(spark, folder, 1, {"a": 3})
    assert commits.latest(spark, folder) == (1, {"a": 3}) and commits.names(spark, folder) == ["c=000000000000", "c=000000000001"]


def test_repeated_inventory_key_is_loaded_once(spark):
    """FL1: a vehicle on two slots of a yard is one row from the first load on."""
    from locastar.operators.facts import split_inventory
    tagged = spark.createDataFrame([(20000101, 1, 2, 3, None, "f"), (20000101, 1, 2, 4, None, "f"), (20000101, 1, 5, 4, None, "f")],
                                   "sk_tempo_referencia int, sk_patio long, sk_veiculo long, sk_grupo long, _reason string, nk_frota_origem string") \
        .withColumn("nk_id_veiculo", F.col("sk_veiculo"))
    fact, _ = split_inventory(tagged)
    assert sorted(tuple(r) for r in fact.select("sk_tempo_referencia", "sk_patio", "sk_veiculo", "sk_grupo").collect()) == [
        (20000101, 1, 2, 4), (20000101, 1, 5, 4)]


def test_failing_job_of_many_is_raised(spark):
    def fails():
        raise OSError("lost")
    with pytest.raises(OSError):
        nightly.together(spark, {"a": lambda: 1, "b": fails})


def test_a_month_is_written_by_few_tasks(spark, tmp_path):
    """not one file of every month from every task."""
    rows_ = spark.range(0, 1200, 1, 8).select(F.lit("f").alias("nk_frota_origem"), F.col("id").alias("nk_id_reserva"),
                                             (F.col("id") % 12 + 202001).cast("int").alias("mes"))
    versions.write(spark, str(tmp_path), "v1", "fato_reserva", rows_)
    months = [m for m in commits.names(spark, f"{tmp_path}/dw/fato_reserva") if m.startswith("mes=")]
    files = [f for m in months for f in commits.names(spark, f"{tmp_path}/dw/fato_reserva/{m}/v=v1") if f.startswith("part-")]
    assert len(months) == 12 and len(files) == 12
    assert spark.read.parquet(f"{tmp_path}/dw/fato_reserva").count() == 1200


def _files_of(folder):
    return [(os.path.join(d, f), os.path.getsize(os.path.join(d, f))) for d, _, names in os.walk(folder) for f in names]


def test_nights_leave_their_tables_alone_on_disk(spark, tmp_path):
    """shuffle files go with their query, no fact is kept as a checkpoint, and the session's settings come back."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        return {n for n in (found.apply(k).getName() for k in range(found.size())) if n.startswith("shuffle_")}

    kept = spark.sparkContext._jsc.sc().getCheckpointDir().get().removeprefix("file:")
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    files, before = shuffled(), sum(size for _, size in _files_of(kept))
    cut, out = dt.date(1997, 6, 1), str(tmp_path)
    run_nightly(spark, SF, out, cut, dt.datetime(1997, 6, 1, 2), known_before=cut)
    run_nightly(spark, SF, out, AS_OF, NIGHT_1)
    assert shuffled() <= files
    written = read_warehouse(spark, out)["fato_locacao"].count()
    assert sum(size for _, size in _files_of(kept)) - before < 20 * written
    assert not _files_of(f"{out}/_aside")
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec


def test_passes_by_fleet_and_months_equal_one_pass(spark, full, tmp_path, monkeypatch):
    """tables too large for one pass are staged and loaded fleet by fleet, and merged some months at a time."""
    merged, months_together = [], nightly._months_together
    monkeypatch.setattr(nightly, "PASS_BYTES", 0)
    monkeypatch.setattr(nightly, "_months_together", lambda *a: (merged.append(list(months_together(*a))), merged[-1])[1])
    cut, out = dt.date(1997, 6, 1), str(tmp_path)
    run_nightly(spark, SF, out, cut, dt.datetime(1997, 6, 1, 2), known_before=cut)
    run_nightly(spark, SF, out, AS_OF, NIGHT_1)
    got, want = read_warehouse(spark, out), read_warehouse(spark, full[0])
    for t in got:
        if t != "fato_inventario_patio":
            assert rows(single(spark, got[t])) == rows(single(spark, want[t])) and got[t].count() == want[t].count(), t
    days = F.col("sk_tempo_referencia")   # the first night's two days stay
    assert rows(got["fato_inventario_patio"].where(days > 19990101)) == rows(want["fato_inventario_patio"])
    assert sorted(r[0] for r in got["fato_inventario_patio"].select(days).distinct().collect()) == [19970530, 19970531, 19991230, 19991231]
    for groups in merged:   # each month in one group
        assert 1 < len(groups) <= 2 * nightly.PASSES and len(sum(groups, [])) == len({*sum(groups, [])})


def test_parts_by_fleet_lose_no_row(spark):
    """a row whose fleet no one knows, or that has none, is in one part too (and refused where it is staged)."""
    df = spark.createDataFrame([(f,) for f in ("frota-1", "frota-2", "frota-3", "frota-4", "frota-9", None)], "nk_frota_origem string")
    parts = nightly._by_fleet(df, nightly.PASS_BYTES + 1)
    assert len(parts) == 4 and sorted(sum((rows(p) for p in parts), [])) == rows(df)
    assert len(nightly._by_fleet(df, nightly.PASS_BYTES)) == 1
