"""Change feed over several micro-batches, out of order across batches, and replays."""

import os
import tempfile
import time

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

from locastar.streaming import cdc

SRC = "/root/testdata/sf0.001/events.parquet"
pytestmark = pytest.mark.skipif(not os.path.exists(SRC), reason="test data not present")


@pytest.fixture(scope="module")
def feed_dir():
    d = tempfile.mkdtemp(prefix="locastar-feed-")
    t = pq.read_table(SRC)
    # interleaved sequences: later batches often carry OLDER changes of a key
    for i, r in enumerate((2, 1, 0)):
        ids = t["event_id"]
        part = t.filter(pc.equal(pc.subtract(ids, pc.multiply(pc.divide(ids, 3), 3)), r))
        pq.write_table(part, os.path.join(d, f"part-{i}.parquet"))
        time.sleep(1.1)   # distinct modification times -> deterministic batch order
    return d


def _expected():
    df = pq.read_table(SRC).to_pandas()
    last = df.sort_values("event_id").groupby("user_id").tail(1)
    return {int(r.user_id): int(r.event_id) for r in last.itertuples()}


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_wins_across_batches(spark, feed_dir, tmp_path):
    t = cdc.Target(spark, f"{tmp_path}/t", ("user_id",), "event_id")
    step = cdc.upsert(t, lambda b: b.select("user_id", "event_id", "event_type"))
    feed = cdc.change_feed(spark, feed_dir, file_glob="*.parquet", max_files_per_trigger=1)
    batches = []

    def counting(batch, batch_id):
        batches.append((cdc.query_id(batch), batch_id))
        step(batch, batch_id)
    cdc.run_stream(feed, counting, f"{tmp_path}/ck")
    assert [b for _, b in batches] == [0, 1, 2] and len({q for q, _ in batches}) == 1 and batches[0][0] != "direct"
    got = {r.user_id: r.event_id for r in t.latest().collect()}
    assert got == _expected()


def test_second_checkpoint_on_one_target_loses_nothing(spark, tmp_path):
    """The batch numbers of a new checkpoint begin at 0 again; its batches are others all the same."""
    t = cdc.Target(spark, f"{tmp_path}/t", ("k",), "seq")
    step = cdc.upsert(t, lambda b: b)
    for n, rows in enumerate(([(1, 1), (2, 1)], [(3, 1), (2, 2)], [(1, 5)])):
        feed = f"{tmp_path}/feed{n}"
        for k, row in enumerate(rows):
            spark.createDataFrame([row], "k long, seq long").coalesce(1).write.mode("append").parquet(feed)
        cdc.run_stream(cdc.change_feed(spark, feed, "part-*.parquet"), step, f"{tmp_path}/ck{n}")
    assert _sorted(t.latest()) == [(1, 5), (2, 2), (3, 1)]
    assert t.changes().count() == 5


def test_replayed_batch_is_idempotent(spark, tmp_path):
    t = cdc.Target(spark, f"{tmp_path}/t", ("user_id",), "event_id")
    step = cdc.upsert(t, lambda b: b.select("user_id", "event_id"))
    batch = spark.read.parquet(SRC)
    step(batch, 0)
    first, rows = _sorted(t.latest()), t.changes().count()
    step(batch, 0)   # the same micro-batch delivered again
    assert _sorted(t.latest()) == first and t.changes().count() == rows


def test_invalid_update_flag(spark, tmp_path):
    """ST2b: an invalid change of a stored key is a reject by default and
    ignored with silent_updates; the stored row stays."""
    rows = [("a", 1, 0, 10, "accepted"), ("a", 1, 1, -5, "rejected"), ("b", 2, 2, -7, "rejected"), ("b", 2, 3, 7, "accepted")]
    t = cdc.Target(spark, f"{tmp_path}/t", ("f", "k"), "seq")
    step = cdc.append_all(t, lambda b: b)
    for k in (3, 1, 0, 2):   # the order of batches does not matter
        step(spark.createDataFrame([rows[k]], "f string, k long, seq long, v long, outcome string"), k)
    assert _sorted(cdc.conformed(t.changes(), t.keys, "seq").select("f", "k", "v")) == [("a", 1, 10), ("b", 2, 7)]
    for silent, late in ((False, "rejected"), (True, "ignored")):
        got = _sorted(cdc.outcomes(t.changes(), t.keys, "seq", silent_updates=silent))
        assert got == sorted([rows[0], (*rows[1][:4], late), rows[2], rows[3]])


def test_update_only_keeps_the_newer_change(spark, tmp_path):
    """ST4/ST6: an older change in a later batch does not overwrite a newer one; unknown keys are ignored."""
    t = cdc.Target(spark, f"{tmp_path}/t", ("k",), "seq")
    t.begin(spark.createDataFrame([(1, "first"), (2, "first")], "k long, v string"))
    assert _sorted(t.updated(["v"])) == [(1, "first"), (2, "first")]
    step = cdc.upsert(t, lambda b: b)
    step(spark.createDataFrame([(1, 10, "new")], "k int, seq long, v string"), 0)
    step(spark.createDataFrame([(1, 5, "old"), (3, 5, "unknown")], "k int, seq long, v string"), 1)
    assert _sorted(t.updated(["v"])) == [(1, "new"), (2, "first")]
    assert t.updated(["v"]).columns == ["k", "v"]


def test_update_to_null_counts(spark, tmp_path):
    t = cdc.Target(spark, f"{tmp_path}/t", ("k",), "seq")
    t.begin(spark.createDataFrame([(1, "first")], "k long, v string"))
    cdc.upsert(t, lambda b: b)(spark.createDataFrame([(1, 1, None)], "k long, seq long, v string"), 0)
    assert _sorted(t.updated(["v"])) == [(1, None)]


def test_changed_and_cancelled_child(spark, tmp_path):
    """ST5: an updated charge counts once, a cancelled one no more; a parent without charges keeps its total."""
    parents = spark.createDataFrame([(1, 0.0), (2, 3.0)], "pk long, total double")
    kids = cdc.Target(spark, f"{tmp_path}/c", ("parent", "id"), "seq")
    step = cdc.upsert(kids, lambda b: b)
    schema, got = "parent long, id long, seq long, status string, amount double", []
    for k, row in enumerate([(1, 7, 1, "PAGA", 100.0), (1, 7, 2, "PAGA", 150.0), (1, 7, 3, "CANCELADA", 150.0)]):
        step(spark.createDataFrame([row], schema), k)
        got.append(_sorted(cdc.child_totals(parents, kids.latest(), "pk", "parent", "amount", "total", "status = 'PAGA'")))
    assert got == [[(1, v), (2, 3.0)] for v in (100.0, 150.0, 0.0)]


def test_second_change_of_a_record(spark, tmp_path):
    """ST2: the sequence is not the key: a later change of a stored record is applied. ST7: an invalid one ends it."""
    t = cdc.Target(spark, f"{tmp_path}/t", ("f", "k"), "seq")
    step = cdc.append_all(t, lambda b: b.selectExpr("*", "if(v >= 0, 'accepted', 'rejected') as outcome"))
    for k, v in enumerate((10, 20, -1)):
        step(spark.createDataFrame([("a", 1, k, v)], "f string, k long, seq long, v long"), k)
    assert [r["v"] for r in cdc.conformed(t.changes(), t.keys, "seq").collect()] == [20]
    assert cdc.cascaded(t.changes(), t.keys, "seq").collect() == []
    assert cdc.outcomes(t.changes(), t.keys, "seq").where("outcome = 'rejected'").count() == 1


def test_interrupted_batch_and_failing_read(spark, tmp_path, monkeypatch):
    """A batch that dies while it is written is delivered again; a read error is raised, not taken for an empty table."""
    from locastar.operators import commits
    t = cdc.Target(spark, f"{tmp_path}/t", ("k",), "seq")
    with pytest.raises(ValueError):
        t.latest()
    step = cdc.upsert(t, lambda b: b)
    step(spark.range(100).selectExpr("id as k", "0L as seq"), 0)
    broken = spark.range(30).selectExpr("id as k", "if(id = 29, raise_error('lost'), 1L) as seq")
    with pytest.raises(Exception, match="lost"):
        step(broken, 1)
    assert sorted(r["seq"] for r in t.latest().collect()) == [0] * 100
    step(spark.range(30).selectExpr("id as k", "1L as seq"), 1)
    assert sorted(r["seq"] for r in t.latest().collect()) == [0] * 70 + [1] * 30
    with monkeypatch.context() as m:
        m.setattr(commits, "names", lambda *a, **k: (_ for _ in ()).throw(OSError("read failed")))
        with pytest.raises(OSError):
            t.latest()


def test_compaction_keeps_state_and_order(spark, tmp_path):
    """The compacted target has the same state, refuses older changes, and takes newer ones."""
    t = cdc.Target(spark, f"{tmp_path}/a", ("k",), "seq")
    for n, rows in enumerate(([(1, 5, "x"), (2, 1, "y")], [(1, 3, "old"), (3, 1, "z")])):
        cdc.upsert(t, lambda b: b)(spark.createDataFrame(rows, "k long, seq long, v string"), n)
    small = t.compact(f"{tmp_path}/b")
    assert _sorted(small.latest()) == _sorted(t.latest()) == [(1, 5, "x"), (2, 1, "y"), (3, 1, "z")]
    cdc.upsert(small, lambda b: b)(spark.createDataFrame([(1, 4, "older"), (2, 9, "newer")], "k long, seq long, v string"), 0)
    assert _sorted(small.latest()) == [(1, 5, "x"), (2, 9, "newer"), (3, 1, "z")]
    u = cdc.Target(spark, f"{tmp_path}/u", ("k",), "seq")
    u.begin(spark.createDataFrame([(1, "first"), (2, "first")], "k long, v string"))
    cdc.upsert(u, lambda b: b)(spark.createDataFrame([(1, 5, "five")], "k long, seq long, v string"), 0)
    again = u.compact(f"{tmp_path}/w", ["v"]).compact(f"{tmp_path}/z", ["v"])
    cdc.upsert(again, lambda b: b)(spark.createDataFrame([(1, 4, "four"), (2, 1, "one")], "k long, seq long, v string"), 0)
    assert _sorted(again.updated(["v"])) == [(1, "five"), (2, "one")]
