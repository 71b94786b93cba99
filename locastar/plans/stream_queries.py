"""Streaming queries (ST1-ST7): each runs the change feed (``events``) to the
end with an ``availableNow`` trigger and returns the final target table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locastar.functions.dates import as_date
from locastar.operators import conform as C
from locastar.session import scratch_path
from locastar.sources.analogue import Analogue
from locastar.sources.fleets import fleet_by_position
from locastar.streaming import cdc

# Event type -> reservation status for the update-only stream.
EVENT_STATUS = {"purchase": "CONVERTIDA", "error": "CANCELADA"}


def _dirs(spark, name):
    base = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    return base, f"{base}/_checkpoint"


#: Micro-batches that the feed is read in, and rows in one of its files.
FEED_BATCHES = 3
FEED_ROWS = 1_000_000


def _feed(spark, sf_dir):
    """The whole feed as files whose events interleave: later micro-batches carry
    older changes too. One parallel write; the files follow the number of events."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    files = max(FEED_BATCHES, -(-events.count() // FEED_ROWS))
    folder = scratch_path(spark, f"feed-{uuid.uuid4().hex}")
    events.repartition(files, F.xxhash64("event_id")).write.parquet(folder)
    return cdc.change_feed(spark, folder, "part-*.parquet", -(-files // FEED_BATCHES))


def event_rental(df: DataFrame, key: str = "event_id") -> DataFrame:
    """A change event seen as a raw rental row (return before pick-up on 'error')."""
    d = as_date("ts")
    real = (F.when(F.col("event_type") == "error", F.date_sub(d, 1))
            .when(F.col("event_type") == "purchase", F.date_add(d, 2)))
    return df.select(fleet_by_position("user_id").alias("nk_frota_origem"), F.col(key).alias("nk_id_locacao"),
                     F.col("user_id").alias("nk_id_cliente"), F.col("user_id").alias("nk_id_veiculo"),
                     F.lit(1).alias("nk_id_grupo"), (F.col("user_id") % 10).alias("nk_id_patio_retirada"),
                     F.lit(None).cast("long").alias("nk_id_patio_devolucao"), d.alias("data_retirada"),
                     F.date_add(d, 1).alias("data_prev_devolucao"), real.alias("data_real_devolucao"),
                     F.col("value").cast("decimal(14,2)").alias("valor_final"), F.col("event_id"))


CONF_COLS = ["nk_frota_origem", "nk_id_locacao", "nk_id_cliente", "data_retirada", "data_real_devolucao",
             "valor_final"]
RENTAL = ("nk_frota_origem", "nk_id_locacao")


def _conformed_changes(key: str = "event_id"):
    """ST2: a batch's changes in one pass, each accepted or rejected with its reason and payload."""
    def prepare(batch: DataFrame) -> DataFrame:
        passed = F.col("motivo_rejeito").isNull()
        return C.tagged_locacao(event_rental(batch, key), "event_id").withColumn(
            "outcome", F.when(passed, cdc.ACCEPTED).otherwise(cdc.REJECTED))
    return prepare


def _conform_log(spark, sf_dir, name, key="event_id") -> DataFrame:
    base, ck = _dirs(spark, name)
    t = cdc.Target(spark, f"{base}/log", RENTAL, "event_id")
    cdc.run_stream(_feed(spark, sf_dir), cdc.append_all(t, _conformed_changes(key)), ck)
    return t.changes()


def st1_latest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, ck = _dirs(spark, "st1")
    t = cdc.Target(spark, f"{base}/raw", ("user_id",), "event_id")
    prep = lambda b: b.select("user_id", "event_id", "event_type", "value", "ts")
    cdc.run_stream(_feed(spark, sf_dir), cdc.upsert(t, prep), ck)
    return t.latest()


def st2_conform_stream(spark, sf_dir):
    # each event is a rental of its own here; its id is also the order of changes
    return cdc.conformed(_conform_log(spark, sf_dir, "st2"), RENTAL, "event_id").select(*CONF_COLS)


def st2_outcomes(spark, sf_dir):
    """Every change with what became of it: conformed rows and rejects of one pass."""
    log = cdc.outcomes(_conform_log(spark, sf_dir, "st2o"), RENTAL, "event_id")
    return log.select(*RENTAL, "outcome", "valor_final", "motivo_rejeito", "dados_json")


def st2b_silent_updates(spark, sf_dir):
    """ST2b: the changes of a user are changes of one rental; an invalid change
    of a rental that is there already is ignored, one of an unknown rental is a reject."""
    log = cdc.outcomes(_conform_log(spark, sf_dir, "st2b", "user_id"), RENTAL, "event_id", silent_updates=True)
    return log.select(*RENTAL, "event_id", "outcome", "motivo_rejeito")


def st3_enrich_stream(spark, sf_dir):
    base, ck = _dirs(spark, "st3")
    a = Analogue(spark, sf_dir)
    cust = (a.t("customer", "c_custkey", "c_name", "c_nationkey")
            .join(a.addresses(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select("c_custkey", "c_name", F.col("cidade").alias("end_cidade")))
    t = cdc.Target(spark, f"{base}/enriched", ("event_id",), "event_id")

    def prep(b):   # stream-static left join
        return b.join(cust, F.col("user_id") == F.col("c_custkey"), "left").select("event_id", "user_id", "c_name", "end_cidade")
    cdc.run_stream(_feed(spark, sf_dir), cdc.append_all(t, prep), ck)
    return t.changes()


def _open_rentals(a: Analogue) -> DataFrame:
    return a.t("orders", "o_orderkey").select(
        F.col("o_orderkey").alias("nk_id_locacao"), F.lit(None).cast("date").alias("data_real_devolucao"),
        F.lit(None).cast("long").alias("nk_id_patio_devolucao"))


def st4_close_out(spark, sf_dir):
    base, ck = _dirs(spark, "st4")
    t = cdc.Target(spark, f"{base}/rentals", ("nk_id_locacao",), "event_id")
    t.begin(_open_rentals(Analogue(spark, sf_dir)))

    def prep(b):
        return b.where(F.col("event_type") == "purchase").select(
            F.col("user_id").alias("nk_id_locacao"), "event_id",
            as_date("ts").alias("data_real_devolucao"), (F.col("user_id") % 10).alias("nk_id_patio_devolucao"))
    cdc.run_stream(_feed(spark, sf_dir), cdc.upsert(t, prep), ck)
    return t.updated(["data_real_devolucao", "nk_id_patio_devolucao"])


def st5_child_total(spark, sf_dir):
    base, ck = _dirs(spark, "st5")
    parents = Analogue(spark, sf_dir).t("customer", "c_custkey").select(
        "c_custkey", F.lit(0).cast("decimal(22,2)").alias("valor_total"))
    kids = cdc.Target(spark, f"{base}/children", ("user_id", "event_id"), "event_id")

    def prep(b):
        return b.select("user_id", "event_id", "event_type", "ts", F.col("value").cast("decimal(12,2)").alias("valor"))
    cdc.run_stream(_feed(spark, sf_dir), cdc.upsert(kids, prep), ck)
    return cdc.child_totals(parents, kids.latest(), "c_custkey", "user_id", "valor", "valor_total",
                            "event_type in ('purchase', 'click')")


def st6_update_only(spark, sf_dir):
    from locastar.sources.analogue import ORDER_STATUS, _case
    base, ck = _dirs(spark, "st6")
    t = cdc.Target(spark, f"{base}/reservations", ("nk_id_reserva",), "event_id")
    t.begin(Analogue(spark, sf_dir).t("orders", "o_orderkey", "o_orderstatus").select(
        F.col("o_orderkey").alias("nk_id_reserva"), _case(F.col("o_orderstatus"), ORDER_STATUS).alias("status_reserva")))
    status = _case(F.col("event_type"), EVENT_STATUS, "ATIVA")

    def prep(b):
        return b.select(F.col("user_id").alias("nk_id_reserva"), "event_id", status.alias("status_reserva"))
    cdc.run_stream(_feed(spark, sf_dir), cdc.upsert(t, prep), ck)
    return t.updated(["status_reserva"])


def st7_cascade(spark, sf_dir):
    """Raw upsert and conform in the same micro-batch: the batch's last raw rows
    are written, and conformed from what was written. A key's conformed row is
    its newest raw row's, so an older change that comes late never overwrites
    newer data, and a key whose newest raw row is invalid leaves the layer."""
    base, ck = _dirs(spark, "st7")
    raw = cdc.Target(spark, f"{base}/raw", ("user_id",), "event_id")
    conf = cdc.Target(spark, f"{base}/conf", RENTAL, "event_id")
    keep = cdc.upsert(raw, lambda b: b.select("user_id", "event_id", "event_type", "value", "ts"))

    def step(batch, batch_id):
        conf.append(_conformed_changes("user_id")(keep(batch, batch_id)), batch, batch_id)
    cdc.run_stream(_feed(spark, sf_dir), step, ck)
    return cdc.cascaded(conf.changes(), RENTAL, "event_id").select(*CONF_COLS)


STREAM_QUERIES = {f.__name__: f for f in [st1_latest_upsert, st2_conform_stream, st2_outcomes, st2b_silent_updates,
                                          st3_enrich_stream, st4_close_out, st5_child_total, st6_update_only, st7_cascade]}
