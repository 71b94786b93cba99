"""SparkSession helpers: one place for the engine settings the jobs rely on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every job wants regardless of cluster size: adaptive execution
# re-plans joins/partition counts from runtime sizes, skew-join splits hot
# partitions, UTC keeps date arithmetic independent of the host.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    # size-checked broadcast: a join side is broadcast only when its runtime
    # (AQE) or estimated size is under this bound; otherwise sort-merge join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # partition sizing: scans split at 128 MB, shuffles coalesced by AQE to
    # ~128 MB per task; on a cluster set spark.sql.shuffle.partitions high
    # (thousands) and let AQE merge small partitions.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "locastar",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, creating one (with ENGINE_CONF) if needed."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of ENGINE_CONF to an existing session."""
    for k, v in ENGINE_CONF.items():
        if k == "spark.ui.enabled":
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a running session: leave as is
            pass


#: For jobs of many queries on whole tables: a query's shuffle files go when it ends (else they
#: stay until the driver happens to collect its garbage), and what is written takes less disk.
LEAN_DISK = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
             "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]):
    """``conf`` holds in the session while the block runs; then what held before."""
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: Independent writes that run at the same time.
TOGETHER = 4


def together(spark: SparkSession, jobs: dict[str, Callable]) -> dict:
    """Results of independent jobs, run side by side; the first failure is raised."""
    with ThreadPoolExecutor(TOGETHER) as pool:
        started = {k: pool.submit(inheritable_thread_target(spark)(job)) for k, job in jobs.items()}
        return {k: f.result() for k, f in started.items()}


#: Scratch folders of local sessions without a setting, by application.
_SCRATCH: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder from ``spark.checkpoint.dir``.

    On a cluster the operator sets ``spark.checkpoint.dir`` to a shared
    folder; it is used as is. Only when it is unset on a local master
    (tests, local runs) a scratch folder is made, one for the session; on a
    cluster the setting must be there.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or \
        spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _SCRATCH:
            _SCRATCH[app] = tempfile.mkdtemp(prefix="locastar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
            atexit.register(shutil.rmtree, _SCRATCH[app], ignore_errors=True)
        d = _SCRATCH[app]
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate written table under the shared checkpoint folder.

    The application's folder goes when its driver ends: what a query returns
    reads these tables, so they live as long as the session.
    """
    folder = os.path.join(ensure_checkpoint_dir(spark), "tables", spark.sparkContext.applicationId)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return os.path.join(folder, name)
