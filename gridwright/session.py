"""SparkSession construction and the shared scratch location."""

from __future__ import annotations

import atexit
import json
import logging
import re
import tempfile
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark.sql import SparkSession

# Settings every session of the job should carry. Sizes are left to AQE:
# partitions are coalesced after each shuffle and skewed join partitions are
# split, so one hot key does not end up in a single task.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(executors: int, cores_per_executor: int, broadcast_cap: str = "64m") -> dict[str, str]:
    """Settings for a large cluster, sized from its task slots.

    Shuffles start at 4 partitions per slot and AQE coalesces them towards
    128 MB each, so one setting fits both the small aggregate shuffles and
    the big ones. ``broadcast_cap`` bounds every broadcast, including the
    measured ones (maxima, territory map, staffed grid): each executor holds
    one copy.
    """
    slots = max(1, int(executors) * int(cores_per_executor))
    return {
        "spark.sql.shuffle.partitions": str(4 * slots),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(4 * slots),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": broadcast_cap,
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.files.openCostInBytes": "4m",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(
    master: str | None = None,
    app_name: str = "gridwright",
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the job settings.

    On a cluster pass ``master=None`` and let spark-submit decide; locally
    pass ``"local[N]"``. ``shuffle_partitions`` should be sized so one
    partition holds ~128 MB at the target scale (AQE coalesces from there).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(JOB_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``. Only a single-process
    local session (tests) gets a private folder when it is unset; on any
    other master that would be a folder the executors cannot see, so it is
    an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError(
                f"set spark.checkpoint.dir to a folder shared by all executors (master {spark.sparkContext.master})"
            )
        configured = tempfile.mkdtemp(prefix="gridwright-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


# Seconds after its last renewal that a session's scratch counts as abandoned.
LEASE_KEY, LEASE_SECONDS = "spark.gridwright.scratch.leaseSeconds", 3600
LEASES = "_leases"
log = logging.getLogger(__name__)
# Folders this process holds a lease of, with the event that ends its renewal.
_HELD: dict[str, threading.Event] = {}
_HELD_LOCK = threading.Lock()


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _write_lease(spark: SparkSession, folder: str, seconds: int) -> int:
    """Write the lease of a session's folder again; the time the shared file
    system gives it (ms)."""
    root, name = folder.rstrip("/").rsplit("/", 1)
    fs, path = _file_system(spark, f"{root}/{LEASES}/{name}.json")
    out = fs.create(path, True)
    try:
        out.write(bytearray(json.dumps({"owner": spark.sparkContext.applicationId, "seconds": seconds}).encode()))
    finally:
        out.close()
    return fs.getFileStatus(path).getModificationTime()


def hold_lease(spark: SparkSession, folder: str) -> None:
    """Lease the session's own checkpoint folder, once, and renew the lease
    while the driver lives; scratch that killed drivers left under the same
    root is removed first (``collect_abandoned``).

    A lease is a file beside the folder. Its age is measured against the
    lease just written, so both times are the file system's and the drivers'
    clocks do not matter."""
    with _HELD_LOCK:
        if folder in _HELD:
            return
        ended = _HELD[folder] = threading.Event()
    seconds = max(1, int(spark.conf.get(LEASE_KEY, str(LEASE_SECONDS))))
    now = _write_lease(spark, folder, seconds)
    collect_abandoned(spark, folder.rstrip("/").rsplit("/", 1)[0], now)

    def renew() -> None:
        while not ended.wait(seconds / 4):
            if spark.sparkContext._jsc is None:
                return
            try:
                _write_lease(spark, folder, seconds)
            except Exception as exc:  # tried again at the next turn, long before the lease ends
                log.warning("lease of %s not renewed: %s", folder, type(exc).__name__)

    threading.Thread(target=renew, name="gridwright-lease", daemon=True).start()


def collect_abandoned(spark: SparkSession, root: str, now: int) -> list[str]:
    """Delete the folders under ``root`` whose lease was last renewed longer
    before ``now`` (ms) than it lasts, then their leases; returns the folders.
    A folder without a lease is never touched, nor one this process holds. A
    lease that another session is collecting at the same time, or that cannot
    be read, is left for the next start."""
    fs, path = _file_system(spark, f"{root}/{LEASES}")
    if not fs.exists(path):
        return []
    jvm, removed = spark.sparkContext._jvm, []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if not re.fullmatch(r"[\w-]+\.json", name) or f"{root}/{name[:-5]}" in _HELD:
            continue
        try:
            stream = fs.open(status.getPath())
            try:
                seconds = int(json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["seconds"])
            finally:
                stream.close()
            if now - status.getModificationTime() <= 1000 * seconds:
                continue
            removed += _delete(spark, [f"{root}/{name[:-5]}"])
            fs.delete(status.getPath(), False)
        except Exception as exc:
            log.warning("lease %s left alone: %s", name, type(exc).__name__)
    return removed


# Open scratch scopes of the current context (innermost last). A context
# variable keeps refreshes in different threads apart; threads started by
# ``run_concurrently`` inherit their caller's scopes.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("gridwright_scratch_scopes", default=())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder. Inside a
    ``scratch_scope`` the path is removed when the scope ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    hold_lease(spark, base)
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    scopes = _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    else:
        _UNSCOPED.append((spark, path))
    return path


# Paths handed out outside any scope: their readers are lazy DataFrames whose
# last action is not known, so they go when the process ends.
_UNSCOPED: list[tuple[SparkSession, str]] = []


@atexit.register
def remove_unscoped() -> list[str]:
    """Delete the scratch handed out outside any scope, where its session
    still runs. Call it earlier when no DataFrame of it is in use."""
    held, _UNSCOPED[:] = list(_UNSCOPED), []
    removed = []
    for spark in {id(s): s for s, _ in held}.values():
        if spark.sparkContext._jsc is not None:
            removed += _delete(spark, [p for s, p in held if s is spark])
    return removed


def open_scopes() -> tuple[list[str], ...]:
    return _SCOPES.get()


def run_concurrently(*builders):
    """Run callables that each trigger Spark jobs in parallel threads, so
    independent jobs share the cluster instead of queueing (Spark schedules
    jobs from several threads concurrently). Each thread runs in a copy of
    the caller's context. Returns the results in order."""
    if len(builders) == 1:
        return [builders[0]()]
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        futures = [pool.submit(copy_context().run, b) for b in builders]
        return [f.result() for f in futures]


def _delete(spark: SparkSession, paths: list[str]) -> list[str]:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            fs.delete(p, True)
            removed.append(path)
    return removed


@contextmanager
def scratch_scope(spark: SparkSession):
    """Collect the scratch paths handed out inside the block and delete them
    on exit -- after the block's last action has read them. Paths from
    outside the block (other DataFrames still in use) are left alone."""
    paths: list[str] = []
    token = _SCOPES.set(_SCOPES.get() + (paths,))
    try:
        yield paths
    finally:
        _SCOPES.reset(token)
        _delete(spark, paths)


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (``local-cluster`` is not)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


__all__ = [
    "JOB_CONF",
    "cluster_conf",
    "build_session",
    "collect_abandoned",
    "ensure_checkpoint_dir",
    "hold_lease",
    "is_local",
    "open_scopes",
    "remove_unscoped",
    "run_concurrently",
    "scratch_path",
    "scratch_scope",
]
