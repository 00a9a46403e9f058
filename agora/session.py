"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

#: Jobs that the driver keeps going at a time.
TOGETHER = 4

# Settings that matter for the operators in this package.  AQE re-plans
# joins from runtime sizes, coalesces small shuffle partitions and splits
# skewed join partitions (a hot key may hold a third of all rows).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "agora",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` unset so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def together(jobs: Iterable[Callable[[], object]]) -> list:
    """The results of independent jobs, in order, a few running at a time: what
    one leaves idle (a numbering's only task, a write's commit) another uses.
    If one fails, its error goes on once the others have ended.  Jobs may leave
    tables to an open ``scratch`` block, but open none themselves."""
    with ThreadPoolExecutor(TOGETHER) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        running = [pool.submit(inherit(job)) for job in jobs]
        return [r.result() for r in running]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and written intermediate tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is
    read from the session and used as it is.  Only a local master may
    fall back to a fresh temporary folder: on a cluster each executor
    would write to its own disk and later reads would miss rows, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="agora-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()
