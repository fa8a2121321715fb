"""Session and shared-folder helpers.

Every job runs with UTC session time (test tables hold ``timestamp_ntz``),
ANSI mode left on (so permissive casts are explicit ``try_*`` calls) and AQE
enabled so joins and shuffle partition counts are re-planned from runtime
statistics rather than guesses.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job relies on. Cluster-sized knobs (shuffle
# partitions, executor memory) are left to the cluster's own config.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "tierflow",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static confs of an existing session
                pass
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a session with a local master (tests) gets a scratch folder when none
    is set; on a cluster a missing setting is an error, because a folder of the
    driver's own disk could not be seen by the executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = sc.getConf().get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
    if not d and sc.master != "local" and not sc.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="tierflow-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir()
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder for one job run."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tierflow-work/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nobody holds any more. It
    does so when the driver's garbage collector finds them dead, which a driver
    that only holds counts may not run for a whole job."""
    spark._jvm.System.gc()


def local_path(uri: str) -> str:
    """Plain filesystem path for ``file:`` URIs (used only by local tests)."""
    if uri.startswith("file:"):
        p = uri[5:]
        while p.startswith("//"):
            p = p[1:]
        return p
    return uri


def env_master() -> str:
    return f"local[{os.environ.get('BENCH_CPUS', '8')}]"
