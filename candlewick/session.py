"""Session helpers: one place that pins the settings every layer relies on.

The layer functions never create a session themselves; they take frames in
and hand frames out.  These helpers exist for tests, the bench and the entry
module, and for the few operators that need a durable folder (checkpoints,
written layer tables, streaming sinks).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the semantics depend on: UTC wall clock for bucketing and hour /
# weekday features, ANSI arithmetic (every division goes through nullif).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Broadcast policy: the static planner would broadcast from *estimated* sizes;
# only AQE may broadcast, from the measured size of a materialised stage.
BROADCAST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}

# Settings for throughput.  AQE re-plans joins from runtime sizes (a measured,
# not guessed, broadcast decision), coalesces small shuffle partitions and
# splits skewed join partitions.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "candlewick") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **BROADCAST_CONF, **TUNING_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (e.g. the driver's)."""
    for key, value in {**REQUIRED_CONF, **BROADCAST_CONF}.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster the operator names a shared folder in ``spark.checkpoint.dir``;
    we read it and never override it.  Where it is unset, a local session gets a
    fresh scratch folder; on a cluster that is an error, as a machine's own folder
    would lose rows.
    """
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not current:
        if not one_machine(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def one_machine(master: str) -> bool:
    """Whether the driver and all tasks share one machine's folders."""
    return master == "local" or master.startswith("local[")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared checkpoint folder (for written layer tables and sinks)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([base, *tail])
