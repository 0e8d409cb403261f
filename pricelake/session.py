"""Spark session defaults for the warehouse.

Only settings that change *results* or *plan shape* live here; cluster sizing
(executor memory, cores) is left to whoever submits the job.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. UTC is part of the semantics: a "day" is a
# UTC day everywhere (load-day filters, marts, freshness gate).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings that shape the physical plan. AQE re-plans joins at runtime from
# real shuffle sizes, splits skewed partitions and coalesces small ones.
PLAN_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Partition overwrite replaces only the partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    master: str | None = None,
    app_name: str = "pricelake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the warehouse defaults.

    ``master`` is only set when given, so ``spark-submit`` keeps control on a
    cluster. The web UI is off: jobs here are batch and non-interactive.
    """
    builder = (SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    for k, v in {**SEMANTIC_CONF, **PLAN_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Apply the semantic settings to an existing session (e.g. the driver's)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only
    when it is unset (local runs, tests) do we set a scratch folder ourselves.
    """
    sc = spark.sparkContext
    in_context = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    current = spark.conf.get("spark.checkpoint.dir", None) or in_context
    if current:
        if not in_context:
            sc.setCheckpointDir(current)  # DataFrame.checkpoint() lands in the same shared folder
        return current
    master = spark.sparkContext.master or ""
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder: intermediate tables go there")
    path = tempfile.mkdtemp(prefix="pricelake-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def sizing_conf(
    input_bytes: int,
    executor_memory_bytes: int,
    cores_per_executor: int,
    executors: int,
) -> dict[str, str]:
    """Shuffle and split sizes for a cluster run, so partitions fit in memory.

    A task gets roughly ``executor memory / cores`` of heap, of which about
    half serves execution (sorts, hash tables, WindowGroupLimit buffers).
    Target partitions of at most a quarter of that, capped at 256 MB; take
    enough shuffle partitions for the whole input at that size (never fewer
    than 3 waves of the cluster's cores), and let AQE coalesce small ones and
    split skewed ones from the real sizes.
    """
    per_task = executor_memory_bytes // max(1, cores_per_executor)
    target = max(32 << 20, min(256 << 20, per_task // 4))
    cores = max(1, cores_per_executor * executors)
    partitions = max(3 * cores, -(-input_bytes // target))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(min(target, 128 << 20)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target),
    }
