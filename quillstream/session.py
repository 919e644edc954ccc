"""Session construction and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job here relies on. AQE coalesces the small shuffles (word
# counts shrink a lot after partial aggregation) and splits skewed partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_SHIPPED: set[str] = set()  # applications that have the package


def build_session(
    master: str | None = None,
    app_name: str = "quillstream",
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the settings the library expects.

    ``master`` is set only when given, so ``spark-submit --master`` (or the
    cluster's configuration) decides otherwise; without either, Spark's default.

    ``checkpoint_dir`` is a fallback used only when the session has no
    ``spark.checkpoint.dir`` of its own; a cluster's shared folder always wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir is not None and not _configured_checkpoint(spark):
        # only where the cluster names no shared folder (local runs, tests)
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def _configured_checkpoint(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Raises if the session has none: a machine-local temporary folder would not
    survive the loss of an executor, so the library never invents one.
    """
    root = _configured_checkpoint(spark)
    if not root:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; configure a shared folder for "
            "checkpoints, ledgers and stream state"
        )
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Operators that cut lineage write to the shared folder that the session names in
    ``spark.checkpoint.dir``. Only a local session without one gets a folder of its
    own; a cluster has to name it."""
    if _configured_checkpoint(spark):
        return
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quillstream-checkpoints-"))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, once a session,
    wherever the driver was started (a zip of its sources through ``addPyFile``)."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quillstream-package-"), "quillstream.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A sub-folder of the shared checkpoint root, e.g. for a stream checkpoint."""
    return "/".join([checkpoint_root(spark), *[p.strip("/") for p in parts]])


def default_partitions(spark: SparkSession) -> int:
    """Partition count for explicit repartitions: the session's shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def parallelism(spark: SparkSession) -> int:
    """Cores available to the session (shuffle partitions where the
    SparkContext is not reachable, e.g. over Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # no SparkContext in this client
        return default_partitions(spark)

