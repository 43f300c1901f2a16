"""Session defaults and the shared scratch location.

Scratch output (staged upsert versions, archive round trips, landing files) must live on the
shared filesystem the cluster names in ``spark.checkpoint.dir``; a machine-local temporary
folder would vanish with the executor that wrote it.  We read that setting from the session
and only fall back to a fresh local directory when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings we rely on for semantics (not only speed).
SEMANTIC_CONF = {
    # date/timestamp literals and run dates are wall-clock values, never shifted
    "spark.sql.session.timeZone": "UTC",
    # month=01 must stay a string when an archive is read back
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Settings for scale: AQE re-plans joins from runtime sizes, coalesces small shuffle
# partitions and splits skewed join partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML pages can be large: keep Arrow batches to the extractor bounded
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def build_session(master: str = "local[*]", app_name: str = "courtline",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs.  On a cluster, pass ``master=None`` and let
    spark-submit decide; the semantic settings are still applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": str(shuffle_partitions),
            "spark.driver.memory": "8g",
            **SCALE_CONF, **SEMANTIC_CONF, **(extra or {})}
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_semantic_conf(spark)
    return spark


# Rows per Arrow batch handed to Python (HTML pages, whole documents can be large).
MAX_ARROW_BATCH = 256


def apply_semantic_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings our operators depend on (idempotent), and make sure the
    Python workers can import this package."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)
    bound_arrow_batches(spark)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Distribute this package to the executors' Python workers (``addPyFile`` of a zip of
    it), once per application, so the extractors and UDFs unpickle wherever they run."""
    try:
        sc = spark.sparkContext
    except Exception:  # remote session: the server side provides the environment
        return
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="courtline-pkg-"), "courtline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def bound_arrow_batches(spark: SparkSession, limit: int = MAX_ARROW_BATCH) -> None:
    """Cap rows per Arrow batch for Python steps unless the session already caps lower."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    try:
        current = int(spark.conf.get(key, "10000"))
    except (TypeError, ValueError):
        current = 10000
    if current <= 0 or current > limit:
        spark.conf.set(key, str(limit))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint directory named by the session; set one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session has no SparkContext: use the conf
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            # a machine-local folder is only shared when the whole job runs in this process
            master = spark.conf.get("spark.master", "") or ""
            if not master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by the "
                                   "cluster (staging and lineage cuts live there)")
            root = tempfile.mkdtemp(prefix="courtline-ckpt-")
            if sc is None:
                spark.conf.set("spark.checkpoint.dir", root)
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/courtline-work/{name}-{uuid.uuid4().hex[:12]}"


def ensure_parallel(df, min_partitions: int | None = None):
    """Spread a narrow input over the cluster before a CPU-heavy Python step.

    Repartitions (round robin) only when the input has fewer partitions than the cluster
    has cores; a large input that already has enough splits is left alone, so at scale
    this adds no shuffle."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # no RDD view (remote session): leave partitioning to the server
        return df
    return df.repartition(want) if have < want else df
