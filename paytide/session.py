"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings the results depend on, or that a large state needs.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build(app: str = "paytide", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's settings; the cluster decides everything not named here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME, STATE_STORE: ROCKSDB, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for name, value in RUNTIME.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, sinks and stream checkpoints.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Where that is
    unset, a local session gets a folder of its own; a cluster session is refused, because
    executors on other machines could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="paytide-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/paytide/{name}-{uuid.uuid4().hex}"
