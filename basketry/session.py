"""Session settings and the shared working folder."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Needed by every query: one clock for windows and dates.
QUERY_CONF = {"spark.sql.session.timeZone": "UTC"}

# State on disk with small changelog checkpoints; open sessions of one user are merged on the map
# side, so a very busy user sends one row per session and task instead of every event.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# Runtime re-planning: joins turn into broadcasts only from measured sizes, skewed partitions split.
BATCH_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "basketry", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**QUERY_CONF, **BATCH_CONF, **STREAM_CONF, **conf}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers of a session, once, so that they find it wherever they run and whatever
    folder the driver was started in."""
    top = os.path.dirname(os.path.abspath(__file__))
    sources = sorted(
        os.path.join(folder, name) for folder, _, names in os.walk(top) for name in names if name.endswith(".py"))
    content = {os.path.relpath(s, os.path.dirname(top)): open(s, "rb").read() for s in sources}
    digest = hashlib.sha256(repr(sorted(content.items())).encode()).hexdigest()[:16]
    name = f"{os.path.basename(top)}-{digest}.zip"
    if name not in spark.sparkContext._python_includes:
        path = os.path.join(os.path.realpath(tempfile.mkdtemp()), name)
        with zipfile.ZipFile(path, "w") as packed:
            for inner, data in content.items():
                packed.writestr(inner, data)
        spark.sparkContext.addPyFile(path)
        # Stateful streams also start Python beside the driver, which does not look into these files.
        environment, parent = spark.sparkContext.environment, os.path.dirname(top)
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [parent, environment.get("PYTHONPATH")]))
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the package and the settings that results depend on; the rest is its owner's."""
    ship(spark)
    for key, value in QUERY_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A new folder that executors on every host see: below ``spark.checkpoint.dir``, else in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
