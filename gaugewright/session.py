"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Streaming state on executor disk, so the number of keys is not bound by the heap.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Spark's runtime Bloom filters, for up to 8 million keys: 8 MB, and 2 % let through in vain.
_FILTER = "spark.sql.optimizer.runtime.bloomFilter."
SCAN_THRESHOLD = f"{_FILTER}applicationSideScanSizeThreshold"
RUNTIME_FILTER = {
    f"{_FILTER}enabled": "true",
    f"{_FILTER}creationSideThreshold": "256MB",
    SCAN_THRESHOLD: "1GB",
    f"{_FILTER}expectedNumItems": "8000000",
    f"{_FILTER}maxNumItems": "8000000",
    f"{_FILTER}numBits": "67108864",
    f"{_FILTER}maxNumBits": "67108864",
}

# Spark finds partition sizes, join sides and skewed partitions at run time; the zone is
# pinned because messages and tables carry zone-less UTC text.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoints of intermediate tables go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    **STATE_STORE,
    **RUNTIME_FILTER,
}


def build_session(app="gaugewright", master=None, settings=None) -> SparkSession:
    """A session with this library's settings; ``settings`` adds to or overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may go without: it then gets a folder of its own, once.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named:
        named = context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        named = tempfile.mkdtemp(prefix="gaugewright-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


# What this process made in the shared folder and the catalog, for ``clean_work``.
_made = {"paths": [], "databases": []}


def work_path(spark, purpose) -> str:
    """A new, unused path in the shared folder; ``clean_work`` deletes it."""
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    _made["paths"].append(path)
    return path


def work_database(name) -> str:
    """Remember a catalog database, made for one result, for ``clean_work``."""
    _made["databases"].append(name)
    return name


def clean_work(spark):
    """Delete all intermediate tables of this process. Results that were not stored are lost, since
    they read them; call it between jobs, or at the end."""
    for name in _made["databases"]:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    configuration = spark._jsc.hadoopConfiguration()
    for name in _made["paths"]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(configuration).delete(path, True)
    for made in _made.values():
        made.clear()
