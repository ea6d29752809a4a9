"""Session settings and the shared scratch folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Set on every session: partition days and text timestamps must not depend on the machine.
PINNED = {"spark.sql.session.timeZone": "UTC"}

# Set only where the session says nothing: state outside the heap, AQE for skew and small partitions; partitioned writes keep
# a file open per folder, up to this many a task, and only beyond sort their rows by folder; times are stored as numbers.
PREFERRED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` keys use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in (PINNED | PREFERRED).items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else built, leaving their explicit choices alone."""
    for key, value in PINNED.items():
        spark.conf.set(key, value)
    explicit = spark.sparkContext.getConf()
    for key, value in PREFERRED.items():
        if not explicit.contains(key) and spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


@contextmanager
def session_conf(spark: SparkSession, **conf: str):
    """Set SQL settings for the block; keys use `__` for `.`. Streams started inside keep them."""
    wanted = {key.replace("__", "."): value for key, value in conf.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield spark
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared checkpoint folder.

    `spark.checkpoint.dir` (or the context's checkpoint folder) is used when set. A machine-local
    folder is only accepted in local mode, where driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="scanweave-")
    return f"{base.rstrip('/')}/scanweave/{purpose}-{uuid.uuid4().hex}"
