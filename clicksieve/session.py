"""Session settings and the folder jobs share."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# State off the JVM heap; checkpoints carry changes, not whole snapshots; no extra reads to count rows.
# Adaptive execution merges small partitions and cannot split the sorted walks, so it starts from many. Streams
# keep the number they start with as the width of their state.
SHUFFLE_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


# Batches that go to Python and back hold so many bytes, not so many rows whatever their length: executors and workers
# hold several copies of one, and what they once allocated they seldom give back.
BATCH_SETTINGS = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def build_session(app="clicksieve", master=None, **conf):
    """A session with the settings the operators are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Splitting a skewed join input is worth a further shuffle.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    # On one machine the many partitions would be nearly empty.
    wide = {} if (master or "").startswith("local") else SHUFFLE_SETTINGS
    for name, value in {**wide, **STATE_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return use_utc(builder.getOrCreate())


def use_utc(spark):
    """Event times are read and bucketed in UTC whatever the machine's zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def use_rocksdb_state(spark):
    """Stateful processors need the RocksDB provider."""
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def use_short_batches(spark):
    """Long texts go to Python a few at a time in this session from now on."""
    for name, value in BATCH_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark):
    """The folder every node can reach: ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster
    must name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="clicksieve-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark, name):
    """An unused path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
