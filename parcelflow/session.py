"""Session settings the library relies on, and where it may write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Results depend on these: zoneless text is read as UTC, malformed numbers must
# raise, and the last of two equal JSON keys wins.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Speed only. Shredding stores the payload's frequent fields as real Parquet
# columns, and the pushed-down variant scan then reads just the asked-for ones.
# Stream joins keep their state in RocksDB, off the heap, and upload only changes.
PERFORMANCE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the library's settings to an existing session.

    ``shuffle_bytes`` is the largest shuffle the caller expects; it raises
    ``spark.sql.shuffle.partitions`` so that a partition stays near 200 MB.
    AQE merges what turns out too small, but never splits a plain shuffle.
    """
    for name, value in {**SEMANTICS, **PERFORMANCE}.items():
        spark.conf.set(name, value)
    if shuffle_bytes is not None:
        wanted = -(-shuffle_bytes // (200 << 20))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200MB")
        if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
            spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def new_session(app: str = "parcelflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; give dotted settings as ``**{"spark.x.y": "v"}``."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared ``spark.checkpoint.dir``, deleted when the application ends.

    Only a local master may go without that setting; it then gets a folder on
    this machine, which is where all of its tasks run.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="parcelflow-")
        spark.conf.set("spark.checkpoint.dir", shared)
    own = f"{shared.rstrip('/')}/parcelflow/{spark.sparkContext.applicationId}"
    if own not in _OWN:
        path = spark._jvm.org.apache.hadoop.fs.Path(own)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(path)
        fs.deleteOnExit(path)
        _OWN.add(own)
    return f"{own}/{purpose}-{uuid.uuid4().hex[:12]}"


# Folders of this process's applications that are marked for deletion.
_OWN: set[str] = set()
