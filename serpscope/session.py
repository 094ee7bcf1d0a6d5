"""Session settings and the shared scratch folder."""

import gc
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: Bytes of rows that go to a Python worker at a time where texts are long. Executor and worker each
#: hold a batch several times over; Spark's own bound is on rows, whatever their length.
BATCH_BYTES = 4 << 20
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "serpscope", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators assume (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Streaming state off the heap, so that it may outgrow executor memory.
        "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


_shipped: set[str] = set()
_local_dirs: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="serpscope-")) / root.name
    archive = shutil.make_archive(str(target), "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def bound_batches(spark: SparkSession) -> None:
    """From now on no batch for a Python worker grows beyond BATCH_BYTES and a row. A smaller bound
    that the session has stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    jvm = spark._jvm.org.apache.spark.network.util.JavaUtils
    if jvm.byteStringAsBytes(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only for local runs that name none."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="serpscope-")
        spark.sparkContext.setCheckpointDir(_local_dirs[app])
    return _local_dirs[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/serpscope/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", **options) -> DataFrame:
    """Cut lineage through a written table: one pass, columnar, survives lost executors. ``options``
    go to the writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of steps whose results are written.

    Spark removes them when the driver's garbage collector finds that no plan refers to them, which
    in a large heap can take hours; until then they fill the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
