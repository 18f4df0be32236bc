"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on. They can be set on a session somebody else built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when the aggregation above then needs its own exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # hash instead of sort where every partition of the smaller side is known to be small
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # a key that occurs twice keeps its last value, in every map that is built or merged
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# For a cluster: many small shuffle partitions that adaptive execution joins to the advised size.
# A value given in `extra` or by the cluster itself wins.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="runlens-package-"), "runlens")
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package)))
        # streams start a Python process of their own beside the driver, which does not get that file
        paths = [p for p in (context.environment.get("PYTHONPATH"), os.path.dirname(package)) if p]
        context.environment["PYTHONPATH"] = os.pathsep.join(paths)
        _shipped.add(context.applicationId)


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and send the package to its workers."""
    ship(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def get_spark(master: str | None = None, app: str = "runlens", shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # checkpointed data goes when nothing refers to it any more
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        given = dict(spark.sparkContext.getConf().getAll())
        for key, value in CLUSTER_CONF.items():
            if key not in given:
                spark.conf.set(key, value)
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` as the cluster names it.

    A machine-local folder is made only for a local master with the setting absent.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured is None:
        existing = context._jsc.sc().getCheckpointDir()
        if existing.isDefined():
            return existing.get()
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="runlens-")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(configured)
    return configured


# paths handed out inside the innermost `scratch` of this thread
_handed: ContextVar[list[str] | None] = ContextVar("handed", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other call uses."""
    path = os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
    handed = _handed.get()
    if handed is not None:
        handed.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at its end, also after an error, the intermediate tables that operators wrote inside.

    DataFrames read those tables when they run: write or collect results before the end. Only paths handed out by
    `scratch_path` in this thread go; tables with a path of their own stay.
    """
    handed: list[str] = []
    token = _handed.set(handed)
    try:
        yield
    finally:
        _handed.reset(token)
        for name in handed:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: it is computed once, whatever reads it.

    Unlike cached blocks the files outlive lost executors, and unlike `checkpoint()` the plan runs
    a single time and later readers fetch only the columns they need. With a `path` of its own the
    table replaces the one written there before, which suits work that is repeated for ever.
    """
    target = path or scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
