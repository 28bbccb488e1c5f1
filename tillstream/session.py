"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import time
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Skewed joins are split at run time even where the split costs one more exchange: a single
# straggling task over a hot key is the worse outcome.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Columnar files unpack to several times their size; without the factor a large fact table just
    # below the broadcast threshold on disk would be broadcast.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Topics, stores and logs are written once and read a few times: half the bytes of the default codec.
    "spark.sql.parquet.compression.codec": "zstd",
}

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tillstream", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave `master` unset and let spark-submit decide."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on to a session made elsewhere."""
    for key, value in _RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def conf_override(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Set runtime confs for a block. A streaming query keeps the confs it was started with."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tillstream-")


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Executors of a cluster must all see it, so a machine-local folder is used in local mode only.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, system = _file_system(spark, path)
    return system.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if it isn't there."""
    where, system = _file_system(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []


def make_folder(spark: SparkSession, path: str) -> None:
    where, system = _file_system(spark, path)
    system.mkdirs(where)


def replace_folder(spark: SparkSession, source: str | None, target: str) -> None:
    """Put a folder in the place of another; without a source the other just goes."""
    where, system = _file_system(spark, target)
    if system.exists(where) and not system.delete(where, True):
        raise OSError(f"{target} can't be replaced")
    if source:
        system.mkdirs(where.getParent())
        if not system.rename(_file_system(spark, source)[0], where):
            raise OSError(f"{source} can't be moved to {target}")


def release_shuffles(spark: SparkSession) -> None:
    """Let shuffle files of ended queries go. Spark removes them when the driver's garbage collector finds
    that nothing refers to them, which on a large heap may be long after."""
    spark._jvm.System.gc()


def drop_folder(spark: SparkSession, path: str, tries: int = 20) -> None:
    """Delete a folder that nothing reads any more. The threads that look after the state and the files of a
    query may outlive it by a moment and write or delete there, so it may take several tries."""
    where, system = _file_system(spark, path)
    for _ in range(tries):
        try:
            if not system.exists(where) or system.delete(where, True):
                return
        except Py4JJavaError:
            pass
        time.sleep(0.1)
    raise OSError(f"{path} can't be deleted")


def file_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size and time of the last change of a file, or of a folder's files together."""
    where, system = _file_system(spark, path)
    statuses = list(system.listStatus(where))
    return sum(s.getLen() for s in statuses), max((s.getModificationTime() for s in statuses), default=0)


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
