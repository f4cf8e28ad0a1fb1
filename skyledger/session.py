"""Session helpers: builder defaults, shared scratch space and lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Compressed bytes a task reads at most, of a file or of a shuffle, as far as keys allow.
SPLIT_BYTES = 16 << 20
#: Bytes of a table's files for each of the partitions that shuffles begin with.
PARTITION_BYTES = 1 << 20


def build_session(app: str = "skyledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library defaults; keyword names use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    settings.update({k.replace("_", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Settings every operator counts on.

    Epoch and day boundaries are UTC. Generated stages larger than the JVM compiles (8000 bytes of bytecode) would run
    interpreted, many times slower; with the limit Spark compiles such a stage operator by operator instead. A task reads
    ``SPLIT_BYTES`` of compressed columns at most: rows take 20 to 60 times as much in the hash table of a sum. Adaptive
    execution joins shuffle partitions up to as many bytes, which widen alike in a sort or a hash table.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    if split > SPLIT_BYTES:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(SPLIT_BYTES))
    advisory = spark._jsparkSession.sessionState().conf().getConf(spark._jvm.org.apache.spark.sql.internal.SQLConf.ADVISORY_PARTITION_SIZE_IN_BYTES())
    if advisory > SPLIT_BYTES:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SPLIT_BYTES))
    return spark


INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def partition_for(spark: SparkSession, path: str) -> SparkSession:
    """Shuffles of this session begin with a partition for every ``PARTITION_BYTES`` of the table at ``path``, or with more.

    A fixed number of partitions grows with the data, and so does the memory of the task that sorts one. Adaptive execution
    joins those that turn out small, so the largest table read sets the number.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    now = int(spark.conf.get(INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    if -(-size // PARTITION_BYTES) > now:
        spark.conf.set(INITIAL, str(-(-size // PARTITION_BYTES)))
    return spark


def local_scratch(spark: SparkSession, folder: str | None = None) -> SparkSession:
    """Names a scratch folder on a local master where none is set: for tests, the bench and the driver's entry.

    A session that already has ``spark.checkpoint.dir`` is left alone, and so is a cluster, where only the operator
    of the cluster knows a folder every executor can reach. A folder made here is removed when the process ends.
    """
    if _checkpoint_dir(spark) or not spark.sparkContext.master.startswith("local"):
        return spark
    if folder is None:
        folder = tempfile.mkdtemp(prefix="skyledger-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return spark


def _checkpoint_dir(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; without one there is no place all executors share."""
    configured = _checkpoint_dir(spark)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return configured.rstrip("/")


_made: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; ``release_scratch`` deletes it."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release_scratch(spark: SparkSession) -> None:
    """Delete everything this process stored below the shared folder. Results that read from it are written by then."""
    while _made:
        delete_path(spark, _made.pop())


REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is run here leaves no shuffle files behind; else they stay until the driver happens to collect its garbage."""
    before = spark.conf.get(REMOVE_SHUFFLES, None)
    spark.conf.set(REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(REMOVE_SHUFFLES) if before is None else spark.conf.set(REMOVE_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the table to the shared folder and go on from there.

    Later steps start from stored files, so a lost executor costs a re-read only; unlike a checkpoint the rows are
    computed once, and the new scan brings exact sizes to the planner. The shuffles behind it are removed.
    """
    path = scratch_path(df.sparkSession, "step")
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def forget(df: DataFrame) -> None:
    """Delete a stored table that nothing will read again."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)
