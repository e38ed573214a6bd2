"""The folder all executors can reach."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a scratch folder only on local master.

    Checkpoints go there too.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="stratalake-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new, unused folder below the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    """(its file system, the path), on whatever file system it is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists."""
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    fs, hadoop = _path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def state_of(spark: SparkSession, path: str) -> tuple:
    """(name, length, time of change) of what a folder holds."""
    fs, hadoop = _path(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hadoop)))


def read_file(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, hadoop = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place, whole, unless there is one: then False."""
    jvm = spark.sparkContext._jvm
    fs, target = _path(spark, path)
    part = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    # a rename that doesn't replace: it is what decides between two writers
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), fs.getConf())
    plain = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(fs.makeQualified(part), fs.makeQualified(target), plain)
    except Py4JJavaError as error:
        fs.delete(part, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder with what it holds; whether there was one."""
    fs, hadoop = _path(spark, path)
    return fs.delete(hadoop, True)


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows stored in the shared folder, their lineage cut."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


#: Runtime settings every plan here counts on. AQE with splitting of skewed joins, also where
#: that costs a further shuffle. Shuffled partitions may be as small as 256 KB: payloads are
#: built from and parsed out of few bytes with much computing, so cores matter more than
#: partition size. Lists are collected in hash maps of up to 4,096 keys a task before it sorts
#: (default 128): they hold no more than the rows of the task, and a sort would serialize
#: every list. Shuffled and scanned partitions are small (default 64 and 128 MB): their rows are narrow and
#: much alike, and take twenty times as much and more when they are hashed, sorted or made into payloads.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m",
    "spark.sql.files.maxPartitionBytes": "16m",
}

#: Bytes of stored input for which a shuffle begins with one partition; AQE puts small ones together.
BYTES_PER_PARTITION = 2 << 20
MOST_PARTITIONS = 8192


def tune(spark: SparkSession) -> None:
    """Apply the settings to a session."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)


def shuffle_by_size(spark: SparkSession, folder: str) -> None:
    """Let shuffles begin with partitions in proportion to a folder's bytes, at least the session's number."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    fs, hadoop = _path(spark, folder)
    wanted = min(fs.getContentSummary(hadoop).getLength() // BYTES_PER_PARTITION, MOST_PARTITIONS)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(name, str(wanted))
    else:
        spark.conf.unset(name)


@contextmanager
def joining_by_part(spark: SparkSession) -> Iterator[None]:
    """Both sides of a join may lie together by some of its columns; they aren't shuffled again by all of them."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def batches_up_to(spark: SparkSession, size: int) -> Iterator[None]:
    """Arrow batches that the jobs inside send to Python workers end after ``size`` bytes, however long the texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def tuned(spark: SparkSession) -> Iterator[None]:
    """The settings for the jobs inside; the session's own come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    tune(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
