"""Session settings and the shared folder for written intermediate results."""

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that Spark hands to a Python task at a time.
BATCH_BYTES = "4m"
_BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cpus: int = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and the bench.  On a cluster use the cluster's own:
    partition counts and memory belong to it."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quirebind")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Where in Python each Column was made: for debugging, a stack walk per call.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    A temporary folder stands in only where driver and tasks are one process, as in
    tests: on a cluster, also one of local machines, it would be lost with its
    machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="quirebind-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run inside hand whole texts to Python ``BATCH_BYTES`` at a time.

    Spark's 64 MB let a batch be a whole file split: task and worker then hold it several
    times over, outside the heap, and do not give all of it back.  Where the session has
    a size of its own, that holds.
    """
    if _BATCH_KEY in spark.conf.getAll:
        yield
        return
    spark.conf.set(_BATCH_KEY, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_KEY)


def _settled(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/settled/{spark.sparkContext.applicationId}"


def settle(df: DataFrame, by: str | None = None) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back.

    The files outlive lost executors, and their size is known to the planner,
    so a small result is broadcast and a large one is not.  They stay until
    ``drop_settled``, since results that are read later depend on them.  With ``by``
    each value of that column has a folder, which ``drop_one`` may remove or keep.
    """
    spark = df.sparkSession
    path = f"{_settled(spark)}/{uuid.uuid4()}"
    if by is None:
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    df.write.partitionBy(by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def drop_settled(spark: SparkSession) -> None:
    """Remove what this application has settled, once its results are stored."""
    _remove(spark, _settled(spark))


def drop_one(settled: DataFrame, keep: str = "") -> None:
    """Remove one settled result, once nothing reads it any more, but for the folder of
    one value that is named (``column=value``)."""
    spark = settled.sparkSession
    inside = f"/{spark.sparkContext.applicationId}/"
    for folder in {f.split(inside, 1)[1].rsplit("/", 1)[0] for f in settled.inputFiles()}:
        if not keep or not folder.endswith(f"/{keep}"):
            _remove(spark, f"{_settled(spark)}/{folder}")


def _remove(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
