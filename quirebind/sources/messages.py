"""Message files: a JSON message per line, in their order of arrival.

A delivery's place is that of its line: the time its file came, the file, the block of the
file and the line in it.  Nothing a sender writes is asked.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PLACE = ("file_modification_time", "file_path", "file_block_start")


def read_stream(spark: SparkSession, folder: str, files_per_batch: int) -> DataFrame:
    """The messages of ``folder`` as a stream, oldest files first: value and ``place``."""
    lines = (
        spark.readStream.schema("value string")
        .option("maxFilesPerTrigger", files_per_batch)
        .text(folder)
    )
    return lines.select("value", F.struct(*[f"_metadata.{c}" for c in _PLACE]).alias("place"))


def with_arrival(batch: DataFrame) -> DataFrame:
    """value and ``arrival`` of a micro-batch: places, and the order of lines inside one.

    A block's lines are read in order by one task, so the running number grows along them,
    whatever it starts from.
    """
    line = F.monotonically_increasing_id()
    return batch.select("value", F.struct("place.*", line.alias("line")).alias("arrival"))
