"""Stored tables that are read by key.

A keyed folder holds its rows in folders by bucket of the key, so a reader with some keys
opens the buckets of these keys and nothing else.  ``KeyedTable`` is such a folder, written
once.  ``KeyedRuns`` grows by batches: every batch writes a run, and ``fan`` runs of a size
become one of the next size, so batch N meets at most ``fan - 1`` runs per power of ``fan``
whatever N is, and a row is rewritten once per power.  The number of buckets follows the
number of rows of a run: a bucket does not grow with the table.

Which runs hold the batches before N follows from N alone.  A batch writes runs that no
earlier batch reads, and its mark last.  So one that is done again, after a failure at any
point, writes what it wrote before, readers see marked batches only, and nothing is taken
away that a batch or reader of the last mark still needs.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 20_000
BUCKET, _HASH = "_bucket", "_hash"
#: From one in so many buckets on a reader of a stored table prunes one listing of all.
MANY = 8


class Folders:
    """Names in a folder of any file system that Spark reads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path(path))]

    def drop(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def time_of(self, path: str) -> int | None:
        """When a file was written; None if there is none."""
        found = self._path(path)
        return self._fs.getFileStatus(found).getModificationTime() if self._fs.exists(found) else None

    def touch(self, path: str) -> None:
        self._fs.create(self._path(path), True).close()

    def move(self, path: str, to: str) -> None:
        self._fs.mkdirs(self._path(to).getParent())
        if not self._fs.rename(self._path(path), self._path(to)):
            raise OSError(f"{path} can not be moved to {to}")

    def set_time(self, path: str, millis: int) -> None:
        self._fs.setTimes(self._path(path), millis, -1)


def _fields(schema: str) -> list[str]:
    """Top-level fields of a schema string."""
    out, depth = [""], 0
    for char in schema:
        depth += (char in "<(") - (char in ">)")
        if char == "," and not depth:
            out.append("")
        else:
            out[-1] += char
    return out


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def buckets_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """A power of two, so that buckets of few divide evenly among those of many."""
    return 1 << max(0, (max(1, rows) - 1) // per_bucket).bit_length()


def write_keyed(rows: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Replace the keyed folder ``path``."""
    _store(_dealt(rows, keys, buckets), path, buckets)


def _dealt(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET)


def _store(dealt: DataFrame, path: str, buckets: int) -> None:
    dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{path}/buckets={buckets}")


def newest_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each key's last batch.  Where rows are dealt to buckets, which hold all
    rows of a key, they stay there."""
    own = [*keys, BUCKET] if BUCKET in rows.columns else list(keys)
    columns = [c for c in rows.columns if c not in own]
    last = F.max_by(F.struct(*columns), "batch_id").alias("_last")
    return rows.groupBy(*own).agg(last).select(*own, "_last.*")


def _buckets_of(asked: DataFrame, keys: Sequence[str], buckets: int) -> set[int]:
    """Buckets of the keys asked for: at most ``buckets`` numbers reach the driver."""
    rows = asked.select(bucket_of(keys, buckets).alias("b")).distinct().collect()
    return {r["b"] for r in rows}


def _read(
    spark: SparkSession, folders: Folders, path: str, schema: str, buckets: int,
    wanted: set[int] | None,
) -> DataFrame | None:
    """The rows in the wanted buckets (None: in all); None if there are none."""
    base = f"{path}/buckets={buckets}"
    own = None if wanted is None else {w % buckets for w in wanted}
    if own is None or len(own) == buckets:
        found = [base]  # listed by Spark, as one folder
    else:
        named = (f"{base}/{BUCKET}={b}" for b in sorted(own))
        found = [p for p in named if folders.exists(p)]
    if not found:
        return None
    rows = spark.read.schema(f"{schema}, {BUCKET} int").option("basePath", base).parquet(*found)
    return rows.drop(BUCKET)


def _in_buckets(rows: DataFrame, wanted: set[int], buckets: int) -> DataFrame:
    """Of all rows those in the wanted buckets; the other folders are not opened."""
    others = set(range(buckets)) - wanted
    if not others:
        return rows
    few, no = (wanted, "") if len(wanted) <= len(others) else (others, "not ")
    return rows.filter(f"{BUCKET} {no}in ({', '.join(map(str, sorted(few)))})")


def _count_of(folders: Folders, path: str) -> int:
    """The number of buckets of a keyed folder."""
    found = [n for n in folders.names(path) if n.startswith("buckets=")]
    if len(found) != 1:
        raise ValueError(f"{path} is no keyed folder")
    return int(found[0].removeprefix("buckets="))


class KeyedTable:
    """A table stored by key.

    ``of`` reads the buckets asked for, ``only`` leaves out most other rows, ``known`` reads
    their keys: rows are stored by column, so what else they hold, which may be large, is
    not read.  Where many buckets are asked for, as by a batch of many keys, the folder is
    listed once for all batches.
    """

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str]) -> None:
        self.spark, self.root, self.schema, self.keys = spark, root, schema, list(keys)
        self._folders = Folders(spark, root)
        self._listed: tuple[str, int, DataFrame] | None = None

    def write(self, rows: DataFrame, buckets: int) -> "KeyedTable":
        write_keyed(rows, f"{self.root}/rows", self.keys, buckets)
        return self

    def of(self, asked: DataFrame) -> DataFrame:
        """The rows in the buckets of the keys in ``asked``: all rows of these keys, and
        of some others."""
        path = f"{self.root}/rows"
        buckets = _count_of(self._folders, path)
        wanted = _buckets_of(asked, self.keys, buckets)
        if len(wanted) * MANY > buckets:
            whole = self._whole(f"{path}/buckets={buckets}")
            if whole is not None:
                return _in_buckets(whole, wanted, buckets).drop(BUCKET)
        rows = _read(self.spark, self._folders, path, self.schema, buckets, wanted)
        return self.spark.createDataFrame([], self.schema) if rows is None else rows

    def _whole(self, base: str) -> DataFrame | None:
        """All buckets, listed when first asked for and after each write; None if the folder
        does not tell when it was written."""
        written = self._folders.time_of(f"{base}/_SUCCESS")
        if written is None:
            return None
        if self._listed is None or self._listed[:2] != (base, written):
            rows = self.spark.read.schema(f"{self.schema}, {BUCKET} int").parquet(base)
            self._listed = (base, written, rows)
        return self._listed[2]

    def only(self, asked: DataFrame) -> DataFrame:
        """The rows of the keys in ``asked``, and of others whose hash is one of theirs.

        Most rows of a bucket are of no use to a batch, and one number tells so sooner than
        the keys do."""
        hashed = lambda df: df.withColumn(_HASH, F.xxhash64(*self.keys))
        wanted = hashed(asked.select(*self.keys)).select(_HASH)
        return hashed(self.of(asked)).join(wanted, _HASH, "left_semi").drop(_HASH)

    def known(self, asked: DataFrame) -> DataFrame:
        """The keys in the buckets of the keys in ``asked``."""
        return self.of(asked).select(*self.keys)


class KeyedRuns:
    """A table that grows by a run per batch, numbered from 0 without gaps.

    With ``newest`` a key has one row, that of its last batch; without it all rows stay.
    Rows carry their ``batch_id``.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: str, keys: Sequence[str],
        newest: bool = True, fan: int = 8, rows_per_bucket: int = ROWS_PER_BUCKET,
    ) -> None:
        self.spark, self.root, self.keys, self.newest = spark, root, list(keys), newest
        self.schema = f"{schema}, batch_id bigint"
        self.fan, self.rows_per_bucket = fan, rows_per_bucket
        self._folders = Folders(spark, root)

    def runs_before(self, batch_id: int) -> list[tuple[int, int]]:
        """(power, last batch) of the runs that hold the batches before ``batch_id``."""
        power, size = 0, 1
        while size * self.fan <= batch_id:
            power, size = power + 1, size * self.fan
        runs, done = [], 0
        while size:
            while batch_id - done >= size:
                done += size
                runs.append((power, done - 1))
            power, size = power - 1, size // self.fan
        return runs

    def _path(self, run: tuple[int, int]) -> str:
        return f"{self.root}/power={run[0]}/upto={run[1]}"

    def _reduced(self, rows: DataFrame) -> DataFrame:
        return newest_of(rows, self.keys) if self.newest else rows

    def _rows(self, runs: list[tuple[int, int]], asked: DataFrame | None) -> DataFrame:
        counts = {run: _count_of(self._folders, self._path(run)) for run in runs}
        wanted = None
        if asked is not None and runs:
            wanted = _buckets_of(asked, self.keys, max(counts.values()))
        found = None
        for run in runs:
            rows = _read(
                self.spark, self._folders, self._path(run), self.schema, counts[run], wanted)
            if rows is not None:
                found = rows if found is None else found.unionByName(rows)
        return self.spark.createDataFrame([], self.schema) if found is None else found

    def before(self, batch_id: int, asked: DataFrame | None = None) -> DataFrame:
        """The table as the batches before ``batch_id`` left it; with ``asked``, of its
        keys only, from their buckets."""
        rows = self._rows(self.runs_before(batch_id), asked)
        if asked is not None:
            rows = rows.join(asked.select(*self.keys).distinct(), self.keys, "left_semi")
        return self._reduced(rows)

    def marked(self) -> int:
        """The number of batches that are complete."""
        return 1 + max(
            (int(n.removeprefix("batch=")) for n in self._folders.names(f"{self.root}/marks")),
            default=-1,
        )

    def current(self, asked: DataFrame | None = None) -> DataFrame:
        """The table as the last complete batch left it."""
        return self.before(self.marked(), asked)

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Add the rows of a batch (without ``batch_id``), and merge what is due.

        ``rows`` is counted and read once more, so give a stored table.
        """
        mark = f"{self.root}/marks/batch={batch_id}"
        if self._folders.exists(mark):
            return  # done before, with the same rows
        self._drop_unread(batch_id)
        numbered = rows.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        self._write_run(numbered, (0, batch_id), rows.count())
        power, size = 1, self.fan
        while (batch_id + 1) % size == 0:
            parts = [
                (power - 1, batch_id - k * (size // self.fan)) for k in reversed(range(self.fan))
            ]
            merged = self._rows(parts, None)
            self._write_run(merged, (power, batch_id), merged.count())
            power, size = power + 1, size * self.fan
        self._folders.touch(mark)

    def _write_run(self, rows: DataFrame, run: tuple[int, int], count: int) -> None:
        path = self._path(run)
        self._folders.drop(path)  # what a run that failed has left, in as many buckets as it had
        columns = [f.strip().split(" ")[0] for f in _fields(self.schema)]
        buckets = buckets_for(count, self.rows_per_bucket)
        # Dealt to buckets first, so that rows move once, not for their keys and then again.
        dealt = _dealt(rows.select(*columns), self.keys, buckets)
        _store(self._reduced(dealt).select(*columns, BUCKET), path, buckets)

    def _drop_unread(self, batch_id: int) -> None:
        """Runs that neither this batch nor readers of the last two marks need."""
        needed = {
            run for n in (batch_id - 1, batch_id) if n >= 0 for run in self.runs_before(n)
        }
        for power in self._folders.names(self.root):
            if not power.startswith("power="):
                continue
            for upto in self._folders.names(f"{self.root}/{power}"):
                run = (int(power.removeprefix("power=")), int(upto.removeprefix("upto=")))
                if run not in needed and run[1] < batch_id:
                    self._folders.drop(self._path(run))
