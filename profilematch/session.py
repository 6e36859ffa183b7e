"""Session defaults, the shared folder for cut lineage, jobs that tidy up after themselves, and size checks."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table of texts that a task counts, on average; partitions of that size in a bucket, at most.
PARTITION_ROWS, BUCKET_PARTITIONS = 2_000, 4


def build_session(app: str = "profilematch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on. Cluster settings come from spark-submit, not from here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="profilematch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


class Job:
    """Steps stored inside ``job``. ``keep`` stores a result with what is outside, so that it outlives the job."""

    def __init__(self, spark: SparkSession, outer: Job | None) -> None:
        self.spark, self.outer = spark, outer
        self.name = f"job_{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, label: str = "result") -> DataFrame:
        inside = _job.set(self.outer)
        try:
            return materialize(df, label)
        finally:
            _job.reset(inside)


_job: ContextVar[Job | None] = ContextVar("profilematch_job", default=None)


@contextmanager
def job(spark: SparkSession) -> Iterator[Job]:
    """Folders and catalog tables that are stored inside are dropped at the end, also after a failure.

    A frame that is read after the end has to go through ``keep``; jobs may be nested, and an inner job's result belongs
    to the outer one. If the driver is lost, ``drop_job`` drops what the job named left, from any session with the
    same catalog and folder. Steps outside of any job stay.
    """
    one = Job(spark, _job.get())
    inside = _job.set(one)
    try:
        yield one
    finally:
        _job.reset(inside)
        drop_job(spark, one.name)


def drop_job(spark: SparkSession, name: str) -> None:
    """Drop the tables and the folder of a job that is over; nothing happens if there are none."""
    if not re.fullmatch("job_[0-9a-f]{32}", name):
        raise ValueError(f"{name!r} is not the name of a job")
    for table in spark.catalog.listTables(pattern=f"profilematch_{name}_*"):
        spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(os.path.join(shared_folder(spark), "profilematch", name))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def step_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, inside the folder of the job that runs."""
    inside = _job.get()
    parts = [shared_folder(spark), "profilematch", *([inside.name] if inside else []), f"{label}-{uuid.uuid4().hex}"]
    return os.path.join(*parts)


def table_name() -> str:
    """A new name for the catalog, with that of the job that runs."""
    inside = _job.get()
    return "_".join(["profilematch", *([inside.name] if inside else []), uuid.uuid4().hex])


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = step_path(spark, label)
    with shuffle_cleanup(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_cleanup(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when each action ends, not when the driver collects garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def in_rounds(spark: SparkSession, rounds: int, step: Callable[[int], DataFrame], label: str) -> DataFrame:
    """The rows of ``step(0)``, ``step(1)``, ... stored one after the other: what a round shuffles goes before the next.

    One round is left to the caller's job and not stored.
    """
    if rounds == 1:
        return step(0)
    path, schema = step_path(spark, label), None
    with shuffle_cleanup(spark):
        for number in range(rounds):
            part = step(number)
            part.write.mode("append").parquet(path)
            schema = part.schema
    return spark.read.schema(schema).parquet(path)


def materialize_by(df: DataFrame, label: str, key: str, buckets: int | None = None) -> DataFrame:
    """Like ``materialize``, as a table bucketed by ``key``: grouping by the key needs no shuffle."""
    return write_bucketed(df, step_path(df.sparkSession, label), key, buckets)


def bucket_count(spark: SparkSession) -> int:
    """As many buckets as shuffle partitions, so that a partition by the key is a bucket."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None) -> DataFrame:
    """A table in ``buckets``, or as many as shuffle partitions. Tasks that read it hold a bucket each."""
    buckets = buckets or bucket_count(df.sparkSession)
    name = table_name()
    with shuffle_cleanup(df.sparkSession):
        df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """A table that ``write_bucketed`` left at ``path``, in a session that may not know it yet."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name = table_name()
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    return spark.table(name)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Partition by ``key`` when the input has fewer partitions than the cluster has cores.

    Meant for a table in one or two files, which would leave most cores idle. Large inputs stay as they
    are, without a shuffle.
    """
    if df.rdd.getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism:
        return df.repartition(key)
    return df


def partition_by(df: DataFrame, key: str, amount: Column | None = None, each: int = PARTITION_ROWS) -> DataFrame:
    """Hash-partition by ``key`` so that a partition holds about ``each`` rows, or that sum of ``amount``.

    Their number is given, so adaptive execution does not join them to what fits its size of compressed bytes: a task's
    rows may take a hundred times that.
    """
    return df.repartition(sizes_for(df, amount, each)[0], key)


def sizes_for(df: DataFrame, amount: Column | None = None, each: int = PARTITION_ROWS) -> tuple[int, int]:
    """(partitions, buckets) for ``df``: a partition holds about ``each`` rows, or that sum of ``amount``.

    A bucket holds BUCKET_PARTITIONS of that at most, so a task that reads one holds no more of a larger table. Beyond
    the shuffle partitions both are multiples of them, and a partition is in one bucket.
    """
    least = bucket_count(df.sparkSession)
    total = df.agg(F.count(F.lit(1)) if amount is None else F.sum(amount)).first()[0] or 0
    wanted = -(-int(total) // each)
    if wanted <= least:
        return min(least, max(wanted, df.sparkSession.sparkContext.defaultParallelism)), least
    buckets = -(-wanted // (BUCKET_PARTITIONS * least)) * least
    return -(-wanted // buckets) * buckets, buckets


def fits(df: DataFrame, bound: int) -> bool:
    """Whether ``df`` has at most ``bound`` rows: a count that combines in the tasks, so no task gathers rows."""
    return df.count() <= bound
