"""Session settings and the shared scratch folder.

Runtime settings only touch SQL options that any session may change. The
scratch folder is the one the cluster names in ``spark.checkpoint.dir``; a
folder of our own is made only for a local master where the setting is unset.
What an application writes there goes when it ends, or earlier with
``scratch_run``.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SQL_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a skewed join is split even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a union that keeps its inputs' partitioning fails where their partition counts differ at run time
    "spark.sql.unionOutputPartitioning": "false",
}

#: Most bytes that a task takes, of joined small shuffle partitions and of files. What it sorts and hashes is many
#: times that, so these bound its memory whatever the size of the tables; smaller settings of the session stay.
_AT_MOST = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.files.maxPartitionBytes": 32 << 20,
}

_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}

_local_scratch: str | None = None
_owned: set[str] = set()
_runs: list[str] = []


def local_session(cores: str = "*", app: str = "strataloom", **options) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in options.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the SQL options every query here relies on."""
    for name, value in _SQL_OPTIONS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    for name, most in _AT_MOST.items():
        if _bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    return spark


def _bytes(size: str) -> int:
    """A size as Spark's options write it, such as 64m, 64MB or 67108864b."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", size.lower()).groups()
    return int(number) << _UNITS[unit]


def shuffle_width(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows that a task groups, about; a hash table of them is many times their size.
TASK_ROWS = 500_000


def dealt(df: DataFrame, rows: int, *by: str) -> DataFrame:
    """``df`` of about ``rows`` rows, dealt by columns where the shuffle partitions are too few for it.

    Grouping by these and further columns needs no other exchange then. Spark
    joins small partitions, but a large one that is grouped stays one task.
    """
    parts = -(-rows // TASK_ROWS)
    return df.repartition(parts, *by) if parts > shuffle_width(df.sparkSession) else df


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables."""
    global _local_scratch
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="strataloom-")
        atexit.register(shutil.rmtree, _local_scratch, ignore_errors=True)
    return _local_scratch


def _file_system(spark: SparkSession, path: str):
    """The file system of a path as Spark sees it, and the path there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _own_folder(spark: SparkSession) -> str:
    """This application's part of the scratch folder; it goes when the application ends."""
    folder = f"{scratch_root(spark)}/strataloom/{spark.sparkContext.applicationId}"
    if folder not in _owned:
        _owned.add(folder)
        system, at = _file_system(spark, folder)
        system.deleteOnExit(at)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    run = f"/{_runs[-1]}" if _runs else ""
    return f"{_own_folder(spark)}{run}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession):
    """What is written to scratch inside goes at the end; results must be stored or read by then."""
    _runs.append(f"run-{uuid.uuid4().hex}")
    folder = f"{_own_folder(spark)}/{_runs[-1]}"
    try:
        yield folder
    finally:
        _runs.pop()
        system, at = _file_system(spark, folder)
        system.delete(at, True)


def pin(df: DataFrame, label: str = "pin") -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts lineage, fixes row placement columns such as a partition number and
    survives the loss of executors.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pin_bucketed(df: DataFrame, by: str, label: str, buckets: int, observed=None) -> DataFrame:
    """Write ``df`` once, dealt into buckets of ``by``, and read it back.

    Joins and aggregations on ``by`` with as many shuffle partitions need no
    exchange. Only a catalog knows buckets: the table is named there while it is
    written and the name is dropped at once, the files are those of ``pin``.
    ``observed`` is an Observation and its aggregates, filled by the write.
    """
    spark = df.sparkSession
    path, name = scratch_path(spark, label), f"pinned_{uuid.uuid4().hex}"
    if observed is not None:
        df = df.observe(observed[0], *observed[1])
    df.write.format("parquet").bucketBy(buckets, by).option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def release(pinned: DataFrame) -> None:
    """Delete the files of a pinned table that nothing reads any more; others stay."""
    spark = pinned.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in pinned.inputFiles()}:
        system, at = _file_system(spark, folder)
        if _own_folder(spark) in folder:
            system.delete(at, True)
