"""Sinks and layout jobs over Parquet folders."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.aggregates import first_row
from ..session import pin, scratch_path, shuffle_width


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh. The source may read ``path`` itself.

    The new table is complete beside the old one before the two change places,
    so a refresh that fails leaves the old table as it was. If the change itself
    is broken off, the new table lies at ``path`` plus ``.new-…`` and the old one
    at ``.old-…``. Between the two renames readers find no table.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    fresh, old = f"{path}.new-{mark}", f"{path}.old-{mark}"
    df.write.partitionBy(*partition_by).parquet(fresh)
    files = spark._jvm.org.apache.hadoop.fs
    at, to, back = (files.Path(p) for p in (path, fresh, old))
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.exists(at) and not system.rename(at, back):
        raise OSError(f"{path} could not be moved")
    if not system.rename(to, at):
        raise OSError(f"{fresh} could not be moved to {path}")
    system.delete(back, True)
    spark.catalog.refreshByPath(path)


def truncate_insert(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """All rows replaced; the columns and types of the table stay."""
    schema = df.sparkSession.read.parquet(path).schema
    overwrite(df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), path, partition_by)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_absent(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[Column] = ()) -> None:
    """Append only rows whose key the table does not hold yet; safe to repeat.

    Of several new rows of a key the first by ``order`` counts, without one the
    smallest by all columns.
    """
    spark = df.sparkSession
    known = spark.read.schema(df.schema).parquet(path).select(*keys)
    fresh = first_row(df, keys, order or [F.col(c) for c in df.columns]).join(known, list(keys), "left_anti")
    append(pin(fresh, "append"), path)


def refresh_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions ``df`` has rows for."""
    staged = pin(df, "partitions")
    (
        staged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


TARGET_BYTES = 128 << 20


def small_files(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """folder, bin, place, path of the files below the target that share a bin with others.

    Files of a folder are taken in order of their names; a bin is full when its
    sizes reach the target. Only names and sizes are read.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
        .filter((F.col("length") < target_bytes))
        .select(F.col("_metadata.file_path").alias("place"), "path", "length")
    )
    located = files.withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    before = Window.partitionBy("folder").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("length").over(before), F.lit(0))
    binned = located.withColumn("bin", F.floor(filled / F.lit(target_bytes)))
    several = F.count(F.lit(1)).over(Window.partitionBy("folder", "bin")) > 1
    return binned.withColumn("_several", several).filter("_several").select("folder", "bin", "place", "path")


def compact(spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES) -> int:
    """Small files of a table joined to files of about the target size; returns how many went.

    Files that reach the target are neither read nor moved. All bins are written
    by one job beside the table, and then each takes the place of its files. A
    note in the folder lists these first, so a run that breaks off there is
    finished by the next one. Readers miss the rows of a bin for the moment
    between the two. Only the names of small files come to the driver.
    """
    _finish_swaps(spark, path)
    listed = pin(small_files(spark, path, target_bytes), "small-files")
    bins: dict[tuple[str, int], list[str]] = {}
    for r in listed.orderBy("folder", "bin", "path").collect():
        bins.setdefault((r["folder"], r["bin"]), []).append(r["path"])
    if not bins:
        return 0
    number = {key: k for k, key in enumerate(bins)}
    schema = "folder string, bin bigint, _bin int"
    numbered = spark.createDataFrame([(*key, k) for key, k in number.items()], schema)
    of_file = listed.join(numbered, ["folder", "bin"]).select("place", "_bin")
    rows = spark.read.option("mergeSchema", "true").parquet(*[p for paths in bins.values() for p in paths])
    dealt = (
        rows.withColumn("_place", F.col("_metadata.file_path"))
        .join(of_file, F.col("_place") == F.col("place")).drop("_place", "place")
        .repartitionByRange(len(bins), "_bin")
    )
    staged = scratch_path(spark, "compacted")
    dealt.write.partitionBy("_bin").parquet(staged)
    hadoop, system = _files(spark, path)
    for (folder, _), k in number.items():
        (made,) = [f.getPath() for f in system.listStatus(hadoop.Path(f"{staged}/_bin={k}")) if f.getPath().getName().startswith("part-")]
        mark = uuid.uuid4().hex
        note = system.create(hadoop.Path(f"{folder}/_swap-{mark}"))
        note.write(bytearray("\n".join(bins[folder, _]).encode()))
        note.close()
        if not system.rename(made, hadoop.Path(f"{folder}/.swap-{mark}.parquet")):
            raise OSError(f"{made} could not be moved to {folder}")
        _finish_swap(spark, folder, mark)
    spark.catalog.refreshByPath(path)
    return sum(map(len, bins.values()))


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())


def _finish_swap(spark: SparkSession, folder: str, mark: str) -> None:
    """The files named in the note go if the file that holds their rows is there; else they stay."""
    hadoop, system = _files(spark, folder)
    note, hidden = hadoop.Path(f"{folder}/_swap-{mark}"), hadoop.Path(f"{folder}/.swap-{mark}.parquet")
    if system.exists(hidden):
        stream = system.open(note)
        names = spark._jvm.java.util.Scanner(stream, "UTF-8").useDelimiter("\\A").next()
        stream.close()
        for old in names.split("\n"):
            system.delete(hadoop.Path(old), False)
        if not system.rename(hidden, hadoop.Path(f"{folder}/compacted-{mark}.parquet")):
            raise OSError(f"{hidden} could not be renamed")
    system.delete(note, False)


def _finish_swaps(spark: SparkSession, path: str) -> None:
    hadoop, system = _files(spark, path)
    open_ = [hadoop.Path(path)]
    while open_:
        for f in system.listStatus(open_.pop()):
            name = f.getPath().getName()
            if f.isDirectory():
                open_.append(f.getPath())
            elif name.startswith("_swap-"):
                _finish_swap(spark, str(f.getPath().getParent()), name.removeprefix("_swap-"))


def interleaved_key(columns: Sequence[Column], bits: int = 16) -> Column:
    """Z-order key: the low ``bits`` of each non-negative integer column, interleaved."""
    if bits * len(columns) > 62:
        raise ValueError("the key must fit into 62 bits")
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for place, c in enumerate(columns):
            one = F.shiftright(c.cast("bigint"), bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + place))
    return key


def scaled(c: Column, low: float, high: float, bits: int = 16) -> Column:
    """Value spread over [0, 2^bits) for use in a Z-order key."""
    top = 2**bits - 1
    span = max(high - low, 1e-12)
    return F.greatest(F.lit(0), F.least(F.lit(top), F.floor((c - low) / span * top)))


def cluster(
    df: DataFrame,
    path: str,
    ranges: Mapping[str, tuple[float, float]],
    files: int | None = None,
    bits: int = 16,
) -> DataFrame:
    """Write rows in Z-order of the named columns, so each file covers a small box."""
    columns = [scaled(F.col(c).cast("double"), lo, hi, bits) for c, (lo, hi) in ranges.items()]
    width = files or shuffle_width(df.sparkSession)
    (
        df.withColumn("_z", interleaved_key(columns, bits))
        .repartitionByRange(width, "_z")
        .sortWithinPartitions("_z")
        .drop("_z")
        .write.parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def write_with_bloom(df: DataFrame, path: str, columns: Sequence[str]) -> DataFrame:
    """Parquet with a bloom filter per row group on each named column.

    The filters are made for as many values as the column has in all, an upper
    bound of what a row group can hold.
    """
    counts = df.agg(*[F.approx_count_distinct(c, 0.02).alias(c) for c in columns]).first()
    writer = df.write
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(max(1, round(1.1 * counts[c]))))
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
