"""What the training-data operators share: tables, the shared folder, written tables, row keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Spark's setting of a batch's bytes, and ours.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Spark's setting by which an execution's shuffle files are deleted when it has ended.
CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What a written table may have at most to be broadcast: rows, and bytes of its files.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 4 << 20
#: Where the session names no shared folder (tests on one machine).
OWN_SHARED = "file:///tmp/checkpoints"


def small_batches(spark: SparkSession) -> None:
    """Sets the session's limit of bytes of a batch that goes to Python, unless it is set below ours: Spark's own of 64 MB
    is held several times over by each task, in the JVM and in its worker."""
    if int(spark.conf.get(BATCH).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; our own where it is unset and all runs on one machine."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master
    if not found and master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return (found or OWN_SHARED).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors. Shuffle files of the run that
    writes it go when it ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    before = spark.conf.get(CLEAN_UP, None)
    spark.conf.set(CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEAN_UP) if before is None else spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(schema).parquet(path)


def free(*tables: DataFrame) -> None:
    """Deletes tables made by written() that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for f in {x.rpartition("/")[0] for x in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def keyed(df: DataFrame, *columns: str, key: str = "_rid") -> DataFrame:
    """The named columns and `key`, a number that tells repeated rows apart, the same one in every pass.

    Of a Parquet scan it is a hash of the row's file plus the row's place in it: whatever the scan's splits and whichever
    executors are there, and without a copy. That no two files' numbers meet is looked up in the files' row counts, and
    the hash seeded anew until it is so. Any other frame is written once with a key.
    """
    picked = [F.col(f"`{c}`") for c in columns]
    try:
        file = df.metadataColumn("_metadata")
        place, path = file["row_index"], file["file_path"]
        rows = df.groupBy(path.alias("path")).agg(F.max(place).alias("last"))
        rows = written(rows, "files")
    except AnalysisException:  # no scan of files with row numbers
        return written(df.select(*picked).withColumn(key, F.monotonically_increasing_id()), "keyed")
    for seed in range(64):
        first = F.xxhash64(path, F.lit(seed)).bitwiseAND(F.lit((1 << 62) - 1))
        of = rows.select(F.xxhash64("path", F.lit(seed)).bitwiseAND(F.lit((1 << 62) - 1)).alias("first"), "last").toPandas()  # a row a file
        of = of.sort_values("first").to_numpy()
        if (of[1:, 0] > of[:-1, 0] + of[:-1, 1]).all():
            free(rows)
            return df.select(*picked, (first + place).alias(key))
    raise ValueError("no numbers for the rows of so many files")


def some_rows(batches: Iterator[pa.RecordBatch], column: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose strings in `column` have about `most` bytes, so that few texts are Python objects at a
    time whatever the batches' size; a longer text is a slice of its own."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), len(size)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if b > a:
                yield batch.slice(a, b - a)


def release() -> None:
    """Gives a worker's free memory back to its machine: the next stage's worker is the same process."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def ascii_lower(col):
    """A-Z lower-cased, all else as it is; the quick way where every character is ASCII."""
    return F.when(F.octet_length(col) == F.length(col), F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def small(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether a written table's files have at most `size` bytes, and it at most `rows` rows (files say little of the
    memory that rows take)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= size and df.count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """df broadcast only where its measured rows and bytes allow; beyond them, the join shuffles."""
    return F.broadcast(df) if small(df, rows, size) else df
