"""What the operators of this subpackage share: lineage cuts, Arrow batches and appended columns."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word of the size, shingle and token contracts: anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Arrow batches handed to Python workers: rows and bytes at most.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a temporary one only in local mode without a setting."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir()
    if found:
        return found
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="foliospark-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows of df from a reliable checkpoint, so that a lost executor doesn't bring back the whole lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files and checkpoints that no live DataFrame uses any more.

    Its cleaner waits for the driver's JVM to collect garbage, which small tables may not bring about for hours."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shrink_heaps(spark: SparkSession) -> None:
    """Lets the executors' JVMs collect garbage, which returns what a heap no longer uses to the system.

    A heap stays as large as earlier stages made it, beside Python workers that need the room. There is a task for each
    core, so every idle executor gets one."""
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).selectExpr("java_method('java.lang.System', 'gc')").collect()  # a null for each core


def packed(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """The rows of a checkpoint in partitions of about so many: few rows don't need a shuffle file for each partition."""
    return df.coalesce(max(1, -(-df.count() // rows)))


def bound_batches(spark: SparkSession) -> None:
    """Keeps Arrow batches small, so that very long texts don't pile up in one batch."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        try:
            now = int(spark.conf.get(key))
        except Exception:  # a version without the setting, or a size with a unit
            now = 0
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))


def give_back() -> None:
    """Returns what a worker process no longer uses to the system: processes stay for other tasks, with all they hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library, which has its own ways
        pass


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow on small batches; a task that ends gives its memory back."""
    bound_batches(df.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def append_columns(df: DataFrame, fields: Sequence[T.StructField], make: Callable[[], Callable[[pa.RecordBatch], Sequence[pa.Array]]]) -> DataFrame:
    """df with columns that Python computes from Arrow batches; an input column with an output's name is replaced.

    make() runs once for each partition and returns the function from a batch to the new arrays, which may have a method
    close for the partition's end.
    """
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names]
    schema = T.StructType([f for f in df.schema.fields if f.name not in names] + list(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = None
        try:
            for batch in batches:
                compute = compute or make()
                new = compute(batch)
                yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in kept), *new], names=[*kept, *(f.name for f in fields)])
        finally:
            getattr(compute, "close", int)()

    return map_batches(df, run, schema)


def text_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def slices(sizes: Sequence[int], most: int) -> Iterator[slice]:
    """Slices of things of these sizes with at most so much in each (one thing may have more)."""
    begin = total = 0
    for k, n in enumerate(sizes):
        if k > begin and total + n > most:
            yield slice(begin, k)
            begin, total = k, 0
        total += n
    if len(sizes):
        yield slice(begin, len(sizes))


def words_in(column) -> F.Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def broadcast_if_small(table: DataFrame, most: int) -> DataFrame:
    """The table, marked for broadcast if it has at most so many rows; it should come from a checkpoint, as it is counted."""
    return F.broadcast(table) if table.limit(most + 1).count() <= most else table


def sorted_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[pa.Table, list[int]]]:
    """Tables of whole groups with the groups' bounds, from rows sorted by their first n_keys columns.

    Only the rows of the group that is open at a batch's end are held.
    """
    import numpy as np

    held: list[pa.RecordBatch] = []
    last = None

    def whole() -> Iterator[tuple[pa.Table, list[int]]]:
        table = pa.Table.from_batches(held).combine_chunks()
        keys = [table.column(i).to_numpy() for i in range(n_keys)]
        new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        yield table, [0, *(np.flatnonzero(new) + 1).tolist(), len(table)]
        held.clear()

    for batch in batches:
        if not len(batch):
            continue
        keys = [batch.column(i).to_numpy() for i in range(n_keys)]
        first = tuple(k[0] for k in keys)
        if held and first != last:
            yield from whole()
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0))
        if len(change):
            at = int(change[-1]) + 1
            held.append(batch.slice(0, at))
            yield from whole()
            batch = batch.slice(at)
        held.append(batch)
        last = tuple(k[-1] for k in keys)
    if held:
        yield from whole()
