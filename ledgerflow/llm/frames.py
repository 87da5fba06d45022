"""Small DataFrame helpers the operators share."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import delete_path, shared_folder


# Bytes of one batch on its way to Python and back; workers hold a few at a time.
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Let the session send texts to Python in batches of `BATCH_BYTES` at most, beside one row."""
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if most > BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage ends there, lost executors cost nothing."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_folder(spark)}/llm/{label}-{uuid4().hex}"
    if _unfinished:
        _unfinished[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Paths staged for the results that are being made, innermost last.
_unfinished: list[list[str]] = []


def finished(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """Stage what `make` returns and delete all else that was staged for it, also if it fails."""
    paths: list[str] = []
    _unfinished.append(paths)
    done = None
    try:
        result = make()
        inner = list(paths)
        done = staged(result, label)
    finally:
        _unfinished.remove(paths)
        for path in paths if done is None else inner:
            delete_path(spark, path)
    return done


def discard(*frames: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for frame in frames:
        spark = frame.sparkSession
        folder = shared_folder(spark)
        roots = {path.rsplit("/", 1)[0] for path in frame.inputFiles()}
        for root in roots:
            if "/llm/" in root:
                location = spark._jvm.org.apache.hadoop.fs.Path(root)
                if location.toUri().getPath().startswith(
                    spark._jvm.org.apache.hadoop.fs.Path(folder).toUri().getPath()
                ):
                    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)


def give_back() -> None:
    """Return memory that nothing holds any more to the system; a worker outlives its tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


Task = Callable[[Iterator], Iterator]


def lean(task: Task) -> Task:
    """A task that gives its memory back when it ends."""

    @functools.wraps(task)
    def wrapped(batches: Iterator) -> Iterator:
        yield from task(batches)
        give_back()

    return wrapped


def documents_of(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, text) alone, whatever else the table has."""
    small_batches(df.sparkSession)
    return df.select(F.col(f"`{id_column}`").cast("bigint").alias("doc_id"), F.col(f"`{text_column}`").alias("text"))


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that `df` does not use yet."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem = f"_{stem}"
    return stem


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# The optimizer's size of rows that come from no file.
UNKNOWN_BYTES = 1 << 54


def plan_bytes(df: DataFrame, column: str) -> int:
    """Bytes that the optimizer expects `df` to have, from the sizes of its files; without files those of a text column."""
    known = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return known if known < UNKNOWN_BYTES else int(df.agg(F.sum(F.octet_length(column))).first()[0] or 0)


def signed(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's bigint."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def in_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches, one group of equal keys at a time; keys are integers without nulls."""
    rest: pa.RecordBatch | None = None

    def parts(batch: pa.RecordBatch) -> list[int]:
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = np.asarray(batch.column(key))
            change[1:] |= values[1:] != values[:-1]
        return [0, *np.flatnonzero(change).tolist(), batch.num_rows]

    for batch in batches:
        if rest is not None:
            batch = pa.concat_batches([rest, batch])
        if not batch.num_rows:
            continue
        cuts = parts(batch)
        for a, b in zip(cuts[:-2], cuts[1:-1], strict=True):
            yield batch.slice(a, b - a)
        rest = batch.slice(cuts[-2])
    if rest is not None and rest.num_rows:
        yield rest
