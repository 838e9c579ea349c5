"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are turned into Python objects at a time, and the bytes of text after which a slice ends.
SLICE_ROWS, SLICE_BYTES = 1024, 2_000_000


#: Bytes of batches after which a worker gives memory back.
RELEASE_BYTES = 4_000_000
#: Rows of a batch between the JVM and a Python worker; the default would hold ten times as much text in both.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, BATCH_ROWS)


def release() -> None:
    """Give free memory back to the system; other tasks and the JVM share the executor's."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def frugal(run: Callable) -> Callable:
    """``run`` over the batches of a task, with release() after each RELEASE_BYTES of them and at the end, as the worker goes on to other tasks."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def watched() -> Iterator[pa.RecordBatch]:
            size = 0
            for batch in batches:
                yield batch
                size += batch.nbytes
                if size > RELEASE_BYTES:
                    size = 0
                    release()

        try:
            yield from run(watched())
        finally:
            release()

    return task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batch: pa.RecordBatch, col: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that column ``col`` (text) holds about SLICE_BYTES a slice; one long row is a slice of its own."""
    n, at = batch.num_rows, 0
    if not n:
        return
    lengths = pc.binary_length(batch.column(col)).fill_null(0).to_numpy(zero_copy_only=False)
    total, begin = 0, 0
    for at in range(n):
        if at > begin and (total + lengths[at] > SLICE_BYTES or at - begin >= SLICE_ROWS):
            yield batch.slice(begin, at - begin)
            begin, total = at, 0
        total += lengths[at]
    yield batch.slice(begin, n - begin)


def map_text(df: DataFrame, keep: list[str], text: str, fn: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch], schema: str, start: Callable | None = None) -> DataFrame:
    """Apply ``fn(kept columns, texts as UTF-8)`` to slices of ``df``. Null text is empty. ``start`` makes per-task state, passed as a third argument.

    Only the named columns are read, so extra columns with any name do not matter.
    """
    small_batches(df.sparkSession)
    names = [f"k{i}" for i in range(len(keep))]
    chosen = df.select(*[F.col(quoted(c)).alias(n) for c, n in zip(keep, names, strict=True)], F.coalesce(F.col(quoted(text)).cast("string"), F.lit("")).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = start() if start else None
        release()  # what loading has left
        for whole in batches:
            for part in slices(whole, len(names)):
                texts = part.column(len(names)).to_pylist()
                yield fn(part, texts, state) if start else fn(part, texts)

    return chosen.mapInArrow(frugal(run), schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def bucket_of(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; null for a null id."""
    return F.crc32(F.col(quoted(doc_id)).cast("string").cast("binary")) % n


def held_out(doc_id: str, n: int) -> Column:
    """True where the remainder is 2. A null id has no text, so it is a training row."""
    return F.coalesce(bucket_of(doc_id, n) == 2, F.lit(False))


def hash_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """About ``rows`` of the ``total`` rows, the same in each run: those whose key's hash is small; 1.5 times as many at most."""
    if total <= rows:
        return df
    place = F.xxhash64(F.col(key).cast("string"), F.lit(17)).cast("double") / F.lit(2.0**64) + 0.5
    return df.where(place < F.lit(rows / total)).limit(rows * 3 // 2)


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir. Where that is unset, a local session uses its own temp folder; a cluster must name a shared one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = f"{tempfile.gettempdir()}/unitflow-checkpoints"
    return f"{base.rstrip('/')}/unitflow-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """Cut lineage: write to the shared folder and read back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files that written() made for ``df``."""
    spark = df.sparkSession
    jvm = spark._jvm
    for f in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
        if "/unitflow-" in f:
            path = jvm.org.apache.hadoop.fs.Path(f)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
