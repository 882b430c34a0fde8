"""Helpers the training-data operators share: work folders, written tables, worker caches."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space of the contracts: [\x20\x09-\x0D].
WS = " \t\n\x0b\x0c\r"


#: Bytes of a row group in written tables: what a task holds before it writes.
ROW_GROUP = 16 << 20
#: Folders of written tables that are still there, oldest first.
_folders: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Where that is unset and all tasks run in the driver's process (local mode, as in tests), a
    temporary folder is taken; on a cluster an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.gettempdir()
    folder = f"{root.rstrip('/')}/weft-{uuid.uuid4().hex}"
    _folders.append((spark, folder))
    return folder


def written(df: DataFrame, name: str = "table", checked: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, lost executors cost nothing.

    The writer looks at the size of its pages and row groups after ``checked`` rows at most. By default it
    guesses from the rows so far when to look next, up to 10,000 rows later, which holds too much where
    large rows follow small ones.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    out = df.write.option("parquet.block.size", ROW_GROUP)
    if checked:
        for what in ("page", "block"):
            out = out.option(f"parquet.{what}.size.row.check.min", checked).option(f"parquet.{what}.size.row.check.max", checked)
    out.parquet(f"{folder}/{name}")
    out = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    out.__dict__["_weft_folder"] = folder
    return out


def _delete(spark: SparkSession, folder: str) -> None:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(*dfs: DataFrame) -> None:
    """Delete tables made by :func:`written` once nothing reads them any more."""
    for df in dfs:
        gone = df.__dict__.get("_weft_folder")
        for own in [x for x in _folders if x[1] == gone]:
            _delete(*own)
            _folders.remove(own)


@contextmanager
def scratch():
    """Deletes the tables written inside the block when it ends, but for those that are appended to the list it gives.

    For callers that have stored an operator's result: the operators can't tell when it has been read.
    """
    before, kept = len(_folders), []
    try:
        yield kept
    finally:
        names = {df.__dict__.get("_weft_folder") for df in kept}
        for own in _folders[before:]:
            if own[1] not in names:
                _delete(*own)
                _folders.remove(own)


def fresh(name: str, *dfs: DataFrame) -> str:
    """``name``, or one made of it that no column of the tables has, in any case of letters."""
    used = {c.lower() for df in dfs for c in df.columns}
    while name.lower() in used:
        name += "_"
    return name


def worker_cache(name: str, make):
    """A value kept in a worker process between tasks; ``make`` builds it on first use.

    One value is kept at a time, so a worker's memory doesn't grow with the operators it has served.
    """
    store = sys.modules.setdefault("_weft_worker_cache", types.ModuleType("_weft_worker_cache"))
    if getattr(store, "name", None) != name:
        if getattr(store, "value", None) is not None:
            store.value = None
            give_back()
        store.name, store.value = name, make()
    return store.value


def give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Jobs run inside the block send at most ``rows`` rows at a time to Python workers, which bounds the memory of both sides."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def slices(batches, rows: int = 1000):
    """Arrow batches in runs of at most ``rows`` rows, which bounds what a worker holds as Python objects."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)


def text_or_empty(col: Column | str) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo k; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_of_each(rows: DataFrame, key: str, *order) -> DataFrame:
    """One row of each value of ``key``, the first in order; after a join on it no further shuffle is needed."""
    n = fresh("copy", rows)
    return rows.withColumn(n, F.row_number().over(Window.partitionBy(F.col(key)).orderBy(*(order or [F.lit(1)])))).filter(F.col(n) == 1)
