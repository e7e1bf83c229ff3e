"""Helpers shared by the operators: worker-side state, shared scratch tables, row keys."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import types
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def by_value(module_name: str) -> None:
    """Ship a module's worker-side functions inside the job, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def worker_state(name: str, make: Callable):
    """One object per Python worker process, kept from task to task (a token cache, an automaton).

    Functions shipped by value get new globals in each task; this registry lives in ``sys.modules``. It holds one
    object: workers outlive jobs, so what another operator left behind goes first.
    """
    home = sys.modules.setdefault("_terrane_worker_state", types.ModuleType("_terrane_worker_state"))
    if getattr(home, "name", None) != name:
        home.name, home.value = None, None
        release_memory()
        home.name, home.value = name, make()
    return home.value


def release_memory() -> None:
    """Returns what this process has freed to the system; allocators keep it otherwise, in every worker."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # not glibc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(work: Callable, owner: str | None = None) -> Callable:
    """``work`` over the batches of a task; behind it the worker returns freed memory. With ``owner``, an operator that
    keeps no state of its own, other operators' state goes before."""

    def run(batches):
        if owner:
            worker_state(owner, object)
        try:
            yield from work(batches)
        finally:
            release_memory()

    return run


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, most_bytes: int):
    """Jobs run inside send about so many bytes at once to Python workers (both sides hold such a batch), unless the
    session has a bound of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, most_bytes)
    try:
        yield
    finally:
        spark.conf.unset(name)


#: A side of a join is broadcast up to so many entries (ids, hashes, words or names, below 100 bytes each).
BROADCAST_ENTRIES = 1_000_000


def beside(rows: DataFrame, entries: int) -> DataFrame:
    """``rows`` as the side of a join that is broadcast while its size, which the caller has counted, is below the
    bound; beyond it both sides are dealt by the key."""
    return F.broadcast(rows) if entries <= BROADCAST_ENTRIES else rows


class Scratch:
    """Intermediate tables in the cluster's shared checkpoint folder.

    Every table is written once and reread, which cuts lineage and survives lost executors. ``drop`` removes
    a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/terrane-{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def texts(column: pa.ChunkedArray | pa.Array) -> list[str]:
    """Texts of an Arrow column, nulls as empty."""
    return [t or "" for t in column.to_pylist()]


def row_id(id_col: str, text_col: str) -> Column:
    """Names a document's row: equal only for rows with the same id and the same text.

    Ids may be null or repeated; joins back to the rows use this pair with null-safe equality.
    """
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))


def hex_sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)
