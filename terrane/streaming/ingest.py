"""Incremental ingest with Structured Streaming.

R1: landed pages arrive as files. The ids that have been taken are keyed state of the stream (in a RocksDB state
store), so a batch costs what its own pages cost, however many came before, and a page is neither lost nor repeated
however late it lands. Rows of the taken pages (S16) are written under their ``batch_id``. Of several landings of an
id in one batch any one is taken.

R2: landed text rows arrive as files; each micro-batch is validated (S2-S6)
and split once: accepted rows append to a log partition and rejects to a
dead-letter partition, both keyed by ``batch_id`` and overwritten on replay, so
a retried batch cannot duplicate rows. The current table is merged on read: a base (the last row per key up to some
batch) and the log behind it, reduced to the last row per key (S7), a partial aggregate. Every ``COMPACT_EVERY``
batches base and log become the next base, so a read costs the table and a bounded number of batches.

A base is a folder named after its last batch and counts once its ``_SUCCESS`` file is there, which the writer puts
last: a crash before leaves the old base and the whole log. What a base replaces is deleted one compaction later, so
a reader that has just chosen the old base still finds all of it.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import ingest as ing
from ..sources import pages as pg
from ..sources.files import _exists


def _run(query) -> None:
    """Everything that has landed, then stop."""
    q = query.trigger(availableNow=True).start()
    try:
        q.awaitTermination()
    finally:
        q.stop()


def _write_pages(batch: DataFrame, batch_id: int, out: str) -> None:
    pg.sale_rows(batch).write.mode("overwrite").parquet(os.path.join(out, "rows", f"batch_id={batch_id}"))


#: The state lives on the executors' disks; its changes go to the checkpoint.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def stream_page_rows(spark: SparkSession, landing: str, schema: str, checkpoint: str, out: str) -> None:
    """Run the page stream over what has landed, then stop."""
    old = {name: spark.conf.get(name, None) for name in STATE_STORE}
    for name, value in STATE_STORE.items():
        spark.conf.set(name, value)
    try:
        src = spark.readStream.schema(schema).parquet(landing).dropDuplicates(["id"])
        _run(src.writeStream.option("checkpointLocation", checkpoint)
             .foreachBatch(lambda df, bid: _write_pages(df, bid, out)))
    finally:
        for name, value in old.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def page_rows(spark: SparkSession, out: str) -> DataFrame:
    """All rows emitted so far."""
    return spark.read.parquet(os.path.join(out, "rows")).drop("batch_id")


def _write_batch(batch: DataFrame, batch_id: int, root: str, as_of_year: int, pos: str) -> None:
    text = ing.null_na_tokens(batch, keep=(pos,))
    v = ing.validate_records(text, as_of_year, keep=(pos,)).withColumn("_ok", F.size("errors") == 0)
    v = v.persist()
    try:
        (ing.accepted(v, keep=(pos,)).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(os.path.join(root, "log", f"batch_id={batch_id}")))
        (ing.rejected(v).withColumn("batch_id", F.lit(batch_id))
         .write.mode("overwrite").parquet(os.path.join(root, "dlq", f"batch_id={batch_id}")))
    finally:
        v.unpersist()


COMPACT_EVERY = 20


def _folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Numbers of the folders ``prefix``N below ``path``, ascending."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []
    return sorted(int(n[len(prefix):]) for n in names if n.startswith(prefix))


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def _base(root: str, upto: int) -> str:
    return os.path.join(root, "base", f"upto={upto}")


def _bases(spark: SparkSession, root: str) -> list[int]:
    """Last batches of the complete bases."""
    return [k for k in _folders(spark, os.path.join(root, "base"), "upto=") if _exists(spark, os.path.join(_base(root, k), "_SUCCESS"))]


def _merged(spark: SparkSession, root: str, pos: str) -> DataFrame | None:
    """The last row per key with its batch and position: the newest base and the log behind it."""
    bases = _bases(spark, root)
    newest = bases[-1] if bases else -1
    paths = [_base(root, newest)] if bases else []
    paths += [os.path.join(root, "log", f"batch_id={k}") for k in _folders(spark, os.path.join(root, "log"), "batch_id=") if k > newest]
    if not paths:
        return None
    rows = spark.read.parquet(*paths)
    columns = [c for c in rows.columns if c != "schno"]
    last = F.max_by(F.struct(*columns), F.struct("batch_id", pos))
    return rows.groupBy("schno").agg(last.alias("_r")).select("schno", "_r.*")


def compact(spark: SparkSession, root: str, batch_id: int, pos: str = "pos", every: int = COMPACT_EVERY) -> bool:
    """R2: makes the base up to ``batch_id`` if the last one is ``every`` batches back, and drops what the last one
    had replaced. Safe to repeat, also where a run of it broke off at any point."""
    bases = _bases(spark, root)
    last = bases[-1] if bases else -1
    if batch_id - last < every:
        return False
    _merged(spark, root, pos).write.mode("overwrite").parquet(_base(root, batch_id))
    for k in _folders(spark, os.path.join(root, "base"), "upto="):
        if k < last:
            _delete(spark, _base(root, k))
    for k in _folders(spark, os.path.join(root, "log"), "batch_id="):
        if k <= last:
            _delete(spark, os.path.join(root, "log", f"batch_id={k}"))
    return True


def stream_validated_ingest(spark: SparkSession, landing: str, schema: str, root: str, as_of_year: int,
                            pos: str = "pos", every: int = COMPACT_EVERY, files_per_batch: int | None = None) -> None:
    """R2: validate landed text rows batch by batch into ``root``/log and ``root``/dlq, and compact the log."""
    src = spark.readStream.schema(schema)
    src = (src.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else src).parquet(landing)

    def take(df: DataFrame, batch_id: int) -> None:
        _write_batch(df, batch_id, root, as_of_year, pos)
        compact(spark, root, batch_id, pos, every)

    _run(src.writeStream.option("checkpointLocation", os.path.join(root, "_checkpoint")).foreachBatch(take))


def current_table(spark: SparkSession, root: str, pos: str = "pos") -> DataFrame:
    """R2: the last accepted row per key (later batch, then later position wins)."""
    return _merged(spark, root, pos).drop("batch_id", pos)


def dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(os.path.join(root, "dlq"))
