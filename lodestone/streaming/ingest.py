"""Incremental ingest: every key enters the table once, in batch or from a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lodestone.operators.tables import unseen_rows
from lodestone.sources.keyed import KeyedTable
from lodestone.sources.versioned import VersionedTable


#: Keys of a stream are state of their own, kept by this store outside the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def ingest_new(source: DataFrame, table: VersionedTable | KeyedTable, key: str,
               rejected: VersionedTable | None = None) -> None:
    """Append the rows of ``source`` whose key the table does not hold, one per key. Running it
    again with the same rows adds nothing, so a replayed batch is harmless.

    Rows without a key never enter the table, in whatever batch they come; they are appended to
    ``rejected`` if it is given. Of a :class:`KeyedTable` only the partitions of the batch's keys
    are read; a plain table is read whole.
    """
    if isinstance(table, KeyedTable):
        if table.key != key:
            raise ValueError(f"the table's key is {table.key}")
        table.insert_new(source)
    elif table.exists():
        table.append(unseen_rows(table.read(), source, key))
    else:
        table.replace(source.filter(F.col(key).isNotNull()).dropDuplicates([key]))
    if rejected is not None:
        rejected.append(source.filter(F.col(key).isNull()))


def stream_files(spark: SparkSession, path: str, schema: StructType | str,
                 fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """New files below ``path`` as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def start_ingest(stream: DataFrame, table: VersionedTable | KeyedTable, key: str,
                 checkpoint: str, once: bool = True,
                 rejected: VersionedTable | None = None) -> StreamingQuery:
    """Feed a stream into :func:`ingest_new`. The checkpoint remembers the files already taken;
    a batch repeated after a failure is absorbed by the key test. ``once`` takes what is there
    and stops."""
    writer = (stream.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _: ingest_new(batch, table, key, rejected)))
    return (writer.trigger(availableNow=True) if once else writer).start()


def start_keyed_ingest(stream: DataFrame, table: KeyedTable, checkpoint: str, once: bool = True,
                       rejected: VersionedTable | None = None) -> StreamingQuery:
    """Feed a stream into a keyed table, with one state for each key seen.

    Repeats inside the stream end at the state store (RocksDB, in the checkpoint) and never reach
    the table; keys that other loads have brought are met in the touched partitions only. Rows
    without a key go to ``rejected``, each as often as it comes.
    """
    key = F.col(table.key)
    fresh = stream.filter(key.isNotNull()).dropDuplicates([table.key])
    if rejected is not None:
        fresh = fresh.unionByName(stream.filter(key.isNull()))
    conf = stream.sparkSession.conf
    name = "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, STATE_STORE)  # a query keeps the settings of its start
    try:
        return start_ingest(fresh, table, table.key, checkpoint, once, rejected)
    finally:
        conf.set(name, before)
