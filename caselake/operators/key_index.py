"""An index of the keys that a sink holds, so that a batch never reads the sink to leave out what
is there already.

The index lies beside the data in ``<sink>/_key_index`` (hidden from reads of the sink). Each
append adds a folder of (h, key) rows, h a 64-bit fingerprint of the key, in buckets by h. A batch
reads the buckets that its own keys fall in, and of other keys the fingerprints alone decide.

An append goes in three steps: the keys are written, then the data, then a marker. Keys without
a marker are of an append that was cut off; whether its data was committed is asked of the sink, for
those keys only, by the next append. So a crash between any two steps neither repeats nor loses a
row. A sink without an index gets one from its own rows; many small appends are merged into one.
One writer at a time, as for a stream's checkpoint.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.sources.lake import has_data

BUCKETS = 64
MERGE_AT = 32     # appends that are merged into one
_SCHEMA = "h bigint, key string, batch string, bucket int"


class KeyIndex:
    def __init__(self, spark: SparkSession, sink_path: str, sink_keys: Callable[[], DataFrame | None], buckets: int = BUCKETS):
        """``sink_keys`` reads the keys of the sink itself (one column ``key``), or None."""
        self.spark, self.sink, self.sink_keys, self.buckets = spark, sink_path, sink_keys, buckets
        self.path = f"{sink_path}/_key_index/buckets={buckets}"
        self.fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.fs_path(sink_path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> set[str]:
        return {s.getPath().getName() for s in self.fs.globStatus(self.fs_path(f"{self.path}/{folder}/*")) or []}

    def clear(self) -> None:
        drop_key_index(self.spark, self.sink)

    def batches(self) -> tuple[set[str], set[str]]:
        """(finished, open): the appends with and without a marker."""
        written = {n.removeprefix("batch=") for n in self._names("entries")}
        done = self._names("done")
        return written & done, written - done

    def _bucketed(self, keys: DataFrame) -> DataFrame:
        h = F.xxhash64("key")
        return keys.select("key").where("key IS NOT NULL").distinct().withColumn("h", h).withColumn("bucket", F.pmod(h, F.lit(self.buckets)).cast("int"))

    def begin(self, keys: DataFrame) -> str:
        """Write the keys (column ``key``) of an append that is about to start; returns its name."""
        name = uuid.uuid4().hex
        self._bucketed(keys).repartition("bucket").sortWithinPartitions("bucket", "h").write.partitionBy("bucket").parquet(f"{self.path}/entries/batch={name}")
        return name

    def finish(self, name: str) -> None:
        """The append's data is committed."""
        self.fs.create(self.fs_path(f"{self.path}/done/{name}"), True).close()
        finished, _ = self.batches()
        if len(finished) > MERGE_AT:
            self._merge(finished)

    def _merge(self, finished: set[str]) -> None:
        """One append in place of many: it is finished before they go, so no key is ever missing."""
        name = self.begin(self.entries().where(F.col("batch").isin(sorted(finished))))
        self.fs.create(self.fs_path(f"{self.path}/done/{name}"), True).close()
        for old in finished:
            self.fs.delete(self.fs_path(f"{self.path}/entries/batch={old}"), True)
            self.fs.delete(self.fs_path(f"{self.path}/done/{old}"), False)

    def entries(self) -> DataFrame:
        root = f"{self.path}/entries"
        if not has_data(self.spark, root):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).option("basePath", root).parquet(root)

    def known(self, keys: DataFrame) -> DataFrame | None:
        """Of ``keys`` (column ``key``) those that the sink holds; None if it holds nothing."""
        if not has_data(self.spark, self.sink):
            self.clear()
            return None
        finished, left_open = self.batches()
        if left_open or not finished:
            finished = self._repair(finished, left_open)
        asked = self._bucketed(keys)
        touched = [r["bucket"] for r in asked.select("bucket").distinct().collect()]  # at most ``buckets``
        mine = self.entries().where(F.col("bucket").isin(touched) & F.col("batch").isin(sorted(finished)))
        return asked.join(mine.select("h", "key"), ["h", "key"], "left_semi").select("key")

    def _repair(self, finished: set[str], left_open: set[str]) -> set[str]:
        """Make the index true again after an append that was cut off, or make it at all: the sink is asked
        once, and what is left open gives way to a finished append. Returns the finished ones."""
        held = self.sink_keys()
        if held is not None:
            if finished:  # the rest of the index is true
                unsure = self.entries().where(F.col("batch").isin(sorted(left_open))).select("key")
                held = unsure.join(held.select("key"), "key", "left_semi")
            name = self.begin(held)
            self.fs.create(self.fs_path(f"{self.path}/done/{name}"), True).close()
            finished = finished | {name}
        for old in left_open:
            self.fs.delete(self.fs_path(f"{self.path}/entries/batch={old}"), True)
        return finished


def drop_key_index(spark: SparkSession, sink_path: str) -> None:
    """Forget the index of a sink whose rows were changed by other means; the next append makes it anew."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sink_path}/_key_index")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def append_new(rows: DataFrame, key: Column, index: KeyIndex, write: Callable[[DataFrame], None]) -> None:
    """Give ``write`` the rows whose key the sink does not hold, and index their keys. A row without a
    key is always new. The rows are made once and kept on disk meanwhile, so that all steps see the same."""
    keyed = rows.withColumn("_key", key).persist(StorageLevel.DISK_ONLY)
    try:
        known = index.known(keyed.select(F.col("_key").alias("key")))
        fresh = keyed if known is None else keyed.join(known, keyed["_key"] == known["key"], "left_anti")
        name = index.begin(fresh.select(F.col("_key").alias("key")))
        write(fresh.drop("_key"))
        index.finish(name)
    finally:
        keyed.unpersist()
