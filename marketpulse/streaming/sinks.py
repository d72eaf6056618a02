"""Micro-batch sinks.

Every sink writes a batch as the partition ``(stream_id, batch_id)``, after
clearing what an earlier try of the batch left there, so a replayed batch (after
a failure between the write and the checkpoint commit) replaces its own rows,
also when it has none any more, instead of duplicating or keeping them.  ``stream_id`` is tied to the checkpoint: a new checkpoint
restarts batch ids at 0 and must not overwrite the history of the old one.

A batch's record, a small file beside the table, is written before its rows. It names
the dates that a try of the batch may have rows in, so that a replay finds them
without listing the table, and whatever else a replay has to see again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketpulse.session import file_system
from marketpulse.sources.codec import read_or_empty


def delete_folders(spark: SparkSession, pattern: str) -> None:
    """Delete the folders that a glob pattern matches (a sink's partitions)."""
    fs, cls = file_system(spark, pattern)
    for found in fs.globStatus(cls(pattern)) or []:
        fs.delete(found.getPath(), True)


class BatchRecord:
    """What a batch's earlier tries have left word of: one JSON file per batch under
    ``_batches`` of a sink (readers skip folders that start with an underscore)."""

    def __init__(self, spark: SparkSession, path: str, stream_id: str, batch_id: int):
        self.fs, self.cls = file_system(spark, path)
        self.io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self.path = f"{path}/_batches/stream_id={stream_id}/batch_id={int(batch_id)}"

    def read(self) -> dict:
        for place in (self.path, f"{self.path}.new"):  # the second only after a failure between delete and rename
            if self.fs.exists(self.cls(place)):
                stream = self.fs.open(self.cls(place))
                try:
                    return json.loads(self.io.toString(stream, "UTF-8"))
                finally:
                    stream.close()
        return {}

    def write(self, record: dict) -> None:
        stream = self.fs.create(self.cls(f"{self.path}.new"), True)
        try:
            stream.write(json.dumps(record).encode())
        finally:
            stream.close()
        self.fs.delete(self.cls(self.path), False)
        self.fs.rename(self.cls(f"{self.path}.new"), self.cls(self.path))

    def once(self, name: str, decide) -> object:
        """The value that the batch's first try decided on."""
        record = self.read()
        if name not in record:
            record[name] = decide()
            self.write(record)
        return record[name]


def _clear_dates(df: DataFrame, batch_id: int, path: str, stream_id: str, date_from: str) -> None:
    """Delete the partitions that earlier tries of the batch may have written, and
    record the ones that this try may write."""
    spark = df.sparkSession
    record = BatchRecord(spark, path, stream_id, batch_id)
    found = record.read()
    dates = {str(r[0]) for r in df.select(F.to_date(date_from).alias("d")).distinct().collect()}  # those of one batch
    fs, cls = file_system(spark, path)
    if "dates" in found:
        for date in found["dates"]:
            name = "__HIVE_DEFAULT_PARTITION__" if date == "None" else date
            fs.delete(cls(f"{path}/date={name}/stream_id={stream_id}/batch_id={int(batch_id)}"), True)
    record.write(found | {"dates": sorted(dates)})


def append_batch(df: DataFrame, batch_id: int, path: str, stream_id: str, preview: bool = False,
                 fmt: str = "parquet", date_from: str | None = None, skip_empty: bool = True) -> int:
    """Write one micro-batch; returns its row count, observed
    during the write.  An empty input writes nothing: with ``skip_empty`` it is
    detected up front (cheap on a persisted batch); a derived output is
    written directly (``skip_empty=False``) so it is computed only once, and
    an empty one simply creates no partition.  ``date_from`` adds a leading
    ``date`` partition derived from that instant column, for range pruning; the
    batch's dates are computed first, so ``df`` should be persisted or cheap."""
    parts = ["stream_id", "batch_id"] if date_from is None else ["date", "stream_id", "batch_id"]
    if date_from is None:
        fs, cls = file_system(df.sparkSession, path)
        fs.delete(cls(f"{path}/stream_id={stream_id}/batch_id={int(batch_id)}"), True)
    else:
        _clear_dates(df, batch_id, path, stream_id, date_from)
    if skip_empty and df.isEmpty():
        return 0
    obs = Observation(f"rows_{stream_id}_{batch_id}")
    out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if date_from is not None:
        out = out.withColumn("date", F.to_date(date_from))
    out = out.withColumn("stream_id", F.lit(stream_id)).withColumn("batch_id", F.lit(int(batch_id)))
    out.write.mode("append").partitionBy(*parts).format(fmt).save(path)
    if preview:
        df.show(truncate=False)
    return int(obs.get["rows"])


def append_summary(summary: DataFrame, batch_id: int, path: str, stream_id: str, preview: bool = False) -> int:
    """K3: write a batch's per-coin summary rows (derived: written directly)."""
    return append_batch(summary, batch_id, path, stream_id, preview, skip_empty=False)


def read_table(spark, path: str, keep_batch_columns: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Read a sink back (the history scan, S6).  With a ``schema``, a sink that
    nothing was written to yet is an empty frame."""
    df = spark.read.parquet(path) if schema is None else read_or_empty(spark, path, schema)
    return df if keep_batch_columns else df.drop("stream_id", "batch_id", "date")


def compact_date(spark, path: str, date: str, rows_per_file: int = 5_000_000) -> int:
    """Merge the per-batch files of one closed ``date`` partition of a sink
    written with ``date_from``, per stream id into a negative batch id.  Returns the
    number of rows compacted.

    Restartable at every point: the merged files are written beside the table
    (readers skip folders that start with an underscore), and only a finished merge
    replaces the batches, by deleting them and moving it in.  A run that finds a
    finished merge goes on from there; an unfinished one is written anew.  Run it on
    dates no micro-batch writes any more.  Readers never see a row twice; while the
    batches are replaced they may miss the date."""
    staging = f"{path}/_compact/date={date}"
    fs, cls = file_system(spark, path)
    merged = 0
    if not fs.exists(cls(f"{staging}/_SUCCESS")):
        delete_folders(spark, staging)
        if not fs.globStatus(cls(f"{path}/date={date}")):
            return 0
        day = spark.read.option("basePath", path).parquet(f"{path}/date={date}")
        batches = [r["batch_id"] for r in day.select("batch_id").distinct().collect()]  # at most the triggers of a day
        if len(batches) <= 1:
            return 0
        target = min([b for b in batches if b < 0], default=0) - 1
        merged = day.count()
        (day.drop("date").withColumn("batch_id", F.lit(target)).repartition(max(1, -(-merged // rows_per_file)))
         .write.mode("overwrite").partitionBy("stream_id", "batch_id").parquet(staging))
    streams = [s.getPath() for s in fs.globStatus(cls(f"{staging}/stream_id=*"))]
    kept = {f"{s.getName()}/{b.getPath().getName()}" for s in streams for b in fs.listStatus(s)}
    for old in fs.globStatus(cls(f"{path}/date={date}/stream_id=*/batch_id=*")) or []:
        if f"{old.getPath().getParent().getName()}/{old.getPath().getName()}" not in kept:  # what was moved in before stays
            fs.delete(old.getPath(), True)
    for stream in streams:
        fs.mkdirs(cls(f"{path}/date={date}/{stream.getName()}"))
        for batch in fs.listStatus(stream):
            fs.rename(batch.getPath(), cls(f"{path}/date={date}/{stream.getName()}/{batch.getPath().getName()}"))
    delete_folders(spark, staging)
    return merged
