"""S7 as a stream: new ECG files -> header scan -> samples -> lake append.

The stream carries file paths only: tasks list the folders, and the paths that
were never listed before are appended to a Parquet listing in the checkpoint,
which is the stream's source. So the source's log and every batch hold a few
listing files, however many recordings there are; nothing lists or logs single
recordings on the driver. Every batch scans the headers of its new files, leaves out recordings already in the lake (anti join on recording id)
before any sample is read, and appends the others through the same functions
as a batch job. The anti join makes a retried batch idempotent (a Parquet
append either commits whole or leaves nothing), and the checkpoint remembers
which files were seen.
"""

from __future__ import annotations

import hashlib
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelink.session import materialize
from tidelink.sources.files import list_files
from tidelink.sources.recordings import ingest_files

ECG_END = "ecg.csv"
LIST_SECONDS = 60


def set_aside(tables: dict[str, DataFrame]) -> DataFrame:
    """The quarantine tables of an ingest as one: (kind, what, row, text,
    reason) of every bad file, bad row and rejected recording."""
    none = {"row": F.lit(None).cast("long"), "text": F.lit(None).cast("string")}

    def shaped(kind: str, what: str, **cols) -> DataFrame:
        cols = none | cols
        return tables[kind].select(F.lit(kind).alias("kind"), F.col(what).alias("what"),
                                   *[c.alias(n) for n, c in cols.items()], "reason")

    return (shaped("bad_files", "path").unionByName(shaped("rejected", "id_recording"))
            .unionByName(shaped("bad_rows", "path", row=F.col("id"), text=F.col("time_text"))))


def _committed(spark: SparkSession, folder: str) -> bool:
    done = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
    return done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done)


def _list_new(spark: SparkSession, root: str, listed: str, at_most: int | None = None) -> None:
    """Append the ECG files below ``root`` that are not in the listing yet,
    ``at_most`` to a file of the listing. An append that was cut off is made
    good by the next one, as what it did list is left out."""
    new = list_files(spark, root).where(F.col("path").endswith(ECG_END)).select("path")
    folder = spark._jvm.org.apache.hadoop.fs.Path(listed)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    new = materialize(new.join(spark.read.schema("path string").parquet(listed), "path", "left_anti"))
    n = new.count()
    if n:
        parts = -(-n // at_most) if at_most else spark.sparkContext.defaultParallelism
        new.repartition(parts).write.mode("append").option("maxRecordsPerFile", at_most or 0).parquet(listed)


def _batch_writer(lake_root: str, recording_id, rejected_root: str, query_key: str):
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{rejected_root.rstrip('/')}/query={query_key}/batch={epoch_id}"

        def quarantine(tables: dict[str, DataFrame]) -> None:
            # written whole before the lake is touched; once it is there, a
            # retry may find the lake filled, and must not write it anew
            if not _committed(spark, folder):
                set_aside(tables).write.mode("overwrite").parquet(folder)

        ingest_files(spark, batch, lake_root, recording_id, before_append=quarantine)
    return write


def stream_ecg_to_lake(spark: SparkSession, ecg_root: str, lake_root: str, checkpoint: str,
                       recording_id=None, available_now: bool = True,
                       max_files_per_trigger: int | None = None,
                       rejected_root: str | None = None) -> StreamingQuery:
    """Start the ingest stream; ``available_now`` processes what is there and
    stops.

    Files, rows and recordings that are turned away go to ``rejected_root``
    (by default the folder ``<lake>-rejected``), each once: a batch has a
    folder of its own, named by the stream (its checkpoint) and the batch.
    """
    rid = recording_id or (lambda p: F.md5(p))
    rejected_root = rejected_root or lake_root.rstrip("/") + "-rejected"
    query_key = hashlib.md5(checkpoint.rstrip("/").encode()).hexdigest()
    listed = f"{checkpoint.rstrip('/')}/listed"
    write = _batch_writer(lake_root, rid, rejected_root, query_key)
    _list_new(spark, ecg_root, listed, max_files_per_trigger)
    reader = spark.readStream.schema("path string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", 1)  # files of the listing, of so many paths each
    writer = reader.parquet(listed).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        return writer.trigger(availableNow=True).start()
    query = writer.trigger(processingTime=f"{LIST_SECONDS} seconds").start()

    def keep_listing() -> None:
        while query.isActive:
            time.sleep(LIST_SECONDS)
            try:
                _list_new(spark, ecg_root, listed, max_files_per_trigger)
            except Exception:
                query.stop()  # not idle for ever on a folder that cannot be listed
                raise

    threading.Thread(target=keep_listing, daemon=True).start()
    return query
