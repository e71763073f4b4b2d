"""The whole ingest of sensor recordings (L7), for a batch and for a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.operators.quality import refuse
from tidelink.session import materialize
from tidelink.sources import files as S
from tidelink.sources import lake as LK

RecordingId = Callable[[Column], Column]


def ingest_files(spark: SparkSession, paths: DataFrame, lake_root: str, recording_id: RecordingId = F.md5,
                 strict: bool = False, before_append: Callable[[dict[str, DataFrame]], None] | None = None,
                 ) -> dict[str, DataFrame]:
    """Header scan, leave out what the lake has, read, write.

    ``paths`` lists ECG files; files of recordings that the lake has are not
    opened beyond their header. Returns ``meta`` (the files' header facts) and
    the quarantine tables ``bad_files`` (dq_readable, dq_time_column),
    ``bad_rows`` (unreadable times) and ``rejected`` (dq_recording_year,
    dq_nonempty_load); ``before_append`` is called with these three before
    anything is added to the lake. ``strict`` raises where one of them has rows: for files
    before anything is written, for recordings after the good ones are.
    """
    good, bad = S.recording_header_scan(paths, quarantine=True)
    if strict:
        refuse(bad)
    meta = materialize(good.withColumn("id", recording_id(F.col("path"))))
    todo = materialize(LK.incremental_candidates(spark, meta, lake_root))
    samples, unreadable = S.ingest_samples(spark, todo, quarantine=True)
    if before_append:
        before_append({"bad_files": bad, "bad_rows": unreadable, "rejected": LK.lake_layout(samples, meta=todo)[1]})
    rejected = LK.write_lake(samples, lake_root, meta=todo)
    if strict:
        refuse(unreadable)
        refuse(rejected)
    return {"meta": meta, "bad_files": bad, "bad_rows": unreadable, "rejected": rejected}


def ingest_recordings(spark: SparkSession, root: str, lake_root: str, recording_id: RecordingId = F.md5,
                      strict: bool = False) -> dict[str, DataFrame]:
    """Find the ECG files below ``root`` (S1), bring the new ones into the
    lake, and join their header facts with the lake's entries (J1).

    Returns the tables of :func:`ingest_files` and ``recordings``: the header
    facts with the year and month of the lake, null where it has none.
    """
    found = S.discover_files(spark, root).where(F.col("kind") == "ecg")
    out = ingest_files(spark, found, lake_root, recording_id, strict)
    entries = LK.lake_ids(spark, lake_root).withColumnRenamed("id_recording", "id")
    return out | {"recordings": out["meta"].join(entries, "id", "left")}
