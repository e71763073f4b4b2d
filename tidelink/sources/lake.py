"""The partitioned sample lake: write (S6), incremental ingest (S7), read."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.functions.timefn import offset_seconds
from tidelink.operators.linkage import bucket_of, index_limits

LEDGER_MARGIN_SECONDS = 2
STUDY_ZONE = "Asia/Dhaka"   # fixed value from the reference: months are those of its calendar
MIN_YEAR = 2000   # fixed value from the reference: earlier recordings are clock errors


def lake_layout(samples: DataFrame, key: str = "id_recording", t: str = "t",
                meta: DataFrame | None = None, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """W1 + S6 layout: offset from the recording's first sample and the
    (year, month) of that first sample for every row of the recording.

    Returns (rows to write, rejected recordings with a reason). A recording
    is rejected when no sample has a time, or the first is before 2000; with
    ``meta`` (one row per recording), also when it has no sample at all.
    """
    first = samples.groupBy(key).agg(F.min(t).alias("_t0"))
    first = first.withColumn("year", F.year("_t0")).withColumn("month", F.month("_t0"))
    reason = F.when(F.col("_t0").isNull(), "no sample has a time").when(F.col("year") < MIN_YEAR, "year before 2000")
    bad = first.where(reason.isNotNull()).select(key, "year", reason.alias("reason"))
    if meta is not None:
        empty = meta.select(F.col(id_col).alias(key)).join(first.select(key), key, "left_anti")
        bad = bad.unionByName(empty.select(key, F.lit(None).cast("int").alias("year"), F.lit("no samples").alias("reason")))
    ok = first.where(reason.isNull()).select(key, "_t0", "year", "month")
    rows = (samples.join(ok, key)
                   .withColumn("offset_secs", offset_seconds(F.col(t), F.col("_t0"))).drop("_t0"))
    return rows, bad


def write_lake(samples: DataFrame, root: str, mode: str = "append", key: str = "id_recording",
               t: str = "t", meta: DataFrame | None = None) -> DataFrame:
    """Write samples as Parquet partitioned by year/month of each
    recording's first sample. Rows are clustered by (year, month, recording,
    day) and sorted by time inside, so files have tight time statistics, one
    long recording is spread over its days, and the runtime merges small
    clusters by size. The ledger beside the lake gets the new files' time
    index. Returns the rejected recordings."""
    rows, bad = lake_layout(samples, key, t, meta)
    (rows.repartition("year", "month", key, F.to_date(t))
         .sortWithinPartitions("year", "month", key, t)
         .write.mode(mode).partitionBy("year", "month").parquet(root))
    listed = 0 if mode == "overwrite" else _ledger_time(rows.sparkSession, root)
    _minutes_since(rows.sparkSession, root, key, t, listed).write.mode(mode).parquet(_ledger(root))
    return bad


def _ledger(root: str) -> str:
    return root.rstrip("/") + "-ledger"


def _children(spark: SparkSession, path: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(p)) if fs.exists(p) else []


def _ledger_time(spark: SparkSession, root: str) -> int:
    """When the ledger was last written, in ms of the file system's clock; 0 if never."""
    return max((x.getModificationTime() for x in _children(spark, _ledger(root))
                if x.getPath().getName().endswith(".parquet")), default=0)


def _newer_files(spark: SparkSession, root: str, schema: str, ms: int) -> DataFrame:
    """Rows of the lake files written after ``ms``, less a margin for clocks that count seconds."""
    reader = spark.read.schema(f"{schema}, year int, month int")
    if ms:
        after = datetime.fromtimestamp(ms / 1000 - LEDGER_MARGIN_SECONDS, timezone.utc)
        reader = reader.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S")).option("timeZone", "UTC")
    return reader.parquet(root)


def _minutes_since(spark: SparkSession, root: str, key: str, t: str, ms: int) -> DataFrame:
    """The time index of the lake files written after ``ms``: a row for each
    (recording, year, month, minute), with first and last time. Samples
    without a time have a row without a minute."""
    rows = _newer_files(spark, root, f"{key} string, {t} timestamp", ms)
    return rows.groupBy(key, "year", "month", bucket_of(F.col(t)).alias("bucket")).agg(
        F.min(t).alias("first_t"), F.max(t).alias("last_t"), F.count(F.lit(1)).alias("n_samples"))


def lake_index(spark: SparkSession, root: str, key: str = "id_recording", t: str = "t") -> DataFrame:
    """The lake's time index (recording, bucket, first_t, last_t), from the
    ledger beside it and from lake files newer than that; the as-of join and
    recording limits need no other scan of the samples. A minute that the
    ledger lists twice counts once."""
    listed = _ledger_time(spark, root)
    minutes = _minutes_since(spark, root, key, t, listed)
    if listed:
        minutes = minutes.unionByName(spark.read.parquet(_ledger(root)))
    return (minutes.where(F.col("bucket").isNotNull()).groupBy(key, "year", "month", "bucket")
            .agg(F.min("first_t").alias("first_t"), F.max("last_t").alias("last_t")))


def lake_ids(spark: SparkSession, root: str, key: str = "id_recording") -> DataFrame:
    """Recording ids already in the lake with their partition.

    They come from the ledger that :func:`write_lake` keeps beside the lake,
    and from those lake files that are newer than it (a write that ended
    before its ledger entry); other files are not opened. One writer at a
    time is assumed. A root without any data is an empty lake; a lake that
    cannot be read raises, so that nothing is appended twice.
    """
    if not any(x.isDirectory() for x in _children(spark, root)):
        return spark.createDataFrame([], f"{key} string, year int, month int")
    listed = _ledger_time(spark, root)
    newer = _newer_files(spark, root, f"{key} string", listed).select(key, "year", "month").distinct()
    if not listed:
        return newer
    return newer.unionByName(spark.read.parquet(_ledger(root)).select(key, "year", "month")).distinct()


def incremental_candidates(spark: SparkSession, meta: DataFrame, root: str, id_col: str = "id",
                           key: str = "id_recording") -> DataFrame:
    """Files whose recording id is not yet in the lake (left anti join)."""
    known = lake_ids(spark, root, key).select(F.col(key).alias(id_col))
    return meta.join(known, id_col, "left_anti")


def read_lake_partition(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """One month of the lake (partition pruning at the scan)."""
    return spark.read.parquet(root).where((F.col("year") == year) & (F.col("month") == month))


def month_bounds(year: int, month: int, zone: str) -> tuple[datetime, datetime]:
    """The UTC instants between which a month lasts in a zone."""
    following = (year + month // 12, month % 12 + 1)
    first, after = (datetime(*ym, 1, tzinfo=ZoneInfo(zone)).astimezone(timezone.utc) for ym in ((year, month), following))
    return first, after


def month_filter(df: DataFrame, t: str, year: int, month: int, zone: str = STUDY_ZONE) -> DataFrame:
    """P3d: rows whose time falls into a month of the zone's calendar.

    The month's bounds are turned into instants once, so the condition is a
    plain range on ``t`` that a scan can push down.
    """
    first, after = (F.lit(x.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp") for x in month_bounds(year, month, zone))
    return df.where((F.col(t) >= first) & (F.col(t) < after))


def read_lake_month(spark: SparkSession, root: str, year: int, month: int, zone: str = STUDY_ZONE,
                    key: str = "id_recording", t: str = "t") -> DataFrame:
    """P3d + S8: the recordings that begin in a month of the zone's calendar.

    The lake is laid out by the UTC month of a recording's first sample, so
    only the one or two months that the zone's month touches are read; the
    ledger's time index says when each recording begins.
    """
    first, after = month_bounds(year, month, zone)
    touched = sorted({(x.year, x.month) for x in (first, after - timedelta(microseconds=1))})
    layout = [(F.col("year") == y) & (F.col("month") == m) for y, m in touched]
    layout = layout[0] if len(layout) == 1 else layout[0] | layout[1]
    begins = index_limits(lake_index(spark, root, key, t).where(layout), key)
    chosen = month_filter(begins, "t_min", year, month, zone).select(key)
    return spark.read.parquet(root).where(layout).join(chosen, key, "left_semi")
