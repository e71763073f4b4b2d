"""Raw-file sources: listing (S1), marker CSV (S2), header scans (S3, S9),
sample ingest (S4, S5), EDA lengths (S10), manifests (S12).

Files are opened inside tasks (``pyarrow.fs``, so local, HDFS and object-store
paths all work): the header scan reads the first few KB of each, the sample
and marker readers byte ranges (see ``splits``). What they return is text;
every field is then parsed with native expressions.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.functions.timefn import epoch_auto, local_to_utc
from tidelink.operators.quality import Observed
from tidelink.operators.scan import ranked
from tidelink.session import materialize
from tidelink.sources.splits import OPEN_BYTES, filesystem, greatest_first_field, open_file, read_columns, task_count

# Fixed values that must equal the reference's: file kinds, header lines.
ECG_SUFFIX = r"ecg\.csv$"                 # case-sensitive; paths with ';' are skipped
MARKER_SUFFIX = r"(?i)utcmarker\.csv$"
CSV_SUFFIX = r"(?i)\.csv$"
ECG_HEADER_LINES = 15
HEADER_PREFIX = "# "
SAMPLING = r"^# Sampling:[ 0-9.s]+\((\d+) Hz\)$"
EXPORT_TZ = r"^# Export timezone: ([A-Za-z_/]+)$"
DEVICE_LINE = r"^# Device: BG"
DEVICE_ID = r"(BG\d{8})"                  # D2: the reference's pattern is invalid in Java
SEQUENCE = r"_(\d+)-ecg\.csv$"            # D1: the whole number
TIME_COLUMNS = ("timestamp", "local_time")   # D11: timestamp preferred
EDA_HEADER_LINES = 29
EDA_DATA_HEADER = "SECOND"
EDA_DATA_HEADER_LINES = (28, 29)
EDA_TIME_FORMAT = "dd.MM.yy HH:mm:ss"
MARKER_COLUMNS = {"id": "id", "participantID": "mirage_pid", "lang": "lang", "marker": "event",
                  "utc_app": "timecode_utc"}

EDA_REASONS = ("no device", "no SECOND header")
HASH_CHUNK = 1 << 20
HEAD_SCHEMA = "path string, length long, first int, lines array<string>, header string"
HEADS_AT_ONCE = 1000
LIST_SCHEMA = "path string, length long, modificationTime timestamp, folder boolean"
FOLDERS_A_TASK = 500
FILES_A_BATCH = 1 << 16


def _kept(name: str, folder: bool) -> bool:
    """Whether Spark's own readers list an entry of that name."""
    hidden = (name.startswith("_") and "=" not in name) or name.startswith(".")
    if folder:
        return name.startswith(("_metadata", "_common_metadata")) or not (hidden or name.endswith("._COPYING_"))
    return not (hidden or name.endswith("._COPYING_"))


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The entries of every folder: files that are not empty, and folders."""
    from pyarrow import fs as pafs

    def batch(rows):
        path, length, ms, folder = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(path, pa.string()), pa.array(length, pa.int64()), pa.array([x * 1000 for x in ms], pa.timestamp("us", "UTC")),
             pa.array(folder, pa.bool_())], ["path", "length", "modificationTime", "folder"])

    for b in batches:
        rows = []
        for path in b.column("path").to_pylist():
            fs, p = filesystem(path)
            for x in fs.get_file_info(pafs.FileSelector(p)):
                folder = x.type == pafs.FileType.Directory
                if not _kept(x.base_name, folder) or not (folder or (x.type == pafs.FileType.File and x.size)):
                    continue
                rows.append((f"{path.rstrip('/')}/{x.base_name}", 0 if folder else x.size, (x.mtime_ns or 0) // 1_000_000, folder))
                if len(rows) == FILES_A_BATCH:
                    yield batch(rows)
                    rows = []
        if rows:
            yield batch(rows)


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, modificationTime) of every file below ``root``, as
    Spark's file readers list them (no empty and no hidden files).

    The tree is walked level by level: tasks list folders, and what they find
    is a stage of its own. The driver sees the number of folders of a level
    only, no path but the root's.
    """
    p = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    tops = [*(fs.globStatus(p) or [])]
    if not tops:
        raise FileNotFoundError(root)
    rows = [(x.getPath().toString(), x.getLen(), x.getModificationTime(), x.isDirectory()) for x in tops]
    level = spark.createDataFrame(rows, "path string, length long, ms long, folder boolean").select(
        "path", "length", F.timestamp_millis("ms").alias("modificationTime"), "folder")
    levels, folders = [level.where(~F.col("folder") & (F.col("length") > 0))], sum(r[3] for r in rows)
    while folders:
        some = max(spark.sparkContext.defaultParallelism, -(-folders // FOLDERS_A_TASK))
        level = materialize(level.where("folder").select("path").repartition(min(folders, some)).mapInArrow(_entries, LIST_SCHEMA))
        levels.append(level.where(~F.col("folder")))
        folders = level.where("folder").count()
    return reduce(DataFrame.unionByName, levels).drop("folder")


def discover_files(spark: SparkSession, root: str) -> DataFrame:
    """Recursive listing with the file kind; contents are never read."""
    p = F.col("path")
    kind = (F.when(p.rlike(ECG_SUFFIX) & ~p.contains(";"), "ecg")
             .when(p.rlike(MARKER_SUFFIX), "marker")
             .when(p.rlike(CSV_SUFFIX), "csv"))
    return list_files(spark, root).withColumn("kind", kind).where(F.col("kind").isNotNull())


def _head(path: str, n_lines: int, comment: str | None) -> tuple:
    """(path, length, number of the first line, lines, header) of a file: 0 if it is empty, -1 if it cannot be read."""
    lines, header, size, no = [], None, None, 0
    try:
        with open_file(path) as f:
            size = f.size()
            for no, line in enumerate(io.TextIOWrapper(f, encoding="utf-8", errors="replace"), 1):
                text = line.rstrip("\r\n")
                if no <= n_lines:
                    lines.append(text)
                if comment is not None and not line.startswith(comment):
                    header = text
                    break
                if comment is None and no >= n_lines:
                    break
        return path, size, min(no, 1), lines, header
    except (OSError, ValueError):
        return path, size, -1, [], None


def _head_reader(n_lines: int, comment: str | None):
    types = {"path": pa.string(), "length": pa.int64(), "first": pa.int32(), "lines": pa.list_(pa.string()), "header": pa.string()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths = b.column("path").to_pylist()
            for k in range(0, len(paths), HEADS_AT_ONCE):
                columns = zip(*(_head(p, n_lines, comment) for p in paths[k:k + HEADS_AT_ONCE]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values())], [*types])
    return read


def head_lines(paths: DataFrame, n_lines: int, comment: str | None = None) -> DataFrame:
    """One row for each distinct file in ``paths.path``: its length, its first
    ``n_lines`` ``lines`` and the number of the ``first`` (0: the file is
    empty, -1: it cannot be read).

    With ``comment``, ``header`` is the first line that does not start with it
    (the column header), however far down, and nothing after it is read.
    """
    paths = materialize(paths.select("path"))
    dealt = paths.repartition(task_count(paths, F.lit(OPEN_BYTES)), "path").distinct()
    return dealt.mapInArrow(_head_reader(n_lines, comment), HEAD_SCHEMA)


def _columns(header: Column) -> Column:
    return F.transform(F.split(header, ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))


def _dirname(p: Column) -> Column:
    return F.regexp_replace(p, "/[^/]*$", "")


def recording_header_scan(paths: DataFrame, quarantine: bool = False):
    """S3: header facts per ECG file: id, id_session, path, length, sequence,
    device_id, time_col, tz, sampling_rate, columns. Unreadable/empty files and
    files without a known time column go to quarantine (with a reason)."""
    heads = head_lines(paths, ECG_HEADER_LINES, comment="#")
    pre = F.filter("lines", lambda x: x.startswith(HEADER_PREFIX))

    def greatest(pattern, value):
        return F.array_max(F.transform(F.filter(pre, lambda x: x.rlike(pattern)), value))
    agg = heads.select(
        "path", "length",
        greatest("^# Sampling", lambda x: F.regexp_extract(x, SAMPLING, 1)).alias("_rate"),
        greatest("^# Export timezone:", lambda x: F.regexp_extract(x, EXPORT_TZ, 1)).alias("tz"),
        greatest(DEVICE_LINE, lambda x: F.coalesce(F.nullif(F.regexp_extract(x, DEVICE_ID, 1), F.lit("")),
                                                   F.regexp_replace(x, "^# Device: ", ""))).alias("device_id"),
        F.col("header").alias("_header"), F.col("first").alias("_first"))
    cols = _columns(F.col("_header"))
    time_col = F.lit(None).cast("string")
    for c in reversed(TIME_COLUMNS):
        time_col = F.when(F.array_contains(cols, c), F.lit(c)).otherwise(time_col)
    seq = F.regexp_extract(F.col("path"), SEQUENCE, 1)
    meta = agg.select(
        F.md5("path").alias("id"), F.md5(_dirname(F.col("path"))).alias("id_session"), "path", "length",
        F.when(seq != "", seq.cast("int")).otherwise(F.lit(1)).alias("sequence"),
        "device_id", time_col.alias("time_col"), F.nullif(F.col("tz"), F.lit("")).alias("tz"),
        F.col("_rate").try_cast("int").alias("sampling_rate"), cols.alias("columns"),
        F.when(F.col("_first") < 0, "unreadable").when(F.col("_header").isNull(), "empty")
         .when(time_col.isNull(), "unknown time column").alias("reason"))
    meta = materialize(meta)  # each file is opened once, whatever reads its facts
    good = meta.where(F.col("reason").isNull()).drop("reason")
    bad = meta.where(F.col("reason").isNotNull())
    return (good, bad) if quarantine else good


def read_marker_events(spark: SparkSession, root: str, quarantine: bool = False):
    """Marker CSVs below ``root``; five columns selected by name, renamed.

    The ms epoch is read as long (text order = numeric order, N1). Rows whose
    epoch is no whole number go to quarantine.
    """
    files = list_files(spark, root).select("path", "length").where(F.col("path").rlike(MARKER_SUFFIX))
    rows = read_columns(files, MARKER_COLUMNS)
    epoch = F.col("timecode_utc").try_cast("long")
    good = rows.where(epoch.isNotNull()).withColumn("timecode_utc", epoch).drop("path")
    if not quarantine:
        return good
    return good, rows.where(epoch.isNull()).withColumn("reason", F.lit("epoch is not a whole number"))


def ingest_samples(spark: SparkSession, meta: DataFrame, id_col: str = "id", quarantine: bool = False):
    """S4 + S5: read the ECG files of ``meta`` and return (id_recording, id,
    t UTC, ecg, ecg_mV). Files not in ``meta`` are not opened; each byte range
    of the others is opened once, head and rows, and what it holds is a stage:
    layout, lake and quarantine read that.

    Each file's header names its columns: ``local_time`` is wall clock in the
    file's zone, ``timestamp`` is epoch seconds or ms decided per row (year >
    3000 as seconds means ms). ``id`` numbers the rows of a recording's file.
    A row whose time cannot be read goes to quarantine; a value that cannot be
    read is null.
    """
    names = {"timestamp": "_epoch", "local_time": "_local", "ecg": "ecg", "ecg_mV": "ecg_mV"}
    files = meta.select(F.col(id_col).alias("id_recording"), "path", "length", "time_col", "tz")
    rows = read_columns(files, names, comment="#", row_number="id")
    t = (F.when(F.col("time_col") == "local_time",
                local_to_utc(F.try_to_timestamp(F.col("_local")), F.coalesce(F.col("tz"), F.lit("UTC"))))
          .otherwise(epoch_auto(F.col("_epoch").try_cast("double"))))
    bad = t.isNull()
    rows = materialize(rows.select(
        "id_recording", "id", t.alias("t"), F.col("ecg").try_cast("double").alias("ecg"),
        F.col("ecg_mV").try_cast("double").alias("ecg_mV"), F.when(bad, F.col("path")).alias("path"),
        F.when(bad, F.coalesce("_local", "_epoch")).alias("time_text")))
    good = rows.where(F.col("t").isNotNull()).drop("path", "time_text")
    if not quarantine:
        return good
    bad = rows.where(F.col("t").isNull()).select("id_recording", "id", "path", "time_text", F.lit("unreadable time").alias("reason"))
    return good, bad


def eda_header_scan(paths: DataFrame, root: str, quarantine: bool = False, strict: bool = False):
    """EDA header facts: device (line 1, after ':' before ';'),
    participant (file name), category (first folder below root), start time
    text (line 4, field 2) parsed in three candidate zones later, data
    header line (28 or 29). Malformed files go to quarantine with a reason;
    ``strict`` raises where there are any, as the reference does."""
    heads = head_lines(paths, EDA_HEADER_LINES)
    data_header = F.coalesce(*[F.when(F.substring(F.get("lines", n - 1), 1, 6) == EDA_DATA_HEADER, n) for n in EDA_DATA_HEADER_LINES])
    agg = heads.select("path", "length", F.get("lines", 0).alias("_l1"), F.get("lines", 3).alias("_l4"),
                       data_header.alias("data_header_line"))
    device = F.ltrim(F.get(F.split(F.get(F.split(F.col("_l1"), ";"), 0), ":"), 1))
    bare_root = root[5:] if root.startswith("file:") else root
    rel = F.replace(F.regexp_replace(F.col("path"), "^file:", ""), F.lit(bare_root.rstrip("/") + "/"), F.lit(""))
    first = F.split(rel, "/")[0]
    rescat = F.regexp_replace(F.regexp_replace(first, r"^([0-9_]+)\..*", "$1"), "_", "").try_cast("int")
    meta = agg.select(
        "path", "length", device.alias("device"),
        F.regexp_replace(F.regexp_extract(F.col("path"), r"([^/]*)$", 1), r"\.csv$", "").alias("mirage_pid"),
        rescat.alias("rescat"), F.get(F.split(F.col("_l4"), ";"), 1).alias("start_text"),
        "data_header_line")
    meta = meta.withColumn("reason", F.when(F.col("device").isNull(), EDA_REASONS[0])
                           .when(F.col("data_header_line").isNull(), EDA_REASONS[1]))
    if strict:
        seen = Observed(*EDA_REASONS)
        meta = materialize(seen.on(meta, F.col("reason"), F.col("path")))
        seen.refuse()
    else:
        meta = materialize(meta)  # each file is opened once, whatever reads its facts
    good = meta.where(F.col("reason").isNull()).drop("reason")
    return (good, meta.where(F.col("reason").isNotNull())) if quarantine else good


def eda_lengths(heads: DataFrame) -> DataFrame:
    """Greatest SECOND value of each file of an EDA header scan (path,
    length, data_header_line): of the rows behind the data header only, so a
    number in the preamble is no length."""
    return greatest_first_field(heads, "data_header_line", out="length_secs")


def file_manifest(spark: SparkSession, root: str, glob: str | None = None, previous: DataFrame | None = None) -> DataFrame:
    """(path, length, modified, md5 of content) of every file.

    Tasks read each file in chunks, so no file is held as one value. With the
    ``previous`` manifest only files that are new, or whose length or time has
    changed, are opened; the others keep the hash that they had.
    """
    found = list_files(spark, root).select("path", "length", F.col("modificationTime").alias("modified"))
    if glob:
        name = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern()
        found = found.where(F.regexp_extract("path", "([^/]*)$", 1).rlike(f"^(?:{name})$"))
    hashed = "path string, length long, modified timestamp, md5 string"

    def hashes(files: DataFrame) -> DataFrame:
        tasks = task_count(files, F.col("length") + OPEN_BYTES)
        return files.repartition(tasks).mapInPandas(_content_hashes, hashed)
    if previous is None:
        return hashes(found)
    before = previous.select("path", F.col("length").alias("_l"), F.col("modified").alias("_t"), "md5")
    both = materialize(found.join(before, "path", "left"))
    known = (F.col("length") == F.col("_l")) & (F.col("modified") == F.col("_t")) & F.col("md5").isNotNull()
    same = F.coalesce(known, F.lit(False))
    anew = hashes(both.where(~same).select("path", "length", "modified"))
    return anew.unionByName(both.where(same).select("path", "length", "modified", "md5"))


def record_manifest(spark: SparkSession, root: str, store: str, glob: str | None = None) -> DataFrame:
    """Write the next version of a folder's manifest below ``store`` and return
    what has changed since the last one (see :func:`manifest_changes`)."""
    old = manifest_version(spark, store)
    last = _versions(spark, store)
    new = file_manifest(spark, root, glob, old)
    number = last[-1] + 1 if last else 1
    new.write.mode("overwrite").parquet(f"{store.rstrip('/')}/version={number}")
    new = manifest_version(spark, store, number)
    return manifest_changes(new.limit(0) if old is None else old, new)


def _versions(spark: SparkSession, store: str) -> list[int]:
    """The versions whose write has ended, in order."""
    path = spark._jvm.org.apache.hadoop.fs.Path(store)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = spark._jvm.org.apache.hadoop.fs.Path(path, "version=*/_SUCCESS")
    return sorted(int(x.getPath().getParent().getName().partition("=")[2]) for x in fs.globStatus(done))


def manifest_version(spark: SparkSession, store: str, number: int | None = None) -> DataFrame | None:
    """A stored manifest, by default the latest; None if there is none."""
    known = _versions(spark, store)
    number = number or (known[-1] if known else None)
    if number not in known:
        return None
    return spark.read.parquet(f"{store.rstrip('/')}/version={number}")


def manifest_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """What became of every path of two manifests: (path, old_path, status).

    ``same``, ``changed`` (other content), ``added``, ``removed`` or ``moved``:
    a path that appears with the content of one that is gone. Where several
    appear and vanish with one content, they are matched in order of their
    paths, and what is left over is added or removed.
    """
    o = old.select(F.col("path").alias("old_path"), F.col("md5").alias("old_md5"), F.col("length").alias("old_length"))
    n = new.select("path", "md5", "length")
    both = materialize(n.join(o, F.col("path") == F.col("old_path"), "full_outer"))
    kept = both.where(F.col("path").isNotNull() & F.col("old_path").isNotNull())
    alike = F.col("md5").eqNullSafe(F.col("old_md5")) & F.col("length").eqNullSafe(F.col("old_length"))
    status = F.when(alike, "same").otherwise("changed")
    come = ranked(both.where(F.col("old_path").isNull()).select("path", "md5", "length"), ["md5", "length"], ["path"], "_k")
    gone = ranked(both.where(F.col("path").isNull()).select("old_path", F.col("old_md5").alias("md5"), F.col("old_length").alias("length")),
                  ["md5", "length"], ["old_path"], "_k")
    moved = come.join(gone, ["md5", "length", "_k"], "full_outer").select("path", "old_path", F.when(
        F.col("old_path").isNull(), "added").when(F.col("path").isNull(), "removed").otherwise("moved").alias("status"))
    return kept.select("path", "old_path", status.alias("status")).unionByName(moved)


def _content_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import hashlib

    for b in batches:
        found = []
        for path in b["path"]:
            digest = hashlib.md5()
            with open_file(path) as f:
                while chunk := f.read(HASH_CHUNK):
                    digest.update(chunk)
            found.append(digest.hexdigest())
        yield b.assign(md5=found)

