"""Queries over raw-file sources and the lake."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelink.functions.timefn import add_seconds
from tidelink.operators.reshape import month_partitions, unpivot_non_null
from tidelink.plans import bindings as B
from tidelink.plans.q_events import windows
from tidelink.plans.rawfiles import ZONES, faulty_root, raw_root
from tidelink.plans.registry import query, stage
from tidelink.plans.sqlparts import marker_windows_ctes, with_ctes
from tidelink.session import scratch_dir
from tidelink.sources import files as S
from tidelink.sources import lake as LK
from tidelink.sources.recordings import ingest_recordings
from tidelink.sources.tables import table

_TYPES = ", ".join(f"'{x}'" for x in B.SAMPLE_TYPES)
ZONE_SQL = f"CASE user_id % 3 WHEN 0 THEN '{ZONES[0]}' WHEN 1 THEN '{ZONES[1]}' ELSE '{ZONES[2]}' END"

# the expected content of the raw files, computed from the tables
RAW_ECG_SQL = f"""
ecg_files AS (
  SELECT DISTINCT user_id, CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week
  FROM events WHERE event_type IN ({_TYPES})),
ecg_rows AS (
  SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '/' ||
           CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS id_recording,
         CASE WHEN user_id % 2 = 0 OR event_id % 2 = 0 THEN ts
              ELSE make_timestamp((epoch_us(ts) // 1000) * 1000) END AS t,
         CAST(row_number() OVER (PARTITION BY user_id, date_trunc('week', ts) ORDER BY ts, event_id) AS BIGINT) AS id,
         value AS ecg, value / 1000 AS "ecg_mV", user_id
  FROM events WHERE event_type IN ({_TYPES}))"""


# every raw file by its path below the root
FILES_SQL = f"""
users AS (
  SELECT DISTINCT user_id, lpad(CAST(user_id AS VARCHAR), 5, '0') AS pid, event_type,
         CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week, CAST(user_id % 12 + 1 AS VARCHAR) AS cat FROM events),
files AS (
  SELECT DISTINCT 'ecg/' || cat || '/' || pid || '/' || week || '_' || (user_id % 13) || '-ecg.csv' AS file, 'ecg' AS kind, pid
  FROM users WHERE event_type IN ({_TYPES})
  UNION ALL
  SELECT 'eda/' || cat || '.eda/' || week || '/' || pid || '.csv', 'eda', pid FROM users WHERE event_type = '{B.EDA_TYPE}'
  UNION ALL
  SELECT DISTINCT 'mirage/PID' || pid || 'utcmarker.csv', 'mirage', pid FROM users)"""
LONG_NAME = r"/((?:ecg|eda|mirage|moved)/.*)$"


def _rec_id_of(p):
    # .../ecg/<cat>/<pid>/<week>_<n>-ecg.csv -> u<pid>/<week>
    return F.concat(F.lit("u"), F.regexp_extract(p, r"/(\d{5})/[^/]*$", 1), F.lit("/"),
                    F.regexp_extract(p, r"/(\d{4}-\d{2}-\d{2})_\d+-ecg\.csv$", 1))


def listing(spark, sf_dir):
    return S.discover_files(spark, raw_root(spark, sf_dir))


def ecg_meta(spark, sf_dir):
    """Header facts of all ECG files, scanned once for all that a query reads."""
    def scan():
        ecg = listing(spark, sf_dir).where(F.col("kind") == "ecg")
        return S.recording_header_scan(ecg).withColumn("id", _rec_id_of(F.col("path")))
    return stage(spark, sf_dir, "ecg_meta", scan)


@query("discover_files", with_ctes(RAW_ECG_SQL, final=f"""
SELECT 'ecg' AS kind, count(*) AS n_files FROM ecg_files
UNION ALL SELECT 'marker', count(DISTINCT user_id) FROM events
UNION ALL SELECT 'csv', count(*) FROM (SELECT DISTINCT user_id, date_trunc('week', ts) FROM events
                                      WHERE event_type = '{B.EDA_TYPE}')"""))
def q_discover_files(spark, sf_dir):
    """Files below the root by kind (listing only, no contents read)."""
    return listing(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n_files"))


@query("read_marker_events", with_ctes(B.MARKER_EVENTS_SQL, final="SELECT * FROM marker_events"))
def q_read_marker_events(spark, sf_dir):
    """Marker CSVs read back with the fixed schema (round trip)."""
    return S.read_marker_events(spark, raw_root(spark, sf_dir) + "/mirage")


@query("recording_header_scan", with_ctes(RAW_ECG_SQL, final=f"""
SELECT 'BG' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS device_id,
       CASE WHEN user_id % 2 = 0 THEN 'local_time' ELSE 'timestamp' END AS time_col,
       {ZONE_SQL} AS tz, 1000 AS sampling_rate, CAST(user_id % 13 AS INTEGER) AS sequence
FROM ecg_files"""))
def q_recording_header_scan(spark, sf_dir):
    """S3: header facts of every ECG file (head bytes only)."""
    return ecg_meta(spark, sf_dir).select("device_id", "time_col", "tz", "sampling_rate", "sequence")


def samples_raw(spark, sf_dir):
    return S.ingest_samples(spark, ecg_meta(spark, sf_dir))


@query("ingest_local_time", with_ctes(RAW_ECG_SQL, final="""
SELECT id_recording, id, t, ecg, "ecg_mV" FROM ecg_rows WHERE user_id % 2 = 0"""))
def q_ingest_local_time(spark, sf_dir):
    """Wall-clock files converted to UTC with each file's zone."""
    m = ecg_meta(spark, sf_dir)
    return S.ingest_samples(spark, m.where(F.col("time_col") == "local_time"))


@query("ingest_epoch", with_ctes(RAW_ECG_SQL, final="""
SELECT id_recording, id, t, ecg, "ecg_mV" FROM ecg_rows WHERE user_id % 2 = 1"""))
def q_ingest_epoch(spark, sf_dir):
    """Epoch files; seconds or milliseconds decided per row."""
    m = ecg_meta(spark, sf_dir)
    return S.ingest_samples(spark, m.where(F.col("time_col") == "timestamp"))


LAKE_COLUMNS = ("id_recording", "id", "t", "ecg", "ecg_mV", "offset_secs")
LAKE_SQL = """
lake AS (
  SELECT id_recording, id, t, ecg, "ecg_mV",
         (epoch_us(t) - min(epoch_us(t)) OVER (PARTITION BY id_recording)) // 1000 / 1000 AS offset_secs,
         CAST(year(min(t) OVER (PARTITION BY id_recording)) AS INTEGER) AS year,
         CAST(month(min(t) OVER (PARTITION BY id_recording)) AS INTEGER) AS month
  FROM ecg_rows)"""


@query("write_lake", with_ctes(RAW_ECG_SQL, LAKE_SQL, final="SELECT * FROM lake"))
def q_write_lake(spark, sf_dir):
    """S6 + W1: ingest all ECG files, write the year/month lake, read it back."""
    root = scratch_dir(spark, "lake")
    LK.write_lake(samples_raw(spark, sf_dir), root)
    return spark.read.parquet(root).select(*LAKE_COLUMNS, "year", "month")


@query("read_lake_partition", with_ctes(RAW_ECG_SQL, LAKE_SQL, final="""
SELECT id_recording, id, t, ecg, "ecg_mV", offset_secs FROM lake WHERE year = 2024 AND month = 1"""))
def q_read_lake_partition(spark, sf_dir):
    """One month of the lake; the month filter prunes partitions."""
    root = scratch_dir(spark, "lake")
    LK.write_lake(samples_raw(spark, sf_dir), root)
    return LK.read_lake_partition(spark, root, 2024, 1).select(*LAKE_COLUMNS)


@query("incremental_ingest", with_ctes(RAW_ECG_SQL, final="""
SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '/' || week AS id FROM ecg_files
WHERE user_id % 2 = 1"""))
def q_incremental_ingest(spark, sf_dir):
    """After the wall-clock files are in the lake, only the other files
    are new (left anti join on recording id); they are then appended."""
    root = scratch_dir(spark, "lake")
    meta = ecg_meta(spark, sf_dir)
    first = meta.where(F.col("time_col") == "local_time")
    LK.write_lake(S.ingest_samples(spark, first), root)
    todo = LK.incremental_candidates(spark, meta, root)
    LK.write_lake(S.ingest_samples(spark, todo), root, mode="append")
    return todo.select("id")


RAW_EDA_SQL = f"""
eda_files AS (
  SELECT user_id, min(ts) AS t0, max(epoch_us(ts)) AS us1, min(epoch_us(ts)) AS us0
  FROM events WHERE event_type = '{B.EDA_TYPE}' GROUP BY user_id, date_trunc('week', ts)),
eda_expect AS (
  SELECT 'ES' || lpad(CAST(user_id % 7 AS VARCHAR), 4, '0') AS device,
         lpad(CAST(user_id AS VARCHAR), 5, '0') AS mirage_pid, CAST(user_id % 12 + 1 AS INTEGER) AS rescat,
         CAST(((us1 - us0) // 10000) / 100 AS FLOAT) AS length_secs,
         date_trunc('second', t0) AS wall
  FROM eda_files)"""
EDA_ZONES_SQL = ", ".join(f"('{k}', '{z}')" for k, z in B.EDA_ZONES.items())


def eda_read(spark, sf_dir):
    """S9 + S10 + P8a: EDA header facts, lengths and zone candidates."""
    root = raw_root(spark, sf_dir) + "/eda"
    files = listing(spark, sf_dir).where(F.col("kind") == "csv")
    heads = stage(spark, sf_dir, "eda_heads", lambda: S.eda_header_scan(files, root))
    meta = heads.join(S.eda_lengths(heads), "path")
    local = F.to_timestamp(F.col("start_text"), S.EDA_TIME_FORMAT)
    wide = meta.select("path", "device", "mirage_pid", "rescat", "length_secs",
                       *[F.to_utc_timestamp(local, z).alias(f"start_time_{k}") for k, z in B.EDA_ZONES.items()])
    long = unpivot_non_null(wide, ["path", "device", "mirage_pid", "rescat", "length_secs"],
                            [f"start_time_{k}" for k in B.EDA_ZONES], "tz", "start_time")
    return (long.withColumn("tz", F.regexp_replace("tz", "start_time_", ""))
                .withColumn("end_time", add_seconds(F.col("start_time"), F.col("length_secs"))))


@query("read_eda_meta", with_ctes(RAW_EDA_SQL, final=f"""
SELECT device, mirage_pid, rescat, length_secs, z.k AS tz,
       timezone('UTC', timezone(z.zone, wall)) AS start_time,
       make_timestamp(epoch_us(timezone('UTC', timezone(z.zone, wall)))
                      + CAST(round(CAST(length_secs AS DOUBLE) * 1000000) AS BIGINT)) AS end_time
FROM eda_expect, (VALUES {EDA_ZONES_SQL}) z(k, zone)"""))
def q_read_eda_meta(spark, sf_dir):
    """EDA files -> device, participant, category, zone candidates."""
    return eda_read(spark, sf_dir).drop("path")


@query("eda_length", with_ctes(RAW_EDA_SQL, final="SELECT mirage_pid, length_secs FROM eda_expect"))
def q_eda_length(spark, sf_dir):
    """Greatest SECOND value per EDA file."""
    files = listing(spark, sf_dir).where(F.col("kind") == "csv")
    lens = S.eda_lengths(S.eda_header_scan(files, raw_root(spark, sf_dir) + "/eda"))
    return lens.select(F.regexp_extract("path", r"/(\d{5})\.csv$", 1).alias("mirage_pid"), "length_secs")


@query("file_manifest", with_ctes(B.MARKER_EVENTS_SQL, """
contents AS (
  SELECT mirage_pid || 'utcmarker.csv' AS file, 'id,participantID,lang,marker,utc_app' || chr(10) ||
         string_agg(concat_ws(',', id, mirage_pid, lang, event, timecode_utc) || chr(10), '' ORDER BY CAST(id AS BIGINT)) AS content
  FROM marker_events GROUP BY mirage_pid)""", RAW_ECG_SQL, FILES_SQL, final="""
SELECT files.file, strlen(content) AS length, md5(content) AS md5
FROM files LEFT JOIN contents ON files.file = 'mirage/' || contents.file"""))
def q_file_manifest(spark, sf_dir):
    """Content hash of every ECG, EDA and marker file; the hashes of the
    marker files, whose bytes SQL can spell, are returned."""
    m = S.file_manifest(spark, raw_root(spark, sf_dir))
    known = F.col("path").endswith("utcmarker.csv")
    sound = F.when((F.length("md5") == 32) & (F.col("length") > 0), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("no hash of "), "path")))
    m = m.where(sound)
    return m.select(F.regexp_extract("path", LONG_NAME, 1).alias("file"), F.when(known, F.col("length")).alias("length"),
                    F.when(known, F.col("md5")).alias("md5"))


def _next_version(old, users):
    """A later state of the files: every 7th user's ECG files are gone, every
    7th + 1 user's EDA files have another content, marker files of every 7th + 2
    user are in another folder, and those of every 7th + 3 user are there twice."""
    kind = F.regexp_extract("path", r"/(ecg|eda|mirage)/", 1)
    moved = F.replace(F.col("path"), F.lit("/mirage/"), F.lit("/moved/"))
    left = old.select("*", kind.alias("kind"), users.alias("user")).where(~((F.col("kind") == "ecg") & (F.col("user") == 0)))
    changed = (F.col("kind") == "eda") & (F.col("user") == 1)
    path = F.when((F.col("kind") == "mirage") & (F.col("user") == 2), F.array(moved)).when(
        (F.col("kind") == "mirage") & (F.col("user") == 3), F.array("path", moved)).otherwise(F.array("path"))
    return left.select(F.explode(path).alias("path"), "length", "modified",
                       F.when(changed, F.md5("md5")).otherwise(F.col("md5")).alias("md5"))


@query("manifest_changes", with_ctes(RAW_ECG_SQL, FILES_SQL, """
later AS (
  SELECT file, kind, CAST(pid AS BIGINT) % 7 AS k, replace(file, 'mirage/', 'moved/') AS other FROM files)""", final="""
SELECT CASE WHEN kind = 'mirage' AND k = 2 THEN other WHEN NOT (kind = 'ecg' AND k = 0) THEN file END AS file,
       file AS old_file, CASE WHEN kind = 'ecg' AND k = 0 THEN 'removed' WHEN kind = 'eda' AND k = 1 THEN 'changed'
         WHEN kind = 'mirage' AND k = 2 THEN 'moved' ELSE 'same' END AS status
FROM later
UNION ALL SELECT other, NULL, 'added' FROM later WHERE kind = 'mirage' AND k = 3"""))
def q_manifest_changes(spark, sf_dir):
    """Two versions of the manifest of all raw files compared."""
    old = stage(spark, sf_dir, "manifest", lambda: S.file_manifest(spark, raw_root(spark, sf_dir)))
    pid = F.regexp_extract("path", r"/(?:PID)?(\d{5})(?:/[^/]*-ecg|utcmarker|)\.csv$", 1)
    found = S.manifest_changes(old, _next_version(old, pid.cast("long") % 7))
    name = lambda c: F.regexp_extract(c, LONG_NAME, 1)
    return found.select(F.when(F.col("path").isNotNull(), name("path")).alias("file"),
                        F.when(F.col("old_path").isNotNull(), name("old_path")).alias("old_file"), "status")


@query("lake_time_index", with_ctes(RAW_ECG_SQL, final="""
SELECT id_recording, epoch_us(t) // 60000000 AS bucket, min(t) AS first_t, max(t) AS last_t
FROM ecg_rows GROUP BY 1, 2"""))
def q_lake_time_index(spark, sf_dir):
    """The first and last time of every occupied minute of a recording, kept beside the lake."""
    root = scratch_dir(spark, "lake")
    LK.write_lake(samples_raw(spark, sf_dir), root)
    return LK.lake_index(spark, root).select("id_recording", "bucket", "first_t", "last_t")


@query("month_filter", with_ctes(*marker_windows_ctes(), final=f"""
SELECT id, mirage_pid, start, "end" FROM windows
WHERE date_trunc('month', timezone('{LK.STUDY_ZONE}', timezone('UTC', start))) = DATE '2024-01-01'"""))
def q_month_filter(spark, sf_dir):
    """P3d: marker windows that start in January 2024 by the study's calendar."""
    found = LK.month_filter(windows(spark, sf_dir), "start", 2024, 1)
    return found.select("id", "mirage_pid", "start", "end")


@query("read_lake_month", with_ctes(RAW_ECG_SQL, LAKE_SQL, f"""
begins AS (
  SELECT id_recording, timezone('{LK.STUDY_ZONE}', timezone('UTC', min(t))) AS wall FROM ecg_rows GROUP BY 1)""", final="""
SELECT lake.* FROM lake JOIN begins USING (id_recording) WHERE year(wall) = 2024 AND month(wall) = 1"""))
def q_read_lake_month(spark, sf_dir):
    """P3d + S8: recordings that begin in January 2024 by the study's calendar."""
    root = scratch_dir(spark, "lake")
    LK.write_lake(samples_raw(spark, sf_dir), root)
    return LK.read_lake_month(spark, root, 2024, 1).select(*LAKE_COLUMNS, "year", "month")


@query("month_partitions", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       count(DISTINCT o_orderkey) AS n_ids, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id
FROM orders GROUP BY 1, 2""")
def q_month_partitions(spark, sf_dir):
    """Distinct (year, month) of orders with their id range and count."""
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"),
                                             F.month("o_orderdate").alias("month"), F.col("o_orderkey").alias("id"))
    return month_partitions(o)


@query("register_view", "SELECT count(*) AS n FROM events WHERE event_type = 'click'")
def q_register_view(spark, sf_dir):
    """A frame exposed to SQL by name and queried there."""
    from tidelink.sources.tables import register_view
    register_view(table(spark, sf_dir, "events"), "events_view")
    return spark.sql("SELECT count(*) AS n FROM events_view WHERE event_type = 'click'")


@query("incremental_ingest_stream", with_ctes(RAW_ECG_SQL, LAKE_SQL, final="SELECT * FROM lake"))
def q_incremental_ingest_stream(spark, sf_dir):
    """S7 streaming: file-source stream (availableNow) appends new
    recordings to the lake; the lake is then read back."""
    from tidelink.streaming.ingest import stream_ecg_to_lake
    lake = scratch_dir(spark, "lake")
    ckpt = scratch_dir(spark, "stream-ckpt")
    q = stream_ecg_to_lake(spark, raw_root(spark, sf_dir) + "/ecg", lake, ckpt,
                           recording_id=_rec_id_of)
    q.awaitTermination()
    return spark.read.parquet(lake).select(*LAKE_COLUMNS, "year", "month")


@query("recordings_with_lake", with_ctes(RAW_ECG_SQL, LAKE_SQL, final="""
SELECT f.id, l.year, l.month FROM
  (SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '/' || week AS id FROM ecg_files) f
LEFT JOIN (SELECT DISTINCT id_recording, year, month FROM lake) l ON l.id_recording = f.id"""))
def q_recordings_with_lake(spark, sf_dir):
    """Header meta left-joined with lake entries (rejected files keep null year)."""
    out = ingest_recordings(spark, raw_root(spark, sf_dir), scratch_dir(spark, "lake"), recording_id=_rec_id_of)
    return out["recordings"].select("id", "year", "month")


@query("ingest_recordings", with_ctes(RAW_ECG_SQL, LAKE_SQL, final="SELECT * FROM lake"))
def q_ingest_recordings(spark, sf_dir):
    """The whole ingest run twice over the same files; the second run adds nothing."""
    lake = scratch_dir(spark, "lake")
    for _ in range(2):
        ingest_recordings(spark, raw_root(spark, sf_dir), lake, recording_id=_rec_id_of)
    return spark.read.parquet(lake).select(*LAKE_COLUMNS, "year", "month")


# --- data-quality checks over faulty files and clocks --------------

def _faulty_files(spark, sf_dir):
    good, bad = S.recording_header_scan(
        S.discover_files(spark, faulty_root(spark, sf_dir) + "/ecg"), quarantine=True)
    return bad.select(F.regexp_extract("path", r"([^/]*)-ecg\.csv$", 1).alias("file"), "reason")


@query("dq_readable", "SELECT DISTINCT CAST(user_id AS VARCHAR) AS file, 'empty' AS reason FROM events WHERE user_id % 5 = 0")
def q_dq_readable(spark, sf_dir):
    """dq_readable: files without any data line are put aside."""
    return _faulty_files(spark, sf_dir).where("reason = 'empty'")


@query("dq_time_column", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS file, 'unknown time column' AS reason FROM events WHERE user_id % 5 = 1""")
def q_dq_time_column(spark, sf_dir):
    """dq_time_column: files whose header names no known time column are put aside."""
    return _faulty_files(spark, sf_dir).where("reason = 'unknown time column'")


@query("dq_eda_header", """
SELECT DISTINCT lpad(CAST(user_id AS VARCHAR), 5, '0') AS mirage_pid,
       CASE user_id % 5 WHEN 0 THEN 'no device' ELSE 'no SECOND header' END AS reason
FROM events WHERE user_id % 5 < 2""")
def q_dq_eda_header(spark, sf_dir):
    """dq_eda_header: files without a device or a data header on its line are put aside."""
    root = faulty_root(spark, sf_dir) + "/eda"
    _, bad = S.eda_header_scan(S.discover_files(spark, root), root, quarantine=True)
    return bad.select("mirage_pid", "reason")


def _rejected(spark, sf_dir):
    """Recordings by a clock 40 years late, without any time, and without a sample."""
    user = F.col("participant").cast("long") % 7
    rows = B.samples(spark, sf_dir)
    late = F.timestamp_micros(F.unix_micros("t") - 40 * 365 * 86400 * 1000000)
    rows = rows.withColumn("t", F.when(user == 0, late).when(user != 1, F.col("t")))
    meta = rows.select(F.col("id_recording").alias("id")).distinct()
    _, bad = LK.lake_layout(rows.where(user != 2), meta=meta)
    return bad


@query("dq_recording_year", with_ctes(B.SAMPLES_SQL, final="""
SELECT id_recording, CAST(year(make_timestamp(min(epoch_us(t)) - 1261440000000000)) AS INTEGER) AS year,
       'year before 2000' AS reason
FROM samples WHERE CAST(participant AS BIGINT) % 7 = 0 GROUP BY 1"""))
def q_dq_recording_year(spark, sf_dir):
    """dq_recording_year: recordings that begin before 2000 are rejected."""
    return _rejected(spark, sf_dir).where("reason = 'year before 2000'")


@query("dq_nonempty_load", with_ctes(B.SAMPLES_SQL, final="""
SELECT DISTINCT id_recording, CASE CAST(participant AS BIGINT) % 7 WHEN 1 THEN 'no sample has a time' ELSE 'no samples' END AS reason
FROM samples WHERE CAST(participant AS BIGINT) % 7 IN (1, 2)"""))
def q_dq_nonempty_load(spark, sf_dir):
    """dq_nonempty_load: recordings that load no usable sample are rejected."""
    return _rejected(spark, sf_dir).where("year is null").select("id_recording", "reason")
