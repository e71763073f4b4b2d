"""Bindings of the study-shaped operators to the driver's tables.

The study data (ECG samples, tablet markers, EDA files) is not public, so
each operator reads the given tables in the roles listed in FIXTURES.md:
``events`` plays the marker log and the sample stream, orders/lineitem the
lake, pages the file paths. Every binding is a lazy DataFrame derived from
the tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.sources.tables import table

# Fixed binding choices (not reference values).
START_EVENT, STOP_EVENT, MARKER_ROOT = "signup", "purchase", "visit"
SAMPLE_TYPES = ("click", "view", "error")


def marker_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> raw marker rows (id, mirage_pid, lang, event, timecode_utc).

    signup/purchase become ``visit_start``/``visit_stop``; other event types
    keep their names and are ignored by the pairing, like non start/stop
    markers in the study log.
    """
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    marker = (F.when(et == START_EVENT, F.lit(MARKER_ROOT + "_start"))
               .when(et == STOP_EVENT, F.lit(MARKER_ROOT + "_stop"))
               .otherwise(et))
    return ev.select(
        F.col("event_id").cast("string").alias("id"),
        F.concat(F.lit("PID"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("mirage_pid"),
        F.lit("en").alias("lang"),
        marker.alias("event"),
        F.unix_millis("ts").alias("timecode_utc"))


MARKER_EVENTS_SQL = f"""
marker_events AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         'PID' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS mirage_pid,
         'en' AS lang,
         CASE event_type WHEN '{START_EVENT}' THEN '{MARKER_ROOT}_start'
                         WHEN '{STOP_EVENT}' THEN '{MARKER_ROOT}_stop'
                         ELSE event_type END AS event,
         epoch_us(ts) // 1000 AS timecode_utc
  FROM events)"""


# --- samples / recordings (ECG roles) -------------------------------------

STUDY_ROOT = "/study"


def _participant(user_id="user_id"):
    return F.lpad(F.col(user_id).cast("string"), 5, "0")


def _week(ts="ts"):
    return F.to_date(F.date_trunc("week", F.col(ts))).cast("string")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """click/view/error events as sensor samples; one recording per user-week."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*SAMPLE_TYPES))
    return ev.select(
        F.concat(F.lit("u"), _participant(), F.lit("/"), _week()).alias("id_recording"),
        _participant().alias("participant"),
        F.col("event_id").alias("id"), F.col("ts").alias("t"), F.col("value").alias("ecg"))


SAMPLES_SQL = f"""
samples AS (
  SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '/' ||
           CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS id_recording,
         lpad(CAST(user_id AS VARCHAR), 5, '0') AS participant,
         event_id AS id, ts AS t, value AS ecg
  FROM events WHERE event_type IN ({", ".join(f"'{x}'" for x in SAMPLE_TYPES)}))"""


def category_of(user_id: str = "user_id"):
    """Binding: respondent category 1..12 of a user."""
    return (F.col(user_id) % 12 + 1).cast("int")


def recordings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recording meta per user-week: id, id_session, participant, path,
    device_id, respondent_cat, year, month (of the first sample)."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*SAMPLE_TYPES))
    per = ev.groupBy("user_id", F.date_trunc("week", "ts").alias("_wk")).agg(F.min("ts").alias("_t0"))
    part = _participant()
    folder = F.concat_ws("/", F.lit(STUDY_ROOT), F.lit("ecg"), category_of().cast("string"), part)
    return per.select(
        F.concat(F.lit("u"), part, F.lit("/"), F.to_date("_wk").cast("string")).alias("id"),
        F.md5(folder).alias("id_session"),
        part.alias("participant"),
        F.concat(folder, F.lit("/"), F.to_date("_wk").cast("string"), F.lit("-ecg.csv")).alias("path"),
        F.concat(F.lit("BG"), F.lpad(F.col("user_id").cast("string"), 8, "0")).alias("device_id"),
        category_of().alias("respondent_cat"),
        F.year("_t0").alias("year"), F.month("_t0").alias("month"))


RECORDINGS_SQL = f"""
recordings AS (
  SELECT 'u' || lpad(CAST(user_id AS VARCHAR), 5, '0') || '/' || CAST(CAST(wk AS DATE) AS VARCHAR) AS id,
         md5(concat_ws('/', '{STUDY_ROOT}', 'ecg', CAST(user_id % 12 + 1 AS VARCHAR),
                       lpad(CAST(user_id AS VARCHAR), 5, '0'))) AS id_session,
         lpad(CAST(user_id AS VARCHAR), 5, '0') AS participant,
         concat_ws('/', '{STUDY_ROOT}', 'ecg', CAST(user_id % 12 + 1 AS VARCHAR),
                   lpad(CAST(user_id AS VARCHAR), 5, '0')) || '/' || CAST(CAST(wk AS DATE) AS VARCHAR)
           || '-ecg.csv' AS path,
         'BG' || lpad(CAST(user_id AS VARCHAR), 8, '0') AS device_id,
         CAST(user_id % 12 + 1 AS INTEGER) AS respondent_cat,
         CAST(year(t0) AS INTEGER) AS year, CAST(month(t0) AS INTEGER) AS month
  FROM (SELECT user_id, date_trunc('week', ts) AS wk, min(ts) AS t0 FROM events
        WHERE event_type IN ({", ".join(f"'{x}'" for x in SAMPLE_TYPES)}) GROUP BY 1, 2))"""


# --- EDA files (second device) ----------------------------------------------

EDA_ZONES = {"bd": "Asia/Dhaka", "al": "Asia/Almaty", "ist": "Asia/Calcutta"}
EDA_TYPE = "click"


def eda_meta_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """click events as EDA files: header start time read as wall clock in
    three candidate zones (wide), length in seconds as float."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == EDA_TYPE)
    part = _participant()
    cols = [F.concat_ws("/", F.lit(STUDY_ROOT), F.lit("eda"), category_of().cast("string"),
                        F.col("event_id").cast("string"), F.concat(part, F.lit(".csv"))).alias("path"),
            F.concat(F.lit("ES"), F.lpad((F.col("user_id") % 7).cast("string"), 4, "0")).alias("device"),
            part.alias("mirage_pid"), category_of().alias("rescat"),
            (F.col("value") * 60).cast("float").alias("length_secs")]
    zones = [F.to_utc_timestamp("ts", z).alias(f"start_time_{k}") for k, z in EDA_ZONES.items()]
    return ev.select(*cols, *zones)


EDA_WIDE_SQL = f"""
eda_wide AS (
  SELECT concat_ws('/', '{STUDY_ROOT}', 'eda', CAST(user_id % 12 + 1 AS VARCHAR), CAST(event_id AS VARCHAR),
                   lpad(CAST(user_id AS VARCHAR), 5, '0') || '.csv') AS path,
         'ES' || lpad(CAST(user_id % 7 AS VARCHAR), 4, '0') AS device,
         lpad(CAST(user_id AS VARCHAR), 5, '0') AS mirage_pid,
         CAST(user_id % 12 + 1 AS INTEGER) AS rescat,
         CAST(value * 60 AS FLOAT) AS length_secs,
         {", ".join(f"timezone('UTC', timezone('{z}', ts)) AS start_time_{k}" for k, z in EDA_ZONES.items())}
  FROM events WHERE event_type = '{EDA_TYPE}')"""


# --- session folders and window labels ----------------------------------------

def _h12(ts):
    return ((F.hour(ts) + 11) % 12 + 1).cast("string")


def _mm(ts):
    return F.lpad(F.minute(ts).cast("string"), 2, "0")


def _ap(ts):
    return F.when(F.hour(ts) < 12, F.lit("AM")).otherwise(F.lit("PM"))


def session_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id_session, path) of every event's session folder."""
    return event_sessions(spark, sf_dir).select("id_session", "path")


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, id_session, path): one session folder per event: <root>/ecg/<category>/<type>/<yyyymmdd>/<code>/<label>.

    The window label is written from the event time and value (minutes),
    with one of twelve typing faults chosen by event id.
    """
    from tidelink.operators.delivery import category_folder
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts")
    te = F.timestamp_micros(F.unix_micros("ts") + F.floor(F.col("value") * 60000000))
    pid = F.lpad(F.col("user_id").cast("string"), 5, "0")
    pid2 = F.lpad(((F.col("user_id") + 1) % 1000 + 10000).cast("string"), 5, "0")
    letter = F.when(F.col("event_id") % 2 == 0, F.lit("M")).otherwise(F.lit("C"))
    t1 = F.concat(_h12(ts), F.lit(";"), _mm(ts))
    t2 = F.concat(_h12(te), F.lit(";"), _mm(te))
    win = F.concat(t1, _ap(ts), F.lit("-"), t2, _ap(te))
    canon = F.concat(pid, letter, F.lit("_"), win)
    k = F.col("event_id") % 12
    label = (F.when(k == 0, canon)
              .when(k == 1, F.concat(pid, F.lit("_"), F.translate(t1, ";", "."), F.lower(_ap(ts)), F.lit("-"),
                                     F.translate(t2, ";", "."), F.lower(_ap(te))))
              .when(k == 2, F.concat(pid, letter, F.lit("_"), t1, F.lit("-"), t2, _ap(te)))
              .when(k == 3, F.concat(pid, letter, F.lit(" _"), win))
              .when(k == 4, F.concat(pid, letter, F.lit("_"), t1, _ap(ts), F.lit("_"), t2, _ap(te)))
              .when(k == 5, F.concat(canon, F.lit("(6 MONTH)")))
              .when(k == 6, F.concat(canon, F.lit(" "), pid, F.lit("C_"), win))
              .when(k == 7, F.concat(pid, F.lit(","), pid2))
              .when(k == 8, F.concat(F.lit("PIDGT"), F.col("event_id").cast("string")))
              .when(k == 9, F.concat(canon, F.lit(" CHILD")))
              .when(k == 10, F.concat(pid, F.lit(" MOTHER")))
              .otherwise(F.concat(pid, letter, F.lit("_"), t1, _ap(ts), F.lit("-"), F.regexp_replace(t2, ";", ""),
                                  _ap(te))))
    cat = category_of()
    type_folder = (F.when(F.col("event_id") % 4 == 0, F.lit("Mother")).when(F.col("event_id") % 4 == 1, F.lit("Child"))
                    .when(F.col("event_id") % 4 == 2, F.lit("Birth_follow_up_mother"))
                    .otherwise(F.lit("Birth_follow_up_child")))
    code = F.concat(pid, F.when(F.col("event_id") % 3 == 0, F.lit("M")).when(F.col("event_id") % 3 == 1, F.lit("C"))
                    .otherwise(F.lit("MC")))
    folder = F.when(cat.isin(*[1, 4, 6, 7, 10]), category_folder(cat)).otherwise(
        F.concat(cat.cast("string"), F.lit(". Wave ")))
    path = F.concat_ws("/", F.lit(STUDY_ROOT), F.lit("ecg"), folder, type_folder,
                       F.date_format(ts, "yyyyMMdd"), code, label)
    return ev.select("event_id", path.alias("path")).select("event_id", F.md5("path").alias("id_session"), "path")
