"""Queries over the linkage operators (A1, W1, J2-J6, P8a/P8d, L3, L4, L8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelink.functions.timefn import day_of
from tidelink.operators import composites as C
from tidelink.operators import labels as LB
from tidelink.operators import linkage as L
from tidelink.plans import bindings as B
from tidelink.plans.q_events import windows
from tidelink.plans.q_labels import session_window_ctes
from tidelink.plans.registry import query, stage
from tidelink.plans.sqlparts import marker_windows_ctes, with_ctes
from tidelink.sources.tables import table

TOLERANCE_MINUTES = 120  # widened from the reference's 10: the two event types rarely coincide

OFFSETS_SQL = """
s2 AS (
  SELECT *, (epoch_us(t) - min(epoch_us(t)) OVER (PARTITION BY id_recording)) // 1000 / 1000 AS offset_secs
  FROM samples)"""
LIMITS_SQL = """
limits AS (
  SELECT id_recording, participant, min(t) AS t_min, max(t) AS t_max FROM samples GROUP BY 1, 2)"""
LINKS_SQL = """
links AS (
  SELECT l.id_recording, w.id AS id_mirage, w.mirage_pid AS id_participant, w.start, w."end"
  FROM limits l JOIN windows w
    ON w.mirage_pid = l.participant AND w.start >= l.t_min AND w."end" <= l.t_max)"""
BACK_SQL = """
bk AS (
  SELECT k.id_recording, k.id_mirage, s.t AS time_start, s.offset_secs AS offset_start
  FROM links k ASOF JOIN s2 s ON k.id_recording = s.id_recording AND k.start >= s.t)"""
FWD_SQL = """
fw AS (
  SELECT k.id_recording, k.id_mirage, s.t AS time_end, s.offset_secs AS offset_end
  FROM links k ASOF JOIN s2 s ON k.id_recording = s.id_recording AND k."end" <= s.t)"""
LINKED_SQL = """
linked AS (SELECT * FROM bk FULL JOIN fw USING (id_recording, id_mirage))"""


def link_ctes() -> list[str]:
    return [*marker_windows_ctes(), B.SAMPLES_SQL, OFFSETS_SQL, LIMITS_SQL, LINKS_SQL,
            BACK_SQL, FWD_SQL, LINKED_SQL]


def samples_with_offset(spark, sf_dir):
    return L.offset_from_start(B.samples(spark, sf_dir))


def index(spark, sf_dir, bucket_seconds=L.BUCKET_SECONDS):
    """The samples' time index, which the lake keeps beside them."""
    return stage(spark, sf_dir, f"index-{bucket_seconds}", lambda: L.occupancy(
        B.samples(spark, sf_dir), bucket_seconds=bucket_seconds, constants=["participant"]))


def limits(spark, sf_dir, bucket_seconds=L.BUCKET_SECONDS):
    return L.index_limits(index(spark, sf_dir, bucket_seconds), "id_recording", "participant")


def links(spark, sf_dir, bucket_seconds=L.BUCKET_SECONDS):
    """(id_recording, id_mirage, id_participant, start, end) by containment."""
    w = windows(spark, sf_dir).select(F.col("mirage_pid").alias("participant"),
                                      F.col("id").alias("id_mirage"), "start", "end")
    return (L.contained_in(limits(spark, sf_dir, bucket_seconds), w, ["participant"])
             .select("id_recording", "id_mirage", F.col("participant").alias("id_participant"),
                     "start", "end"))


def linked(spark, sf_dir, bucket_seconds=L.BUCKET_SECONDS):
    """L4: links with the sample times/offsets at both window edges."""
    return stage(spark, sf_dir, f"linked-{bucket_seconds}", lambda: C.edge_samples(
        links(spark, sf_dir, bucket_seconds), B.samples(spark, sf_dir), index(spark, sf_dir, bucket_seconds), bucket_seconds))


@query("recording_limits", with_ctes(B.SAMPLES_SQL, final="""
SELECT id_recording, min(t) AS t_min, max(t) AS t_max FROM samples GROUP BY 1"""))
def q_recording_limits(spark, sf_dir):
    """A1: first/last sample per recording."""
    return L.recording_limits(B.samples(spark, sf_dir))


@query("offset_from_start", with_ctes(B.SAMPLES_SQL, OFFSETS_SQL,
                                      final="SELECT id_recording, id, t, offset_secs FROM s2"))
def q_offset_from_start(spark, sf_dir):
    """Offset of every sample from its recording's first sample."""
    return samples_with_offset(spark, sf_dir).select("id_recording", "id", "t", "offset_secs")


@query("contained_in", with_ctes(*marker_windows_ctes(), B.SAMPLES_SQL, LIMITS_SQL, LINKS_SQL,
                                 final="SELECT id_recording, id_mirage, id_participant FROM links"))
def q_contained_in(spark, sf_dir):
    """Marker windows inside a recording of the same participant."""
    return links(spark, sf_dir).select("id_recording", "id_mirage", "id_participant")


@query("asof_backward", with_ctes(*link_ctes()[:-2], final="SELECT * FROM bk"))
def q_asof_backward(spark, sf_dir):
    """Last sample at or before each linked window's start."""
    return linked(spark, sf_dir).select("id_recording", "id_mirage", "time_start", "offset_start")


@query("asof_forward", with_ctes(*link_ctes()[:-3], FWD_SQL, final="SELECT * FROM fw"))
def q_asof_forward(spark, sf_dir):
    """First sample at or after each linked window's end."""
    return linked(spark, sf_dir).select("id_recording", "id_mirage", "time_end", "offset_end")


@query("link_recordings", with_ctes(*link_ctes(), final="SELECT * FROM linked"))
def q_link_recordings(spark, sf_dir):
    """L4 (flagship): containment + as-of at both edges, wide per link."""
    return linked(spark, sf_dir)


@query("asof_bucketed", with_ctes(*link_ctes(), final="SELECT * FROM linked"))
def q_asof_bucketed(spark, sf_dir):
    """L4 with buckets of an hour."""
    return linked(spark, sf_dir, 3600)


# a recording belongs to the session of its first sample's event
RECORDING_SESSIONS_SQL = """
recording_sessions AS (
  SELECT r.id_recording, md5(p.path) AS id_session
  FROM (SELECT id_recording, min(id) AS event_id FROM samples GROUP BY 1) r JOIN event_paths p USING (event_id))"""
RESOLVED_SQL = """
links AS (
  SELECT DISTINCT l.id_recording, w.id AS id_mirage, w.mirage_pid AS id_participant, w.start, w."end"
  FROM limits l, recording_sessions rs, session_windows sw, windows w
  WHERE rs.id_recording = l.id_recording AND sw.id_session = rs.id_session AND w.mirage_pid = sw.participant
    AND w.start >= l.t_min AND w."end" <= l.t_max)"""


def resolved_ctes() -> list[str]:
    return [*marker_windows_ctes(), B.SAMPLES_SQL, OFFSETS_SQL, LIMITS_SQL, *session_window_ctes(),
            RECORDING_SESSIONS_SQL, RESOLVED_SQL]


def session_tables(spark, sf_dir):
    """Recordings with their sessions (id, id_session) and the session windows."""
    events = B.event_sessions(spark, sf_dir)
    first = B.samples(spark, sf_dir).groupBy(F.col("id_recording").alias("id")).agg(F.min("id").alias("event_id"))
    return (first.join(events, "event_id").select("id", "id_session"),
            LB.session_windows(events.select("id_session", "path"), B.STUDY_ROOT + "/"))


@query("resolve_links", with_ctes(*resolved_ctes(), final="SELECT id_recording, id_mirage, id_participant FROM links"))
def q_resolve_links(spark, sf_dir):
    """Marker windows inside a recording, by the participants of its session."""
    recordings, windows_of = session_tables(spark, sf_dir)
    found = L.resolve_links(limits(spark, sf_dir), recordings, windows_of, windows(spark, sf_dir))
    return found.select("id_recording", "id_mirage", "id_participant")


@query("link_by_sessions", with_ctes(*resolved_ctes(), BACK_SQL, FWD_SQL, LINKED_SQL, final="SELECT * FROM linked"))
def q_link_by_sessions(spark, sf_dir):
    """L4 whole: limits, session windows (J5) and as-of at both edges."""
    recordings, windows_of = session_tables(spark, sf_dir)
    return C.link_recordings(B.samples(spark, sf_dir), recordings, windows_of, windows(spark, sf_dir),
                             index=index(spark, sf_dir))


# --- second device: tolerance and nearest matches -------------------------

def _interval_events(spark, sf_dir, etype, s, e, idc, datec="date"):
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == etype)
    end = F.timestamp_micros(F.unix_micros("ts") + F.floor(F.col("value") * 60000000))
    return ev.select(F.lpad(F.col("user_id").cast("string"), 5, "0").alias("mirage_pid"),
                     F.col("ts").alias(s), end.alias(e), F.col("event_id").alias(idc),
                     day_of("ts").alias(datec))


def _interval_sql(name, etype, s, e, idc):
    return f"""
{name} AS (
  SELECT lpad(CAST(user_id AS VARCHAR), 5, '0') AS mirage_pid, ts AS {s},
         make_timestamp(epoch_us(ts) + CAST(floor(value * 60000000) AS BIGINT)) AS "{e}",
         event_id AS {idc}, date_trunc('day', ts) AS date
  FROM events WHERE event_type = '{etype}')"""


@query("tolerance_match", with_ctes(
    _interval_sql("e", "click", "start_time", "end_time", "row_esense"),
    _interval_sql("m", "view", "start", "end", "row_mirage"), """
minutes AS (
  SELECT mirage_pid, date, row_mirage, start AS start_mirage, "end" AS end_mirage,
         epoch_us(start) // 60000000 AS first_minute, epoch_us("end") // 60000000 AS last_minute FROM m)""", final=f"""
SELECT mirage_pid, date, row_esense, row_mirage, e.start_time AS start_esense, e.end_time AS end_esense,
       start_mirage, end_mirage, abs(first_minute - epoch_us(e.start_time) // 60000000) AS diff_start,
       abs(last_minute - epoch_us(e.end_time) // 60000000) AS diff_end
FROM minutes JOIN e USING (mirage_pid, date)
WHERE epoch_us(e.start_time) // 60000000 BETWEEN first_minute - {TOLERANCE_MINUTES} AND first_minute + {TOLERANCE_MINUTES}
  AND epoch_us(e.end_time) // 60000000 BETWEEN last_minute - {TOLERANCE_MINUTES} AND last_minute + {TOLERANCE_MINUTES}"""))
def q_tolerance_match(spark, sf_dir):
    """Click vs view intervals of one user-day within the tolerance."""
    e = _interval_events(spark, sf_dir, "click", "start_time", "end_time", "row_esense")
    m = _interval_events(spark, sf_dir, "view", "start", "end", "row_mirage")
    return C.eda_marker_matches(e, m, TOLERANCE_MINUTES)


EDA_LONG_SQL = """
eda_long AS (
  SELECT * EXCLUDE (tz, start_time), regexp_replace(tz, 'start_time_', '') AS tz, start_time,
         make_timestamp(epoch_us(start_time) + CAST(round(CAST(length_secs AS DOUBLE) * 1000000) AS BIGINT))
           AS end_time
  FROM (UNPIVOT eda_wide ON COLUMNS('^start_time_') INTO NAME tz VALUE start_time))"""


def eda_long(spark, sf_dir):
    return C.zone_candidates(B.eda_meta_wide(spark, sf_dir))


@query("unpivot_timezones", with_ctes(B.EDA_WIDE_SQL, EDA_LONG_SQL, final="SELECT * FROM eda_long"))
def q_unpivot_timezones(spark, sf_dir):
    """One row per candidate zone, end = start + length."""
    return eda_long(spark, sf_dir)


EDA_META_SQL = """
eda_meta AS (
  SELECT *, CAST(row_number() OVER (ORDER BY mirage_pid, start_time, tz, path) AS INTEGER) AS id
  FROM (SELECT DISTINCT * FROM eda_long))"""


def eda_meta(spark, sf_dir):
    """EDA candidates, deduplicated and numbered by (participant, start)."""
    return C.eda_metadata(B.eda_meta_wide(spark, sf_dir))


@query("eda_metadata", with_ctes(B.EDA_WIDE_SQL, EDA_LONG_SQL, EDA_META_SQL, final="SELECT * FROM eda_meta"))
def q_eda_metadata(spark, sf_dir):
    """Unpivoted EDA meta with dense ids."""
    return eda_meta(spark, sf_dir)


# whole minutes between the ends, and each participant-day's least
ME_MERGE_SQL = """
gaps AS (
  SELECT w.mirage_pid, date_trunc('day', w.start) AS date, w.start AS start_m, c.start_time AS start_e,
         w."end" AS end_m, c.end_time AS end_e, c.path AS file_esense, w.id AS row_mirage,
         abs(epoch_us(c.end_time) // 60000000 - epoch_us(w."end") // 60000000) AS diff_end
  FROM eda_meta c JOIN windows w
    ON w.mirage_pid = c.mirage_pid AND CAST(w.start AS DATE) = CAST(c.start_time AS DATE)),
nearest AS (SELECT mirage_pid, date, min(diff_end) AS min_diff_end FROM gaps GROUP BY 1, 2),
me_merge_distinct AS (
  SELECT DISTINCT gaps.*, min_diff_end FROM gaps JOIN nearest USING (mirage_pid, date)
  WHERE diff_end = min_diff_end)"""


def me_merge_distinct(spark, sf_dir):
    """Marker windows vs EDA candidates at the day's smallest end gap."""
    return stage(spark, sf_dir, "me_merge", lambda: C.nearest_marker_ends(windows(spark, sf_dir), eda_meta(spark, sf_dir)))


@query("nearest_end_match", with_ctes(*marker_windows_ctes(), B.EDA_WIDE_SQL, EDA_LONG_SQL,
                                      EDA_META_SQL, ME_MERGE_SQL, final="SELECT * FROM me_merge_distinct"))
def q_nearest_end_match(spark, sf_dir):
    """Nearest-end EDA candidates per marker day, ties kept, zones collapsed."""
    return me_merge_distinct(spark, sf_dir)
