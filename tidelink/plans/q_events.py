"""Queries over the marker-event operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelink.operators import events as E
from tidelink.operators.reshape import dense_ids
from tidelink.operators.stats import mad
from tidelink.plans import bindings as B
from tidelink.plans.registry import query, stage
from tidelink.plans.sqlparts import (MARKER_EVENTS_SQL, PAIRS_SQL, PREPARED_SQL, SESSIONS_SQL,
                                     marker_windows_ctes, with_ctes)
from tidelink.sources.tables import table

# Binding parameters: the event log spans January 2024, so the excluded
# period and the long-window cut-off are chosen inside it.
JAN_EXCLUDE = (B.MARKER_ROOT, "2024-01-10", "2024-01-12")
LONG_WINDOW_SECONDS = 86400


def windows(spark, sf_dir):
    """Marker windows, materialised once per plan (read by many branches)."""
    return stage(spark, sf_dir, "windows", lambda: E.marker_windows(B.marker_events(spark, sf_dir)))


@query("pair_start_stop", with_ctes(MARKER_EVENTS_SQL, PREPARED_SQL, PAIRS_SQL,
                                    final="SELECT * FROM raw_windows"))
def q_pair_start_stop(spark, sf_dir):
    """Every closed start/stop pair, before any filter."""
    ev = E.prepare_marker_events(B.marker_events(spark, sf_dir))
    return E.windows_from_events(ev)


@query("marker_windows", with_ctes(*marker_windows_ctes(), final="SELECT * FROM windows"))
def q_marker_windows(spark, sf_dir):
    """L1: prepared events -> pairs -> >= 30 s -> dedup -> ids -> exclusion."""
    return windows(spark, sf_dir)


@query("min_duration", with_ctes(*marker_windows_ctes(LONG_WINDOW_SECONDS),
                                 final="SELECT * FROM windows"))
def q_min_duration(spark, sf_dir):
    """P3b with a one-day cut-off (all windows in the data exceed 30 s)."""
    return E.marker_windows(B.marker_events(spark, sf_dir), min_seconds=LONG_WINDOW_SECONDS)


@query("exclude_baseline_period", with_ctes(*marker_windows_ctes(exclude=JAN_EXCLUDE),
                                            final="SELECT * FROM windows"))
def q_exclude_baseline_period(spark, sf_dir):
    """Drop windows of one event starting inside a closed date range."""
    return E.marker_windows(B.marker_events(spark, sf_dir), exclude=JAN_EXCLUDE)


@query("orphan_stops", with_ctes(MARKER_EVENTS_SQL, PREPARED_SQL, PAIRS_SQL.split("lv AS")[0].rstrip().rstrip(","),
                                 final="SELECT mirage_pid, root, id, t AS timecode_utc FROM run3 "
                                       "WHERE kind = 'stop' AND m < pm"))
def q_orphan_stops(spark, sf_dir):
    """dq_orphan_stop: stops that find no open start (quarantined, not fatal)."""
    ev = E.split_marker(E.prepare_marker_events(B.marker_events(spark, sf_dir)))
    return (E.orphan_stops(ev, ["mirage_pid"], "root", "kind", "timecode_utc", ["id"])
             .select("mirage_pid", "root", "id", "timecode_utc"))


OPEN_SECONDS = 2 * 86400  # how long a start stays open in the two keys below
# a stop closes the latest start from which the starts and stops up to it balance
BALANCED_SQL = f"""
counted AS (
  SELECT *, row_number() OVER w AS place, sum(CASE kind WHEN 'start' THEN 1 ELSE -1 END) OVER w AS height
  FROM mk WINDOW w AS (PARTITION BY mirage_pid, root ORDER BY t, id)),
opened AS (SELECT mirage_pid, root, height, place, t AS t0 FROM counted WHERE kind = 'start'),
closed AS (SELECT mirage_pid, root, id, height + 1 AS height, place, t FROM counted WHERE kind = 'stop'),
matched AS (
  SELECT closed.*, t0, t - t0 <= {OPEN_SECONDS * 1000} AS open
  FROM closed ASOF LEFT JOIN opened USING (mirage_pid, root, height, place))"""
MARKS_SQL = PAIRS_SQL.split("run AS")[0].rstrip().rstrip(",")


@query("pair_max_length", with_ctes(MARKER_EVENTS_SQL, PREPARED_SQL, MARKS_SQL, BALANCED_SQL, final="""
SELECT mirage_pid, root AS event, epoch_ms(t0) AS start, epoch_ms(t) AS "end", (t - t0) / 1000.0 AS length
FROM matched WHERE open"""))
def q_pair_max_length(spark, sf_dir):
    """W9 with an expiry (D10): a start stays open for two days at most."""
    return E.windows_from_events(E.prepare_marker_events(B.marker_events(spark, sf_dir)), max_seconds=OPEN_SECONDS)


@query("expired_stops", with_ctes(MARKER_EVENTS_SQL, PREPARED_SQL, MARKS_SQL, BALANCED_SQL, final="""
SELECT mirage_pid, root, id, CASE WHEN t0 IS NULL THEN 'stop without open start' ELSE 'open start has expired' END AS reason
FROM matched WHERE open IS NOT TRUE"""))
def q_expired_stops(spark, sf_dir):
    """dq_orphan_stop with an expiry: stops that find no start, or only expired ones."""
    ev = E.split_marker(E.prepare_marker_events(B.marker_events(spark, sf_dir)))
    found = E.orphan_stops(ev, ["mirage_pid"], "root", "kind", "timecode_utc", ["id"], OPEN_SECONDS * 1000)
    return found.select("mirage_pid", "root", "id", "reason")


@query("marker_sessions", with_ctes(*marker_windows_ctes(), SESSIONS_SQL,
                                    final="SELECT * FROM sessions"))
def q_marker_sessions(spark, sf_dir):
    """L2: session root per participant-day and valid flags (no pair table)."""
    return E.session_roots(windows(spark, sf_dir))


@query("mad", r"""
SELECT user_id, CAST(ts AS DATE) AS day, mad(value) AS mad_value
FROM events GROUP BY 1, 2""")
def q_mad(spark, sf_dir):
    """A2: median absolute deviation of event values per user-day."""
    ev = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"), "value")
    return mad(ev, ["user_id", "day"], "value", "mad_value")


@query("session_keys", with_ctes(*marker_windows_ctes(), r"""
m AS (SELECT *, date_trunc('day', start) AS date FROM windows)""",
                                 final="""SELECT mirage_pid, date,
  CAST(row_number() OVER (ORDER BY mirage_pid, date) AS INTEGER) AS id_session
FROM (SELECT DISTINCT mirage_pid, date FROM m)"""))
def q_session_keys(spark, sf_dir):
    """Distinct (participant, day) with dense ids in key order."""
    keys = windows(spark, sf_dir).select("mirage_pid", F.date_trunc("day", "start").alias("date")).distinct()
    return dense_ids(keys, ["date"], bucket=["mirage_pid", "date"], id_col="id_session")


@query("attach_session_id", with_ctes(*marker_windows_ctes(), r"""
m AS (SELECT *, date_trunc('day', start) AS date FROM windows),
sk AS (SELECT mirage_pid, date, CAST(row_number() OVER (ORDER BY mirage_pid, date) AS INTEGER) AS id_session
       FROM (SELECT DISTINCT mirage_pid, date FROM m))""",
                                    final="SELECT m.id, sk.id_session FROM m LEFT JOIN sk USING (mirage_pid, date)"))
def q_attach_session_id(spark, sf_dir):
    """Every window gets the id of its (participant, day) session."""
    w = windows(spark, sf_dir).withColumn("date", F.date_trunc("day", "start"))
    keys = dense_ids(w.select("mirage_pid", "date").distinct(), ["date"], bucket=["mirage_pid", "date"],
                     id_col="id_session")
    return w.join(keys, ["mirage_pid", "date"], "left").select("id", "id_session")
