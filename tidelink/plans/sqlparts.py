"""Shared CTE fragments for the DuckDB oracles (one statement per query)."""

from __future__ import annotations

from tidelink.plans.bindings import MARKER_EVENTS_SQL


def with_ctes(*ctes: str, final: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + final.strip()


PREPARED_SQL = r"""
prepared AS (
  SELECT id, regexp_replace(mirage_pid, 'PID', '', 'g') AS mirage_pid, lang, event, timecode_utc
  FROM (SELECT DISTINCT * FROM marker_events)
  WHERE regexp_matches(mirage_pid, '\d{5,6}$'))"""

# start/stop pairing with an explicit stack depth per (participant, root)
PAIRS_SQL = r"""
mk AS (
  SELECT mirage_pid, id, timecode_utc AS t,
         regexp_extract(event, '_(start|stop)$', 1) AS kind,
         regexp_replace(event, '_(start|stop)$', '') AS root
  FROM prepared WHERE regexp_matches(event, '_(start|stop)$')),
run AS (
  SELECT *, sum(CASE WHEN kind = 'start' THEN 1 ELSE -1 END) OVER (
      PARTITION BY mirage_pid, root ORDER BY t, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s
  FROM mk),
run2 AS (
  SELECT *, min(least(0, s)) OVER (
      PARTITION BY mirage_pid, root ORDER BY t, id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS m
  FROM run),
run3 AS (
  SELECT *, coalesce(lag(m) OVER (PARTITION BY mirage_pid, root ORDER BY t, id), 0) AS pm
  FROM run2),
lv AS (
  SELECT *, s - m + CASE WHEN kind = 'start' THEN 0 ELSE 1 END AS lvl
  FROM run3 WHERE NOT (kind = 'stop' AND m < pm)),
pr AS (
  SELECT mirage_pid, root, kind, t,
         lag(t) OVER (PARTITION BY mirage_pid, root, lvl ORDER BY t, id) AS t0
  FROM lv),
raw_windows AS (
  SELECT mirage_pid, root AS event, epoch_ms(t0) AS start, epoch_ms(t) AS "end",
         (t - t0) / 1000.0 AS length
  FROM pr WHERE kind = 'stop')"""


def windows_sql(min_seconds: float = 30, exclude: tuple[str, str, str] | None = None) -> str:
    excl = ""
    if exclude:
        ev, lo, hi = exclude
        excl = (f" WHERE NOT (event = '{ev}' AND start >= TIMESTAMP '{lo}' "
                f"AND start <= TIMESTAMP '{hi}')")
    return f"""
windows_all AS (
  SELECT *, CAST(row_number() OVER (ORDER BY mirage_pid, start, "end", event) AS INTEGER) AS id
  FROM (SELECT DISTINCT * FROM raw_windows WHERE length >= {min_seconds})),
windows AS (SELECT mirage_pid, event, start, "end", length, id FROM windows_all{excl})"""


def marker_windows_ctes(min_seconds: float = 30, exclude=None) -> list[str]:
    return [MARKER_EVENTS_SQL, PREPARED_SQL, PAIRS_SQL, windows_sql(min_seconds, exclude)]


# An event's spread is the median absolute deviation of the day's *other*
# starts; the session's root has the least, and then the least id.
SESSIONS_SQL = r"""
days AS (
  SELECT mirage_pid, date_trunc('day', start) AS date,
         list(struct_pack(id := id, ms := epoch_ms(start))) AS evs
  FROM windows GROUP BY 1, 2),
spreads AS (
  SELECT mirage_pid, date, unnest(list_transform(evs, lambda e: struct_pack(
           id := e.id, ms := e.ms,
           spread := list_aggregate(list_transform(list_filter(evs, lambda o: o.id <> e.id),
                                                   lambda o: CAST(o.ms AS DOUBLE)), 'mad')))) AS e
  FROM days),
roots AS (
  SELECT mirage_pid, date, arg_min(e.id, (coalesce(e.spread, 0), e.id)) AS root_id,
         arg_min(e.ms, (coalesce(e.spread, 0), e.id)) AS root_ms
  FROM spreads GROUP BY 1, 2),
sessions AS (
  SELECT CAST(dense_rank() OVER (ORDER BY s.mirage_pid, s.date) AS INTEGER) AS id_session, s.mirage_pid, s.date,
         s.e.id AS id_event, s.e.id = r.root_id OR abs(s.e.ms - r.root_ms) < 3600000 AS valid_event
  FROM spreads s JOIN roots r ON r.mirage_pid = s.mirage_pid AND r.date = s.date)"""
