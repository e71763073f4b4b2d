"""Marker events: start/stop pairing (W9), windows (L1), session roots (L2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelink.operators.reshape import dense_ids
from tidelink.operators.scan import previous_in_level, running_sum_min
from tidelink.operators.stats import leave_one_out_mad
from tidelink.session import materialize

# Fixed values that must equal the reference's.
MARKER_SUFFIX = "_(start|stop)$"          # marker names end in _start / _stop
VALID_PARTICIPANT = r"\d{5,6}$"           # participant ids end in 5-6 digits
PARTICIPANT_PREFIX = "PID"                # stripped from participant ids
MIN_WINDOW_SECONDS = 30                   # shortest window kept
SESSION_VALID_SECONDS = 3600              # events within an hour of the root
BASELINE_EVENT = "baseline"               # excluded between the two dates below
BASELINE_FROM = "2023-03-12"
BASELINE_TO = "2023-06-11"


class OrphanStopError(ValueError):
    """Raised in strict mode when a stop has no open start."""


def _order(time: str, tiebreak: Sequence[str]) -> list[Column]:
    return [F.col(time)] + [F.col(c) for c in tiebreak]


def _stack_levels(df: DataFrame, by: Sequence[str], root: str, kind: str, time: str,
                  tiebreak: Sequence[str]) -> DataFrame:
    """Annotate events with stack depth; flags stops that find an empty stack.

    ``_s`` is the running sum of +1 (start) / -1 (stop); ``_m`` the running
    minimum of ``least(0, _s)``. Depth after an event is ``_s - _m``; a stop
    is an orphan exactly when ``_m`` falls on it. The scan is skew-safe: a
    participant with most of the events is split over range parts.
    """
    keys = list(by) + [root]
    is_start = F.col(kind) == "start"
    d = df.withColumn("_delta", F.when(is_start, 1).otherwise(-1))
    r = running_sum_min(d, keys, _order(time, tiebreak), "_delta")
    return (r.withColumn("_orphan", ~is_start & (F.col("_m") < F.col("_m_prev")))
             .withColumn("_level", F.col("_s") - F.col("_m") + F.when(is_start, 0).otherwise(1)))


def pair_start_stop(df: DataFrame, by: Sequence[str], root: str, kind: str, time: str,
                    tiebreak: Sequence[str] = (), strict: bool = False,
                    start_col: str = "start_t", end_col: str = "end_t",
                    max_length: int | None = None) -> DataFrame:
    """LIFO pairing of start/stop events per (by, root), without a UDF.

    ``kind`` holds 'start' or 'stop'. Each stop closes the most recent open
    start of its root; unclosed starts are ignored; orphan stops are dropped
    (``strict=True`` raises instead, like the reference). At a given stack
    level starts and stops alternate, so a stop's partner is the previous
    event of its level (carried across range parts for hot participants).

    With ``max_length`` (in units of ``time``) an open start expires when it
    gets older than that; a stop that finds only expired starts is an orphan.
    Starts expire from the bottom of the stack, so a stop's partner is the
    same start with and without expiry unless that one has expired, and then
    all below it have: the pairing is the plain one without its long pairs,
    and range parts need not pass on their stacks.
    """
    keys = list(by) + [root]
    lv = _stack_levels(df, by, root, kind, time, tiebreak)
    paired = _paired_stops(lv, keys, kind, time, tiebreak)
    expired = F.lit(False) if max_length is None else F.col(time) - F.col("_prev") > max_length
    if strict:
        lost = lv.where("_orphan").select(*keys, time)
        if max_length is not None:
            lost = lost.unionByName(paired.where(expired).select(*keys, time))
        lost = materialize(lost)
        n_orphans = lost.count()
        if n_orphans:
            ex = [r.asDict() for r in lost.limit(5).collect()]
            raise OrphanStopError(f"{n_orphans} stop markers without an open start, e.g. {ex}")
    return paired.where(~expired).select(*keys, F.col("_prev").alias(start_col), F.col(time).alias(end_col))


def _paired_stops(levels: DataFrame, keys: Sequence[str], kind: str, time: str, tiebreak: Sequence[str]) -> DataFrame:
    """Stops that close a start, with its time as ``_prev``."""
    ok = levels.where(~F.col("_orphan"))
    return previous_in_level(ok, keys, "_level", _order(time, tiebreak), time, "_prev").where(F.col(kind) == "stop")


def orphan_stops(df: DataFrame, by: Sequence[str], root: str, kind: str, time: str,
                 tiebreak: Sequence[str] = (), max_length: int | None = None) -> DataFrame:
    """dq_orphan_stop: the stops the reference would abort on (quarantine);
    with ``max_length`` also those whose start has expired."""
    lv = _stack_levels(df, by, root, kind, time, tiebreak)
    found = lv.where("_orphan").select(*df.columns, F.lit("stop without open start").alias("reason"))
    if max_length is None:
        return found
    late = _paired_stops(lv, [*by, root], kind, time, tiebreak).where(F.col(time) - F.col("_prev") > max_length)
    return found.unionByName(late.select(*df.columns, F.lit("open start has expired").alias("reason")))


def split_marker(df: DataFrame, event: str = "event") -> DataFrame:
    """Marker name -> (root, kind); non start/stop markers are dropped."""
    return (df.withColumn("kind", F.regexp_extract(F.col(event), MARKER_SUFFIX, 1))
              .where(F.col("kind") != "")
              .withColumn("root", F.regexp_replace(F.col(event), MARKER_SUFFIX, "")))


def prepare_marker_events(raw: DataFrame, pid: str = "mirage_pid") -> DataFrame:
    """Dedup, keep participants ending in 5-6 digits, strip PID."""
    return (raw.distinct()
               .where(F.col(pid).rlike(VALID_PARTICIPANT))
               .withColumn(pid, F.regexp_replace(F.col(pid), PARTICIPANT_PREFIX, "")))


def windows_from_events(events: DataFrame, pid: str = "mirage_pid", event: str = "event",
                        time_ms: str = "timecode_utc", tiebreak: Sequence[str] = ("id",),
                        strict: bool = False, max_seconds: float | None = None) -> DataFrame:
    """W9 on marker events: (pid, event root, start, end, length seconds)."""
    ev = split_marker(events.select(pid, event, time_ms, *tiebreak), event)
    pairs = pair_start_stop(ev, [pid], "root", "kind", time_ms, tiebreak, strict,
                            "_start_ms", "_end_ms", None if max_seconds is None else int(max_seconds * 1000))
    return pairs.select(
        F.col(pid).alias("mirage_pid"), F.col("root").alias("event"),
        F.timestamp_millis("_start_ms").alias("start"),
        F.timestamp_millis("_end_ms").alias("end"),
        ((F.col("_end_ms") - F.col("_start_ms")) / F.lit(1000.0)).alias("length"))


def min_duration(windows: DataFrame, seconds: float = MIN_WINDOW_SECONDS,
                 length: str = "length") -> DataFrame:
    """Keep windows at least ``seconds`` long."""
    return windows.where(F.col(length) >= F.lit(seconds))


def exclude_period(windows: DataFrame, event_name: str = BASELINE_EVENT,
                   lo: str = BASELINE_FROM, hi: str = BASELINE_TO,
                   event: str = "event", start: str = "start") -> DataFrame:
    """Drop ``event_name`` windows starting in [lo, hi] (UTC midnights)."""
    s = F.col(start)
    bad = (F.col(event) == event_name) & (s >= F.to_timestamp(F.lit(lo))) & (s <= F.to_timestamp(F.lit(hi)))
    return windows.where(~bad)


def marker_windows(raw_events: DataFrame, min_seconds: float = MIN_WINDOW_SECONDS,
                   exclude: tuple[str, str, str] | None = (BASELINE_EVENT, BASELINE_FROM, BASELINE_TO),
                   strict: bool = False, max_seconds: float | None = None) -> DataFrame:
    """L1: raw marker rows -> numbered windows (mirage_pid, event, start, end, length, id).

    Ids follow (mirage_pid, start, end, event) and are assigned before the
    exclusion, so excluded windows leave gaps, as in the reference. A start
    stays open for ever, as there, unless ``max_seconds`` is given.
    """
    ev = prepare_marker_events(raw_events)
    win = min_duration(windows_from_events(ev, strict=strict, max_seconds=max_seconds), min_seconds).distinct()
    # stage boundary: numbering reads the table twice (bucket sizes, rows)
    win = materialize(win.withColumn("_day", F.date_trunc("day", "start")))
    win = dense_ids(win, ["start", "end", "event"], bucket=["mirage_pid", "_day"]).drop("_day")
    if exclude:
        win = exclude_period(win, *exclude)
    return win.select("mirage_pid", "event", "start", "end", "length", "id")


def session_roots(windows: DataFrame, pid: str = "mirage_pid", start: str = "start",
                  id_col: str = "id", valid_seconds: float = SESSION_VALID_SECONDS) -> DataFrame:
    """L2: per participant-day session, pick the root event and flag members.

    The reference pairs every two events of a participant-day and takes the
    median absolute deviation (MAD) of start differences per event. MAD is
    shift-invariant, so an event's value equals the MAD of the *other*
    events' starts: a leave-one-out MAD, computed from ranks without
    forming pairs. The root is the event with the smallest value (ties ->
    lowest id); every event of the session is flagged valid when it starts
    within ``valid_seconds`` of the root. Integer milliseconds keep ties exact.
    """
    base = (windows.select(F.col(pid).alias("mirage_pid"), F.col(id_col).alias("id_event"),
                           F.date_trunc("day", F.col(start)).alias("date"),
                           F.unix_millis(F.col(start)).alias("_x")))
    sessions = dense_ids(base.select("mirage_pid", "date").distinct(), ["date"],
                         bucket=["mirage_pid", "date"], id_col="id_session")
    loo = leave_one_out_mad(base, ["mirage_pid", "date"], "id_event", "_x", "_mad")
    gmin = loo.groupBy("mirage_pid", "date").agg(F.min("_mad").alias("_min"))   # partial agg, skew-safe
    best = (loo.join(gmin, ["mirage_pid", "date"])
               .where((F.col("_mad") == F.col("_min")) | F.col("_min").isNull())
               .groupBy("mirage_pid", "date")
               .agg(F.min("id_event").alias("_root")))
    roots = (best.join(base.select("mirage_pid", "date", F.col("id_event").alias("_root"),
                                   F.col("_x").alias("_x_root")), ["mirage_pid", "date", "_root"]))
    diff_ms = F.col("_x") - F.col("_x_root")
    valid = F.when(F.col("id_event") == F.col("_root"), F.lit(True)).otherwise(
        F.abs(diff_ms) < F.lit(valid_seconds * 1000))
    return (base.join(roots, ["mirage_pid", "date"])
                .join(sessions, ["mirage_pid", "date"])
                .select("id_session", "mirage_pid", "date", "id_event", valid.alias("valid_event")))
