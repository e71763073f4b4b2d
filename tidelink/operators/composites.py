"""Whole linkage steps as functions of DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.functions.timefn import add_seconds, day_of, offset_seconds
from tidelink.operators import linkage as L
from tidelink.operators import quality as Q
from tidelink.operators.reshape import dense_ids, unpivot_non_null
from tidelink.session import materialize

ZONE_PREFIX = "start_time_"
EDA_FACTS = ("path", "device", "mirage_pid", "rescat", "length_secs")


def zone_candidates(wide: DataFrame) -> DataFrame:
    """EDA files with one start column for each candidate zone
    (``start_time_<zone>``) -> one row for each zone, end = start + length."""
    zones = [c for c in wide.columns if c.startswith(ZONE_PREFIX)]
    long = unpivot_non_null(wide, list(EDA_FACTS), zones, "tz", "start_time")
    return (long.withColumn("tz", F.replace(F.col("tz"), F.lit(ZONE_PREFIX), F.lit("")))
                .withColumn("end_time", add_seconds(F.col("start_time"), F.col("length_secs"))))


def eda_metadata(wide: DataFrame) -> DataFrame:
    """Zone candidates without repeats, numbered by (participant, start)."""
    return dense_ids(zone_candidates(wide).distinct(), ["start_time", "tz", "path"], bucket=["mirage_pid"])


def eda_marker_matches(esense: DataFrame, mirage: DataFrame, minutes: int = 10) -> DataFrame:
    """L3: EDA intervals (mirage_pid, date, row_esense, start_time, end_time)
    and marker windows (mirage_pid, date, row_mirage, start, end) of one
    participant-day whose starts and ends both differ by ``minutes`` or less."""
    pairs = L.tolerance_match(esense, mirage, ["mirage_pid", "date"], minutes, ("start_time", "end_time"), ("start", "end"))
    return pairs.select("mirage_pid", F.col("start_time").alias("start_esense"), F.col("end_time").alias("end_esense"),
                        F.col("start").alias("start_mirage"), F.col("end").alias("end_mirage"), "date", "row_esense",
                        "row_mirage", "diff_start", "diff_end").distinct()


def edge_samples(links: DataFrame, samples: DataFrame, index: DataFrame,
                 bucket_seconds: int = L.BUCKET_SECONDS) -> DataFrame:
    """J6 + P8d: the sample times and offsets at both edges of each link.

    ``index`` is the samples' time index; offsets are taken from each
    recording's first time in it, after the lookup.
    """
    out = L.asof_edges(links, samples, "id_recording", "start", "end", "t", [], ["id_recording", "id_mirage"],
                       bucket_seconds, index)
    first = L.index_limits(index, "id_recording").select("id_recording", "t_min")
    return out.join(first, "id_recording").select(
        "id_recording", "id_mirage", "time_start", "time_end",
        offset_seconds(F.col("time_start"), F.col("t_min")).alias("offset_start"),
        offset_seconds(F.col("time_end"), F.col("t_min")).alias("offset_end"))


def link_recordings(samples: DataFrame, recordings: DataFrame, session_windows: DataFrame, markers: DataFrame,
                    bucket_seconds: int = L.BUCKET_SECONDS, index: DataFrame | None = None) -> DataFrame:
    """L4: marker windows linked to the recordings that hold them, by the
    participants of the recording's session (J5), with the samples at both
    window edges (J6).

    ``samples`` (id_recording, t), the other tables as in
    :func:`tidelink.operators.linkage.resolve_links`. With the lake's time
    ``index`` the samples are read once, for the edges that fall inside an
    occupied minute; without it, once more to make the index.
    """
    if index is None:
        index = materialize(L.occupancy(samples, bucket_seconds=bucket_seconds))
    links = L.resolve_links(L.index_limits(index, "id_recording"), recordings, session_windows, markers)
    return edge_samples(links, samples, index, bucket_seconds)


def nearest_marker_ends(markers: DataFrame, eda: DataFrame) -> DataFrame:
    """Marker windows and EDA candidates of a participant-day at the
    day's smallest difference of ends, in whole minutes; ties are kept."""
    m = markers.select("mirage_pid", day_of("start").alias("date"), F.col("start").alias("start_m"),
                       F.col("end").alias("end_m"), F.col("id").alias("row_mirage"))
    e = eda.select("mirage_pid", day_of("start_time").alias("date"), F.col("start_time").alias("start_e"),
                   F.col("end_time").alias("end_e"), F.col("path").alias("file_esense"))
    j = L.nearest_match(m, e, ["mirage_pid", "date"], "end_m", "end_e")
    return j.select("mirage_pid", "date", "start_m", "start_e", "end_m", "end_e", "file_esense", "row_mirage",
                    F.col("diff").alias("diff_end"), F.col("diff").alias("min_diff_end")).distinct()


def session_flags(sessions: DataFrame, matches: DataFrame, links: DataFrame) -> DataFrame:
    """Each session event with ``linked_esense`` (a valid event of the
    session has an EDA match) and ``linked_bg`` (an event has an ECG link)."""
    eda = sessions.where("valid_event").join(matches.select(F.col("row_mirage").alias("id_event")), "id_event", "left_semi")
    ecg = sessions.join(links.select(F.col("id_mirage").alias("id_event")), "id_event", "left_semi")
    return Q.flag_membership(sessions, "id_session", linked_esense=eda.select("id_session"),
                             linked_bg=ecg.select("id_session"))


def linkage_report(sessions: DataFrame, eda: DataFrame, matches: DataFrame, links: DataFrame) -> dict[str, DataFrame]:
    """``recovery`` (A7, by rows), ``recovery_files`` (A7, by files),
    ``flags`` (J9) and ``contingency`` (A8). The flags are written once."""
    flags = materialize(session_flags(sessions, matches, links))
    return {"recovery": Q.recovery_rate(eda, matches), "recovery_files": Q.recovery_rate(eda, matches, per_file=True),
            "flags": flags, "contingency": Q.contingency(flags, "id_session", "linked_esense", "linked_bg")}
