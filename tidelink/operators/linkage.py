"""Linkage joins: limits, offsets, containment, as-of, tolerance, nearest.

Design rules (100 TB scale):
* samples are the only huge input; they are never put into time order.
  Limits and as-of lookups are answered from a time index of one row per
  occupied minute; samples are opened only for edges inside a minute.
* range conditions always ride on an equi key plus a time bucket, so no
  join ever degenerates into a cartesian product or all pairs of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelink.functions.timefn import minute_boundary_diff, minute_index, offset_seconds
from tidelink.operators.scan import surrounding
from tidelink.session import materialize

# Clocks before this are wrong (the lake rejects such recordings too).
EARLIEST = "2000-01-01"
BUCKET_SECONDS = 60  # of the time index


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def recording_limits(samples: DataFrame, key: str = "id_recording", t: str = "t") -> DataFrame:
    """A1: first and last sample time per recording (partial agg, one shuffle of tiny rows)."""
    return samples.groupBy(key).agg(F.min(t).alias("t_min"), F.max(t).alias("t_max"))


def offset_from_start(samples: DataFrame, key: str = "id_recording", t: str = "t",
                      out: str = "offset_secs") -> DataFrame:
    """Seconds since the recording's first sample, at ms resolution.

    Aggregate + join back instead of a window: the samples are not sorted
    or gathered per recording; the per-recording minimum table is small
    (one row per recording) and AQE broadcasts it at runtime.
    """
    first = samples.groupBy(key).agg(F.min(t).alias("_t0"))
    return samples.join(first, key).withColumn(out, offset_seconds(F.col(t), F.col("_t0"))).drop("_t0")


def contained_in(outer: DataFrame, inner: DataFrame, on: Sequence[str],
                 outer_range: tuple[str, str] = ("t_min", "t_max"),
                 inner_range: tuple[str, str] = ("start", "end")) -> DataFrame:
    """Pairs (outer, inner) with the inner interval inside the outer one.

    Equi keys first, then a day bucket: each outer interval is listed once
    per calendar day it covers, each inner row under the day it starts, and
    the range test is a residual. A hot key is split across its days and no
    pair is formed twice (an inner row has exactly one start day).
    """
    on = _cols(on)
    o0, o1 = outer_range
    i0, i1 = inner_range
    # a clock error at one end must not list decades of days
    o = outer.where(F.col(o0) >= F.lit(EARLIEST).cast("timestamp")).withColumn("_day", F.explode(F.sequence(F.to_date(o0), F.to_date(o1))))
    i = inner.withColumn("_day", F.to_date(i0))
    return (o.join(i, on + ["_day"])
             .where((F.col(i0) >= F.col(o0)) & (F.col(i1) <= F.col(o1)))
             .drop("_day"))


def resolve_links(limits: DataFrame, recordings: DataFrame, session_windows: DataFrame,
                  markers: DataFrame) -> DataFrame:
    """(id_recording, id_mirage, id_participant, start, end) of the marker
    windows inside a recording whose participant is named by one of the
    windows of the recording's session.

    ``limits`` (id_recording, t_min, t_max), ``recordings`` (id, id_session),
    ``session_windows`` (id_session, participant), ``markers`` (id, mirage_pid,
    start, end). A participant named by several windows of a session counts
    once, so no link is repeated. Null ids and participants link with nothing.
    """
    named = session_windows.select("id_session", "participant").distinct()
    may = recordings.select(F.col("id").alias("id_recording"), "id_session").distinct().join(named, "id_session")
    outer = limits.select("id_recording", "t_min", "t_max").join(may.select("id_recording", "participant").distinct(),
                                                                 "id_recording")
    inner = markers.select(F.col("mirage_pid").alias("participant"), F.col("id").alias("id_mirage"), "start", "end")
    return contained_in(outer, inner, ["participant"]).select(
        "id_recording", "id_mirage", F.col("participant").alias("id_participant"), "start", "end")


def occupancy(samples: DataFrame, key: str = "id_recording", t: str = "t", bucket_seconds: int = BUCKET_SECONDS,
              constants: Sequence[str] = ()) -> DataFrame:
    """The time index of a sample table: one row per (key, time bucket) that
    holds samples, with its first and last time.

    Thousands of samples fall into a bucket, and it takes one scan with a
    partial aggregation to make; the lake keeps it beside the samples.
    ``constants`` are columns that every sample of a key has alike.
    """
    rows = samples.where(F.col(t).isNotNull())
    return rows.groupBy(key, bucket_of(F.col(t), bucket_seconds).alias("bucket")).agg(
        F.min(t).alias("first_t"), F.max(t).alias("last_t"), F.count(F.lit(1)).alias("n_samples"),
        *[F.max(c).alias(c) for c in constants])


def bucket_of(t: Column, bucket_seconds: int = BUCKET_SECONDS) -> Column:
    return F.floor(F.unix_micros(t) / int(bucket_seconds * 1_000_000))


def index_limits(index: DataFrame, *by: str) -> DataFrame:
    """A1 from the time index: the samples themselves are not read."""
    return index.groupBy(*by).agg(F.min("first_t").alias("t_min"), F.max("last_t").alias("t_max"))


def _edge_records(edges: DataFrame, samples: DataFrame, key: str, t: str, payload: Sequence[str],
                  edge_id: Sequence[str], bucket_seconds: int, index: DataFrame | None) -> DataFrame:
    """As-of for ``edges`` (edge_id, key, _at, _back): the sample nearest to
    ``_at``, at or before it (``_back``) or at or after it, as struct ``_r``.

    The first and last times of the occupied buckets and the edges are put
    into one order, in one pass. If the point beside a backward edge is the
    last time of a bucket, that is the answer; if it is a first time, the edge
    stands inside that bucket, and only then (or for a payload) are the
    samples opened, joined on (key, bucket). Forward edges mirror this. A hot
    key is spread over its buckets.
    """
    if index is None:
        index = materialize(occupancy(samples, key, t, bucket_seconds))
    # at equal times: forward edges, first times, last times, backward edges,
    # so that every edge meets the point that answers it
    ends = F.explode(F.array(
        F.struct(F.col("first_t").alias("t"), "bucket", F.lit(True).alias("first"), F.lit(1).alias("rank")),
        F.struct(F.col("last_t").alias("t"), "bucket", F.lit(False).alias("first"), F.lit(2).alias("rank")))).alias("_point")
    points = index.where(F.col(key).isNotNull()).select(key, ends).select(
        key, "_point", F.col("_point.t").alias("_at"), F.col("_point.rank").alias("_rank"))
    asked = edges.where(F.col("_at").isNotNull() & F.col(key).isNotNull()).withColumn(
        "_rank", F.when(F.col("_back"), 3).otherwise(0))
    merged = points.unionByName(asked, allowMissingColumns=True)
    scanned = surrounding(merged, [key], [F.col("_at"), F.col("_rank")], F.col("_point"), "_left", "_right")
    hit = scanned.where(F.col("_point").isNull()).withColumn("_hit", F.when(F.col("_back"), F.col("_left")).otherwise(F.col("_right")))
    hit = materialize(hit.where(F.col("_hit").isNotNull()).select(*dict.fromkeys([*edge_id, key]), "_at", "_back", "_hit"))

    rows = samples.select(F.col(key).alias("_key"), F.col(t).alias("_t"), *payload, bucket_of(F.col(t), bucket_seconds).alias("_bk"))
    record = F.struct("_t", *[F.col(p).alias(f"_p{k}") for k, p in enumerate(payload)])
    settled = F.col("_hit.first") != F.col("_back")
    open_ = hit if payload else hit.where(~settled)
    requests = open_.select(*[F.col(c).alias(f"_e{k}") for k, c in enumerate(edge_id)], F.col(key).alias("_key"), "_at",
                            "_back", F.col("_hit.bucket").alias("_bk"))
    near = requests.join(rows, ["_key", "_bk"]).where(F.when(F.col("_back"), F.col("_t") <= F.col("_at")).otherwise(F.col("_t") >= F.col("_at")))
    ids = [f"_e{k}" for k in range(len(edge_id))]
    best = near.groupBy(*ids, "_back").agg(F.max(F.when(F.col("_back"), record)).alias("_b"),
                                           F.min(F.when(~F.col("_back"), record)).alias("_f"))
    found = best.select(*ids, "_back", F.coalesce("_b", "_f").alias("_r"))
    if not payload:
        found = found.unionByName(hit.where(settled).select(
            *[F.col(c).alias(e) for c, e in zip(edge_id, ids)], "_back", F.struct(F.col("_hit.t").alias("_t")).alias("_r")).distinct())
    return found.select(*[F.col(e).alias(c) for c, e in zip(edge_id, ids)], "_back", "_r")


def asof_edges(lookups: DataFrame, samples: DataFrame, key: str, start: str, end: str,
               t: str, payload: Sequence[str], pair: Sequence[str], bucket_seconds: int = BUCKET_SECONDS,
               index: DataFrame | None = None) -> DataFrame:
    """J6a+J6b+U1+P8d: for each lookup window, the last sample at or before
    its start and the first sample at or after its end (same key).

    Returns ``pair`` + ``time_start, time_end`` + ``<payload>_start/_end``.
    Both edges are answered in one pass. With the samples' time ``index`` (of
    the same bucket width) they are read once, and not at all for edges that
    fall outside every bucket; without it, they are read once more to make it.
    """
    pair, payload = _cols(pair), _cols(payload)
    both = F.explode(F.array(F.struct(F.lit(True).alias("back"), F.col(start).alias("at")),
                             F.struct(F.lit(False).alias("back"), F.col(end).alias("at"))))
    edges = lookups.select(*dict.fromkeys([*pair, key]), both.alias("_e")).select(
        *dict.fromkeys([*pair, key]), F.col("_e.at").alias("_at"), F.col("_e.back").alias("_back"))
    found = _edge_records(edges, samples, key, t, payload, pair, bucket_seconds, index)
    side = found.groupBy(*pair).agg(F.max(F.when(F.col("_back"), F.col("_r"))).alias("_b"),
                                    F.max(F.when(~F.col("_back"), F.col("_r"))).alias("_f"))
    return side.select(*pair, F.col("_b._t").alias("time_start"), F.col("_f._t").alias("time_end"),
                       *[F.col(f"_b._p{k}").alias(f"{p}_start") for k, p in enumerate(payload)],
                       *[F.col(f"_f._p{k}").alias(f"{p}_end") for k, p in enumerate(payload)])


def asof(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str,
         direction: str, payload: Sequence[str], left_id: Sequence[str],
         bucket_seconds: int = BUCKET_SECONDS, index: DataFrame | None = None) -> DataFrame:
    """Exact inner as-of join.

    ``backward``: the right row with the greatest ``right_time <= left_time``;
    ``forward``: the least ``right_time >= left_time``; same ``key``.
    Returns ``left_id`` + ``right_time`` + ``payload``.
    """
    payload, left_id = _cols(payload), _cols(left_id)
    edges = left.select(*dict.fromkeys([*left_id, key]), F.col(left_time).alias("_at"),
                        F.lit(direction == "backward").alias("_back"))
    found = _edge_records(edges, right, key, right_time, payload, left_id, bucket_seconds, index)
    return found.select(*left_id, F.col("_r._t").alias(right_time),
                        *[F.col(f"_r._p{k}").alias(p) for k, p in enumerate(payload)])


def tolerance_match(a: DataFrame, b: DataFrame, on: Sequence[str], minutes: int,
                    a_range: tuple[str, str], b_range: tuple[str, str]) -> DataFrame:
    """Pairs on ``on`` whose starts and ends are both within ``minutes``
    minute boundaries of each other (|diff| <= minutes), with the diffs.

    A band join: a-rows are keyed by minute bucket of width ``minutes``,
    b-rows are listed under their bucket and both neighbours, and the band
    is a residual; only pairs within two buckets are ever formed.
    """
    on = _cols(on)
    a0, a1 = a_range
    b0, b1 = b_range
    width = int(max(minutes, 1))
    ak = a.withColumn("_bk", F.floor(minute_index(a0) / width))
    bk = b.withColumn("_bk", F.explode(F.array(*[F.floor(minute_index(b0) / width) + d for d in (-1, 0, 1)])))
    j = ak.join(bk, on + ["_bk"]).drop("_bk")
    ds = minute_boundary_diff(F.col(b0), F.col(a0))
    de = minute_boundary_diff(F.col(b1), F.col(a1))
    return (j.withColumn("diff_start", ds).withColumn("diff_end", de)
             .where((F.col("diff_start") <= minutes) & (F.col("diff_end") <= minutes)))


def nearest_match(left: DataFrame, right: DataFrame, on: Sequence[str], left_t: str,
                  right_t: str) -> DataFrame:
    """J3+W4: per group ``on``, the (left, right) pairs whose minute-boundary
    distance equals the group's smallest distance; ties are all kept.

    The group minimum is found from each left row's nearest right rows (a
    running window over the merged minute sequence), so pairs are formed
    only at the winning distance: never all pairs of a group.
    Returns left columns + right columns + ``diff``.
    """
    on = _cols(on)
    lm = left.withColumn("_m", minute_index(left_t))
    rm = right.withColumn("_m", minute_index(right_t))
    u = (lm.select(*on, "_m", F.lit(1).alias("_side"))
           .unionByName(rm.select(*on, "_m", F.lit(0).alias("_side"))))
    rmin = F.when(F.col("_side") == 0, F.col("_m"))
    # nearest right minute at or before / at or after each left row (a
    # skew-safe running scan; right rows sort first within a minute)
    both = surrounding(u, on, [F.col("_m"), F.col("_side")], rmin, "_prev", "_next")
    dist = (both.withColumn("_d", F.least(F.col("_m") - F.col("_prev"), F.col("_next") - F.col("_m")))
                .where((F.col("_side") == 1) & F.col("_d").isNotNull()))
    gmin = dist.groupBy(*on).agg(F.min("_d").alias("_dmin"))
    # left rows at the group minimum, looked up at m - d and m + d
    lrows = lm.join(gmin, on).withColumn("_want", F.explode(F.array_distinct(
        F.array(F.col("_m") - F.col("_dmin"), F.col("_m") + F.col("_dmin")))))
    rr = rm.withColumnRenamed("_m", "_want")
    return (lrows.join(rr, on + ["_want"])
                 .withColumn("diff", F.col("_dmin"))
                 .drop("_m", "_want", "_dmin"))
