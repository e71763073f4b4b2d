"""Window-based start/stop pairing equals a plain stack simulation."""

import random

import pytest
from pyspark.sql import functions as F

from tidelink.operators.events import OrphanStopError, orphan_stops, pair_start_stop, session_roots


def stack_pairs(events):
    """Reference behaviour (lenient): LIFO stack per (pid, root)."""
    stacks, out = {}, []
    for pid, root, kind, t, i in sorted(events, key=lambda e: (e[0], e[1], e[3], e[4])):
        st = stacks.setdefault((pid, root), [])
        if kind == "start":
            st.append(t)
        elif st:
            out.append((pid, root, st.pop(), t))
    return sorted(out)


def random_events(rng, n_pid=6, n=60):
    ev, i = [], 0
    for pid in range(n_pid):
        t = 0
        for _ in range(rng.randint(0, n)):
            t += rng.choice([0, 1, 1, 2, 5])          # equal times happen
            ev.append((f"p{pid}", rng.choice(["a", "b"]), rng.choice(["start", "stop"]), t, i))
            i += 1
    return ev


@pytest.mark.parametrize("seed", range(8))
def test_pairing_matches_stack(spark, seed):
    rng = random.Random(seed)
    ev = random_events(rng)
    df = spark.createDataFrame(ev, "pid string, root string, kind string, t long, i long")
    got = sorted(tuple(r) for r in pair_start_stop(df, ["pid"], "root", "kind", "t", ["i"]).collect())
    assert got == stack_pairs(ev)


def test_strict_raises_on_orphan(spark):
    df = spark.createDataFrame([("p", "a", "stop", 1, 1)], "pid string, root string, kind string, t long, i long")
    with pytest.raises(OrphanStopError):
        pair_start_stop(df, ["pid"], "root", "kind", "t", ["i"], strict=True)


def test_nested_and_interleaved(spark):
    ev = [("p", "a", "start", 1, 1), ("p", "a", "start", 2, 2), ("p", "b", "start", 3, 3),
          ("p", "a", "stop", 4, 4), ("p", "b", "stop", 5, 5), ("p", "a", "stop", 6, 6),
          ("p", "a", "stop", 7, 7), ("p", "a", "start", 8, 8)]
    df = spark.createDataFrame(ev, "pid string, root string, kind string, t long, i long")
    got = sorted(tuple(r) for r in pair_start_stop(df, ["pid"], "root", "kind", "t", ["i"]).collect())
    assert got == [("p", "a", 1, 6), ("p", "a", 2, 4), ("p", "b", 3, 5)]


def _brute_roots(rows, valid_ms=3_600_000):
    import statistics
    groups = {}
    for pid, i, x in rows:
        groups.setdefault((pid, x // 86_400_000), []).append((i, x))
    out = {}
    for key, g in groups.items():
        def loo(i):
            others = [x for j, x in g if j != i]
            if not others:
                return None
            med = statistics.median(others)
            return statistics.median([abs(x - med) for x in others])
        vals = {i: loo(i) for i, _ in g}
        finite = [v for v in vals.values() if v is not None]
        best = min(finite) if finite else None
        root = min(i for i, v in vals.items() if v == best)
        xr = dict(g)[root]
        for i, x in g:
            out[i] = True if i == root else abs(x - xr) < valid_ms
    return out


@pytest.mark.parametrize("seed", range(4))
def test_session_roots_match_pairwise_definition(spark, seed):
    rng = random.Random(seed)
    rows, i = [], 0
    for pid in ("00001", "00002", "00003"):
        for _ in range(rng.randint(1, 12)):
            rows.append((pid, i, 1_704_067_200_000 + rng.randint(0, 2) * 86_400_000 + rng.randint(0, 7_200_000)))
            i += 1
    df = (spark.createDataFrame(rows, "mirage_pid string, id int, x long")
               .withColumn("start", F.timestamp_millis("x")))
    got = {r.id_event: r.valid_event for r in session_roots(df).collect()}
    assert got == _brute_roots(rows)


def many_parts(spark):
    """Range exchanges keep their 16 parts: none is coalesced."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    return was


def test_hot_participant_split_over_parts(spark):
    """One participant with all events: the scan is spread over range parts
    and must still equal the stack."""
    from tidelink.operators.scan import range_parts
    rng = random.Random(99)
    ev = random_events(rng, n_pid=1, n=600)
    df = spark.createDataFrame(ev, "pid string, root string, kind string, t long, i long")
    was = many_parts(spark)
    try:
        assert range_parts(df, ["pid", "root"], ["t", "i"]).select("_part").distinct().count() > 4
        got = sorted(tuple(r) for r in pair_start_stop(df, ["pid"], "root", "kind", "t", ["i"]).collect())
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert got == stack_pairs(ev)


@pytest.mark.parametrize("split", [True, False])
def test_dense_ids_global_order(spark, split):
    from tidelink.operators.reshape import dense_ids
    from tidelink.operators.scan import ranked
    rows = [(i % 3, (i * 7919) % 1000, i) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, x int, i int")
    was = many_parts(spark) if split else {}
    try:
        ids = {r.i: r.id for r in dense_ids(df, ["x", "i"]).collect()}
        by_bucket = {r.i: r.id for r in dense_ids(df, ["x", "i"], bucket=["g"]).collect()}
        ranks = {r.i: r["_rank"] for r in ranked(df, ["g"], ["x", "i"]).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    want = sorted(rows, key=lambda r: (r[1], r[2]))
    assert ids == {r[2]: k + 1 for k, r in enumerate(want)}
    assert by_bucket == {r[2]: k + 1 for k, r in enumerate(sorted(rows, key=lambda r: (r[0], r[1], r[2])))}
    for g in range(3):
        assert [ranks[r[2]] for r in want if r[0] == g] == list(range(1, sum(r[0] == g for r in rows) + 1))


def test_no_window_over_a_single_partition(spark):
    import contextlib
    import io

    from tidelink.operators.reshape import dense_ids
    df = spark.range(1000).selectExpr("id % 7 as g", "id as x")
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        dense_ids(df, ["x"], bucket=["g"]).explain("formatted")
    assert "Window" not in out.getvalue()


def expiring_stack(ev, limit):
    """Pairs and orphans where an open start expires at an age above ``limit``."""
    pairs, orphans, stacks = [], [], {}
    for pid, root, kind, t, i in sorted(ev, key=lambda e: (e[0], e[1], e[3], e[4])):
        st = stacks.setdefault((pid, root), [])
        while st and t - st[0] > limit:
            st.pop(0)
        if kind == "start":
            st.append(t)
        elif st:
            pairs.append((pid, root, st.pop(), t))
        else:
            orphans.append((pid, root, i))
    return sorted(pairs), sorted(orphans)


@pytest.mark.parametrize("seed,limit", [(0, 0), (1, 3), (2, 15)])
def test_expiring_starts_match_a_stack(spark, seed, limit):
    ev = random_events(random.Random(100 + seed), n_pid=4, n=120)
    df = spark.createDataFrame(ev, "pid string, root string, kind string, t long, i long")
    pairs, orphans = expiring_stack(ev, limit)
    got = pair_start_stop(df, ["pid"], "root", "kind", "t", ["i"], max_length=limit).collect()
    assert sorted(tuple(r) for r in got) == pairs
    lost = orphan_stops(df, ["pid"], "root", "kind", "t", ["i"], max_length=limit).collect()
    assert sorted((r.pid, r.root, r.i) for r in lost) == orphans
    if orphans:
        with pytest.raises(OrphanStopError):
            pair_start_stop(df, ["pid"], "root", "kind", "t", ["i"], strict=True, max_length=limit)
