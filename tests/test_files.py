"""Byte ranges, manifests, strict checks, stream rejects and the lake's index."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelink.operators import labels as LB
from tidelink.operators import linkage as L
from tidelink.operators.quality import DataQualityError, Observed
from tidelink.operators.reshape import fill_groups, first_by_priority, first_seen_values
from tidelink.operators.scan import positioned, ranked, surrounding
from tidelink.session import materialize
from tidelink.sources import files as S
from tidelink.sources import lake as LK
from tidelink.sources import splits as SP
from tidelink.sources.recordings import ingest_files
from tidelink.streaming import ingest as ST

HEAD = "# Device: BG00000001\ntimestamp,ecg,ecg_mV\n"


def put(root, rel, text):
    p = root / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)
    return p


def listed(spark, root):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(root)).select("path", "length")


# --- byte ranges ---------------------------------------------------------------

@pytest.mark.parametrize("size,end", [(1, "\n"), (7, "\r\n"), (64, "\n"), (1 << 20, "\r\n")])
def test_ranges_of_any_size_give_every_row_once(spark, tmp_path, size, end, monkeypatch):
    monkeypatch.setattr(SP, "OPEN_BYTES", 0)
    rows = [f"{k},{'x' * (k % 9)},{k * k}" for k in range(60)]
    put(tmp_path, "a.csv", "# note" + end + "b,c,a" + end + end.join(rows) + end)
    put(tmp_path, "b.csv", "a,b" + end + '5,"quoted, text"' + end + "6")  # no end, a short row
    put(tmp_path, "c.csv", "a,b,c")  # no rows
    if size == 1:
        rows = rows[:3]
        put(tmp_path, "a.csv", "b,c,a" + end + end.join(rows) + end)
    got = SP.read_columns(listed(spark, tmp_path), {"a": "x", "b": "y"}, "#", row_number="n", split_bytes=size).collect()
    assert Counter((os.path.basename(r.path), r.x, r.y) for r in got) == Counter(
        [("a.csv", r.split(",")[2], r.split(",")[0]) for r in rows] + [("b.csv", "5", "quoted, text"), ("b.csv", "6", None)])
    mine = sorted((r.n, r.y) for r in got if r.path.endswith("a.csv"))
    assert [int(y) for _, y in mine] == list(range(len(rows))) and len({n for n, _ in mine}) == len(rows)
    if size == 1 << 20:
        assert [n for n, _ in mine] == list(range(1, len(rows) + 1))


def test_folders_with_blanks_and_percent_signs_are_opened(spark, tmp_path):
    put(tmp_path, "1. Re cruit/50%20 of+it/a b.csv", "v\n1\n2\n")
    got = SP.read_columns(listed(spark, tmp_path), {"v": "v"}, "#").collect()
    assert sorted(r.v for r in got) == ["1", "2"]


def test_facts_of_a_file_travel_with_its_rows(spark, tmp_path):
    put(tmp_path, "a.csv", "v\n1\n2\n")
    put(tmp_path, "b.csv", "w,v\n9,3\n")
    files = listed(spark, tmp_path).withColumn("zone", F.when(F.col("path").endswith("a.csv"), "Asia/Dhaka"))
    got = SP.read_columns(files, {"v": "value", "none": "gone"}).select("zone", "value", "gone").collect()
    assert Counter(map(tuple, got)) == Counter([("Asia/Dhaka", "1", None), ("Asia/Dhaka", "2", None), (None, "3", None)])
    assert SP.read_columns(files.limit(0), {"v": "value"}).collect() == []


@pytest.mark.parametrize("size", [40, 1 << 20])
def test_eda_length_ignores_numbers_before_the_data_header(spark, tmp_path, size, monkeypatch):
    head = "Device: ES1;v\n2;x\n500;Hz\nStart;01.02.24 10:00:00\n" + "Param;0\n" * 23
    put(tmp_path, "1.eda/00001.csv", head + "SECOND;SC\n0,5;1\n12,75;1\nend;1\n3;1\n")
    put(tmp_path, "1.eda/00002.csv", head + "Param;0\nSECOND;SC\n")
    monkeypatch.setattr(SP, "SPLIT_BYTES", size)
    heads = S.eda_header_scan(S.discover_files(spark, str(tmp_path)), str(tmp_path))
    got = SP.greatest_first_field(heads, "data_header_line", split_bytes=size).collect()
    assert {r.path[-9:-4]: r.greatest for r in got} == {"00001": 12.75, "00002": None}
    assert {r.length_secs for r in S.eda_lengths(heads).collect()} == {12.75, None}


# --- manifests -----------------------------------------------------------------

def test_manifest_versions_and_changes(spark, tmp_path):
    root, store = tmp_path / "raw", str(tmp_path / "store")
    for name in ("same", "edit", "gone", "old", "twin1", "twin2"):
        put(root, f"{name}.csv", "twin" if name.startswith("twin") else name)
    first = S.record_manifest(spark, str(root), store)
    assert Counter(r.status for r in first.collect()) == {"added": 6}
    assert S.manifest_version(spark, store).count() == 6 and S.manifest_version(spark, store, 9) is None
    (root / "edit.csv").write_text("edited")
    (root / "gone.csv").unlink()
    (root / "old.csv").rename(root / "new.csv")
    (root / "twin1.csv").rename(root / "a_twin.csv")
    put(root, "empty.csv", "")
    changes = S.record_manifest(spark, str(root), store)
    base = lambda p: p and os.path.basename(p)
    got = {(base(r.old_path), base(r.path), r.status) for r in changes.collect()}
    assert got - {(None, "empty.csv", "added")} == {
        ("same.csv", "same.csv", "same"), ("twin2.csv", "twin2.csv", "same"), ("edit.csv", "edit.csv", "changed"),
        ("gone.csv", None, "removed"), ("old.csv", "new.csv", "moved"), ("twin1.csv", "a_twin.csv", "moved")}


def test_unchanged_files_are_not_hashed_again(spark, tmp_path):
    put(tmp_path, "a.csv", "one")
    put(tmp_path, "b.csv", "two")
    told = materialize(S.file_manifest(spark, str(tmp_path)).withColumn("md5", F.lit("told")))
    (tmp_path / "b.csv").write_text("three")
    got = {os.path.basename(r.path): r.md5 for r in S.file_manifest(spark, str(tmp_path), previous=told).collect()}
    assert got["a.csv"] == "told" and got["b.csv"] == "35d6d33467aae9a2e3dccb4b6b027878"


# --- strict checks -------------------------------------------------------------

def test_observed_counts_while_writing(spark):
    seen = Observed("odd", "big")
    reason = F.when(F.col("id") % 2 == 1, "odd").when(F.col("id") > 5, "big")
    assert materialize(seen.on(spark.range(10), reason, F.col("id"))).count() == 10
    assert seen.counts() == {"odd": 5, "big": 2}
    with pytest.raises(DataQualityError, match="5 x odd, e.g. '1'; 2 x big, e.g. '6'"):
        seen.refuse()
    clean = Observed("odd")
    materialize(clean.on(spark.range(3), F.lit(None).cast("string"), F.col("id")))
    clean.refuse()


def test_eda_heads_strict(spark, tmp_path):
    good = "Device: ES1;v\n" + "Param;0\n" * 26 + "SECOND;SC\n"
    put(tmp_path, "1.eda/00001.csv", good)
    files = S.discover_files(spark, str(tmp_path))
    assert S.eda_header_scan(files, str(tmp_path), strict=True).count() == 1
    put(tmp_path, "1.eda/00002.csv", good.replace("SECOND", "MINUTE"))
    files = S.discover_files(spark, str(tmp_path))
    with pytest.raises(DataQualityError, match="1 x no SECOND header"):
        S.eda_header_scan(files, str(tmp_path), strict=True)
    kept, bad = S.eda_header_scan(files, str(tmp_path), quarantine=True)
    assert kept.count() == 1 and [r.reason for r in bad.collect()] == ["no SECOND header"]


@pytest.mark.parametrize("label,reason", [
    ("23456M_10;05AM-11;20AM", None),
    ("23456M_10;05AM-11;20AM(9 YEARS)", "label not parsed|label breaks the grammar"),
    ("12345M 10;05AM-11;20AM 23456M 1;05PM-2;20PM 34567M", "label not split|label breaks the grammar")])
def test_labels_strict(spark, label, reason):
    paths = spark.createDataFrame([("s", f"/root/6. Birth follow up/Mother/20230512/{label}")], "id_session string, path string")
    if reason is None:
        assert LB.session_windows(paths, "/root/", strict=True).count() == 1
        return
    with pytest.raises(DataQualityError, match=reason):
        LB.session_windows(paths, "/root/", strict=True)
    _, bad = LB.session_windows(paths, "/root/", quarantine=True)
    assert bad.count() == 1


# --- rejects of a stream -------------------------------------------------------

def faulty(root):
    put(root, "good-ecg.csv", HEAD + "1700000000,1,1\nnever,2,2\n1700000001,3,3\n")
    put(root, "old-ecg.csv", HEAD + "5,1,1\n")
    put(root, "bare-ecg.csv", "# only\n")


def rejects(spark, folder):
    got = spark.read.parquet(folder).collect()
    return Counter((r.kind, os.path.basename(r.what), r.row, r.text) for r in got)


WANT = Counter([("bad_files", "bare-ecg.csv", None, None), ("bad_rows", "good-ecg.csv", 2, "never"),
                ("rejected", "old-ecg.csv", None, None)])


def test_stream_keeps_its_rejects(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    faulty(raw)
    ST.stream_ecg_to_lake(spark, str(raw), lake, str(tmp_path / "ck"), recording_id=lambda p: p).awaitTermination()
    assert spark.read.parquet(lake).count() == 2
    assert rejects(spark, lake + "-rejected") == WANT
    put(raw, "more-ecg.csv", HEAD + "1700000000,1,1\nsoon,2,2\n")
    ST.stream_ecg_to_lake(spark, str(raw), lake, str(tmp_path / "ck"), recording_id=lambda p: p).awaitTermination()
    assert rejects(spark, lake + "-rejected") == WANT + Counter([("bad_rows", "more-ecg.csv", 2, "soon")])


@pytest.mark.parametrize("fails", ["quarantine", "append", "ledger"])
def test_failed_and_repeated_batch_counts_once(spark, tmp_path, monkeypatch, fails):
    """The batch dies while its rejects, its rows or its ledger entry are
    written, and is repeated, twice."""
    raw, lake, aside = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "aside")
    faulty(raw)
    batch = S.discover_files(spark, str(raw)).select("path")
    write = ST._batch_writer(lake, lambda p: p, aside, "q")

    def dies(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if fails == "quarantine":
            m.setattr(ST, "set_aside", dies)
        elif fails == "append":
            m.setattr(LK, "write_lake", dies)
        else:
            m.setattr(LK, "_minutes_since", dies)
        with pytest.raises(RuntimeError):
            write(batch, 0)
    write(batch, 0)
    write(batch, 0)
    assert spark.read.parquet(lake).count() == 2
    assert rejects(spark, aside) == WANT


# --- the lake's index and months ------------------------------------------------

def test_lake_index_gives_limits_and_edges(spark, tmp_path):
    rng = random.Random(3)
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    times = {n: sorted(1700000000 + rng.randrange(20_000) for _ in range(150)) for n in "abc"}
    for n, ts in times.items():
        put(raw, f"{n}-ecg.csv", HEAD + "".join(f"{t}.0,1,1\n" for t in ts))
        ingest_files(spark, S.discover_files(spark, str(raw)), lake, lambda p: F.regexp_extract(p, "([^/]*)-ecg.csv$", 1))
    index = materialize(LK.lake_index(spark, lake))
    stamp = lambda t: dt.datetime.fromtimestamp(t, dt.timezone.utc).replace(tzinfo=None)
    assert {(r.id_recording, r.t_min, r.t_max) for r in L.index_limits(index, "id_recording").collect()} == {
        (n, stamp(ts[0]), stamp(ts[-1])) for n, ts in times.items()}
    assert index.count() == sum(len({t // 60 for t in ts}) for ts in times.values())
    asked = [(n, k, 1700000000 + rng.randint(-500, 20_500)) for n in "abcd" for k in range(80)]
    asked += [(n, 1000 + k, t) for n, ts in times.items() for k, t in enumerate(ts[:20])]  # exactly at samples
    edges = spark.createDataFrame(asked, "id_recording string, k int, s long").withColumn("at", F.timestamp_seconds("s"))
    for payload in ([], ["ecg"]):
        got = L.asof_edges(edges, spark.read.parquet(lake), "id_recording", "at", "at", "t", payload, ["id_recording", "k"], index=index)
        found = {(r.id_recording, r.k): (r.time_start, r.time_end) for r in got.collect()}
        for n, k, s in asked:
            back = max((t for t in times.get(n, []) if t <= s), default=None)
            ahead = min((t for t in times.get(n, []) if t >= s), default=None)
            want = (back and stamp(back), ahead and stamp(ahead))
            assert found.get((n, k), (None, None)) == want


def test_settled_edges_do_not_open_samples(spark):
    samples = spark.createDataFrame([("r", 60), ("r", 65), ("r", 300)], "id_recording string, s long").select(
        "id_recording", F.timestamp_seconds("s").alias("t"))
    index = materialize(L.occupancy(samples))
    gone = samples.where(F.lit(False))  # only the index can answer
    edges = spark.createDataFrame([(1, "r", 100, 200), (2, "r", 65, 60)], "k int, id_recording string, a long, b long").select(
        "k", "id_recording", F.timestamp_seconds("a").alias("start"), F.timestamp_seconds("b").alias("end"))
    got = L.asof_edges(edges, gone, "id_recording", "start", "end", "t", [], ["k"], index=index).collect()
    second = lambda x: x.replace(tzinfo=dt.timezone.utc).timestamp()
    assert {r.k: (second(r.time_start), second(r.time_end)) for r in got} == {1: (65, 300), 2: (65, 60)}


def test_months_are_those_of_the_zone(spark, tmp_path):
    lake = str(tmp_path / "lake")
    begin = {"before": "2024-01-31 17:59:59.9", "first": "2024-01-31 18:00:00", "mid": "2024-02-10 00:00:00",
             "last": "2024-02-29 17:59:59.9995", "after": "2024-02-29 18:00:00"}
    rows = [(n, t, 0) for n, t in begin.items()] + [(n, t, 40 * 86400) for n, t in begin.items()]
    samples = spark.createDataFrame(rows, "id_recording string, b string, add long").select(
        "id_recording", F.timestamp_micros(F.unix_micros(F.to_timestamp("b")) + F.col("add") * 1000000).alias("t"))
    LK.write_lake(samples, lake)
    got = LK.read_lake_month(spark, lake, 2024, 2)
    assert Counter(r.id_recording for r in got.collect()) == {"first": 2, "mid": 2, "last": 2}
    scans = [x for x in got._jdf.queryExecution().executedPlan().toString().split("\n") if "PartitionFilters" in x and "offset_secs" in x]
    assert scans and all("PartitionFilters: [" in x and "PartitionFilters: []" not in x for x in scans)
    kept = LK.month_filter(samples.where("add is null or true"), "t", 2024, 2).select("id_recording").distinct()
    assert {r.id_recording for r in kept.collect()} == {"first", "mid", "last"}
    assert LK.month_bounds(2023, 12, "Asia/Dhaka")[1].isoformat() == "2023-12-31T18:00:00+00:00"
    assert LK.month_bounds(2024, 3, "Europe/Berlin")[1].isoformat() == "2024-03-31T22:00:00+00:00"


# --- scans and groups ------------------------------------------------------------

def test_surrounding_and_ranked_against_plain_python(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.randrange(500), rng.choice([None, 1, 2, 3])) for _ in range(300)]
    rows = [(g, x, k, v) for k, (g, x, v) in enumerate(rows)]
    df = spark.createDataFrame(rows, "g string, x int, k int, v int").repartition(5)
    got = surrounding(df, ["g"], [F.col("x"), F.col("k")], F.col("v"), "b", "a").collect()
    for r in got:
        line = sorted((x, k, v) for g, x, k, v in rows if g == r.g)
        at = line.index((r.x, r.k, r.v))
        assert r.b == next((v for *_, v in reversed(line[:at + 1]) if v is not None), None)
        assert r.a == next((v for *_, v in line[at:] if v is not None), None)
    place = {r.k: r.n for r in ranked(df, ["g"], ["x", "k"], "n").collect()}
    for g in "ab":
        line = sorted((x, k) for h, x, k, _ in rows if h == g)
        assert [place[k] for _, k in line] == list(range(1, len(line) + 1))
    whole = sorted(positioned(df, ["x", "k"], "p").select("x", "k", "p").collect())
    assert [r.p for r in whole] == list(range(300))


def test_groups_first_filled_and_first_seen(spark):
    rows = [("a", 2, None, "x"), ("a", 1, "p", "x"), ("a", 3, "q", "p"), (None, 1, "n", None), (None, 2, None, None), ("b", 1, None, None)]
    df = spark.createDataFrame(rows, "g string, o int, u string, v string")
    assert Counter((r.g, r.u) for r in first_by_priority(df, ["g"], "u", ["o"]).collect()) == Counter([("a", "p"), (None, "n")])
    filled = fill_groups(df, ["g"], ["o"], ["u"]).collect()
    assert Counter((r.g, r.o, r.u) for r in filled) == Counter(
        [("a", 1, "p"), ("a", 2, "p"), ("a", 3, "p"), (None, 1, "n"), (None, 2, "n"), ("b", 1, None)])
    seen = first_seen_values(df, ["g"], ["u", "v"], ["o"]).collect()
    assert sorted(((r.g or ""), r.position, r.value) for r in seen) == [("", 1, "n"), ("a", 1, "p"), ("a", 2, "x"), ("a", 3, "q")]
