"""Whole steps: links through sessions, the lake's ledger, strict checks."""

import itertools
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidelink.operators import composites as C
from tidelink.operators import linkage as L
from tidelink.operators.quality import DataQualityError, quarantine
from tidelink.sources import files as S
from tidelink.sources import lake as LK
from tidelink.sources.recordings import ingest_recordings

T0 = datetime(2024, 3, 1)
NEEDED = "# Device: BG00000001\ntimestamp,ecg,ecg_mV\n"


def minutes(n):
    return T0 + timedelta(minutes=n)


def test_resolve_links_against_all_pairs(spark):
    rng = random.Random(5)
    limits = [(f"r{i}", minutes(a), minutes(a + rng.randint(1, 3000))) for i in range(20) for a in [rng.randint(0, 4000)]]
    recordings = [(f"r{i}", rng.choice(["s1", "s2", "s3", None])) for i in range(20)]
    sessions = [(rng.choice(["s1", "s2", "s4", None]), rng.choice(["p1", "p2", "p3", None])) for _ in range(12)]
    markers = [(i, rng.choice(["p1", "p2", "p3", None]), minutes(a), minutes(a + rng.randint(0, 90)))
               for i in range(60) for a in [rng.randint(0, 7000)]]
    want = set()
    for (r, lo, hi), (i, s), (sw, p), (m, who, a, b) in itertools.product(limits, recordings, sessions, markers):
        if r == i and s is not None and s == sw and p is not None and p == who and lo <= a and b <= hi:
            want.add((r, m, who))
    got = L.resolve_links(spark.createDataFrame(limits, "id_recording string, t_min timestamp, t_max timestamp"),
                          spark.createDataFrame(recordings, "id string, id_session string"),
                          spark.createDataFrame(sessions, "id_session string, participant string"),
                          spark.createDataFrame(markers, "id int, mirage_pid string, start timestamp, end timestamp")
                          ).select("id_recording", "id_mirage", "id_participant").collect()
    assert want and len(got) == len(want) and {tuple(r) for r in got} == want


def test_link_recordings_gives_edge_samples(spark):
    samples = spark.createDataFrame([("r1", minutes(k)) for k in (0, 10, 20, 30)], "id_recording string, t timestamp")
    recordings = spark.createDataFrame([("r1", "s1")], "id string, id_session string")
    sessions = spark.createDataFrame([("s1", "p1"), ("s1", "p1")], "id_session string, participant string")
    markers = spark.createDataFrame([(1, "p1", minutes(12), minutes(19)), (2, "p1", minutes(25), minutes(31))],
                                    "id int, mirage_pid string, start timestamp, end timestamp")
    rows = C.link_recordings(samples, recordings, sessions, markers).collect()
    assert [(r.id_mirage, r.time_start, r.time_end, r.offset_start, r.offset_end) for r in rows] == [
        (1, minutes(10), minutes(20), 600.0, 1200.0)]


def _ecg(folder, name, first_epoch):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}-ecg.csv").write_text(NEEDED + "".join(f"{first_epoch + k},1.0,0.001\n" for k in range(3)))


def test_ledger_spares_listed_files_and_covers_unlisted_ones(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    _ecg(raw, "a_1", 1700000000)
    first = ingest_recordings(spark, str(raw), lake)
    assert first["recordings"].where("year = 2023").count() == 1
    ids = {r.id_recording for r in spark.read.parquet(lake + "-ledger").collect()}
    assert ids == {r.id for r in first["meta"].collect()}
    # a write that ended before its ledger entry
    extra = spark.createDataFrame([("late", 2023, 11, 0.0)], "id_recording string, year int, month int, ecg double")
    extra.write.mode("append").partitionBy("year", "month").parquet(lake)
    assert {r.id_recording for r in LK.lake_ids(spark, lake).collect()} == ids | {"late"}
    # with an old ledger, files before it are not opened
    old = {p for p in (tmp_path / "lake").rglob("*.parquet")}
    import os
    for p in old:
        os.utime(p, (1, 1))
    assert {r.id_recording for r in LK.lake_ids(spark, lake).collect()} == ids
    again = ingest_recordings(spark, str(raw), lake)
    assert again["rejected"].count() == 0
    assert spark.read.parquet(lake).where(F.col("id_recording") != "late").count() == 3


def test_ingest_quarantines_and_strict_raises(spark, tmp_path):
    raw, lake = tmp_path / "raw", str(tmp_path / "lake")
    _ecg(raw, "good_1", 1700000000)
    _ecg(raw, "old_1", 100)
    (raw / "bare_1-ecg.csv").write_text("# only\n")
    (raw / "none_1-ecg.csv").write_text("when,ecg\n1,2\n")
    (raw / "rowless_1-ecg.csv").write_text(NEEDED)
    out = ingest_recordings(spark, str(raw), lake)
    assert {r.reason for r in out["bad_files"].collect()} == {"empty", "unknown time column"}
    assert {r.reason for r in out["rejected"].collect()} == {"year before 2000", "no samples"}
    assert out["recordings"].where("year is not null").count() == 1
    with pytest.raises(DataQualityError):
        ingest_recordings(spark, str(raw), str(tmp_path / "other"), strict=True)


def test_eda_head_without_colon_is_put_aside(spark, tmp_path):
    folder = tmp_path / "1.eda"
    folder.mkdir()
    (folder / "00001.csv").write_text("ES0001\n" * 27 + "SECOND;SC\n")
    good, bad = S.eda_header_scan(S.discover_files(spark, str(tmp_path)), str(tmp_path), quarantine=True)
    assert good.count() == 0 and [r.reason for r in bad.collect()] == ["no device"]


def test_quarantine_strict(spark):
    df = spark.range(3)
    good, bad = quarantine(df, {"small": F.col("id") < 2})
    assert good.count() == 2 and [r.reason for r in bad.collect()] == ["small"]
    with pytest.raises(DataQualityError):
        quarantine(df, {"small": F.col("id") < 2}, strict=True)
