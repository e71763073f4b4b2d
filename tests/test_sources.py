"""Raw-file edge cases for listing, header scan and sample ingest."""

import datetime as dt

from pyspark.sql import functions as F

from tidelink.sources import files as S

PRE = "# Sampling: 1.0s (1000 Hz)\n# Export timezone: Asia/Dhaka\n# Device: BG12345678\n"


def _write(root, rel, text):
    p = root / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)
    return p


def test_header_scan_and_ingest(spark, tmp_path):
    _write(tmp_path, "a/rec_12-ecg.csv", PRE + "local_time,ecg,ecg_mV\n2024-01-01 06:00:00.5,1.0,0.001\n")
    _write(tmp_path, "b/rec-ecg.csv", "# Sampling: 1.0s (250 Hz)\n# Device: BG87654321\n"
           "timestamp,ecg,ecg_mV\n1704067200.25,2.0,0.002\n1704067200250,3.0,0.003\n")
    _write(tmp_path, "c/bad-ecg.csv", PRE + "when,ecg,ecg_mV\n1,2,3\n")
    _write(tmp_path, "d/empty-ecg.csv", "")
    _write(tmp_path, "e/x;y-ecg.csv", PRE + "timestamp,ecg,ecg_mV\n1704067200,1,1\n")
    _write(tmp_path, "m/PID12345utcmarker.csv", "id,participantID,lang,marker,utc_app\n1,PID12345,en,a_start,1704067200000\n")
    files = S.discover_files(spark, str(tmp_path))
    kinds = {r.path.rsplit("/", 1)[-1]: r.kind for r in files.collect()}
    assert kinds["rec_12-ecg.csv"] == "ecg" and kinds["PID12345utcmarker.csv"] == "marker"
    assert kinds["x;y-ecg.csv"] != "ecg"                                 # paths with ; are no ECG files
    good, bad = S.recording_header_scan(files.where("kind = 'ecg'"), quarantine=True)
    g = {r.path.rsplit("/", 1)[-1]: r for r in good.collect()}
    assert set(g) == {"rec_12-ecg.csv", "rec-ecg.csv"}
    a, b = g["rec_12-ecg.csv"], g["rec-ecg.csv"]
    assert (a.sequence, a.tz, a.device_id, a.time_col, a.sampling_rate) == (12, "Asia/Dhaka", "BG12345678", "local_time", 1000)
    assert (b.sequence, b.tz, b.time_col, b.sampling_rate) == (1, None, "timestamp", 250)   # missing zone -> null
    reasons = {r.path.rsplit("/", 1)[-1]: r.reason for r in bad.collect()}
    assert reasons["bad-ecg.csv"] == "unknown time column"
    assert reasons.get("empty-ecg.csv", "empty") == "empty"   # zero-length files are skipped by the listing
    s = S.ingest_samples(spark, good.withColumn("id", F.col("path")))
    got = sorted((r.t, r.ecg) for r in s.collect())
    want = [(dt.datetime(2024, 1, 1, 0, 0, 0, 250000), 2.0), (dt.datetime(2024, 1, 1, 0, 0, 0, 250000), 3.0),
            (dt.datetime(2024, 1, 1, 0, 0, 0, 500000), 1.0)]                    # Dhaka is UTC+6; s and ms
    assert got == want


def test_columns_are_found_by_name(spark, tmp_path):
    """Swapped, extra and both time columns, a long preamble, unreadable rows."""
    _write(tmp_path, "a-ecg.csv", PRE + "# note\n" * 30 + "ecg_mV,x,local_time,timestamp,ecg\n"
           "0.002,9,2024-01-01 06:00:00,1704067200,2.0\n0.003,9,never,soon,3.0\n0.004,9,,1704067201,oops\n")
    _write(tmp_path, "b-ecg.csv", PRE + "ecg,local_time\n5.0,2024-01-01 06:00:02\n")
    good, bad = S.recording_header_scan(S.discover_files(spark, str(tmp_path)).where("kind = 'ecg'"), quarantine=True)
    assert bad.count() == 0 and good.count() == 2
    rows, rejected = S.ingest_samples(spark, good, quarantine=True)
    t0 = dt.datetime(2024, 1, 1)
    got = sorted(((r.t - t0).total_seconds(), r.ecg, r.ecg_mV) for r in rows.collect())
    assert got == [(0.0, 2.0, 0.002), (1.0, None, 0.004), (2.0, 5.0, None)]
    assert [r.reason for r in rejected.collect()] == ["unreadable time"]


def test_marker_columns_by_name(spark, tmp_path):
    _write(tmp_path, "PID1utcmarker.csv", "id,lang,participantID,extra,marker,utc_app\n1,en,PID12345,z,a_start,17\n")
    _write(tmp_path, "PID2utcmarker.csv", "utc_app,marker,lang,participantID,id\n18,a_stop,bn,PID12345,2\nx,b,bn,P,3\n")
    good, bad = S.read_marker_events(spark, str(tmp_path), quarantine=True)
    assert sorted(tuple(r) for r in good.collect()) == [
        ("1", "PID12345", "en", "a_start", 17), ("2", "PID12345", "bn", "a_stop", 18)]
    assert [r.id for r in bad.collect()] == ["3"]


def test_ingested_files_are_not_opened_again(spark, tmp_path):
    from tidelink.sources import lake as LK
    old = _write(tmp_path, "raw/old-ecg.csv", PRE + "timestamp,ecg\n1704067200,1.0\n")
    lake = str(tmp_path / "lake")
    listing = lambda: S.discover_files(spark, str(tmp_path / "raw")).where("kind = 'ecg'")
    LK.write_lake(S.ingest_samples(spark, S.recording_header_scan(listing())), lake)
    _write(tmp_path, "raw/new-ecg.csv", PRE + "timestamp,ecg\n1704067201,2.0\n")
    todo = LK.incremental_candidates(spark, S.recording_header_scan(listing()), lake).cache()
    assert [r.path.rsplit("/", 1)[-1] for r in todo.collect()] == ["new-ecg.csv"]
    old.unlink()   # a read of it would fail from here on
    LK.write_lake(S.ingest_samples(spark, todo), lake)
    assert spark.read.parquet(lake).count() == 2


def test_lake_rejections_have_reasons(spark):
    from tidelink.sources.lake import lake_layout
    rows = [("a", "2024-01-01 00:00:00"), ("b", None), ("c", "1970-01-01 00:00:05")]
    samples = spark.createDataFrame(rows, "id_recording string, s string").select(
        "id_recording", F.to_timestamp("s").alias("t"))
    meta = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    kept, bad = lake_layout(samples, meta=meta)
    assert [r.id_recording for r in kept.collect()] == ["a"]
    assert {r.id_recording: r.reason for r in bad.collect()} == {
        "b": "no sample has a time", "c": "year before 2000", "d": "no samples"}
