"""Many small files: listings, heads and rows that are read once and in tasks, a stream over listings."""

import datetime as dt
import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelink.operators import labels as LB
from tidelink.operators.reshape import fill_groups, first_by_priority
from tidelink.sources import files as S
from tidelink.sources import splits as SP
from tidelink.streaming import ingest as ST

HEAD = "# Device: BG00000001\ntimestamp,ecg,ecg_mV\n"


def put(root, rel, text):
    p = root / rel
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)
    return p


def test_listing_is_sparks_own_without_its_driver(spark, tmp_path):
    for name in ("a.csv", "x/b c%20.csv", "x/y/.hidden.csv", "x/_odd.csv", "x/_k=1.csv", "_gone/c.csv", ".git/d.csv", "x/e._COPYING_",
                 "_k=2/f.csv", "_metadata/g.csv"):
        put(tmp_path, name, "text")
    put(tmp_path, "x/empty.csv", "")
    (tmp_path / "none").mkdir()
    os.utime(tmp_path / "a.csv", ns=(0, 1_700_000_000_123_456_789))
    plain = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path))
             .select("path", "length", "modificationTime"))
    found = S.list_files(spark, str(tmp_path))
    assert sorted(found.collect()) == sorted(plain.collect()) and found.count() == 5
    assert "binaryFile" not in S.discover_files(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert S.list_files(spark, str(tmp_path / "a.csv")).count() == 1 and S.list_files(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(FileNotFoundError):
        S.list_files(spark, str(tmp_path / "nowhere"))
    assert S.file_manifest(spark, str(tmp_path), glob="{a,b}*.csv").count() == 2


def test_heads_and_rows_are_read_once(spark, tmp_path):
    files = [put(tmp_path, f"{k}-ecg.csv", HEAD + f"{1700000000 + k},1,1\nnever,2,2\n") for k in range(3)]
    paths = S.discover_files(spark, str(tmp_path))
    good, bad = S.recording_header_scan(paths.unionByName(paths), quarantine=True)  # a path that comes twice is one file
    rows, unreadable = S.ingest_samples(spark, good, quarantine=True)
    for f in files:
        f.unlink()   # a read of it would fail from here on
    assert good.count() == 3 and bad.count() == 0
    assert sorted(r.t for r in rows.collect()) == [dt.datetime(2023, 11, 14, 22, 13, 20 + k) for k in range(3)]
    assert Counter((os.path.basename(r.path), r.id, r.time_text) for r in unreadable.collect()) == Counter(
        (f"{k}-ecg.csv", 2, "never") for k in range(3))


def test_small_files_share_tasks_and_batches(spark, tmp_path):
    for k in range(200):
        put(tmp_path, f"{k}.csv", f"v\n{k}\n{-k}\n")
    listed = S.list_files(spark, str(tmp_path))
    got = SP.read_columns(listed, {"v": "v"}, row_number="n").select("path", "n", "v").collect()
    assert Counter((os.path.basename(r.path), r.n, r.v) for r in got) == Counter(
        (f"{k}.csv", n, str(v)) for k in range(200) for n, v in ((1, k), (2, -k)))
    many = spark.range(100_000).select(F.lit(10).cast("long").alias("length"))
    assert SP.task_count(many, F.col("length") + SP.OPEN_BYTES) <= 100  # 64 files a task were 1,563 tasks


def test_stream_follows_listings_not_files(spark, tmp_path):
    raw, lake, ck = tmp_path / "raw", str(tmp_path / "lake"), str(tmp_path / "ck")
    for k in range(5):
        put(raw, f"{k}/r-ecg.csv", HEAD + f"{1700000000 + k},1,1\n")
    put(raw, "empty-ecg.csv", "")
    run = lambda: ST.stream_ecg_to_lake(spark, str(raw), lake, ck, recording_id=lambda p: p, max_files_per_trigger=2)
    first = run()
    first.awaitTermination()
    assert spark.read.parquet(lake).count() == 5
    assert len(first.recentProgress) >= 3 and spark.read.parquet(ck + "/listed").count() == 5
    assert all(spark.read.parquet(p).count() <= 2 for p in glob.glob(ck + "/listed/*.parquet"))
    logged = "".join(open(p).read() for p in glob.glob(ck + "/sources/0/*"))
    assert "ecg.csv" not in logged
    put(raw, "5/r-ecg.csv", HEAD + "1700000005,1,1\n")
    run().awaitTermination()
    run().awaitTermination()
    assert spark.read.parquet(lake).count() == 6 and spark.read.parquet(ck + "/listed").count() == 6


def test_wide_priorities_and_fills_equal_the_long_ones(spark):
    rows = [(g, w, a, k, v) for k, (g, w, a, v) in enumerate(
        (g, w, a, v) for g in ("s", "t", None) for w in (1, 2) for a in ("x", "y") for v in (None, f"{g}{w}{a}1", f"{g}{w}{a}0"))
        if not (g == "t" and w == 1 and a == "y")]
    df = spark.createDataFrame(rows, "g string, w int, a string, at long, v string")
    long = {(r.g, r.w, r.a): r.v for r in first_by_priority(df, ["g", "w", "a"], "v", ["at"]).collect()}
    wide = df.select("g", "w", *[F.when((F.col("a") == a) & F.col("v").isNotNull(), F.struct("at", F.col("v").alias("value"))).alias(a)
                                 for a in "xy"])
    best = first_by_priority(wide, ["g", "w"], ["x", "y"])
    got = best.collect()
    assert {(r.g, r.w, a): r[a] for r in got for a in "xy" if r[a]} == long and len(got) == 6
    assert Counter(fill_groups(best, ["g"], ["w"], ["y"], few=True).collect()) == Counter(fill_groups(best, ["g"], ["w"], ["y"]).collect())


def test_session_windows_shuffle_wide_rows_only(spark):
    paths = spark.createDataFrame([
        ("s", "/root/6. Birth follow up/Mother/20230512/23456M/23456M_10;05AM-11;20AM"), ("s", "/root/7. x/Child"),
        (None, "/root/20230513/34567C"), ("u", "/root/Child")], "id_session string, path string")
    out = LB.session_windows(paths, "/root/")
    got = {r.id_session: (r.participant, r.participant_type, r.start, r.end, r.respondent_cat, r.year, r.month, r.day, r.id) for r in out.collect()}
    assert got["s"] == ("23456", "M", "10:05AM", "11:20AM", 6, 2023, 5, 12, 2)
    assert got[None] == ("34567", "C", None, None, None, 2023, 5, 13, 1) and len(got) == 2
