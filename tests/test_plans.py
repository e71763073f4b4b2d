"""Plan checks: pruning reaches the scan, joins are equi/broadcast, no cartesian products."""

import contextlib
import io

from conftest import SF_SMALL

import __spark_entry__ as E


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_link_recordings_plan(spark):
    p = plan_of(E.queries()["link_recordings"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_asof_edges_prunes_columns_and_pushes_filters(spark):
    from tidelink.operators.linkage import asof_edges, offset_from_start
    from tidelink.plans import bindings as B
    from tidelink.plans.q_linkage import links
    out = asof_edges(links(spark, SF_SMALL), offset_from_start(B.samples(spark, SF_SMALL)), "id_recording",
                     "start", "end", "t", ["offset_secs"], ["id_recording", "id_mirage"])
    p = plan_of(out)
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # only the needed event columns are read, and the type filter is pushed
    scans = [x for x in p.split("ReadSchema: ")[1:] if "event_type" in x.split("\n")[0]]
    assert scans and all("props" not in x.split("\n")[0] for x in scans)
    assert "PushedFilters" in p


def test_lake_read_prunes_partitions(spark, tmp_path):
    from pyspark.sql import functions as F

    from tidelink.sources.lake import read_lake_partition, write_lake
    rows = [("r1", "2024-01-03 10:00:00", 1.0), ("r1", "2024-01-03 10:00:01", 2.0), ("r2", "2024-02-05 00:00:00", 3.0),
            ("r3", "1970-01-01 00:00:05", 4.0)]
    df = spark.createDataFrame(rows, "id_recording string, t string, ecg double").withColumn("t", F.to_timestamp("t"))
    root = str(tmp_path / "lake")
    bad = write_lake(df, root)
    assert [r.id_recording for r in bad.collect()] == ["r3"]           # year < 2000 rejected
    part = read_lake_partition(spark, root, 2024, 1)
    assert "PartitionFilters" in plan_of(part)
    got = sorted((r.id_recording, r.offset_secs) for r in part.collect())
    assert got == [("r1", 0.0), ("r1", 1.0)]


def test_contained_in_uses_equi_keys(spark):
    p = plan_of(E.queries()["contained_in"](spark, SF_SMALL))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
