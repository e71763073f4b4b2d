"""Rank statistics equal direct numpy computations."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from tidelink.operators import stats
from tidelink.operators.stats import leave_one_out_mad, mad, mode_with_ties, order_statistics, unique_values


def _mad(xs):
    m = statistics.median(xs)
    return statistics.median([abs(x - m) for x in xs])


@pytest.mark.parametrize("bins,cell", [(2, 1), (4, 3), (512, 1024)])
def test_order_statistics_of_odd_values(spark, monkeypatch, bins, cell):
    """Narrowed to a single value or read off a short list: the same places."""
    monkeypatch.setattr(stats, "BINS", max(bins, 3))
    monkeypatch.setattr(stats, "CELL", cell)
    inf, nan = float("inf"), float("nan")
    groups = {"wide": [-1.7e308, 1.7e308, 0.0, 5e-324, 1e-323, -1e300], "ends": [inf, -inf, inf, nan, 3.0, nan, -inf],
              "same": [7.0] * 9, "one": [2.5], None: [3.0, 1.0, 2.0, 2.0], "outlier": [float(k) for k in range(12)] + [1e17],
              "none": [None, None]}
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v double")
    n = F.col("_n")
    wanted = {"low": F.lit(1), "mid": F.floor((n + 1) / 2), "high": n, "zero": F.lit(0), "past": n + 1}
    got = {r.g: r for r in order_statistics(df, ["g"], "v", wanted).collect()}
    assert "none" not in got and len(got) == len(groups) - 1
    for g, r in got.items():
        xs = sorted(groups[g], key=lambda v: (v != v, v if v == v else 0))
        want = [xs[0], xs[(len(xs) + 1) // 2 - 1], xs[-1]]
        assert [repr(v) for v in (r.low, r.mid, r.high)] == [repr(v) for v in want], g
        assert r.zero is None and r.past is None and r._n == len(xs)


@pytest.mark.parametrize("seed", range(3))
def test_leave_one_out_mad(spark, seed, monkeypatch):
    monkeypatch.setattr(stats, "CELL", [1024, 2, 5][seed])
    monkeypatch.setattr(stats, "BINS", [512, 4, 3][seed])
    rng = random.Random(seed)
    rows = [(g, i, rng.choice([rng.randint(0, 50), 7])) for g in range(5) for i in range(rng.randint(1, 15))]
    rows = [(g, gi * 100 + i, x) for gi, (g, i, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, "g int, id int, x long")
    got = {r.id: r.loo for r in leave_one_out_mad(df, ["g"], "id", "x", "loo").collect()}
    for g, i, x in rows:
        others = [xx for gg, ii, xx in rows if gg == g and ii != i]
        want = _mad(others) if others else None
        assert got[i] == want, (g, i)


def test_mad_with_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (1, 4.0), (1, None), (2, None)], "g int, x double")
    got = {r.g: r.mad for r in mad(df, ["g"], "x").collect()}
    assert got == {1: 1.0, 2: None}


def test_mode_and_unique(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, "c"), (2, None)], "g int, v string")
    assert {r.g: r.mode for r in mode_with_ties(df, ["g"], "v").collect()} == {1: "a|b", 2: None}
    assert {r.g: r["values"] for r in unique_values(df, ["g"], ["v"]).collect()} == {1: "a|b|c", 2: None}
