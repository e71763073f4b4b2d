"""Connected components: within one task with numpy, and over a table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.session import materialize


def local_components(n: int, u: np.ndarray, v: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest vertex of each vertex's component in a graph on 0..n-1.

    ``label`` continues from an earlier call on the same vertices.
    """
    label = np.arange(n) if label is None else label
    while len(u):
        a, b = label[u], label[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up
    return label


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(vertex, root) of every vertex with an edge; root is the smallest.

    Rounds of large star and small star until the edges no longer change.
    Minima are aggregated before the shuffle and joined back, so a vertex
    with many edges is never gathered; they are written first, so that the
    join has plain exchanges and such a vertex's edges can be split. Each
    round is written to the shared folder, which cuts the lineage. Null ends
    are ignored.
    """
    a, b = F.col(u), F.col(v)
    now = materialize(edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    mark = _fingerprint(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = (large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        now = materialize(small.distinct())
        was, mark = mark, _fingerprint(now)
        if was == mark:
            break
    return now.select(F.col("u").alias("vertex"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("vertex"), F.col("v").alias("root")).distinct())


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(h), F.sum(h.cast("decimal(38,0)"))).first()
    return tuple(row)
