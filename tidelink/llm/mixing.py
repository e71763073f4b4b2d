"""Mixing sources to target weights by cube-method balanced sampling.

Every source gets a target size by its weight; a source whose target is a
ratio r of its size takes each of its documents floor(r) times, and once more
with probability r - floor(r). The extra copies are drawn by the cube
method: inclusion probabilities move through the null space of the balancing
constraints (documents, and sizes) until they are 0 or 1, so that the sample
has the expected document and token totals.

Sources are cut into blocks of bounded size. Each block flies on its own and
leaves at most two documents undecided; those of many blocks meet in a next
flight, and so on to one block for each source, whose last two are landed.
Large documents fly first, so what is left for the landing is small.

Defined results: a null text has size 0 and a null source is a source of its
own, last in order; a source of size 0 has target 0 and takes nothing; an
empty table gives an empty table; repeated rows are sampled each; draws
depend on the rows' ids, sizes and sources alone, so reruns agree; columns
already named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelink.llm.common import without
from tidelink.operators.scan import positioned
from tidelink.session import materialize

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_RATIO = 2.0
BLOCK_ROWS = 1000
FAN_IN = 400
SNAP = 1e-9


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Flight phase over sizes in descending order; at most two entries stay
    fractional, the smallest ones wherever sizes allow.

    The largest fractional unit moves against all smaller ones, along the
    vector of the constraints' null space that spreads the change over them:
    sum(p) and sum(p * size) keep their values, and the two step lengths are
    drawn so that each p keeps its expectation. Every step decides a unit. A
    block that repeated rows have made large flies in slices first.
    """
    p = np.where(p < SNAP, 0.0, np.where(p > 1 - SNAP, 1.0, p))
    s = size.astype(float)
    if len(p) > 2 * BLOCK_ROWS:
        slices = -(-len(p) // BLOCK_ROWS)
        for k in range(slices):
            p[k::slices] = fly(p[k::slices], size[k::slices], rng)
    left = np.flatnonzero((p > 0) & (p < 1))
    if len(left) > 2 * BLOCK_ROWS:
        p[left] = fly(p[left], size[left], rng)
        left = np.flatnonzero((p > 0) & (p < 1))
    while len(left) > 2:
        k, rest = left[0], left[1:]
        q, x = p[rest] * (1 - p[rest]), s[rest]
        a, b, c = q.sum(), q @ x, q @ (x * x)
        det = a * c - b * b
        if det > SNAP * a * c:
            against = ((c - b * s[k]) + (a * s[k] - b) * x) / det * q
        elif b > 0:  # equal sizes: the totals of sizes come first
            against = q * (s[k] / b)
        else:
            against = q / a
        _step(p, left, np.concatenate([[1.0], -against]), float(rng.random()))
        left = left[(p[left] > 0) & (p[left] < 1)]
    return p


def _step(p: np.ndarray, units: np.ndarray, move: np.ndarray, draw: float) -> None:
    """Move ``p`` of the units as far as it goes, forwards or backwards."""
    at = p[units]
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(move > 0, (1 - at) / move, np.where(move < 0, -at / move, np.inf)).min()
        down = np.where(move > 0, at / move, np.where(move < 0, (at - 1) / move, np.inf)).min()
    at = at + (up if draw * (up + down) < down else -down) * move
    p[units] = np.where(at < SNAP, 0.0, np.where(at > 1 - SNAP, 1.0, at))


def land(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Landing of at most two units: first keep the sizes, then draw the last."""
    p = p.copy()
    left = np.flatnonzero((p > 0) & (p < 1))
    if len(left) == 2:
        move = np.array([float(size[left[1]]), -float(size[left[0]])])
        _step(p, left, move if move.any() else np.array([1.0, -1.0]), float(rng.random()))
    for i in left:
        if 0 < p[i] < 1:
            p[i] = float(rng.random() < p[i])
    return p


def source_targets(sized: DataFrame, weights: Sequence[float] = WEIGHTS,
                   share: float = SHARE, max_ratio: float = MAX_RATIO) -> DataFrame:
    """(source, n, source_size, target): targets by weight, each at most
    ``max_ratio`` of its source, what is above it shared again by weight.

    Weights repeat along the sources in code-point order, null last. Sources
    are numbered within range partitions and offset by earlier parts' counts.
    Each round of resharing is one aggregate; a round caps a source at least.
    """
    totals = materialize(sized.groupBy("source")
                         .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")))
    ranged = totals.repartitionByRange(F.col("source").asc_nulls_last())
    ranged = materialize(ranged.sortWithinPartitions(F.col("source").asc_nulls_last())
                         .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")))
    parts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n_part"), F.min("at").alias("first"))
    before, offset = [], 0
    for r in parts.orderBy("part").collect():  # a row for each range partition
        before.append((r["part"], r["first"], offset))
        offset += r["n_part"]
    spark = sized.sparkSession
    offsets = spark.createDataFrame(before, "part int, first long, offset long")
    place = F.col("offset") + F.col("at") - F.col("first")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int"))
    table = materialize(ranged.join(F.broadcast(offsets), "part").select(
        "source", "n", "source_size", weight.alias("weight"),
        (F.col("source_size") * F.lit(float(max_ratio))).alias("cap")))

    total = table.agg(F.sum("source_size")).first()[0]
    wanted, level = share * (total or 0), 0.0
    capped = -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        r = table.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("taken"),
                      F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("open"),
                      F.sum(over.cast("long")).alias("n")).first()
        if r["n"] is None or not r["open"]:
            break
        level = max(0.0, wanted - r["taken"]) / r["open"]
        if r["n"] == capped:
            break
        capped = r["n"]
    target = F.least(F.col("cap"), F.col("weight") * F.lit(level))
    return table.select("source", "n", "source_size", target.alias("target"))


def copies(sized: DataFrame, targets: DataFrame, block_rows: int = BLOCK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """(row, source_size, target, copies) of rows (row, id, source, size)."""
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # numbers a hair from a whole one are whole
    whole = F.floor(ratio + F.lit(SNAP))
    rate = targets.select(
        F.col("source").alias("_s"), "n", "source_size", "target", whole.cast("int").alias("whole"),
        F.greatest(ratio - whole, F.lit(0.0)).alias("p"))
    # a source's rows follow each other, so they are dealt evenly, equal ones too
    dealt = positioned(sized, ["source", F.xxhash64("id", "source", "size"), "id", "size", "row"], "_place")
    rows = dealt.join(rate, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    blocks = F.greatest(F.ceil(F.col("n") / block_rows), F.lit(1)).cast("long")
    rows = materialize(rows.withColumn("block", F.pmod("_place", blocks))
                       .withColumn("order", F.xxhash64(F.lit(1), "id", "source", "size")).drop("id", "_place"))

    largest = targets.agg(F.max("n")).first()[0] or 0
    n_blocks = max(1, -(-largest // block_rows))
    flying = rows.select("source", "block", "row", "order", "size", "p")
    decided: DataFrame | None = None
    round_no = 0
    while True:
        last = n_blocks == 1
        now = materialize(_flight(flying, last, round_no))
        settled = now.where("p = 0 or p = 1").select("row", F.col("p").alias("extra"))
        decided = settled if decided is None else decided.union(settled)
        if last:
            break
        flying = now.where("p > 0 and p < 1").withColumn("block", F.floor(F.col("block") / fan_in))
        n_blocks = -(-n_blocks // fan_in)
        round_no += 1
    return rows.join(decided, "row").select(
        "row", "source_size", "target", (F.col("whole") + F.col("extra")).cast("int").alias("copies"))


def _flight(flying: DataFrame, last: bool, round_no: int) -> DataFrame:
    """One flight of every (source, block); the last one also lands.

    A block has at most a thousand rows at any input size: the number of blocks
    of a source follows its number of rows, repeated rows or not.
    """
    def flown(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "order", "p", "row"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
        size = pdf["size"].to_numpy()
        seed = [round_no, int(pdf["block"].iloc[0]), len(pdf), *(int(x) & 0xffffffff for x in pdf["order"].iloc[:3])]
        rng = np.random.default_rng(seed)
        p = fly(pdf["p"].to_numpy(float), size, rng)
        pdf["p"] = land(p, size, rng) if last else p
        return pdf

    return flying.groupBy("source", "block").applyInPandas(flown, flying.schema)


def mix(docs: DataFrame, id_col: str = "doc_id", size_col: str = "size", source_col: str = "source",
        out: str = "mix", weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        max_ratio: float = MAX_RATIO) -> DataFrame:
    """Add the struct ``out`` (size, source_size, target, copies) to every row.

    The rows are written once with a row number; sampling sees ids, sources
    and sizes only. :func:`repeat_rows` applies the copies.
    """
    marked = materialize(without(docs, out).withColumn("_row", F.monotonically_increasing_id()))
    sized = marked.select(F.col("_row").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                          F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("size"))
    targets = materialize(source_targets(sized, weights, share, max_ratio))
    chosen = copies(sized, targets).withColumnRenamed("row", "_row_of")
    joined = marked.join(chosen, F.col("_row") == F.col("_row_of"))
    size = F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("size")
    kept = [marked[c] for c in marked.columns if c != "_row"]
    return joined.select(*kept, F.struct(size, chosen["source_size"], chosen["target"], chosen["copies"]).alias(out))


def repeat_rows(docs: DataFrame, n: Column) -> DataFrame:
    """Each row ``n`` times; rows with n of 0 go."""
    return (docs.withColumn("_copy", n).where("_copy > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), "_copy"))).drop("_copy"))
