"""Skew-safe ordered scans: ranks and running values within groups.

A plain ``Window.partitionBy(group).orderBy(...)`` puts a whole group into
one task. Here rows are always range-partitioned by (group, order), at any
size, so a group with a third of all rows is spread over many range parts;
each (group, part) block is scanned on its own, and what a block needs from
earlier parts of its group (sums, minima, last values) is carried from a
summary of one row per (group, part).

The parts are written once (a stage in the shared folder) before they are
read: a range exchange may be coalesced differently for each consumer, so
a part number holds only once it is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelink.session import materialize

PART = "_part"
_POSITION = "_position"
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row number below


def _keys(columns: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def range_parts(df: DataFrame, group: Sequence[str], order: Sequence) -> DataFrame:
    """Rows range-partitioned by (group, order), each with its part."""
    ranged = df.repartitionByRange(*_keys([*group, *order]))
    return materialize(ranged.withColumn(PART, F.spark_partition_id()))


def _carried(summary: DataFrame, group: Sequence[str], cols: dict) -> DataFrame:
    """Values from the earlier parts of a group, over its few summary rows."""
    w = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    for name, fn in cols.items():
        summary = summary.withColumn(name, fn(w))
    return summary


def positioned(df: DataFrame, order: Sequence, out: str = _POSITION) -> DataFrame:
    """0-based position of each row in the whole table's ``order`` (a total
    order), as a long.

    Rows are sorted inside their range part and numbered as they are written.
    The sizes of the parts, one number a part of the exchange, are added up on
    the driver and go back as a constant, so no row meets a window or a join.
    """
    keys = _keys(order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    part = F.shiftright("_mid", _ROW_BITS).cast("int")
    sizes = dict(rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n")).collect())
    before = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0)))]
    offsets = F.split(F.lit(",".join(map(str, before))), ",").cast("array<long>")
    row = F.col("_mid").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.withColumn(out, F.get(offsets, part) + row).drop("_mid")


def ranked(df: DataFrame, group: Sequence[str], order: Sequence, out: str = "_rank") -> DataFrame:
    """``row_number()`` over (partition by group order by order), as a long.

    ``order`` must be a total order within each group (add a unique key). A
    group's rows follow each other in the whole table's order, so a rank is a
    position less the group's first one.
    """
    group = list(group)
    rows = positioned(df, [*group, *order])
    if not group:
        return rows.withColumn(out, F.col(_POSITION) + 1).drop(_POSITION)
    names = [f"_g{i}" for i in range(len(group))]
    first = rows.groupBy(*[F.col(g).alias(n) for g, n in zip(group, names)]).agg(F.min(_POSITION).alias("_first"))
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names)]
    return (rows.join(first, same).withColumn(out, F.col(_POSITION) - F.col("_first") + 1)
            .drop(_POSITION, "_first", *names))


def running_sum_min(df: DataFrame, group: Sequence[str], order: Sequence, delta: str) -> DataFrame:
    """Per group in order: ``_s`` = running sum of ``delta``; ``_m`` = running
    minimum of least(0, _s); ``_m_prev`` = ``_m`` before the row (0 first).

    Carried per part: the sum of earlier parts and the minimum of their
    prefix sums. The result keeps ``_part``.
    """
    group = list(group)
    parts = range_parts(df, group, order)
    block = Window.partitionBy(*group, PART).orderBy(*order)
    run = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = parts.withColumn("_ls", F.sum(delta).over(run)).withColumn("_lmin", F.min("_ls").over(run))
    summary = local.groupBy(*group, PART).agg(F.sum(delta).alias("_tot"), F.min("_ls").alias("_pmin"))
    carried = _carried(summary, group, {"_s_in": lambda w: F.coalesce(F.sum("_tot").over(w), F.lit(0))})
    carried = carried.withColumn("_x", F.col("_s_in") + F.col("_pmin"))
    carried = _carried(carried, group, {
        "_m_in": lambda w: F.least(F.lit(0), F.coalesce(F.min("_x").over(w), F.lit(0)))})
    j = local.join(carried.select(*group, PART, "_s_in", "_m_in"), [*group, PART])
    return (j.withColumn("_s", F.col("_s_in") + F.col("_ls"))
            .withColumn("_m", F.least(F.col("_m_in"), F.col("_s_in") + F.col("_lmin")))
            .withColumn("_m_prev", F.coalesce(F.lag("_m").over(block), F.col("_m_in")))
            .drop("_ls", "_lmin", "_s_in", "_m_in"))


def previous_in_level(df: DataFrame, group: Sequence[str], level: str, order: Sequence, value: str,
                      out: str = "_prev") -> DataFrame:
    """``lag(value)`` over (partition by group, level order by order) on data
    that carries ``_part`` from a range partitioning by (group, order).

    Inside a part the previous row of the same level is a local ``lag``; the
    first row of a level in a part takes the last value of that level from
    earlier parts (carried over the small (group, level, part) summary).
    """
    group = list(group)
    wl = Window.partitionBy(*group, PART, level).orderBy(*order)
    local = df.withColumn(out, F.lag(value).over(wl)).withColumn("_first", F.lag(F.lit(1)).over(wl).isNull())
    last = df.groupBy(*group, level, PART).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    carry = _carried(last, [*group, level], {
        "_carry": lambda w: F.last("_last", ignorenulls=True).over(w)}).drop("_last")
    return (local.join(carry, [*group, level, PART], "left")
                 .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col(out)))
                 .drop("_first", "_carry"))


def surrounding(df: DataFrame, group: Sequence[str], keys: Sequence[Column], value: Column, before: str,
                after: str) -> DataFrame:
    """For every row, ordered by ``keys`` within its group: the last non-null
    ``value`` up to it and the first non-null one from it on.

    Both come from one range write; what a part needs from the parts on either
    side is carried from a summary of one row per (group, part).
    """
    group = list(group)
    names = [f"_k{i}" for i in range(len(keys))]
    d = df.withColumn("_v", value)
    for name, k in zip(names, keys):
        d = d.withColumn(name, k)
    parts = range_parts(d, group, names)
    block = Window.partitionBy(*group, PART).orderBy(*names)
    local = (parts.withColumn(before, F.last("_v", ignorenulls=True).over(block.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn(after, F.first("_v", ignorenulls=True).over(block.rowsBetween(0, Window.unboundedFollowing))))
    place = F.when(F.col("_v").isNotNull(), F.struct(*names))
    ends = parts.groupBy(*group, PART).agg(F.max_by("_v", place).alias("_plast"), F.min_by("_v", place).alias("_pfirst"))
    over = Window.partitionBy(*group).orderBy(PART)
    carry = ends.select(
        *group, PART, F.last("_plast", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_b"),
        F.first("_pfirst", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_a"))
    return (local.join(carry, [*group, PART], "left")
            .withColumn(before, F.coalesce(before, "_b")).withColumn(after, F.coalesce(after, "_a"))
            .drop("_v", "_a", "_b", PART, *names))
