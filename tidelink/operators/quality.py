"""Linkage-quality metrics and data-quality checks (A7-A9, J9, §2.11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    """Raised by :func:`quarantine` in strict mode."""


def quarantine(df: DataFrame, checks: dict[str, Column], strict: bool = False,
               examples: int = 5) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad); ``checks`` maps a reason to a predicate
    that is true for *valid* rows. Bad rows carry the first failed reason.

    ``strict=True`` reproduces the reference's abort: it raises with the
    number of offending rows and a few examples.
    """
    reason = None
    for name, ok in checks.items():
        cond = ~F.coalesce(ok, F.lit(False))
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    tagged = df.withColumn("reason", reason)
    good = tagged.where(F.col("reason").isNull()).drop("reason")
    bad = tagged.where(F.col("reason").isNotNull())
    if strict:
        refuse(bad, examples)
    return good, bad


def refuse(bad: DataFrame, examples: int = 5) -> None:
    """Strict mode: raise if a quarantine table has rows."""
    n = bad.count()
    if n:
        ex = [r.asDict() for r in bad.limit(examples).collect()]
        raise DataQualityError(f"{n} rows fail checks, e.g. {ex}")


class Observed:
    """Counts and one example of every failed check, collected while the rows
    that are checked are written: strict mode without a second pass."""

    def __init__(self, *reasons: str):
        self.reasons, self._seen = reasons, Observation()

    def on(self, df: DataFrame, reason: Column, example: Column) -> DataFrame:
        """``df``, watched; ``reason`` is null for rows that are sound."""
        metrics = []
        for k, name in enumerate(self.reasons):
            hit = reason == name
            metrics += [F.count_if(hit).alias(f"n{k}"), F.min(F.when(hit, example.cast("string"))).alias(f"x{k}")]
        return df.observe(self._seen, *metrics)

    def counts(self) -> dict[str, int]:
        """Failed rows by reason; waits for the write."""
        got = self._seen.get
        return {name: got[f"n{k}"] for k, name in enumerate(self.reasons)}

    def refuse(self) -> None:
        """Raise if a check has failed."""
        got = self._seen.get
        bad = [f"{got[f'n{k}']} x {name}, e.g. {got[f'x{k}']!r}" for k, name in enumerate(self.reasons) if got[f"n{k}"]]
        if bad:
            raise DataQualityError("rows fail checks: " + "; ".join(bad))


def flag_membership(df: DataFrame, key: str, **sets: DataFrame) -> DataFrame:
    """One boolean column per named set: is ``key`` in the set's column?

    Each set is a one-column DataFrame of keys; it is deduplicated, then
    attached by a left join (an existence join, no IN-list on the driver).
    """
    out = df
    for name, s in sets.items():
        k = s.columns[0]
        flags = s.select(F.col(k).alias(key)).where(F.col(key).isNotNull()).distinct() \
                 .withColumn(name, F.lit(True))
        out = out.join(flags, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))
    return out


def contingency(df: DataFrame, key: str, a: str, b: str, out: str = "proportion") -> DataFrame:
    """Distinct (key, a, b) -> share of keys in each of the 2x2 cells.

    Empty cells are present with 0. The grid is a 4-row literal table.
    """
    spark: SparkSession = df.sparkSession
    from pyspark.sql import Window
    d = df.select(key, a, b).distinct()
    counts = d.groupBy(a, b).agg(F.count(F.lit(1)).alias("_n"))
    grid = spark.createDataFrame([(x, y) for x in (False, True) for y in (False, True)], f"{a} boolean, {b} boolean")
    n = F.coalesce(F.col("_n"), F.lit(0))
    # the total is a window over the 4-row grid, not over the data
    return (F.broadcast(grid).join(counts, [a, b], "left")
                .select(a, b, (n / F.sum(n).over(Window.partitionBy())).alias(out)))


def recovery_rate(files: DataFrame, merged: DataFrame, path: str = "path", start: str = "start_time",
                  merged_path: str = "file_esense", merged_row: str = "row_mirage",
                  merged_date: str = "date", per_file: bool = False) -> DataFrame:
    """100 * matched / all over file rows dated up to the last merged day.

    As in the reference the unit is joined rows (zones x matches per file,
    N9); ``per_file=True`` counts each file once instead.
    """
    j = (files.select(path, F.date_trunc("day", start).alias("_date_file"))
              .join(merged.select(F.col(merged_path).alias(path), merged_row, F.col(merged_date).alias("_date_m")),
                    path, "left")
              .withColumn("_match", F.when(F.col(merged_row).isNull(), 0).otherwise(1)))
    cutoff = j.agg(F.max("_date_m")).scalar()
    j = j.where(F.col("_date_file") <= cutoff)
    if per_file:
        j = j.groupBy(path).agg(F.max("_match").alias("_match"))
    return j.agg((F.lit(100) * F.sum("_match") / F.count(F.lit(1))).alias("pct_recovery"))


def pct_linked(markers: DataFrame, unlinked: DataFrame, cells: DataFrame,
               on: Sequence[str] = ("year", "month")) -> DataFrame:
    """Per layout cell, round(100 * (1 - unlinked/all markers), 2);
    null when the month has no markers. The denominator spans all
    categories of the month, as in the reference."""
    on = list(on)
    tot = markers.groupBy(*on).agg(F.count(F.lit(1)).alias("_all"))
    unl = unlinked.groupBy(*on).agg(F.count(F.lit(1)).alias("_unl"))
    pct = F.round(F.lit(100) * (F.lit(1) - F.coalesce(F.col("_unl"), F.lit(0)) / F.col("_all")), 2)
    return (cells.join(tot, on, "left").join(unl, on, "left")
                 .withColumn("pct_mirage_linked", F.when(F.col("_all") > 0, pct))
                 .drop("_all", "_unl"))
