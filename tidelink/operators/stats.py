"""Exact rank statistics without sorting or gathering groups: order statistics
by distributed selection, median, MAD, leave-one-out MAD.

A group's wanted places are found by refining value histograms: a cell (a
range of values of a group) is cut into ``BINS`` bins by one partial
aggregation, bins that hold a wanted place become the next cells, and a cell
of one value or of at most ``CELL`` rows is read off. No rows are ranked or
written in order, and a group of any size is only ever counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelink.session import materialize

BINS = 512  # of one cell in one pass
CELL = 1024  # rows of a cell that are sorted in memory
_INF = float("inf")


def _facts() -> list[Column]:
    """Rows, ends and finite ends of a cell."""
    x = F.col("_x")
    finite = F.when((x > -_INF) & (x < _INF), x)
    return [F.count(F.lit(1)).alias("_n"), F.min(x).alias("_lo"), F.max(x).alias("_hi"),
            F.min(finite).alias("_flo"), F.max(finite).alias("_fhi")]


def _bin() -> Column:
    """The bin of a value: never falls as values rise, and a cell's least and
    greatest values fall apart. Halves keep wide ranges from overflowing."""
    x, lo, hi = F.col("_x"), F.col("_flo"), F.col("_fhi")
    share = F.try_divide(x / 2 - lo / 2, hi / 2 - lo / 2)
    inner = F.least(F.lit(BINS - 2), F.coalesce(F.floor(share * (BINS - 1)), F.lit(0)))
    return (F.when(F.isnan(x), F.lit(BINS + 1)).when(x == _INF, F.lit(BINS)).when(x == -_INF, F.lit(-1))
            .when(x == hi, F.lit(BINS - 1)).otherwise(inner).cast("int"))


def order_statistics(df: DataFrame, by: Sequence[str], value: str, places: dict[str, Column]) -> DataFrame:
    """Per group of non-null values: the value (double) at each place.

    ``places`` names 1-based places as expressions over ``_n``, the group's
    number of values; a place outside 1.._n is null. Null keys form groups;
    NaN is the greatest value. Each pass narrows a cell to a bin, so the
    passes depend on the spread of the values, not on the rows.
    """
    by, names = list(by), list(places)
    data = materialize(df.where(F.col(value).isNotNull())
                       .select(F.struct(*by).alias("_g"), F.col(value).cast("double").alias("_x")))
    whole = data.groupBy("_g").agg(*_facts()).withColumn("_places", F.array(*[p.cast("long") for p in places.values()]))
    groups = cells = materialize(whole.withColumn("_before", F.lit(0).cast("long")))
    shut = (F.col("_lo") == F.col("_hi")) | (F.col("_n") <= CELL)
    closed = cells.where(shut)
    inside = F.col("_x").between(F.col("_lo"), F.col("_hi"))
    while not (wide := cells.where(~shut)).isEmpty():
        bins = (data.join(wide.drop("_n"), "_g").where(inside)
                .groupBy("_g", "_places", "_before", _bin().alias("_bin")).agg(*_facts()))
        earlier = Window.partitionBy("_g", "_before").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # BINS + 3 rows
        bins = bins.withColumn("_before", F.col("_before") + F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_bin")
        wanted = F.exists("_places", lambda p: (p > F.col("_before")) & (p <= F.col("_before") + F.col("_n")))
        cells = materialize(bins.where(wanted))
        closed = closed.unionByName(cells.where(shut))
    few = closed.where("_lo != _hi").select("_g", "_before", "_lo", "_hi")
    listed = (data.join(few, "_g").where(inside).groupBy("_g", "_before")
              .agg(F.sort_array(F.collect_list("_x")).alias("_values")))  # at most CELL values
    found = (closed.join(listed, ["_g", "_before"], "left")
             .select("_g", "_before", "_n", "_lo", "_values", F.posexplode("_places").alias("_k", "_p"))
             .where("_p > _before and _p <= _before + _n")
             .select("_g", "_k", F.coalesce(F.get("_values", (F.col("_p") - F.col("_before") - 1).cast("int")),
                                            F.col("_lo")).alias("_v")))
    wide_rows = found.groupBy("_g").agg(*[F.max(F.when(F.col("_k") == k, F.col("_v"))).alias(n) for k, n in enumerate(names)])
    return (groups.select("_g", "_n").join(wide_rows, "_g", "left")
            .select(*[F.col("_g")[c].alias(c) for c in by], "_n", *names))


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on keys, nulls as values; the left keys stay."""
    named = right.select(*[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)]
    return left.join(named, on, how).drop(*[f"_r{i}" for i in range(len(keys))])


# The values around a group's middle; leaving a row out shifts the middle by one.
_MIDDLE = ("_q1", "_q2", "_q3")


def _middle(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return order_statistics(df, by, value, {q: F.floor(F.col("_n") / 2) + k for k, q in enumerate(_MIDDLE)})


def _loo_median(x: Column) -> Column:
    """Median of the group without one row of value ``x`` (uses _n, _q1.._q3).

    The middle of the other n - 1 values sits at n // 2 (and n // 2 + 1 when
    n - 1 is even); places at and behind the row move down by one. Where
    ``x`` equals a middle value, leaving out either gives the same values.
    """
    first = F.when(x > F.col("_q1"), F.col("_q1")).otherwise(F.col("_q2"))
    second = F.when(x > F.col("_q2"), F.col("_q2")).otherwise(F.col("_q3"))
    return (F.when(F.col("_n") <= 1, F.lit(None).cast("double"))
             .when(F.col("_n") % 2 == 0, first).otherwise((first + second) / 2))


def _median(df: DataFrame, keys: Sequence[str], val: str, out: str) -> DataFrame:
    """Exact (interpolated) median per group; null values ignored."""
    n = F.col("_n")
    ends = order_statistics(df, keys, val, {"_a": F.floor((n + 1) / 2), "_b": F.floor(n / 2) + 1})
    return ends.select(*keys, ((F.col("_a") + F.col("_b")) / 2).alias(out))


def mad(df: DataFrame, by: Sequence[str], x: str, out: str = "mad") -> DataFrame:
    """A2: median absolute deviation per group; nulls ignored, all-null -> null."""
    by = list(by)
    groups = df.select(*by).distinct()
    med = _median(df, by, x, "_med")
    dev = (_same(df.where(F.col(x).isNotNull()), med, by)
           .select(*by, F.abs(F.col(x).cast("double") - F.col("_med")).alias("_dev")))
    return _same(groups, _median(dev, by, "_dev", out), by, "left").select(*by, out)


def leave_one_out_mad(df: DataFrame, by: Sequence[str], id_col: str, x: str,
                      out: str = "loo_mad") -> DataFrame:
    """For every row, the MAD of the *other* rows of its group.

    Step 1: the leave-one-out median ``c`` of each row from three order
    statistics of the group (so at most three distinct ``c`` per group).
    Step 2: for each distinct ``c`` the same three statistics of all
    deviations |x - c|, read at the row's own deviation.
    Output has one row per input row; a null ``x`` is no other row of any
    and its own value is null, as is that of a group's only row.
    """
    by = list(by)
    base = df.select(*by, id_col, x)
    value = F.col(x).cast("double")
    centred = (_same(base, _middle(base, by, x), by, "left")
               .withColumn("_c", F.when(value.isNotNull(), _loo_median(value))).drop("_n", *_MIDDLE))
    centred = materialize(centred)
    centres = centred.where(F.col("_c").isNotNull()).select(*by, "_c").distinct()
    dev = F.abs(value - F.col("_c"))
    stats = _middle(_same(base, centres, by).select(*by, "_c", dev.alias("_d")), by + ["_c"], "_d")
    return (_same(centred.withColumn("_d", dev), stats, by + ["_c"], "left")
            .select(*by, id_col, x, _loo_median(F.col("_d")).alias(out)))


def mode_with_ties(df: DataFrame, by: Sequence[str], value: str, out: str = "mode",
                   sep: str = "|") -> DataFrame:
    """All most frequent non-null values, sorted and joined by ``sep``.

    Counts are partial-aggregated per (group, value); only the tied winners
    of a group are joined into the output string.
    """
    by = list(by)
    groups = df.select(*by).distinct()
    counts = (df.where(F.col(value).isNotNull())
                .groupBy(*by, value).agg(F.count(F.lit(1)).alias("_k")))
    top = (counts.join(counts.groupBy(*by).agg(F.max("_k").alias("_max")), by)
                 .where(F.col("_k") == F.col("_max")))
    joined = top.withColumn("_s", F.col(value).cast("string")).groupBy(*by).agg(
        F.expr(f"listagg(_s, '{sep}') WITHIN GROUP (ORDER BY _s)").alias(out))
    return groups.join(joined, by, "left")


def unique_values(df: DataFrame, by: Sequence[str], cols: Sequence[str], out: str = "values",
                  sep: str = "|") -> DataFrame:
    """Distinct non-null values of one or more columns, sorted and joined.

    Values are deduplicated per (group, value) before the string is built;
    null only if the group has no non-null value.
    """
    by = list(by)
    groups = df.select(*by).distinct()
    vals = (df.select(*by, F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias("_v"))
              .where(F.col("_v").isNotNull()).distinct())
    agg = vals.groupBy(*by).agg(F.expr(f"listagg(_v, '{sep}') WITHIN GROUP (ORDER BY _v)").alias(out))
    return groups.join(agg, by, "left")


def flatten_values(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (),
                   drop_pattern: str | None = None, restrict_pattern: str | None = None,
                   out: str = "value") -> DataFrame:
    """Many columns -> one long column of strings, optionally filtered.

    ``drop_pattern`` removes values matching it; ``restrict_pattern`` keeps
    only values matching it. Nulls are dropped.
    """
    long = df.select(*keep, F.explode(F.array(*[F.col(c).cast("string") for c in cols])).alias(out))
    long = long.where(F.col(out).isNotNull())
    if drop_pattern:
        long = long.where(~F.col(out).rlike(drop_pattern))
    if restrict_pattern:
        long = long.where(F.col(out).rlike(restrict_pattern))
    return long


# Fixed values that must equal the reference's: number-like and integer-like text.
NUMBER_LIKE = r"^-?\d+(\.\d+)?(e[+-]?\d+)?$"
INTEGER_LIKE = r"^-?\d+$"


def column_type_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column, whether every non-empty trimmed value is number-like
    and integer-like. Numeric columns are number-like; integer columns are
    integer-like. An all-empty text column is number-like but not int-like.

    One aggregation pass over the table; output has one row per column.
    """
    from pyspark.sql import types as T
    cols = list(cols or df.columns)
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)
    aggs: list[Column] = []
    for c in cols:
        t = dtypes[c]
        if isinstance(t, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            num, intl = F.lit(True), F.lit(True)
        elif isinstance(t, T.NumericType):
            num = F.lit(True)
            intl = F.coalesce(F.bool_and(F.col(c).isNull() | (F.col(c) == F.floor(F.col(c)))), F.lit(True))
        else:
            v = F.trim(F.col(c).cast("string"))
            nonempty = v.isNotNull() & (v != "")
            num = F.coalesce(F.bool_and(F.when(nonempty, v.rlike(NUMBER_LIKE))), F.lit(True))
            intl = F.coalesce(F.bool_and(F.when(nonempty, v.rlike(INTEGER_LIKE))), F.lit(False))
            any_val = F.max(nonempty.cast("int")) == 1
            intl = F.when(any_val, intl).otherwise(F.lit(False))
        aggs += [num.alias(f"{c}__num"), intl.alias(f"{c}__int")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__num`, `{c}__int`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, is_numeric_like, is_int_like)")
