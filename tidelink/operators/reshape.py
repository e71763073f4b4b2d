"""Projection, reshape, set and id operators (P*, U*, W6-W8, A3)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelink.operators.scan import ranked


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def dense_ids(df: DataFrame, order: Sequence, bucket: Sequence[str] | None = None,
              id_col: str = "id") -> DataFrame:
    """Global 1..n ids (long) following ``bucket`` then ``order``.

    Rows are sorted inside range parts and numbered as they are written; an
    id is a row's number in its part plus the sizes of the earlier parts. No
    window holds the table or a group of it, whatever their sizes.
    """
    return ranked(df, [], [*(bucket or []), *order], out=id_col)


def distinct_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """A3: row dedup (map-side partial dedup happens before the shuffle)."""
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def union_all_by_name(*dfs: DataFrame) -> DataFrame:
    """Stack frames by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct_by_name(*dfs: DataFrame) -> DataFrame:
    """Stack by name and remove duplicates."""
    return union_all_by_name(*dfs).distinct()


def insert_by_name(target: DataFrame, rows: DataFrame) -> DataFrame:
    """Append rows to a result by column name (target's columns)."""
    return target.unionByName(rows.select(*target.columns))


def project_rename(df: DataFrame, mapping: dict[str, str] | Sequence[str]) -> DataFrame:
    """Select (and rename) in the given order."""
    if isinstance(mapping, dict):
        return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])
    return df.select(*mapping)


def all_except(df: DataFrame, *drop: str) -> DataFrame:
    """``SELECT * EXCEPT (...)``."""
    return df.drop(*drop)


def all_replace(df: DataFrame, **exprs: Column) -> DataFrame:
    """``SELECT * REPLACE (expr AS col)`` keeping column positions."""
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def columns_like(df: DataFrame, pattern: str) -> list[str]:
    """``COLUMNS('regex')`` - names matching a pattern, in table order."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def select_by_pattern(patterns: Sequence[str], pool: Sequence[str]) -> list[str]:
    """Names matching any pattern, grouped in pattern order."""
    out: list[str] = []
    for p in patterns:
        rx = re.compile(p)
        out.extend(c for c in pool if rx.search(c))
    return out


def null_drop(df: DataFrame, *cols: str) -> DataFrame:
    """Drop failed (null) branch outputs."""
    return df.dropna(subset=list(cols)) if cols else df.dropna(how="all")


def unpivot_non_null(df: DataFrame, ids: Sequence[str], values: Sequence[str],
                     name_col: str, value_col: str) -> DataFrame:
    """Wide -> long; like SQL UNPIVOT, rows with a NULL value are dropped.

    ``DataFrame.unpivot`` keeps NULL values, so the filter is explicit.
    """
    return (df.unpivot(list(ids), list(values), name_col, value_col)
              .where(F.col(value_col).isNotNull()))


def pivot_first(df: DataFrame, ids: Sequence[str], name_col: str, names: Sequence[str],
                values: Sequence[str] | str) -> DataFrame:
    """P8c/P8d: long -> wide with a fixed name list (no extra pass to find names).

    With one value column the output columns are the names; with several,
    ``<value>_<name>``.
    """
    values = _cols(values)
    aggs = [F.first(v, ignorenulls=True).alias(v) for v in values]
    out = df.groupBy(*ids).pivot(name_col, list(names)).agg(*aggs)
    if len(values) == 1:
        return out
    ren = {f"{n}_{v}": f"{v}_{n}" for n in names for v in values}
    return out.select(*[F.col(c).alias(ren.get(c, c)) for c in out.columns])


def explode_path(df: DataFrame, path_col: str, root: str | None = None,
                 out_col: str = "component", pos_col: str = "pos") -> DataFrame:
    """Path below ``root`` -> one row per component, numbered from 1."""
    p = F.col(path_col)
    if root:
        p = F.replace(p, F.lit(root), F.lit(""))
    parts = F.filter(F.split(p, "/"), lambda x: x != "")
    return (df.select("*", F.posexplode(parts).alias("_pos", out_col))
              .withColumn(pos_col, (F.col("_pos") + 1).cast("int")).drop("_pos"))


def split_multi(df: DataFrame, col: str, sep: str = "\t", win_col: str = "id_win") -> DataFrame:
    """One row per piece of a joined label, ``id_win`` = 1..n."""
    return (df.select("*", F.posexplode(F.split(F.col(col), sep)).alias("_p", "_piece"))
              .withColumn(col, F.col("_piece"))
              .withColumn(win_col, (F.col("_p") + 1).cast("int"))
              .drop("_p", "_piece"))


def sample_by_hash(df: DataFrame, key: str, n: int, seed: int = 0xABBA) -> DataFrame:
    """Deterministic seeded sample of ``n`` rows without replacement.

    A limit is the feature here (test mode). The top-n by a seeded hash is a
    per-partition top-k followed by a merge of n rows per partition. The hash
    is the MD5 of ``key#seed``; equal keys follow the other columns.
    """
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(f"#{seed}")))
    return df.orderBy(h, key, *[c for c in df.columns if c != key]).limit(n)


def keep_known(df: DataFrame, known: DataFrame, on) -> DataFrame:
    """P5: rows whose key exists in ``known`` (left semi join)."""
    return df.join(known, on, "left_semi")


def month_partitions(df: DataFrame, year: str = "year", month: str = "month",
                     id_col: str = "id") -> DataFrame:
    """Distinct non-null (year, month) with the number of member ids.

    The reference carries the id list inside each descriptor; here the
    members stay a long table (:func:`month_members`) so no month is ever
    gathered into one value.
    """
    return (df.where(F.col(year).isNotNull() & F.col(month).isNotNull())
              .groupBy(year, month)
              .agg(F.count_distinct(id_col).alias("n_ids"),
                   F.min(id_col).alias("first_id"), F.max(id_col).alias("last_id")))


def month_members(df: DataFrame, year: str = "year", month: str = "month",
                  id_col: str = "id") -> DataFrame:
    """The (year, month, id) membership in long form."""
    return (df.where(F.col(year).isNotNull() & F.col(month).isNotNull())
              .select(year, month, id_col).distinct())


def first_by_priority(rows: DataFrame, by: Sequence[str], value: str | Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Per group the non-null ``value`` that comes first in ``order``;
    groups without one are left out. A partial aggregation, no group is held.

    With several columns, each holds (at, value) structs or nulls and gets its
    own first value by ``at``; all of them take one shuffle of wide rows.
    """
    if isinstance(value, str):
        return rows.where(F.col(value).isNotNull()).groupBy(*by).agg(F.min_by(value, F.struct(*order)).alias(value))
    first = rows.groupBy(*by).agg(*[F.min(v).alias(v) for v in value])
    return first.select(*by, *[F.col(v)["value"].alias(v) for v in value])


def fill_groups(df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Sequence[str], few: bool = False) -> DataFrame:
    """In every row, ``columns`` become their group's first non-null value
    in ``order``: an aggregate joined back, not a window over the group. Where
    no group can have more than a ``few`` rows, a window takes one shuffle."""
    if few:
        whole = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return df.select(*[F.first(c, ignorenulls=True).over(whole).alias(c) if c in columns else F.col(c) for c in df.columns])
    first = df.groupBy(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)]).agg(*[
        F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_f{i}") for i, c in enumerate(columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)]
    filled = {c: F.col(f"_f{i}") for i, c in enumerate(columns)}
    return df.join(first, same, "left").select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])


def first_seen_values(df: DataFrame, by: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The distinct non-null values of one or more columns of each group,
    in the order in which they are first seen: by ``order`` (a total order of
    a group's rows), then from the first column to the last.

    A long table (by, position from 1, value): a group with any number of
    values is rows, not one string.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(c).cast("string").alias("v")) for k, c in enumerate(columns)]))
    seen = (df.select(*by, F.struct(*order).alias("_at"), cells.alias("_c")).where(F.col("_c.v").isNotNull())
            .groupBy(*by, F.col("_c.v").alias("value")).agg(F.min(F.struct("_at", "_c.k")).alias("_at")))
    return ranked(seen, by, ["_at"], "position").drop("_at")
