"""Queries over reshape, set, id, sampling and profile operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelink.operators import reshape as R
from tidelink.operators import stats as ST
from tidelink.plans.registry import query
from tidelink.sources.tables import table

TOP_N = 100


@query("dense_ids", """
SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS INTEGER) AS id FROM orders""")
def q_dense_ids(spark, sf_dir):
    """Global 1..n ids by (order date, key); buckets = months, no single-task window."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate",
                                             F.date_trunc("month", "o_orderdate").alias("_m"))
    return R.dense_ids(o, ["o_orderdate", "o_orderkey"], bucket=["_m"]).select("o_orderkey", "id")


@query("sort_output", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey")
def q_sort_output(spark, sf_dir):
    """sort_output: a total order at the sink (range-partitioned sort)."""
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey") \
        .orderBy("o_custkey", "o_orderdate", "o_orderkey")


@query("limit_n", f"""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT {TOP_N}""")
def q_limit_n(spark, sf_dir):
    """limit_n/top1: a top-k report (per-partition top-k, then merge)."""
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice") \
        .orderBy(F.desc("o_totalprice"), "o_orderkey").limit(TOP_N)


@query("top1", "SELECT max(l_shipdate) AS last_ship, min(l_shipdate) AS first_ship FROM lineitem")
def q_top1(spark, sf_dir):
    """A6/top1: ORDER BY ... LIMIT 1 as a max/min aggregate."""
    return table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate").alias("last_ship"),
                                                F.min("l_shipdate").alias("first_ship"))


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf_dir):
    """A3: row dedup (partial dedup before the shuffle)."""
    return R.distinct_rows(table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus"))


@query("union_all_by_name", """
SELECT o_orderkey AS k, o_orderdate AS d, NULL::INTEGER AS l_linenumber, 'o' AS src FROM orders
UNION ALL SELECT l_orderkey, l_shipdate, l_linenumber, 'l' FROM lineitem""")
def q_union_all_by_name(spark, sf_dir):
    """Stack by column name, missing columns null."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("d"),
                                             F.lit("o").alias("src"))
    li = table(spark, sf_dir, "lineitem").select(F.lit("l").alias("src"), F.col("l_linenumber"),
                                                F.col("l_shipdate").alias("d"), F.col("l_orderkey").alias("k"))
    return R.union_all_by_name(o, li)


@query("union_distinct_by_name", """
SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders
UNION SELECT l_orderkey, CAST(l_shipdate AS DATE) FROM lineitem""")
def q_union_distinct_by_name(spark, sf_dir):
    """Stack by name and remove duplicates."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("d"))
    li = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("d"), F.col("l_orderkey").alias("k"))
    return R.union_distinct_by_name(o, li)


@query("insert_by_name", """
SELECT n_nationkey, n_name FROM nation UNION ALL SELECT r_regionkey + 100, r_name FROM region""")
def q_insert_by_name(spark, sf_dir):
    """Append rows into a result by the target's column names."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    r = table(spark, sf_dir, "region").select(F.col("r_name").alias("n_name"),
                                             (F.col("r_regionkey") + 100).alias("n_nationkey"))
    return R.insert_by_name(n, r)


@query("sample_files", "SELECT page_id, url FROM pages ORDER BY md5(url || '#43962'), url, page_id LIMIT 20")
def q_sample_files(spark, sf_dir):
    """Seeded sample of page paths without replacement (hash order)."""
    return R.sample_by_hash(table(spark, sf_dir, "pages").select("page_id", "url"), "url", 20)


@query("sample_rows", f"SELECT * FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '#7') LIMIT {TOP_N}")
def q_sample_rows(spark, sf_dir):
    """P10: preview of random rows (seeded)."""
    return R.sample_by_hash(table(spark, sf_dir, "orders"), "o_orderkey", TOP_N, seed=7)


@query("keep_known_sessions", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def q_keep_known_sessions(spark, sf_dir):
    """P5: keep rows whose key is known (left semi join)."""
    known = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("o_custkey"))
    return R.keep_known(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), known, "o_custkey")


@query("project_rename", "SELECT o_orderkey AS id, o_orderstatus AS status, o_totalprice AS price FROM orders")
def q_project_rename(spark, sf_dir):
    """Select with rename."""
    return R.project_rename(table(spark, sf_dir, "orders"),
                            {"o_orderkey": "id", "o_orderstatus": "status", "o_totalprice": "price"})


@query("star_algebra", """
SELECT * EXCLUDE (o_orderpriority, o_orderstatus) REPLACE (round(o_totalprice, 0) AS o_totalprice) FROM orders""")
def q_star_algebra(spark, sf_dir):
    """All-but-columns and all-with-replacement."""
    o = R.all_except(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderstatus")
    return R.all_replace(o, o_totalprice=F.round("o_totalprice", 0))


@query("select_by_pattern", "SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice FROM lineitem")
def q_select_by_pattern(spark, sf_dir):
    """Columns chosen by patterns, in pattern order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(*R.select_by_pattern([r"^l_.*key$", "price"], li.columns))


@query("null_drop", """
SELECT c_custkey, seg FROM (SELECT c_custkey, nullif(c_mktsegment, 'BUILDING') AS seg FROM customer)
WHERE seg IS NOT NULL""")
def q_null_drop(spark, sf_dir):
    """Drop rows whose branch output is null."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return R.null_drop(c, "seg")


@query("attributes_long", """
SELECT p_partkey, attribute, value, CASE WHEN attribute = 'p_brand' THEN 0 ELSE 100 END AS priority
FROM (UNPIVOT (SELECT p_partkey, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size FROM part)
      ON p_brand, p_type, p_size INTO NAME attribute VALUE value)""")
def q_attributes_long(spark, sf_dir):
    """Wide attributes -> (attribute, value, priority) rows."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", F.col("p_size").cast("string"))
    long = R.unpivot_non_null(p, ["p_partkey"], ["p_brand", "p_type", "p_size"], "attribute", "value")
    return long.withColumn("priority", F.when(F.col("attribute") == "p_brand", 0).otherwise(100))


def _attr_rows(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    t = p.select("p_brand", "p_partkey", F.lit("type").alias("attribute"),
                 F.when(F.col("p_size") > 10, F.col("p_type")).alias("value"), F.col("p_size").alias("priority"))
    n = p.select("p_brand", "p_partkey", F.lit("name").alias("attribute"),
                 F.when(F.col("p_size") > 48, F.col("p_name")).alias("value"), (50 - F.col("p_size")).alias("priority"))
    return t.unionByName(n)


ATTR_ROWS_SQL = """
WITH rows AS (
  SELECT p_brand, p_partkey, 'type' AS attribute, CASE WHEN p_size > 10 THEN p_type END AS value, p_size AS priority
  FROM part
  UNION ALL
  SELECT p_brand, p_partkey, 'name', CASE WHEN p_size > 48 THEN p_name END, 50 - p_size FROM part),
best AS (
  SELECT p_brand, attribute, arg_min(value, (priority, p_partkey)) FILTER (WHERE value IS NOT NULL) AS value
  FROM rows GROUP BY 1, 2)"""


def first_by_priority(spark, sf_dir):
    rows = _attr_rows(spark, sf_dir)
    keys = rows.select("p_brand", "attribute").distinct()
    best = R.first_by_priority(rows, ["p_brand", "attribute"], "value", ["priority", "p_partkey"])
    return keys.join(best, ["p_brand", "attribute"], "left")


@query("first_non_null_by_priority", ATTR_ROWS_SQL + " SELECT * FROM best")
def q_first_non_null_by_priority(spark, sf_dir):
    """Per (group, attribute) the first non-null value in priority order."""
    return first_by_priority(spark, sf_dir)


@query("attributes_wide", ATTR_ROWS_SQL + """
SELECT p_brand, max(value) FILTER (WHERE attribute = 'type') AS type,
       max(value) FILTER (WHERE attribute = 'name') AS name FROM best GROUP BY 1""")
def q_attributes_wide(spark, sf_dir):
    """(attribute, value) rows -> one row per group with fixed columns."""
    return R.pivot_first(first_by_priority(spark, sf_dir), ["p_brand"], "attribute", ["type", "name"], "value")


@query("fill_across_windows", """
SELECT p_partkey, p_brand,
       first(CASE WHEN p_size > 45 THEN p_type END IGNORE NULLS) OVER (
         PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS filled
FROM part""")
def q_fill_across_windows(spark, sf_dir):
    """First non-null over the whole group written to every row."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(F.col("p_size") > 45, F.col("p_type")).alias("filled"))
    return R.fill_groups(p, ["p_brand"], ["p_partkey"], ["filled"])


@query("mode_with_ties", """
WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS k FROM customer GROUP BY 1, 2),
m AS (SELECT *, max(k) OVER (PARTITION BY c_nationkey) AS mk FROM c)
SELECT c_nationkey, string_agg(c_mktsegment, '|' ORDER BY c_mktsegment) AS mode FROM m WHERE k = mk GROUP BY 1""")
def q_mode_with_ties(spark, sf_dir):
    """Most frequent market segments per nation, ties joined."""
    return ST.mode_with_ties(table(spark, sf_dir, "customer"), ["c_nationkey"], "c_mktsegment")


@query("unique_values", """
SELECT p_size, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS "values" FROM part GROUP BY 1""")
def q_unique_values(spark, sf_dir):
    """Distinct brands per size, sorted and joined."""
    return ST.unique_values(table(spark, sf_dir, "part"), ["p_size"], ["p_brand"])


@query("first_seen_values", """
WITH cells AS (
  SELECT user_id, unnest([{'v': event_type, 'k': 0}, {'v': CAST(floor(value) AS VARCHAR), 'k': 1}]) AS c, ts, event_id FROM events),
seen AS (
  SELECT user_id, c.v AS value, row_number() OVER (PARTITION BY user_id, c.v ORDER BY ts, event_id, c.k) AS nth, ts, event_id, c.k AS k
  FROM cells WHERE c.v IS NOT NULL)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id, k) AS position, value FROM seen WHERE nth = 1""")
def q_first_seen_values(spark, sf_dir):
    """Distinct values of two columns per user, in the order first seen."""
    ev = table(spark, sf_dir, "events").withColumn("floor", F.floor("value").cast("double"))
    return R.first_seen_values(ev, ["user_id"], ["event_type", "floor"], ["ts", "event_id"])


@query("flatten_values", r"""
SELECT event_id, value FROM (
  SELECT event_id, unnest([event_type, props, CAST(user_id AS VARCHAR)]) AS value FROM events)
WHERE value IS NOT NULL AND NOT regexp_matches(value, '^\d+$') AND regexp_matches(value, '[a-z]')""")
def q_flatten_values(spark, sf_dir):
    """Several columns -> one bag of strings with drop/keep patterns."""
    ev = table(spark, sf_dir, "events")
    return ST.flatten_values(ev, ["event_type", "props", "user_id"], keep=["event_id"],
                             drop_pattern=r"^\d+$", restrict_pattern="[a-z]")


def _profile_sql() -> str:
    num, intl = ST.NUMBER_LIKE, ST.INTEGER_LIKE
    parts = ["SELECT 'c_custkey' AS column_name, true AS is_numeric_like, true AS is_int_like",
             "SELECT 'c_nationkey', true, true",
             "SELECT 'c_acctbal', true, coalesce(bool_and(c_acctbal = floor(c_acctbal)), true) FROM customer"]
    for c in ("c_name", "c_mktsegment"):
        v = f"trim(CAST({c} AS VARCHAR))"
        parts.append(f"""SELECT '{c}',
  coalesce(bool_and(regexp_matches({v}, '{num}')) FILTER (WHERE {v} <> ''), true),
  CASE WHEN count(*) FILTER (WHERE {v} <> '') > 0
       THEN coalesce(bool_and(regexp_matches({v}, '{intl}')) FILTER (WHERE {v} <> ''), false) ELSE false END
FROM customer""")
    return "\nUNION ALL ".join(parts)


@query("column_type_profile", _profile_sql())
def q_column_type_profile(spark, sf_dir):
    """Per column, number-like and integer-like flags (one pass)."""
    return ST.column_type_profile(table(spark, sf_dir, "customer"))
