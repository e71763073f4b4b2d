"""Fold rule packs (see packs.py) into native Column expressions.

Every rule becomes ``rlike`` + ``regexp_replace``/``translate``/``concat``
inside a first-match-wins ``when`` chain, so packs run inside whole-stage
codegen with no Python in the data path. ``sql_*`` build the same logic
as DuckDB SQL text for the oracles.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def java_replacement(rep: str) -> str:
    """R-style group references (\\1) -> Java ($1)."""
    return re.sub(r"\\(\d)", r"$\1", rep)


def rule_value(v: Column, rule: tuple) -> Column:
    kind = rule[1]
    if kind == "sub":
        return F.regexp_replace(v, rule[2], java_replacement(rule[3]))
    if kind == "null":
        return F.lit(None).cast("string")
    if kind == "append":
        return F.concat(v, F.lit(rule[2]))
    if kind == "prefix":
        return F.substring(v, 1, rule[2])
    if kind == "prefix_append":
        return F.concat(F.substring(v, 1, rule[2]), F.lit(rule[3]))
    if kind == "tr":
        return F.translate(v, rule[2], rule[3])
    raise ValueError(f"unknown rule kind {kind}")


BIND_ONCE = True


def _once(v: Column, body) -> Column:
    """Evaluate ``body(x)`` with ``x`` bound to ``v`` (as a lambda variable).

    Every stage reads its input many times (one detector and one rewrite
    per rule). Written plainly, the optimizer substitutes the previous
    stage's whole expression at each read when it pushes predicates down,
    which grows the plan exponentially with the number of stages. Binding
    the input once keeps each stage a single reference to the one before.
    """
    if not BIND_ONCE:
        return body(v)
    return F.transform(F.array(v), body)[0]


def first_match(v: Column, stage: list[tuple]) -> Column:
    """One stage: the first rule whose detector matches rewrites ``v``."""
    def body(x):
        expr = F.when(x.isNull(), x)
        for rule in stage:
            expr = expr.when(x.rlike(rule[0]), rule_value(x, rule))
        return expr.otherwise(x)
    return _once(v, body)


def apply_stages(df: DataFrame, col: str, stages: list[list[tuple]]) -> DataFrame:
    """Run stages in order on ``col`` (one projection per stage, so each
    stage's expression stays small for code generation)."""
    for stage in stages:
        df = df.withColumn(col, first_match(F.col(col), stage))
    return df


def apply_flagged(df: DataFrame, col: str, rules: list[tuple], flag_prefix: str = "_split") -> DataFrame:
    """R2 semantics: every detector reads the value *before* any rewrite;
    rewrites then apply in order where their detector fired."""
    def flags_of(x):
        return F.struct(*[F.coalesce(x.rlike(r[0]), F.lit(False)).alias(f"f{i}") for i, r in enumerate(rules)])
    df = df.withColumn("_flags", _once(F.col(col), flags_of))
    def rewrite(flag: Column, rule: tuple):
        return lambda x: F.when(flag, rule_value(x, rule)).otherwise(x)
    for i, rule in enumerate(rules):
        df = df.withColumn(col, _once(F.col(col), rewrite(F.col("_flags").getField(f"f{i}"), rule)))
    any_flag = F.lit(False)
    for i in range(len(rules)):
        any_flag = any_flag | F.col("_flags").getField(f"f{i}")
    return df.withColumn("to_split", any_flag).drop("_flags")


# --- DuckDB text of the same rules (oracles) --------------------------------

def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_rule_value(v: str, rule: tuple) -> str:
    kind = rule[1]
    if kind == "sub":
        return f"regexp_replace({v}, {_q(rule[2])}, {_q(rule[3])}, 'g')"
    if kind == "null":
        return "CAST(NULL AS VARCHAR)"
    if kind == "append":
        return f"({v} || {_q(rule[2])})"
    if kind == "prefix":
        return f"substr({v}, 1, {rule[2]})"
    if kind == "prefix_append":
        return f"(substr({v}, 1, {rule[2]}) || {_q(rule[3])})"
    if kind == "tr":
        return f"translate({v}, {_q(rule[2])}, {_q(rule[3])})"
    raise ValueError(kind)


def sql_first_match(v: str, stage: list[tuple]) -> str:
    arms = " ".join(f"WHEN regexp_matches({v}, {_q(r[0])}) THEN {sql_rule_value(v, r)}" for r in stage)
    return f"CASE WHEN {v} IS NULL THEN NULL {arms} ELSE {v} END"


def sql_stages(src: str, col: str, stages: list[list[tuple]], keep: str = "*") -> list[str]:
    """CTE texts s0..sN applying each stage to ``col`` of ``src``."""
    ctes, prev = [], src
    for i, stage in enumerate(stages):
        name = f"{src}_st{i}"
        ctes.append(f"{name} AS (SELECT * REPLACE ({sql_first_match(col, stage)} AS {col}) FROM {prev})")
        prev = name
    return ctes
