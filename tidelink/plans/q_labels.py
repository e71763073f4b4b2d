"""Queries over path explosion, classification and the label rule packs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidelink.functions import packs as P
from tidelink.functions.rules import _q, sql_rule_value, sql_stages
from tidelink.operators import labels as LB
from tidelink.operators.delivery import CATEGORY_FOLDERS
from tidelink.operators.reshape import explode_path
from tidelink.plans import bindings as B
from tidelink.plans.registry import query
from tidelink.plans.sqlparts import with_ctes
from tidelink.sources.tables import table

URL_ROOT = "https://"


def _cat_folder_sql(c: str) -> str:
    arms = " ".join(f"WHEN {k} THEN {_q(v)}" for k, v in CATEGORY_FOLDERS.items())
    return f"CASE {c} {arms} ELSE CAST({c} AS VARCHAR) || '. Wave ' END"


SESSION_PATHS_SQL = f"""
sp0 AS (
  SELECT event_id, ts, user_id % 12 + 1 AS cat, event_id % 12 AS k,
         make_timestamp(epoch_us(ts) + CAST(floor(value * 60000000) AS BIGINT)) AS te,
         lpad(CAST(user_id AS VARCHAR), 5, '0') AS pid,
         lpad(CAST((user_id + 1) % 1000 + 10000 AS VARCHAR), 5, '0') AS pid2,
         CASE WHEN event_id % 2 = 0 THEN 'M' ELSE 'C' END AS letter
  FROM events),
sp1 AS (
  SELECT *, CAST((hour(ts) + 11) % 12 + 1 AS VARCHAR) || ';' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') AS t1,
         CAST((hour(te) + 11) % 12 + 1 AS VARCHAR) || ';' || lpad(CAST(minute(te) AS VARCHAR), 2, '0') AS t2,
         CASE WHEN hour(ts) < 12 THEN 'AM' ELSE 'PM' END AS ap1,
         CASE WHEN hour(te) < 12 THEN 'AM' ELSE 'PM' END AS ap2
  FROM sp0),
sp2 AS (SELECT *, t1 || ap1 || '-' || t2 || ap2 AS win, pid || letter || '_' || t1 || ap1 || '-' || t2 || ap2 AS canon FROM sp1),
sp3 AS (
  SELECT *, CASE k
      WHEN 0 THEN canon
      WHEN 1 THEN pid || '_' || translate(t1, ';', '.') || lower(ap1) || '-' || translate(t2, ';', '.') || lower(ap2)
      WHEN 2 THEN pid || letter || '_' || t1 || '-' || t2 || ap2
      WHEN 3 THEN pid || letter || ' _' || win
      WHEN 4 THEN pid || letter || '_' || t1 || ap1 || '_' || t2 || ap2
      WHEN 5 THEN canon || '(6 MONTH)'
      WHEN 6 THEN canon || ' ' || pid || 'C_' || win
      WHEN 7 THEN pid || ',' || pid2
      WHEN 8 THEN 'PIDGT' || CAST(event_id AS VARCHAR)
      WHEN 9 THEN canon || ' CHILD'
      WHEN 10 THEN pid || ' MOTHER'
      ELSE pid || letter || '_' || t1 || ap1 || '-' || replace(t2, ';', '') || ap2 END AS label,
    CASE event_id % 4 WHEN 0 THEN 'Mother' WHEN 1 THEN 'Child' WHEN 2 THEN 'Birth_follow_up_mother'
         ELSE 'Birth_follow_up_child' END AS type_folder,
    pid || CASE event_id % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'C' ELSE 'MC' END AS code
  FROM sp2),
event_paths AS (
  SELECT event_id, concat_ws('/', '{B.STUDY_ROOT}', 'ecg', {_cat_folder_sql('cat')}, type_folder,
                             strftime(ts, '%Y%m%d'), code, label) AS path FROM sp3),
session_paths AS (SELECT md5(path) AS id_session, path FROM event_paths)"""

CLASSIFY_SQL = f"""
comps AS (
  SELECT id_session, pos, value,
    CASE WHEN regexp_matches(value, {_q(P.DATE_COMPONENT)}) THEN 'date_str'
         WHEN regexp_matches(upper(value), {_q(P.PARTICIPANT_COMPONENT)}) THEN 'participant_str'
         WHEN regexp_matches(value, {_q(P.CATEGORY_COMPONENT)}) THEN 'respondent_cat'
         WHEN value IN ({", ".join(_q(x) for x in P.TYPE_COMPONENTS)}) THEN 'participant_type' END AS attribute
  FROM (SELECT id_session, unnest(range(len(parts))) AS pos, unnest(parts) AS value
        FROM (SELECT id_session, list_filter(string_split(replace(path, '{B.STUDY_ROOT}/', ''), '/'),
                                             lambda x: x <> '') AS parts FROM session_paths)))"""


def comps(spark, sf_dir):
    p = B.session_paths(spark, sf_dir)
    rel = F.replace(F.col("path"), F.lit(B.STUDY_ROOT + "/"), F.lit(""))
    c = p.select("id_session", F.posexplode(F.filter(F.split(rel, "/"), lambda x: x != "")).alias("pos", "value"))
    return c.withColumn("attribute", LB.classify_component(F.col("value")))


@query("classify_component", with_ctes(SESSION_PATHS_SQL, CLASSIFY_SQL, final="SELECT * FROM comps"))
def q_classify_component(spark, sf_dir):
    """Every folder component with its kind (null = window label)."""
    return comps(spark, sf_dir)


def _split_sql() -> list[str]:
    flags = ", ".join(f"regexp_matches(v, {_q(r[0])}) AS f{i}" for i, r in enumerate(P.SPLIT_RULES))
    ctes = [f"unk AS (SELECT DISTINCT value AS label FROM comps WHERE attribute IS NULL)",
            f"fl0 AS (SELECT label, upper(label) AS v, {flags} FROM unk)"]
    for i, r in enumerate(P.SPLIT_RULES):
        ctes.append(f"fl{i + 1} AS (SELECT * REPLACE (CASE WHEN f{i} THEN {sql_rule_value('v', r)} ELSE v END AS v) "
                    f"FROM fl{i})")
    n = len(P.SPLIT_RULES)
    any_f = " OR ".join(f"f{i}" for i in range(n))
    ctes.append(f"""split AS (
  SELECT label, v AS value, {any_f} AS to_split,
         regexp_matches(v, {_q(P.UNSPLIT_LABEL)}) AND NOT contains(v, chr(9)) AS split_error FROM fl{n})""")
    ctes.append("""pieces AS (
  SELECT label, unnest(string_split(value, chr(9))) AS value,
         unnest(range(1, len(string_split(value, chr(9))) + 1)) AS id_win, split_error
  FROM split WHERE to_split
  UNION ALL SELECT label, value, 1 AS id_win, split_error FROM split WHERE NOT to_split)""")
    return ctes


def _repair_sql() -> list[str]:
    a, b = P.LABEL_CHAR_MAP
    ctes = [f"rp AS (SELECT label, CAST(id_win AS INTEGER) AS id_win, translate(value, {_q(a)}, {_q(b)}) AS value, "
            f"split_error FROM pieces)"]
    ctes += sql_stages("rp", "value", P.REPAIR_STAGES)
    last = f"rp_st{len(P.REPAIR_STAGES) - 1}"
    ctes.append(f"repaired AS (SELECT *, value IS NULL OR regexp_matches(value, {_q(P.LABEL_GRAMMAR)}) AS label_ok "
                f"FROM {last})")
    return ctes


def _parse_sql() -> str:
    def sub(rule):
        return f"regexp_replace(value, {_q(rule[0])}, {_q(rule[1])}, 'g')"
    cat = " ".join(f"WHEN regexp_matches(value, {_q(p)}) THEN {n}" for p, n in P.LABEL_CATEGORY)
    has = f"regexp_matches(value, {_q(P.LABEL_HAS_WINDOW)})"
    return f"""
parsed0 AS (
  SELECT *, {sub(P.LABEL_PARTICIPANT)} AS participant, {sub(P.LABEL_TYPE)} AS participant_type,
         CASE WHEN {has} THEN translate({sub(P.LABEL_START)}, ';', ':') END AS start,
         CASE WHEN {has} THEN translate({sub(P.LABEL_END)}, ';', ':') END AS "end",
         CAST(CASE {cat} END AS INTEGER) AS respondent_cat
  FROM repaired),
parsed AS (
  SELECT *, coalesce(NOT (value IS NOT NULL AND regexp_matches(value, {_q(P.LABEL_PAREN)})
                          AND respondent_cat IS NULL)
              AND (start IS NULL OR regexp_matches(start, {_q(P.LABEL_TIME)}))
              AND ("end" IS NULL OR regexp_matches("end", {_q(P.LABEL_TIME)})), true) AS parse_ok
  FROM parsed0)"""


def rescued(spark, sf_dir):
    c = comps(spark, sf_dir)
    return LB.rescue_labels(c.where(F.col("attribute").isNull()).select(F.col("value").alias("label")), "label")


LABEL_CTES = [SESSION_PATHS_SQL, CLASSIFY_SQL]


@query("split_multi_windows", with_ctes(*LABEL_CTES, *_split_sql(),
                                        final="SELECT label, value, id_win FROM pieces"))
def q_split_multi_windows(spark, sf_dir):
    """Upper-cased labels split into windows (id_win 1..n)."""
    c = comps(spark, sf_dir).where(F.col("attribute").isNull()).select(F.col("value").alias("label")).distinct()
    s = LB.split_labels(c.withColumn("value", F.col("label")))
    from tidelink.operators.reshape import split_multi
    pieces = split_multi(s.where("to_split"), "value").select("label", "value", "id_win")
    whole = s.where(~F.col("to_split")).select("label", "value", F.lit(1).alias("id_win"))
    return pieces.unionByName(whole)


@query("repair_window_label", with_ctes(*LABEL_CTES, *_split_sql(), *_repair_sql(),
                                        final="SELECT label, id_win, value, label_ok FROM repaired"))
def q_repair_window_label(spark, sf_dir):
    """Repaired window labels and the grammar check."""
    return rescued(spark, sf_dir).select("label", "id_win", "value", "label_ok")


@query("parse_window_label", with_ctes(*LABEL_CTES, *_split_sql(), *_repair_sql(), _parse_sql(), final="""
SELECT label, id_win, participant, participant_type, start, "end", respondent_cat, parse_ok FROM parsed"""))
def q_parse_window_label(spark, sf_dir):
    """Parsed participant, type, window times and category per label window."""
    return rescued(spark, sf_dir).select("label", "id_win", "participant", "participant_type", "start", "end",
                                         "respondent_cat", "parse_ok")


@query("repair_category", with_ctes(*LABEL_CTES, final=f"""
SELECT DISTINCT value, TRY_CAST(replace(regexp_replace(value, {_q(P.CATEGORY_TEXT[0])},
                                               {_q(P.CATEGORY_TEXT[1])}, 'g'), '_', '') AS INTEGER) AS respondent_cat
FROM comps WHERE attribute = 'respondent_cat'"""))
def q_repair_category(spark, sf_dir):
    """Category folder text -> number (two-digit categories included, D5)."""
    c = comps(spark, sf_dir).where(F.col("attribute") == "respondent_cat")
    return c.select("value", LB.category_number(F.col("value")).alias("respondent_cat")).distinct()


@query("repair_participant", with_ctes(*LABEL_CTES, final=f"""
SELECT DISTINCT value, regexp_replace(value, {_q(P.CODE_PARTICIPANT[0])}, {_q(P.CODE_PARTICIPANT[1])}, 'g')
         AS participant,
       CASE WHEN regexp_extract(upper(value), {_q(P.CODE_SUFFIX)}, 1) IN ('MC', 'CM') THEN 'B'
            WHEN regexp_extract(upper(value), {_q(P.CODE_SUFFIX)}, 1) <> ''
            THEN regexp_extract(upper(value), {_q(P.CODE_SUFFIX)}, 1) END AS participant_type
FROM comps WHERE attribute = 'participant_str'"""))
def q_repair_participant(spark, sf_dir):
    """Participant code folder -> participant and type (MC/CM -> B, D3)."""
    c = comps(spark, sf_dir).where(F.col("attribute") == "participant_str")
    v = F.col("value")
    return c.select("value", LB.code_participant(v).alias("participant"),
                    LB.code_type(v).alias("participant_type")).distinct()


@query("repair_date", with_ctes(*LABEL_CTES, final="""
SELECT DISTINCT value, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day
FROM (SELECT value, TRY_CAST(strptime(value, '%Y%m%d') AS DATE) AS d FROM comps WHERE attribute = 'date_str')"""))
def q_repair_date(spark, sf_dir):
    """8-digit date folder -> year, month, day (invalid -> null)."""
    c = comps(spark, sf_dir).where(F.col("attribute") == "date_str")
    d = F.try_to_date(F.col("value"), "yyyyMMdd")
    return c.select("value", F.year(d).alias("year"), F.month(d).alias("month"),
                    F.dayofmonth(d).alias("day")).distinct()


_CATEGORY_SQL = (f"TRY_CAST(replace(regexp_replace(value, {_q(P.CATEGORY_TEXT[0])}, {_q(P.CATEGORY_TEXT[1])}, 'g'), "
                 "'_', '') AS INTEGER)")
_SUFFIX_SQL = f"regexp_extract(upper(value), {_q(P.CODE_SUFFIX)}, 1)"

# what each label window and each folder states, lower ranks first
SESSION_WINDOWS_SQL = f"""
sound AS (SELECT * FROM parsed WHERE label_ok AND parse_ok AND NOT split_error),
lab AS (
  SELECT c.id_session, c.pos, s.* FROM comps c JOIN sound s ON s.label = c.value WHERE c.attribute IS NULL),
dated AS (
  SELECT id_session, pos, TRY_CAST(strptime(value, '%Y%m%d') AS DATE) AS d FROM comps WHERE attribute = 'date_str'),
said AS (
  SELECT id_session, id_win, 'cat' AS a, CAST(respondent_cat AS VARCHAR) AS v, 0 AS rank, pos FROM lab
  UNION ALL SELECT id_session, id_win, 'who', participant, 1, pos FROM lab
  UNION ALL SELECT id_session, id_win, 'type', participant_type, 1, pos FROM lab
  UNION ALL SELECT id_session, id_win, 'start', start, 1, pos FROM lab
  UNION ALL SELECT id_session, id_win, 'end', "end", 1, pos FROM lab
  UNION ALL SELECT id_session, 1, 'cat', CAST({_CATEGORY_SQL} AS VARCHAR), 2, pos FROM comps
            WHERE attribute = 'respondent_cat'
  UNION ALL SELECT id_session, 1, 'year', CAST(year(d) AS VARCHAR), 2, pos FROM dated
  UNION ALL SELECT id_session, 1, 'month', CAST(month(d) AS VARCHAR), 2, pos FROM dated
  UNION ALL SELECT id_session, 1, 'day', CAST(day(d) AS VARCHAR), 2, pos FROM dated
  UNION ALL SELECT id_session, 1, 'type', value, 2, pos FROM comps WHERE attribute = 'participant_type'
  UNION ALL SELECT id_session, 1, 'who',
      regexp_replace(value, {_q(P.CODE_PARTICIPANT[0])}, {_q(P.CODE_PARTICIPANT[1])}, 'g'), 3, pos
      FROM comps WHERE attribute = 'participant_str'
  UNION ALL SELECT id_session, 1, 'type', CASE WHEN {_SUFFIX_SQL} IN ('MC', 'CM') THEN 'B'
      WHEN {_SUFFIX_SQL} <> '' THEN {_SUFFIX_SQL} END, 3, pos FROM comps WHERE attribute = 'participant_str'),
best AS (
  SELECT id_session, id_win, a, arg_min(CASE WHEN a <> 'type' THEN v WHEN lower(v) LIKE '%child%' THEN 'C'
                                             WHEN lower(v) LIKE '%mother%' THEN 'M' ELSE v END, (rank, pos)) AS v
  FROM said WHERE v IS NOT NULL GROUP BY 1, 2, 3),
shared AS (
  SELECT id_session, CAST(arg_min(v, id_win) FILTER (a = 'cat') AS INTEGER) AS respondent_cat,
         CAST(arg_min(v, id_win) FILTER (a = 'year') AS INTEGER) AS year,
         CAST(arg_min(v, id_win) FILTER (a = 'month') AS INTEGER) AS month,
         CAST(arg_min(v, id_win) FILTER (a = 'day') AS INTEGER) AS day
  FROM best GROUP BY 1),
own AS (
  SELECT id_session, id_win, max(v) FILTER (a = 'who') AS participant, max(v) FILTER (a = 'type') AS participant_type,
         max(v) FILTER (a = 'start') AS start, max(v) FILTER (a = 'end') AS "end"
  FROM best GROUP BY 1, 2),
session_windows AS (
  SELECT own.*, respondent_cat, year, month, day, row_number() OVER (ORDER BY id_session, id_win) AS id
  FROM own JOIN shared USING (id_session) WHERE participant IS NOT NULL)"""


def session_window_ctes() -> list[str]:
    return [*LABEL_CTES, *_split_sql(), *_repair_sql(), _parse_sql(), SESSION_WINDOWS_SQL]


@query("session_windows", with_ctes(*session_window_ctes(), final="SELECT * FROM session_windows"))
def q_session_windows(spark, sf_dir):
    """Session folders -> one row per (session, window) with all facts."""
    return LB.session_windows(B.session_paths(spark, sf_dir), B.STUDY_ROOT + "/")


@query("label_quarantine", with_ctes(*LABEL_CTES, *_split_sql(), *_repair_sql(), _parse_sql(), final="""
SELECT label, id_win, value, label_ok, parse_ok, split_error FROM parsed
WHERE NOT label_ok OR NOT parse_ok OR split_error"""))
def q_label_quarantine(spark, sf_dir):
    """dq_label_split, dq_label_grammar, dq_label_parse: labels the packs cannot repair."""
    _, bad = LB.session_windows(B.session_paths(spark, sf_dir), B.STUDY_ROOT + "/", quarantine=True)
    return bad.select("label", "id_win", "value", "label_ok", "parse_ok", "split_error")


@query("explode_path", f"""
SELECT page_id, CAST(pos AS INTEGER) AS pos, component FROM (
  SELECT page_id, unnest(range(1, len(parts) + 1)) AS pos, unnest(parts) AS component
  FROM (SELECT page_id, list_filter(string_split(replace(url, '{URL_ROOT}', ''), '/'), lambda x: x <> '') AS parts
        FROM pages))""")
def q_explode_path(spark, sf_dir):
    """URL below the scheme root -> numbered components."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return explode_path(pages, "url", URL_ROOT).select("page_id", "pos", "component")


@query("relative_path", f"SELECT page_id, replace(url, '{URL_ROOT}', '') AS rel_path FROM pages")
def q_relative_path(spark, sf_dir):
    """Strip a literal root prefix."""
    return table(spark, sf_dir, "pages").select("page_id", F.replace(F.col("url"), F.lit(URL_ROOT), F.lit(""))
                                                .alias("rel_path"))


@query("daytime_fix", with_ctes(*LABEL_CTES, *_split_sql(), *_repair_sql(), final=f"""
SELECT label, id_win,
  CASE WHEN regexp_matches(v1, {_q(P.DAYTIME_RULES[1][0])})
       THEN regexp_replace(v1, {_q(P.DAYTIME_RULES[1][0])}, {_q(P.DAYTIME_RULES[1][1])}, 'g') ELSE v1 END AS value
FROM (SELECT label, id_win,
        CASE WHEN regexp_matches(value, {_q(P.DAYTIME_RULES[0][0])})
             THEN regexp_replace(value, {_q(P.DAYTIME_RULES[0][0])}, {_q(P.DAYTIME_RULES[0][1])}, 'g')
             ELSE value END AS v1
      FROM repaired)"""))
def q_daytime_fix(spark, sf_dir):
    """R11 (optional rule of the older pack): 12..AM -> PM and 11..PM -> AM."""
    return LB.daytime_fix(rescued(spark, sf_dir).select("label", "id_win", "value"))


def _by_rules_sql(c: str, rules) -> str:
    arms = " ".join(f"WHEN regexp_matches({c}, {_q(guard)}) THEN coalesce(nullif(regexp_extract({c}, {_q(capture)}, {group}), ''), {c})"
                    for guard, capture, group in rules)
    return f"CASE {arms} END"


_WORDS_SQL = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in P.PART_WORDS.items())


@query("long_label_table", with_ctes(*LABEL_CTES, *_split_sql(), *_repair_sql(), final=f"""
SELECT *, string_split("window", '-')[1] AS start, string_split("window", '-')[2] AS "end" FROM (
  SELECT label, value, component, {_by_rules_sql('component', P.PART_DATES)} AS date,
         {_by_rules_sql('component', P.PART_IDS)} AS mirage_id,
         CASE regexp_extract(component, {_q(P.PART_LETTER)}, 1) {_WORDS_SQL} END AS participant,
         {_by_rules_sql('component', P.PART_WINDOWS)} AS "window"
  FROM (SELECT label, value, unnest(string_split(replace(value, ';', ':'), chr(9))) AS component
        FROM repaired WHERE label_ok))"""))
def q_long_label_table(spark, sf_dir):
    """R12 (optional): repaired labels as component rows."""
    r = rescued(spark, sf_dir).where("label_ok").select("label", "value")
    return LB.long_label_table(r, "value")


@query("repair_type", with_ctes(*LABEL_CTES, final="""
SELECT DISTINCT value, CASE WHEN lower(value) LIKE '%child%' THEN 'C' WHEN lower(value) LIKE '%mother%' THEN 'M'
                            ELSE value END AS participant_type
FROM comps WHERE attribute = 'participant_type'"""))
def q_repair_type(spark, sf_dir):
    """Free-text participant type folder -> C / M."""
    c = comps(spark, sf_dir).where(F.col("attribute") == "participant_type")
    return c.select("value", LB.type_letter(F.col("value")).alias("participant_type")).distinct()
