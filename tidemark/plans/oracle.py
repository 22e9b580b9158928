"""DuckDB SQL equivalent to each registered query (the correctness oracle).

Written independently of the Spark plans: the SCD2 oracles follow the literal
three-branch description (rebuild, then upsert / close / delete sets).
"""

from __future__ import annotations

# Daily snapshot of events (see tidemark.sources.fixtures.snapshot).
SNAP = """
snap AS (
  SELECT user_id, CAST(ts AS DATE) AS calendar_dt,
         arg_max(event_type, ts) AS attr,
         CAST(sum(round(value * 100)) AS BIGINT) AS v,
         count(*) AS n,
         CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS day
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)"""


def _build(name: str, rows: str) -> str:
    """CTE ``name`` = collapse + lead over ``rows`` (user_id, attr, valid_from_dttm)."""
    return f"""
{name}_h AS (
  SELECT *, md5(coalesce(CAST(attr AS VARCHAR), 'none')) AS hk,
         lag(md5(coalesce(CAST(attr AS VARCHAR), 'none'))) OVER (PARTITION BY user_id ORDER BY valid_from_dttm) AS prev
  FROM ({rows})
),
{name} AS (
  SELECT user_id, attr, valid_from_dttm,
         lead(valid_from_dttm) OVER (PARTITION BY user_id ORDER BY valid_from_dttm) AS valid_to_dttm
  FROM {name}_h WHERE prev IS NULL OR hk <> prev
)"""


def _vin(where: str) -> str:
    return f"SELECT user_id, attr, CAST(calendar_dt AS TIMESTAMP) AS valid_from_dttm FROM snap WHERE {where}"


LATE = _vin("day BETWEEN 8 AND 12")
# The late days sent again, with other values and a day that repeats its predecessor.
RESENT = """SELECT user_id, CASE WHEN day = 10 THEN 'x' ELSE lower(attr) || (day // 2) END AS attr,
         CAST(calendar_dt AS TIMESTAMP) AS valid_from_dttm FROM snap WHERE day BETWEEN 8 AND 12"""


def _scd2(mode: str, target: str = "day NOT BETWEEN 8 AND 12", source: str = LATE) -> str:
    """CTEs tgt, src, scope, rebuilt, ups, closes, dels, final; by default for the late-days scenario."""
    if mode == "no":
        scope = """SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM hist
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from_dttm DESC) = 1"""
    elif mode == "from_dt":
        scope = """SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM hist WHERE valid_from_dttm >= boundary
  UNION ALL
  SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM (
    SELECT * FROM hist WHERE valid_from_dttm < boundary
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY valid_from_dttm DESC) = 1)"""
    else:
        scope = "SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM hist"
    return f"""WITH {SNAP},
{_build('tgt', _vin(target))},
src AS ({source}),
touched AS (SELECT user_id, min(valid_from_dttm) AS boundary FROM src GROUP BY user_id),
hist AS (SELECT t.*, b.boundary FROM tgt t JOIN touched b USING (user_id)),
scope AS ({scope}),
kept AS (
  SELECT user_id, attr, valid_from_dttm FROM scope s
  WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.user_id = s.user_id AND src.valid_from_dttm = s.valid_from_dttm)
  UNION ALL SELECT user_id, attr, valid_from_dttm FROM src
),
{_build('rebuilt', 'SELECT * FROM kept')},
ups AS (
  SELECT r.* FROM rebuilt r
  WHERE EXISTS (SELECT 1 FROM src s WHERE s.user_id = r.user_id AND s.valid_from_dttm = r.valid_from_dttm)
    AND NOT EXISTS (SELECT 1 FROM tgt t WHERE t.user_id = r.user_id AND t.valid_from_dttm = r.valid_from_dttm
                    AND t.attr IS NOT DISTINCT FROM r.attr AND t.valid_to_dttm IS NOT DISTINCT FROM r.valid_to_dttm)
),
closes AS (
  SELECT r.* FROM rebuilt r
  WHERE NOT EXISTS (SELECT 1 FROM src s WHERE s.user_id = r.user_id AND s.valid_from_dttm = r.valid_from_dttm)
    AND EXISTS (SELECT 1 FROM tgt t WHERE t.user_id = r.user_id AND t.valid_from_dttm = r.valid_from_dttm
                AND t.valid_to_dttm IS DISTINCT FROM r.valid_to_dttm)
),
dels AS (
  SELECT user_id, valid_from_dttm FROM scope s
  WHERE NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.user_id = s.user_id AND r.valid_from_dttm = s.valid_from_dttm)
),
final AS (
  SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM tgt t
  WHERE NOT EXISTS (SELECT 1 FROM rebuilt r WHERE r.user_id = t.user_id AND r.valid_from_dttm = t.valid_from_dttm)
    AND NOT EXISTS (SELECT 1 FROM dels d WHERE d.user_id = t.user_id AND d.valid_from_dttm = t.valid_from_dttm)
  UNION ALL SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM rebuilt
)"""


def _scd2_upsert_sql(mode: str, *inputs: str) -> str:
    return _scd2(mode, *inputs) + "\nSELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM final"


def _scd2_changes_sql(mode: str) -> str:
    return _scd2(mode) + """
SELECT user_id, attr, valid_from_dttm, valid_to_dttm, 'upsert' AS _operation FROM ups
UNION ALL SELECT user_id, attr, valid_from_dttm, valid_to_dttm, 'close' FROM closes
UNION ALL SELECT user_id, CAST(NULL AS VARCHAR), valid_from_dttm, CAST(NULL AS TIMESTAMP), 'delete' FROM dels"""


PAIRS = """
tgt AS (SELECT user_id, event_type, count(*) AS cnt FROM events
        WHERE ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-19' GROUP BY 1, 2),
src AS (SELECT user_id, event_type, count(*) AS cnt FROM events
        WHERE ts >= TIMESTAMP '2024-01-14' AND ts < TIMESTAMP '2024-01-31' GROUP BY 1, 2)"""


def _links(where: str) -> str:
    return f"""SELECT md5(concat_ws('||', CAST(user_id AS VARCHAR), event_type)) AS link_id, user_id, event_type,
       min(ts) AS created_at FROM events WHERE {where} GROUP BY user_id, event_type"""


DISAPPEAR = f"""WITH {SNAP},
s AS (SELECT *, user_id % 10 AS cohort_id FROM snap),
hist AS (SELECT * FROM s WHERE day <= 28),
links AS (SELECT DISTINCT user_id, cohort_id FROM hist),
hubs AS (SELECT user_id, min(CAST(calendar_dt AS TIMESTAMP)) AS created_at FROM hist GROUP BY user_id),
{_build('versions', "SELECT user_id, attr, CAST(calendar_dt AS TIMESTAMP) AS valid_from_dttm FROM hist")},
cur AS (SELECT * FROM versions WHERE valid_to_dttm IS NULL)"""


def _missing(first: int, last: int) -> str:
    return f"""
SELECT l.user_id, c.attr, false AS is_available, p.missing_from AS valid_from_dttm
FROM links l
JOIN (SELECT cohort_id, min(CAST(calendar_dt AS TIMESTAMP)) AS missing_from FROM s
      WHERE day BETWEEN {first} AND {last} GROUP BY cohort_id) p USING (cohort_id)
JOIN hubs h USING (user_id)
JOIN cur c USING (user_id)
WHERE h.created_at <= p.missing_from
  AND l.user_id NOT IN (SELECT user_id FROM s WHERE day BETWEEN {first} AND {last})"""


DQ_COLS = "table_name, check_name, violations, passed"


def _dq(table: str, check: str, violations_sql: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{check}' AS check_name, CAST(({violations_sql}) AS BIGINT) AS violations, "
            f"CAST(({violations_sql}) AS BIGINT) = 0 AS passed")


def _dq_table(table: str, keys: list[str], measures: list[str], refs: list[tuple[str, str, str]]) -> list[str]:
    k = ", ".join(keys)
    parts = [
        _dq(table, "not_empty", f"SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table}"),
        _dq(table, "no_nulls_in_key", "SELECT " + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in keys)
            + f" FROM {table}"),
        _dq(table, "no_duplicates", f"SELECT count(*) FROM (SELECT {k} FROM {table} GROUP BY {k} HAVING count(*) > 1)"),
    ]
    if measures:
        parts.append(_dq(table, "no_negative", "SELECT " + " + ".join(
            f"count(*) FILTER (WHERE {c} < 0)" for c in measures) + f" FROM {table}"))
    for col, parent, pcol in refs:
        parts.append(_dq(table, f"no_orphans[{col}]",
                         f"SELECT count(*) FROM {table} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                         f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = c.{col})"))
    return parts


DQ_SUMMARY = "\nUNION ALL\n".join(
    _dq_table("region", ["r_regionkey"], [], [])
    + _dq_table("lineitem", ["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice"],
                [("l_orderkey", "orders", "o_orderkey")])
    + _dq_table("customer", ["c_custkey"], ["c_acctbal"], [("c_nationkey", "nation", "n_nationkey")])
)

EVENT_TYPES = ("view", "click", "purchase", "signup", "error")

ORACLE: dict[str, str] = {
    "hub_first_seen": "SELECT user_id, min(ts) AS created_at FROM events GROUP BY user_id",
    "hub_new_keys": """
SELECT o_custkey AS customer_id, min(o_orderdate) AS created_at FROM orders o
WHERE o_orderdate >= TIMESTAMP '1996-01-01'
  AND NOT EXISTS (SELECT 1 FROM orders p WHERE p.o_custkey = o.o_custkey AND p.o_orderdate < TIMESTAMP '1996-01-01')
GROUP BY o_custkey""",
    "link_md5": _links("true"),
    "link_new": f"""
SELECT * FROM ({_links("ts >= TIMESTAMP '2024-01-11'")}) n
WHERE n.link_id NOT IN (SELECT link_id FROM ({_links("ts < TIMESTAMP '2024-01-11'")}))""",
    "ref_category": """
SELECT DISTINCT event_type AS category_id, upper(event_type) AS category_name, event_type <> 'error' AS is_assignable
FROM events""",
    "json_props": "SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "duration_seconds": r"""
WITH d AS (
  SELECT p_partkey,
    CASE p_partkey % 6
      WHEN 0 THEN 'PT' || CAST(p_size % 3 AS VARCHAR) || 'H' || CAST(p_size AS VARCHAR) || 'M' || CAST(p_partkey % 60 AS VARCHAR) || 'S'
      WHEN 1 THEN 'PT' || CAST(p_size AS VARCHAR) || 'M'
      WHEN 2 THEN 'P' || CAST(p_size % 4 AS VARCHAR) || 'D'
      WHEN 3 THEN 'PT'
      WHEN 4 THEN 'P1DT' || CAST(p_size % 24 AS VARCHAR) || 'H'
    END AS duration
  FROM part)
SELECT p_partkey, duration,
  CAST(CASE WHEN regexp_full_match(duration, 'PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?') THEN
    coalesce(TRY_CAST(regexp_extract(duration, '^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$', 1) AS INTEGER), 0) * 3600
  + coalesce(TRY_CAST(regexp_extract(duration, '^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$', 2) AS INTEGER), 0) * 60
  + coalesce(TRY_CAST(regexp_extract(duration, '^PT(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?$', 3) AS INTEGER), 0)
  END AS INTEGER) AS duration_sec
FROM d""",
    "stats_daily": "SELECT user_id, CAST(ts AS DATE) AS calendar_dt, count(event_id) AS events_cnt, "
                   "CAST(sum(round(value * 100)) AS BIGINT) AS value_total, "
                   + ", ".join(f"CAST(sum(CASE WHEN event_type = '{t}' THEN round(value * 100) END) AS BIGINT) AS {t}_total"
                               for t in EVENT_TYPES)
                   + " FROM events GROUP BY user_id, CAST(ts AS DATE)",
    "collapse_versions": f"""WITH {SNAP},
h AS (SELECT user_id, attr, CAST(calendar_dt AS TIMESTAMP) AS valid_from_dttm FROM snap),
l AS (SELECT *, md5(coalesce(attr, 'none')) AS hk,
             lag(md5(coalesce(attr, 'none'))) OVER (PARTITION BY user_id ORDER BY valid_from_dttm) AS prev FROM h)
SELECT user_id, attr, valid_from_dttm FROM l WHERE prev IS NULL OR hk <> prev""",
    "scd2_build": f"WITH {SNAP}, {_build('b', _vin('true'))} SELECT * FROM b",
    "scd2_upsert_no": _scd2_upsert_sql("no"),
    "scd2_upsert_from_dt": _scd2_upsert_sql("from_dt"),
    "scd2_upsert_full": _scd2_upsert_sql("full"),
    "scd2_changes_no": _scd2_changes_sql("no"),
    "scd2_changes_from_dt": _scd2_changes_sql("from_dt"),
    "scd2_changes_full": _scd2_changes_sql("full"),
    "scd2_in_order_equals_full": f"WITH {SNAP}, {_build('b', _vin('true'))} SELECT * FROM b",
    "scd1_upsert": f"""WITH {PAIRS}
SELECT coalesce(s.user_id, t.user_id) AS user_id, coalesce(s.event_type, t.event_type) AS event_type,
       CASE WHEN s.user_id IS NOT NULL THEN s.cnt ELSE t.cnt END AS cnt,
       s.user_id IS NOT NULL AND (t.user_id IS NULL OR s.cnt IS DISTINCT FROM t.cnt) AS refreshed
FROM tgt t FULL OUTER JOIN src s ON s.user_id = t.user_id AND s.event_type = t.event_type""",
    "scd1_changes": f"""WITH {PAIRS}
SELECT s.user_id, s.event_type, s.cnt, CASE WHEN t.user_id IS NULL THEN 'insert' ELSE 'update' END AS _operation
FROM src s LEFT JOIN tgt t ON s.user_id = t.user_id AND s.event_type = t.event_type
WHERE t.user_id IS NULL OR s.cnt IS DISTINCT FROM t.cnt""",
    "scd1_insert": f"WITH {PAIRS} SELECT user_id, event_type, cnt FROM tgt UNION ALL SELECT user_id, event_type, cnt FROM src",
    "scd1_rewrite": f"WITH {PAIRS} SELECT user_id, event_type, cnt FROM src",
    "slice_after_watermark": "SELECT event_id, ts, user_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-20 00:00:00'",
    "disappeared": DISAPPEAR + _missing(29, 29),
    "disappeared_two_days": DISAPPEAR + _missing(29, 30),
    "reappeared": DISAPPEAR + f""",
gone AS ({_missing(29, 29)})
SELECT s.user_id, s.attr, CAST(s.calendar_dt AS TIMESTAMP) AS valid_from_dttm
FROM s JOIN gone g USING (user_id) WHERE s.day = 30""",
    "as_of_join": f"""WITH {SNAP}, {_build('b', _vin('true'))}
SELECT s.user_id, s.calendar_dt, s.v, b.attr FROM snap s LEFT JOIN b
  ON s.user_id = b.user_id AND CAST(s.calendar_dt AS TIMESTAMP) >= b.valid_from_dttm
 AND (b.valid_to_dttm IS NULL OR CAST(s.calendar_dt AS TIMESTAMP) < b.valid_to_dttm)""",
    "as_of_carried": f"""WITH {SNAP}, {_build('b', _vin('true'))}
SELECT s.user_id, s.calendar_dt, s.v, b.attr FROM snap s LEFT JOIN b
  ON s.user_id = b.user_id AND CAST(s.calendar_dt AS TIMESTAMP) >= b.valid_from_dttm
 AND (b.valid_to_dttm IS NULL OR CAST(s.calendar_dt AS TIMESTAMP) < b.valid_to_dttm)""",
    "totals_by_retraction": f"""WITH {SNAP},
f AS (SELECT user_id, user_id % 10 AS cohort_id, calendar_dt, v, v - lag(v) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS v_delta FROM snap),
b AS (SELECT * FROM f WHERE calendar_dt > DATE '2024-01-28'),
n AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN (cohort_id + 1) % 10 ELSE cohort_id END AS cohort_id, calendar_dt,
             CASE WHEN user_id % 3 = 0 THEN v * 2 ELSE v END AS v, v_delta FROM b WHERE user_id % 7 <> 0)
SELECT cohort_id, calendar_dt, count(*) AS users_cnt, CAST(sum(v) AS BIGINT) AS v_total, CAST(sum(v_delta) AS BIGINT) AS v_delta_total
FROM n GROUP BY cohort_id, calendar_dt""",
    "daily_delta": f"""WITH {SNAP}
SELECT user_id, calendar_dt, v, v - lag(v) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS v_delta FROM snap""",
    "incremental_delta": f"""WITH {SNAP}
SELECT * FROM (SELECT user_id, calendar_dt, v, v - lag(v) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS v_delta
               FROM snap) WHERE calendar_dt > DATE '2024-01-20'""",
    "late_delta_refresh": f"""WITH {SNAP},
f AS (SELECT user_id, calendar_dt, v, day,
             v - lag(v) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS v_delta,
             lag(day) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS prev_day FROM snap)
SELECT user_id, calendar_dt, v, v_delta FROM f WHERE day = 15 OR prev_day = 15""",
    "reaggregate_affected": f"""WITH {SNAP},
f AS (SELECT user_id, user_id % 10 AS cohort_id, calendar_dt, v,
             v - lag(v) OVER (PARTITION BY user_id ORDER BY calendar_dt) AS v_delta FROM snap),
a AS (SELECT DISTINCT cohort_id, calendar_dt FROM f WHERE calendar_dt > DATE '2024-01-28'),
t AS (SELECT cohort_id, calendar_dt, count(user_id) AS users_cnt, CAST(sum(v) AS BIGINT) AS v_total,
             CAST(sum(v_delta) AS BIGINT) AS v_delta_total
      FROM f JOIN a USING (cohort_id, calendar_dt) GROUP BY cohort_id, calendar_dt),
c AS (SELECT user_id % 10 AS cohort_id, CAST(ts AS DATE) AS calendar_dt, count(*) AS events_cnt FROM events GROUP BY 1, 2)
SELECT * FROM t JOIN c USING (cohort_id, calendar_dt)""",
    "bronze_typed": """
SELECT CAST(event_id AS VARCHAR) AS id, CAST(ts AS DATE) AS calendar_dt, date_trunc('second', ts) AS published_at,
       'c' || CAST(user_id % 10 AS VARCHAR) AS channel_id, event_type AS title,
       CAST(floor(value) AS INTEGER) AS duration_sec,
       CASE event_type WHEN 'click' THEN true WHEN 'view' THEN false END AS caption,
       CASE WHEN event_type = 'error' THEN '{"k":"' || json_extract_string(props, '$.k') || '"}' ELSE '{}' END
         AS content_rating,
       CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(round(value * 100) AS BIGINT) END AS view_count
FROM events""",
    "fct_video_daily": f"""WITH {SNAP}, {_build('b', _vin('true'))},
f AS (
  SELECT s.user_id AS video_id, CAST(s.user_id % 10 AS VARCHAR) AS channel_id, b.attr AS category_id, s.calendar_dt,
         s.v AS views_cnt, s.n AS likes_cnt, CAST(0 AS BIGINT) AS favorites_cnt, s.n * 2 AS comments_cnt
  FROM snap s LEFT JOIN b ON s.user_id = b.user_id AND CAST(s.calendar_dt AS TIMESTAMP) >= b.valid_from_dttm
   AND (b.valid_to_dttm IS NULL OR CAST(s.calendar_dt AS TIMESTAMP) < b.valid_to_dttm))
SELECT * FROM (
  SELECT *, views_cnt - lag(views_cnt) OVER w AS views_delta, likes_cnt - lag(likes_cnt) OVER w AS likes_delta,
         comments_cnt - lag(comments_cnt) OVER w AS comments_delta
  FROM f WINDOW w AS (PARTITION BY video_id ORDER BY calendar_dt))
WHERE calendar_dt > DATE '2024-01-20'""",
    "dim_denormalised": f"""WITH {SNAP}, {_build('b', _vin('true'))},
hub AS (SELECT user_id, min(ts) AS created_at FROM events GROUP BY user_id),
lnk AS (SELECT DISTINCT user_id, user_id % 10 AS cohort_id FROM snap),
cat AS (SELECT DISTINCT event_type AS attr, upper(event_type) AS category_name FROM events)
SELECT b.user_id, lnk.cohort_id, hub.created_at, b.attr, cat.category_name, b.valid_from_dttm, b.valid_to_dttm
FROM hub JOIN b USING (user_id) LEFT JOIN lnk USING (user_id) LEFT JOIN cat ON cat.attr = b.attr""",
    "calendar_dim": """
WITH d AS (SELECT CAST(unnest(generate_series(min(o_orderdate)::DATE, max(o_orderdate)::DATE, INTERVAL 1 DAY)) AS DATE) AS calendar_dt
           FROM orders)
SELECT calendar_dt, CAST(day(calendar_dt) AS INTEGER) AS monthday, CAST(month(calendar_dt) AS INTEGER) AS month,
       strftime(calendar_dt, '%B') AS month_name, CAST(quarter(calendar_dt) AS INTEGER) AS quarter,
       CAST(year(calendar_dt) AS INTEGER) AS year, strftime(calendar_dt, '%Y-%m') AS year_month,
       CAST(weekofyear(calendar_dt) AS INTEGER) AS week_of_year, CAST(isoyear(calendar_dt) AS INTEGER) AS iso_year,
       CAST(isodow(calendar_dt) AS INTEGER) AS weekday, strftime(calendar_dt, '%A') AS day_name,
       isodow(calendar_dt) > 5 AS is_weekend
FROM d""",
    "dq_summary": DQ_SUMMARY,
    "dq_not_empty": f"SELECT * FROM ({DQ_SUMMARY}) WHERE check_name = 'not_empty'",
    "dq_no_duplicates": _dq("lineitem", "no_duplicates",
                            "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"),
    "dq_no_nulls": _dq("documents_labeled", "no_nulls_in_key",
                       "SELECT count(*) FILTER (WHERE d.doc_id IS NULL) + count(*) FILTER (WHERE l.quality IS NULL) "
                       "FROM documents d LEFT JOIN labels l USING (doc_id)"),
    "dq_no_negative": _dq("customer", "no_negative", "SELECT count(*) FILTER (WHERE c_acctbal < 0) FROM customer"),
    "dq_single_open": _scd2("from_dt") + "\n" + _dq(
        "scd2_upsert_from_dt", "single_open_version",
        "SELECT count(*) FROM (SELECT user_id FROM final GROUP BY user_id "
        "HAVING count(*) FILTER (WHERE valid_to_dttm IS NULL) <> 1)"),
    "dq_no_orphans": _dq("documents", "no_orphans[doc_id]",
                         "SELECT count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
                     + "\nUNION ALL\n"
                     + _dq("lineitem", "no_orphans[l_orderkey]",
                           "SELECT count(*) FROM lineitem c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = c.l_orderkey)"),
}
