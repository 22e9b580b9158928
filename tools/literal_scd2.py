"""The literal three-branch SCD2 upsert in Spark SQL, for the bench comparison.

Rebuild = (history scope without replaced keys) + input, collapsed, with
``valid_to = lead(valid_from)``, planned once per branch: upserts (rebuilt rows
whose key is in the input), closes (rebuilt rows whose key is not) and deletes
(scope keys missing from the rebuild).  Plain per-key windows, no bucket
split.  The new state is compared with the single-pass ``scd2_upsert``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCOPE = {
    "no": """SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM (
               SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_from_dttm DESC) AS rn FROM hist)
             WHERE rn = 1""",
    "from_dt": """SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM hist WHERE valid_from_dttm >= boundary
                  UNION ALL
                  SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM (
                    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY valid_from_dttm DESC) AS rn
                    FROM hist WHERE valid_from_dttm < boundary) WHERE rn = 1""",
    "full": "SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM hist",
}


def literal_upsert(spark: SparkSession, target: DataFrame, source: DataFrame, mode: str) -> DataFrame:
    target.createOrReplaceTempView("lit_tgt")
    source.createOrReplaceTempView("lit_src")
    return spark.sql(f"""
WITH touched AS (SELECT user_id, min(valid_from_dttm) AS boundary FROM lit_src GROUP BY user_id),
hist AS (SELECT t.*, b.boundary FROM lit_tgt t JOIN touched b USING (user_id)),
scope AS ({SCOPE[mode]}),
kept AS (
  SELECT s.user_id, s.attr, s.valid_from_dttm FROM scope s
  LEFT ANTI JOIN lit_src x ON x.user_id = s.user_id AND x.valid_from_dttm = s.valid_from_dttm
  UNION ALL SELECT user_id, attr, valid_from_dttm FROM lit_src),
hashed AS (
  SELECT *, md5(coalesce(attr, 'none')) AS hk,
         lag(md5(coalesce(attr, 'none'))) OVER (PARTITION BY user_id ORDER BY valid_from_dttm) AS prev FROM kept),
rebuilt AS (
  SELECT user_id, attr, valid_from_dttm,
         lead(valid_from_dttm) OVER (PARTITION BY user_id ORDER BY valid_from_dttm) AS valid_to_dttm
  FROM hashed WHERE prev IS NULL OR hk <> prev),
ups AS (SELECT r.* FROM rebuilt r LEFT SEMI JOIN lit_src s
        ON s.user_id = r.user_id AND s.valid_from_dttm = r.valid_from_dttm),
closes AS (SELECT r.* FROM rebuilt r LEFT ANTI JOIN lit_src s
           ON s.user_id = r.user_id AND s.valid_from_dttm = r.valid_from_dttm),
dels AS (SELECT s.user_id, s.valid_from_dttm FROM scope s LEFT ANTI JOIN rebuilt r
         ON r.user_id = s.user_id AND r.valid_from_dttm = s.valid_from_dttm),
changed AS (SELECT user_id, valid_from_dttm FROM ups UNION ALL SELECT user_id, valid_from_dttm FROM closes
            UNION ALL SELECT user_id, valid_from_dttm FROM dels)
SELECT t.user_id, t.attr, t.valid_from_dttm, t.valid_to_dttm FROM lit_tgt t
LEFT ANTI JOIN changed c ON c.user_id = t.user_id AND c.valid_from_dttm = t.valid_from_dttm
UNION ALL SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM ups
UNION ALL SELECT user_id, attr, valid_from_dttm, valid_to_dttm FROM closes
""")
