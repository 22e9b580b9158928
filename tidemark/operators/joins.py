"""Key-based joins: new-key detection and the point-in-time (as-of) join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.history import VALID_FROM, VALID_TO
from tidemark.operators.ordered import bucket_column, with_latest


def new_keys(incoming: DataFrame, existing: DataFrame | None, key: str | list[str], first_seen: str,
             alias: str | None = None) -> DataFrame:
    """Keys of ``incoming`` absent from ``existing`` with their earliest ``first_seen``.

    The incoming rows are reduced to one row per key first (a partial aggregate,
    so a hot key costs one row per task) and only then anti-joined.
    """
    keys = [key] if isinstance(key, str) else list(key)
    firsts = incoming.groupBy(*keys).agg(F.min(first_seen).alias(alias or first_seen))
    if existing is None:
        return firsts
    return firsts.join(existing.select(*keys), keys, "left_anti")


def as_of_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    at: str,
    version_key: str | None = None,
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
    how: str = "left",
    bucket_seconds: float | None = None,
) -> DataFrame:
    """Attach to each fact the version valid at ``at``.

    Condition: same key, ``valid_from <= at`` and (``valid_to`` is NULL or
    ``at < valid_to``).  Both sides are split by a time bucket of ``at``: each
    version is repeated once per bucket of its interval that lies between the
    key's first and last fact bucket, and the join is an equi-join on
    ``(key, bucket)`` plus the interval test.  So a key with very many facts is
    spread over many tasks, each fact is only tested against the versions of
    its own bucket, and an interval that ends in the far future costs nothing.
    """
    vk = version_key or key
    if vk == key:
        versions = versions.withColumnRenamed(vk, "__vkey")
        vk = "__vkey"
    fb = bucket_column(facts, at, bucket_seconds)
    facts_b = facts.withColumn("__fbucket", fb)
    span = facts_b.groupBy(key).agg(F.min("__fbucket").alias("__first_bucket"), F.max("__fbucket").alias("__last_bucket"))
    vfrom_b = bucket_column(versions, valid_from, bucket_seconds)
    vto_b = bucket_column(versions, valid_to, bucket_seconds)
    v = (versions
         .join(span.withColumnRenamed(key, vk), vk, "inner")
         .withColumn("__from_b", F.greatest(vfrom_b, F.col("__first_bucket")))
         .withColumn("__to_b", F.least(F.coalesce(vto_b, F.col("__last_bucket")), F.col("__last_bucket")))
         .where(F.col("__from_b") <= F.col("__to_b"))
         .withColumn("__vbucket", F.explode(F.sequence(F.col("__from_b"), F.col("__to_b"))))
         .drop("__from_b", "__to_b", "__first_bucket", "__last_bucket"))
    cond = ((facts_b[key] == v[vk]) & (facts_b["__fbucket"] == v["__vbucket"])
            & (facts_b[at] >= v[valid_from])
            & (v[valid_to].isNull() | (facts_b[at] < v[valid_to])))
    out = facts_b.join(v, cond, how).drop("__fbucket", "__vbucket")
    if vk == "__vkey":
        out = out.drop("__vkey")
    return out


def as_of_carried(facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str = VALID_FROM, valid_to: str = VALID_TO) -> DataFrame:
    """Attach to each fact the version that began last by ``at``, if it is still valid then.

    Versions of a key must not overlap (a rebuilt history does not); ``as_of_join`` takes
    intervals that do.  Facts and versions are one union, in time order per key, and the last
    version is carried forward to the facts behind it: each side is read once, no version is
    copied, and a key with very many facts is spread over its time buckets.  Every fact
    is kept; without a version its columns are NULL.
    """
    columns = [c for c in versions.columns if c != key]
    moment = versions.schema[valid_from].dataType
    version = F.struct(*[F.col(c) for c in columns])
    empty = F.lit(None).cast(versions.select(version.alias("v")).schema["v"].dataType)
    both = (facts.select(key, F.col(at).cast(moment).alias("__at"), F.lit(1).alias("__fact"), F.struct(*[F.col(c) for c in facts.columns]).alias("__row"), empty.alias("__version"))
            .unionByName(versions.select(key, F.col(valid_from).alias("__at"), F.lit(0).alias("__fact"), version.alias("__version")), allowMissingColumns=True))
    found = with_latest(both, [key], ["__at", "__fact"], "__version", "__valid").where("__fact = 1")
    holds = F.col(f"__valid.{valid_to}").isNull() | (F.col("__at") < F.col(f"__valid.{valid_to}"))
    valid = F.when(F.col(key).isNotNull() & holds, F.col("__valid"))
    return found.withColumn("__valid", valid).select("__row.*", *[F.col(f"__valid.{c}").alias(c) for c in columns])
