"""Sharding by extendible hashing; DataFrame operations only.

A document's hash bits lead it through a directory of bit prefixes.  A bucket is
the shortest prefix whose documents fit the byte limit: it splits on another bit
only while it is too large.  Bytes are summed for the directory's entries (with
map-side partial sums), never gathered; entries that no depth settles go on with
eight more bits, all others are done.

The bits are those of the MD5 of id and text, then those of a row number, so
that repeated rows part as well.  Defined results: a null id or text hashes as
the empty one; a document above the limit is a shard of its own; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import new_path, stored, text_of

SHARD_BYTES = 1 << 20
STEP = 8


def _bits(id_col: str, text: str, row: str) -> Column:
    digest = F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), text_of(text)))
    part = lambda at: F.lpad(F.conv(F.substring(digest, at, 15), 16, 2), 60, "0")
    return F.concat(part(1), part(16), F.lpad(F.bin(row), 64, "0"))


def _directory(rows: DataFrame, floor: int, depth: int, limit: int) -> DataFrame:
    """(entry, depth, bytes, docs) for every prefix of ``depth`` bits: the shortest of
    its prefixes from ``floor`` bits on that is settled; null where none is."""
    entries = stored(rows.groupBy(F.expr(f"substring(bits, 1, {depth})").alias("entry")).agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("docs")), "entries")
    levels = entries.withColumn("depth", F.explode(F.sequence(F.lit(floor), F.lit(depth)))).withColumn("prefix", F.expr("substring(entry, 1, depth)"))
    sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
    settled = stored(sums.where((F.col("bytes") <= limit) | (F.col("docs") == 1)), "settled")
    best = levels.select("entry", "depth", "prefix").join(settled, ["depth", "prefix"]).groupBy("entry").agg(F.min(F.struct("depth", "bytes", "docs")).alias("b"))
    return stored(entries.select("entry").join(best, "entry", "left").select("entry", "b.depth", "b.bytes", "b.docs"), "directory")


def assign_shards(docs: DataFrame, limit: int = SHARD_BYTES, id_col: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``shard`` (the prefix, as a
    string of bits), ``depth``, ``shard_bytes`` and ``shard_docs``; with ``row`` also that."""
    number = row or "__row"
    source = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), (F.col(row) if row else F.monotonically_increasing_id()).alias("__row"))
    rows = stored(source.select("__id", "__row", F.octet_length(text_of("__text")).cast("bigint").alias("n_bytes"), _bits("__id", "__text", "__row").alias("bits")), "hashed")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    floor, depth, done = 0, max(STEP, (total // limit).bit_length() + 4), []
    while True:
        directory = _directory(rows, floor, depth, limit)
        found = rows.withColumn("entry", F.expr(f"substring(bits, 1, {depth})")).join(directory, "entry")
        done.append(found.where("depth is not null").select(
            F.col("__id").alias(id_col), F.col("__row").alias(number), "n_bytes",
            F.expr("substring(bits, 1, depth)").alias("shard"), "depth", F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs")))
        if directory.where("depth is null").isEmpty():
            break
        rows = stored(found.where("depth is null").select("__id", "__row", "n_bytes", "bits"), "hashed")
        floor, depth = depth + 1, depth + STEP
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out if row else out.drop(number)


def write_shards(docs: DataFrame, assigned: DataFrame, row: str, path: str | None = None) -> str:
    """Write ``docs`` (a table numbered by ``row``) with a folder for each shard; returns the path."""
    path = path or new_path(docs.sparkSession, "shards")
    placed = docs.join(assigned.select(row, "shard"), row).drop(row)
    placed.repartition("shard").write.partitionBy("shard").parquet(path)
    return path


def op5(spark, sf_dir: str) -> DataFrame:
    return assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = f"""
with d as (
  select doc_id, cast(octet_length(encode(coalesce(text, ''))) as bigint) as n_bytes,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || coalesce(text, '')), 1, 15) as bigint) as k
  from documents),
p as (select doc_id, n_bytes, g.depth, k >> (60 - g.depth) as prefix from d, (select unnest(range(0, 41)) as depth) g),
s as (select *, sum(n_bytes) over (partition by depth, prefix) as shard_bytes, count(*) over (partition by depth, prefix) as shard_docs from p),
b as (select *, row_number() over (partition by doc_id order by depth) as r from s where shard_bytes <= {SHARD_BYTES} or shard_docs = 1)
select doc_id, n_bytes, case when depth = 0 then '' else lpad(bin(prefix), cast(depth as int), '0') end as shard,
       cast(depth as int) as depth, cast(shard_bytes as bigint) as shard_bytes, shard_docs
from b where r = 1
"""
