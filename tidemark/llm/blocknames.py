"""Exact duplicates by deterministic block naming; DataFrame operations only.

A text is cut into fixed-size blocks of bytes.  The distinct blocks are put in
order (by 64-bit hash, length, and the content itself where those tie) and
numbered: the integer names.  Then adjacent pairs of names are sorted and named
anew, until each document holds one name.  Equal names mean equal texts; a hash
only places a block in the order and never decides that two blocks are equal.

Blocks are aggregated before they are shuffled, so the copies of a hot text cost
one row for each map task; documents join names and groups on stored tables, so
Spark can split a skewed key or broadcast a table of checked size.

Defined results: null texts equal empty ones; of rows with equal text and equal
(largest) id exactly one is kept; a null id ranks below all others; an empty
table gives no rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import numbered, stored, text_of

BLOCK_BYTES = 32 * 1024


def _blocks(text: str, block_bytes: int) -> Column:
    """The text's bytes in blocks; an empty text is one empty block."""
    raw = text_of(text).cast("binary")
    last = F.greatest(F.ceil(F.octet_length(raw) / F.lit(block_bytes)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * block_bytes + 1, F.lit(block_bytes)))


def _named(ordered: DataFrame, *order: str) -> DataFrame:
    """Number distinct rows in their order; stored, so that names never change again."""
    return stored(ordered.orderBy(*order).withColumn("name", F.monotonically_increasing_id()), "names")


def _block_names(docs: DataFrame, text: str, block_bytes: int) -> DataFrame:
    """(h, l, n, block, name): a name for each distinct block.  ``n`` counts the
    blocks that share hash and length; the content stays only where n > 1."""
    blocks = docs.select(F.explode(_blocks(text, block_bytes)).alias("block"))
    placed = blocks.groupBy(F.xxhash64("block").alias("h"), F.octet_length("block").alias("l")).agg(F.sort_array(F.collect_set("block")).alias("same"))
    distinct = placed.select("h", "l", F.size("same").alias("n"), F.posexplode("same").alias("j", "block"))
    distinct = distinct.withColumn("block", F.when(F.col("n") > 1, F.col("block")))
    return _named(stored(distinct, "blocks"), "h", "l", "j")


def identities(docs: DataFrame, keep: tuple[str, ...], text: str = "text", row: str = "__row",
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: ``row``, the ``keep`` columns, ``n_bytes``, ``text_sha256`` and the
    text's identity (``many``: more than one block, ``name``)."""
    names = _block_names(docs, text, block_bytes)
    marks = F.transform(_blocks(text, block_bytes), lambda b: F.struct(F.xxhash64(b).alias("h"), F.octet_length(b).alias("l")))
    rows = stored(docs.select(row, *keep, F.octet_length(text_of(text)).cast("bigint").alias("n_bytes"),
                              F.sha2(text_of(text).cast("binary"), 256).alias("text_sha256"), marks.alias("marks")), "marks")
    level = rows.select(row, F.posexplode("marks").alias("i", "mark")).select(row, "i", "mark.h", "mark.l")
    level = _join_names(docs, level, names, text, row, block_bytes)
    rows = rows.select(row, *keep, "n_bytes", "text_sha256", (F.size("marks") > 1).alias("many"))
    longest = level.agg(F.max("i")).first()[0]
    if not longest:
        return rows.join(level.select(row, "name"), row)
    single = level.join(rows.where("not many").select(row), row, "left_semi").select(row, "name") if longest else level
    level = level.join(rows.where("many").select(row), row, "left_semi").select(row, "i", "name")
    while longest:
        pairs = level.groupBy(row, F.expr("i div 2").cast("int").alias("i")).agg(
            F.max(F.expr("if(i % 2 = 0, name, null)")).alias("a"), F.coalesce(F.max(F.expr("if(i % 2 = 1, name, null)")), F.lit(-1)).alias("b"))
        pairs = stored(pairs, "pairs")
        level = stored(pairs.join(_named(pairs.select("a", "b").distinct(), "a", "b"), ["a", "b"]).select(row, "i", "name"), "level")
        longest //= 2
    return rows.join(single.unionByName(level.select(row, "name")), row)


def _join_names(docs: DataFrame, level: DataFrame, names: DataFrame, text: str, row: str, block_bytes: int) -> DataFrame:
    """(row, i, name) of every block.  Blocks whose hash and length only one
    content has join on those; the others join on the content as well."""
    out = level.join(names.where("n = 1").select("h", "l", "name"), ["h", "l"]).select(row, "i", "name")
    shared = names.where("n > 1").select("h", "l", "block", "name")
    if not shared.isEmpty():
        whole = docs.select(row, F.posexplode(_blocks(text, block_bytes)).alias("i", "block"))
        whole = whole.withColumns({"h": F.xxhash64("block"), "l": F.octet_length("block")})
        out = out.unionByName(whole.join(shared, ["h", "l", "block"]).select(row, "i", "name"))
    return stored(out, "level")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", row: str | None = None,
                     block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: the id, ``keep_id`` (the largest id among equal
    texts), ``group_size``, ``kept`` and ``text_sha256``; with ``row`` also that.

    ``row`` names a column that numbers the rows of a stored table; without it
    rows are numbered as they are read.
    """
    number = row or "__row"
    source = docs.select(F.col(id_col).alias("__id"), F.col(text).alias("__text"), *([F.col(row)] if row else [F.monotonically_increasing_id().alias(number)]))
    found = stored(identities(source, ("__id",), "__text", number, block_bytes), "identities")
    groups = found.groupBy("many", "name").agg(F.count("*").alias("group_size"), F.max(F.struct("__id", number)).alias("keep"))
    groups = stored(groups.where("group_size > 1").select("many", "name", "group_size", F.col("keep.__id").alias("keep_id"), F.col(f"keep.{number}").alias("keep_row")), "groups")
    out = found.join(groups, ["many", "name"], "left")
    own = F.col("group_size").isNull()
    return out.select(F.col("__id").alias(id_col), F.when(own, F.col("__id")).otherwise(F.col("keep_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
                      (own | (F.col("keep_row") == F.col(number))).alias("kept"), "text_sha256", *([number] if row else []))


def op6(spark, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = """
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(text) as text_sha256
from (select doc_id, coalesce(text, '') as text,
             max(doc_id) over (partition by coalesce(text, '')) as keep_id,
             count(*) over (partition by coalesce(text, '')) as group_size
      from documents)
"""


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts the row with the largest doc_id stays."""
    rows, row = numbered(docs, "exact")
    gone = stored(exact_duplicates(rows, row=row).where("not kept").select(row), "gone")
    return rows.join(gone, row, "left_anti").select(*docs.columns)
