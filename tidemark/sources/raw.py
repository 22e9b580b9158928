"""Raw JSON envelopes ``{"items": [...]}``: explicit-schema reads and writes.

Schemas are always declared, never inferred.  Partition columns
(``ingestion_date=``, ``channel_id=``) come from the directory names via
``basePath``; reading a date that has no directory raises ``PATH_NOT_FOUND``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: items per envelope written by the raw sink (an API page size).
ITEMS_PER_ENVELOPE = 50


def envelope_schema(item: T.StructType | str) -> T.StructType | str:
    """``{items: [item]}`` for an item schema given as a StructType or a DDL type string."""
    if isinstance(item, str):
        return f"struct<items:array<{item}>>"
    return T.StructType([T.StructField("items", T.ArrayType(item))])


CORRUPT = "corrupt"


def read_envelopes(spark: SparkSession, path: str | Sequence[str], item: T.StructType | str,
                   base_path: str | None = None, multi_line: bool = True, keep_corrupt: bool = False) -> DataFrame:
    """One row per item (column ``i``) plus the partition columns of the path.

    A file may hold one envelope or a top-level array of envelopes; an envelope
    without ``items`` contributes no rows.  With ``keep_corrupt`` a record that is no
    envelope gives a row too, without an item and with its text in ``corrupt`` (NULL
    in all others), so that it can be counted or set aside; else it is passed over.
    """
    schema = envelope_schema(item)
    if isinstance(schema, str):
        schema = schema.removeprefix("struct<").removesuffix(">").replace(":", " ", 1)
    if keep_corrupt:
        schema = T.StructType([*(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if base_path:
        reader = reader.option("basePath", base_path)
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    raw = reader.json(path)
    partition_cols = [c for c in raw.columns if c not in ("items", CORRUPT)]
    if keep_corrupt:
        items = F.when(F.col(CORRUPT).isNull(), F.col("items")).otherwise(F.array(F.lit(None).cast(raw.schema["items"].dataType.elementType)))
        return raw.select(*partition_cols, CORRUPT, F.explode(items).alias("i"))
    return raw.select(*partition_cols, F.explode("items").alias("i"))


def parse_envelopes(df: DataFrame, text: str | Column, item: T.StructType | str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Same as ``read_envelopes`` for envelopes held as JSON text in a column."""
    c = F.col(text) if isinstance(text, str) else text
    parsed = df.select(*keep, F.from_json(c, envelope_schema(item)).alias("__env"))
    return parsed.select(*keep, F.explode("__env.items").alias("i"))


def to_envelopes(df: DataFrame, group_cols: Sequence[str], item: Column, order_col: str,
                 per_envelope: int = ITEMS_PER_ENVELOPE) -> DataFrame:
    """Pack rows into envelopes of at most ``per_envelope`` items, as JSON text.

    Rows are numbered by ``order_col`` (unique within a group) and cut into
    fixed-size pages, so no envelope ever gathers an unbounded group.  Every item is
    written as text on its own before the rows move, so that a page gathers two flat values
    a row and is put in order without a comparing function.
    """
    page = F.floor(F.col(order_col) / F.lit(per_envelope))
    alone = F.to_json(F.array(item))  # of one item, whatever its type; a null is written too
    text = F.substring(alone, F.lit(2), F.length(alone) - 2)
    packed = (df.withColumn("__page", page)
              .groupBy(*group_cols, "__page")
              .agg(F.sort_array(F.collect_list(F.struct(F.col(order_col).alias("__o"), text.alias("__item")))).alias("__items")))
    return packed.select(*group_cols, "__page",
                         F.concat(F.lit('{"items":['), F.array_join("__items.__item", ","), F.lit("]}")).alias("envelope"))


def write_envelopes(df: DataFrame, path: str, partition_cols: Sequence[str], text_col: str = "envelope") -> None:
    """Raw sink: one JSON envelope per line, partitioned by ``ingestion_date`` (and more).

    Dynamic partition overwrite replaces the dates being written, so a rerun
    of the same day replaces it instead of duplicating it.
    """
    (df.select(*partition_cols, text_col)
       .write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols)
       .text(path))
