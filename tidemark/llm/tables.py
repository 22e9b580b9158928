"""Small helpers shared by the operators: stored intermediates, row ids, columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only a ``local[...]`` session that names none (tests, a laptop) gets a
    scratch folder of its own; any other session without one is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        current = tempfile.mkdtemp(prefix="tidemark-llm-")
        sc.setCheckpointDir(current)
    return current.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Cuts the lineage: what depends on it survives a lost executor without
    recomputing (and possibly renumbering) what came before.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_STORED: list[str] = []


def release_stored(spark: SparkSession) -> int:
    """Delete the tables that ``stored`` has written so far; returns how many.  Call it
    once every result that reads them has been written or collected."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    count = len(_STORED)
    while _STORED:
        path = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        path.getFileSystem(conf).delete(path, True)
    return count


def text_of(column: str = "text"):
    """A text column, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_for(spark: SparkSession) -> int:
    """Shuffle partitions the session asks for, for Python stages that Spark does not size."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


ARROW_ROWS = 1024  # rows of an Arrow batch of texts; Spark's default of 10,000 may be gigabytes


def map_texts(source: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` over rows that hold texts, in batches of at most ``ARROW_ROWS``.

    Spark reads the batch size from the session when the plan runs, so a larger
    setting of the session is lowered and stays so.
    """
    conf, name = source.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= ARROW_ROWS:
        conf.set(name, str(ARROW_ROWS))
    return source.mapInArrow(run, schema)


def small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches of an Arrow map in slices of few rows, so that a worker never holds
    Python objects or results for a whole batch; what they took is given back at the end."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    pa.default_memory_pool().release_unused()


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` as a stored table with a unique number for each row, and that column's name."""
    row = "__row"
    while row in docs.columns:
        row += "_"
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), name), row
