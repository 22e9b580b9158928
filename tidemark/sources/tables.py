"""Tables in Spark's catalog, and merges of change sets into them.

``CatalogTables`` keeps ``namespace.table`` as a table of the session catalog, with its
files under a root (a shared path on a cluster).  Where the provider changes rows
itself (Iceberg, Delta) a merge is ``DataFrame.mergeInto``.  Parquet tables cannot; there
a merge rewrites the partitions a change set touches, by ``insertInto`` with dynamic
partition overwrite.  Such an overwrite leaves a partition alone that receives no row,
so one that loses its last row receives a marker row instead, which no read returns.
All paths, partition names and their escaping are Spark's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import changed, key_match
from tidemark.session import materialize

Apply = Callable[[DataFrame, DataFrame], DataFrame]
ROW_LEVEL = ("iceberg", "delta")  # providers that can merge rows
GONE = "__gone"  # true in the marker row of an emptied partition


class CatalogTables:
    def __init__(self, spark: SparkSession, root: str, provider: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.provider = provider
        # Databases of one catalog are told apart by their root.
        self._suffix = "_" + hashlib.md5(self.root.encode()).hexdigest()[:8]
        self._partitions: dict[str, tuple[str, Column | None]] = {}
        self._columns: dict[str, list[str]] = {}

    # ----------------------------------------------------------- namespaces
    def _parts(self, name: str) -> tuple[str, str]:
        if name.count(".") != 1:
            raise ValueError(f"table name must be namespace.table, got {name!r}")
        namespace, table = name.split(".")
        return namespace, table

    def catalog_name(self, name: str) -> str:
        namespace, table = self._parts(name)
        return f"{namespace}{self._suffix}.{table}"

    def path(self, name: str) -> str:
        namespace, table = self._parts(name)
        return f"{self.root}/{namespace}/{table}"

    def create_namespace(self, namespace: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}{self._suffix}` LOCATION {_quoted(f'{self.root}/{namespace}')}")

    def namespaces(self) -> list[str]:
        return sorted(d.name.removesuffix(self._suffix) for d in self.spark.catalog.listDatabases() if d.name.endswith(self._suffix))

    # ----------------------------------------------------------- tables
    def exists(self, name: str) -> bool:
        return self.spark.catalog.tableExists(self.catalog_name(name))

    def require(self, name: str) -> None:
        if not self.exists(name):
            raise ValueError(f"output table {name} does not exist")

    def create(self, name: str, schema: T.StructType | str, partition_by: str | None = None,
               partition_expr: Column | None = None, bucket_by: tuple[str, int] | None = None) -> None:
        """Create the table if absent; files that already lie under its path belong to it.

        ``partition_by`` names the partition column; with ``partition_expr`` it is derived
        from other columns (a hidden transform such as the day of ``valid_to_dttm``) and
        never returned by ``read``.  ``bucket_by`` (a column, a number of buckets) lays the rows
        out by the hash of a column, so that joins and groupings on it need not move them.
        """
        if partition_by:
            self._partitions[name] = (partition_by, partition_expr)
        empty = self.spark.createDataFrame([], schema)
        self._columns[name] = empty.columns
        if self.exists(name):
            return
        self.create_namespace(self._parts(name)[0])
        fields = self._with_partition(name, empty).withColumn(GONE, F.lit(None).cast("boolean")).schema.fields
        clauses = [f"CREATE TABLE {self.catalog_name(name)} ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in fields)})", f"USING {self.provider}"]
        if self.provider == "parquet":
            clauses.append("OPTIONS (partitionOverwriteMode 'dynamic')")
        if partition_by:
            clauses.append(f"PARTITIONED BY (`{partition_by}`)")
        if bucket_by:
            clauses.append(f"CLUSTERED BY (`{bucket_by[0]}`) INTO {bucket_by[1]} BUCKETS")
        self.spark.sql(" ".join([*clauses, f"LOCATION {_quoted(self.path(name))}"]))
        if partition_by and self.provider == "parquet":
            self._insert(name, empty, overwrite=False)  # the folder exists from here on
            self.spark.catalog.recoverPartitions(self.catalog_name(name))

    def _with_partition(self, name: str, df: DataFrame) -> DataFrame:
        part, expr = self._partitions.get(name, (None, None))
        if part and expr is not None:
            return df.withColumn(part, expr)
        return df

    def _raw(self, name: str) -> DataFrame:
        """The rows with their partition column."""
        self.require(name)
        return self.spark.table(self.catalog_name(name)).where(F.col(GONE).isNull()).drop(GONE)

    def read(self, name: str) -> DataFrame:
        return self._raw(name).select(*self._columns[name])

    def read_matching(self, name: str, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        """The table restricted to the partitions ``rows`` fall in, where that is sound.

        A row can only match stored rows of its own partition if the partition
        column is a plain column of the merge key; any other table is returned
        whole.  The restriction is a semi-join on the partition column, which
        Spark turns into pruning at run time; nothing is collected.
        """
        part, expr = self._partitions.get(name, (None, None))
        table = self.read(name)
        if not part or expr is not None or part not in keys or part not in rows.columns:
            return table
        return table.join(rows.select(part).distinct(), part, "left_semi").select(*table.columns)

    def partition_of(self, name: str) -> str | None:
        return self._partitions.get(name, (None, None))[0]

    def _insert(self, name: str, rows: DataFrame, overwrite: bool, emptied: DataFrame | None = None) -> None:
        """``rows`` in the table's column order; ``emptied`` holds partitions that get a marker row."""
        order = self.spark.table(self.catalog_name(name)).columns
        out = self._with_partition(name, rows.select(*self._columns[name])).withColumn(GONE, F.lit(None).cast("boolean"))
        if emptied is not None:
            out = out.unionByName(emptied.withColumn(GONE, F.lit(True)), allowMissingColumns=True)
        out.select(*order).write.insertInto(self.catalog_name(name), overwrite=overwrite)
        self.spark.catalog.refreshTable(self.catalog_name(name))

    def append(self, name: str, df: DataFrame) -> None:
        self.require(name)
        self._insert(name, df, overwrite=False)

    def replace(self, name: str, df: DataFrame) -> None:
        """Whole-content replacement; ``df`` may read the table, so it is stored first."""
        self.require(name)
        part, fresh = self.partition_of(name), materialize(df.select(*self._columns[name]))
        emptied = None
        if part:
            emptied = _partitions_without(self._raw(name).select(part).distinct(), self._with_partition(name, fresh), part)
        self._insert(name, fresh, overwrite=True, emptied=emptied)

    def merge(self, name: str, changes: DataFrame, apply: Apply, keys: Sequence[str] | None = None, clauses=None) -> None:
        """Apply a change set.

        A provider with row-level operations takes it as a MERGE with ``clauses`` (see
        ``scd1_merge_clauses``).  A Parquet table has the partitions rewritten that the change
        set touches: those of the rows to write and, with ``keys``, those that hold
        the stored rows of the changed keys now (a row may move, e.g. where a table is
        partitioned by the day of ``valid_to``), found by a read of the key columns alone.
        The range of these partitions is a literal filter, so files outside it are not read.
        """
        self.require(name)
        if self.provider in ROW_LEVEL and clauses is not None:
            on, when = clauses(self.catalog_name(name))
            when(self._with_partition(name, changes).alias("s").mergeInto(self.catalog_name(name), on)).merge()
            return
        part = self.partition_of(name)
        if not part:
            self.replace(name, apply(self.read(name), changes))
            return
        changes = materialize(changes)
        current = self._raw(name)
        written = changes
        if keys and "_operation" in changes.columns:
            written = changes.where(F.col("_operation") != "delete")
        touched = self._with_partition(name, written).select(part)
        if keys:
            touched = touched.unionByName(current.select(*keys, part).join(changes.select(*keys), list(keys), "left_semi").select(part))
        touched = materialize(touched.distinct())
        low, high, nulls = touched.agg(F.min(part), F.max(part), F.count_if(F.col(part).isNull())).first()
        if low is None and not nulls:
            return
        kind = current.schema[part].dataType
        within = F.col(part).between(F.lit(low).cast(kind), F.lit(high).cast(kind)) if low is not None else F.lit(False)
        scope = _semi(current.where(within | F.col(part).isNull() if nulls else within), touched, part, "left_semi")
        new = apply(scope.select(*self._columns[name]), changes)
        self._insert(name, new, overwrite=True, emptied=_partitions_without(touched, self._with_partition(name, new), part))


def _semi(left: DataFrame, right: DataFrame, column: str, how: str) -> DataFrame:
    """Semi- or anti-join on one column where NULL equals NULL."""
    other = right.select(F.col(column).alias("__other"))
    return left.join(other, F.col(column).eqNullSafe(F.col("__other")), how)


def _partitions_without(partitions: DataFrame, rows: DataFrame, part: str) -> DataFrame:
    return _semi(partitions, rows.select(part).distinct(), part, "left_anti")


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def assignments(columns: Sequence[str], prefix: str = "s") -> dict[str, Column]:
    """``{column: s.column}`` for a MERGE update or insert clause; never empty."""
    if not columns:
        raise ValueError("assignment columns must not be empty")
    return {c: F.col(f"{prefix}.{c}") for c in columns}


def scd1_merge_clauses(table: str, source_columns: Sequence[str], keys: Sequence[str]):
    """Clauses of a guarded key upsert: update only if a value differs, insert if new.

    The target is referred to by the last part of its name, the source as ``s``.
    """
    t = table.split(".")[-1]
    values = [c for c in source_columns if c not in keys and c != "processed_dttm"]

    def when(builder):
        if values:
            builder = builder.whenMatched(changed(t, "s", values)).update(
                assignments([c for c in source_columns if c not in keys]))
        return builder.whenNotMatched().insert(assignments(source_columns))

    return key_match(t, "s", keys), when


def scd2_merge_clauses(table: str, columns: Sequence[str], keys: Sequence[str]):
    """Clauses applying an SCD2 change set tagged ``upsert`` / ``close`` / ``delete``."""
    t = table.split(".")[-1]
    values = [c for c in columns if c not in keys]
    compare = [c for c in values if c != "processed_dttm"]
    op = F.col("s._operation")

    def when(builder):
        return (builder
                .whenMatched(op == "delete").delete()
                .whenMatched((op == "close") & ~F.col(f"{t}.valid_to_dttm").eqNullSafe(F.col("s.valid_to_dttm")))
                .update(assignments(["valid_to_dttm", "processed_dttm"]))
                .whenMatched((op == "upsert") & changed(t, "s", compare)).update(assignments(values))
                .whenNotMatched(op == "upsert").insert(assignments(columns)))

    return key_match(t, "s", keys), when
