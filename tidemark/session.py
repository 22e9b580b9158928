"""Session options the library relies on.

No master and no shuffle-partition count are forced here: on a cluster those
come from the launcher, and AQE sizes shuffle partitions at run time.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Options every tidemark job expects.  Case-insensitive names (raw JSON uses
# camelCase, tables use lower case), UTC wall clock, ANSI kept on (casts that
# may fail use try_cast), AQE for partition coalescing and skew-join splitting.
# The overwrite mode is chosen per write (static replace, dynamic merge).
SESSION_OPTIONS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.caseSensitive": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tidemark", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or reuse) a session with the options above.

    ``master`` is only for tests and local runs; leave it ``None`` on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_OPTIONS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in SESSION_OPTIONS.items():
        if not key.startswith("spark.ui."):
            spark.conf.set(key, value)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a ``local[...]`` session without one (tests, a laptop) gets a
    scratch folder; a cluster session without one is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage of an intermediate that several plan branches read.

    The rows are written once as a Parquet table in a fresh folder under
    ``spark.checkpoint.dir`` (a shared folder on a cluster, so a lost executor
    loses nothing) and read back: one computation (an eager RDD checkpoint
    computes its plan twice), columnar storage, and column pruning on every
    later read.  Never a machine-local folder on a cluster, never
    ``localCheckpoint``.  The folder belongs to the innermost open
    ``scratch_scope``, or else to the session until ``release_scratch``.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    _SCOPES[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


# Folders written by ``materialize``: a list for each open scope, innermost last.
_SCOPES: list[list[str]] = [[]]


@contextmanager
def scratch_scope(spark: SparkSession):
    """Own the folders that ``materialize`` writes inside; deletes just them at the end."""
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        _SCOPES.remove(own)
        _delete(spark, own)


def release_scratch(spark: SparkSession) -> int:
    """Delete the folders that belong to no scope; returns how many.

    Call it once every DataFrame that reads them has been written or collected.
    """
    return _delete(spark, _SCOPES[0])


def _delete(spark: SparkSession, paths: list[str]) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    released = 0
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        fs = path.getFileSystem(conf)
        if fs.exists(path):
            fs.delete(path, True)
            released += 1
    return released
