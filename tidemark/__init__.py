"""tidemark: layered (bronze / silver / gold) history tables on Spark.

Every operator is a pure ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst plans, prunes and pushes down as usual.  Writers are
thin and separate (``tidemark.sources.tables``).
"""

from tidemark.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
