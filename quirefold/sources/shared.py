"""Where intermediate tables go: the shared folder the cluster names."""

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a local folder only where it is unset and Spark is local."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="quirefold-")
    return _LOCAL_ROOTS[context.applicationId]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
