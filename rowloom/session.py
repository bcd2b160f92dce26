"""The shared folder of a session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SCRATCH: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path under the folder the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset and Spark runs on this machine alone, as in local tests, a temporary folder is made and set as
    the session's folder. On a cluster an unset folder is an error: a machine's own folder is not seen by the others.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rowloom-"))
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A shared path for an intermediate result, which ``release`` removes."""
    path = shared_dir(spark, purpose)
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def release(spark: SparkSession) -> int:
    """Remove the intermediate results of this application, once nothing that reads them is needed; returns how many."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove(spark, path)
    return len(paths)
