"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Settings worth having on any session that runs these jobs. None of them changes a result.
RECOMMENDED_CONF = {
    # runtime re-planning: size-checked broadcasts, skewed joins split, small partitions merged
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # partitioned writes keep one open file per partition value instead of sorting the task
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # a union is not taken for partitioned by key, which adaptive execution may undo below it
    "spark.sql.unionOutputPartitioning": "false",
    # times are wall times; nothing here depends on the zone, but printed output does
    "spark.sql.session.timeZone": "UTC",
}


_LOCAL_FOLDERS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder path under the shared scratch folder.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Where that is unset, a
    local session gets a temporary folder; a session on a cluster is refused, as no machine-local
    folder would be seen by every executor.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        application = spark.sparkContext.applicationId
        if application not in _LOCAL_FOLDERS:
            _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="tapewright-")
        root = _LOCAL_FOLDERS[application]
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
