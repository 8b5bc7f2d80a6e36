"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for an intermediate table.

    It lies in the shared folder that ``spark.checkpoint.dir`` names, so every
    executor sees it and the table outlives a lost executor. A session without that
    setting keeps such tables in its warehouse, which is shared as well.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        base = f"{spark.conf.get(WAREHOUSE_DIR).rstrip('/')}/scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
