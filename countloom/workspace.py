"""Where jobs put tables that must outlive an executor."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all nodes must reach.

    Where that is unset, a session within one process uses its warehouse; on a cluster that may be a folder of one
    machine, so there it is an error.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all nodes reach")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
