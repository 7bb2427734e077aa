"""Where working data (stream outputs, checkpoints, staged files) goes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path that every executor can reach.

    It lies under the shared folder the session names in
    ``spark.checkpoint.dir``. Where none is named, a local session (one process)
    gets a folder of this machine, and any other session an error: executors
    would each write to a disk of their own. Paths are grouped by application id
    so that one application's leftovers can be removed together.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master.partition("[")[0] != "local":
            raise ValueError(
                f"spark.checkpoint.dir is not set: with master {master!r} working data"
                " needs a folder that driver and executors share"
            )
        root = tempfile.mkdtemp(prefix="weirflow-")
    app = spark.conf.get("spark.app.id", "local")
    return f"{root.rstrip('/')}/weirflow/{app}/{label}-{uuid.uuid4().hex}"
