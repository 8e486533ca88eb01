"""Cutting a long lineage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """Materialise reliably in the session's checkpoint folder.

    The folder is the one named by ``spark.checkpoint.dir``. Only a local session without one gets
    a temporary folder; on a cluster a missing folder is an error, since a machine-local one would
    not survive the loss of its machine.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("Set spark.checkpoint.dir to a shared folder.")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
