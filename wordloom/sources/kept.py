"""Rows written once, where what is read again has to be the same: row numbers depend on how a scan was cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def shared_folder(rows: DataFrame) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; a temporary one only where all runs on one machine."""
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = context.getConf().get("spark.checkpoint.dir")
        if named is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def kept_as_table(rows: DataFrame) -> DataFrame:
    """Write the rows as a Parquet table of their own and read them back."""
    path = f"{shared_folder(rows)}/table-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
