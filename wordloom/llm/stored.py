"""Cutting a plan: intermediate rows kept where every executor can read them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.sources.kept import kept_as_table, shared_folder

__all__ = ["cut", "kept_as_table", "placed"]


def cut(rows: DataFrame) -> DataFrame:
    """Write the rows to the checkpoint folder of the session and go on from there, in the partitions they have."""
    shared_folder(rows)
    return rows.checkpoint()


def placed(rows: DataFrame) -> DataFrame:
    """(file, at, ...) of a scan, the file's path and the row's place in it -> the same with `row` in their place.

    Numbers of a file follow each other without gaps, and every scan gives the same ones, however it is cut. The names
    of the files are numbered in one task and broadcast: a list the driver holds to plan the scan.
    """
    number = (F.row_number().over(Window.orderBy("file")) - 1).cast("long").alias("number")
    files = rows.select("file").distinct().select("file", number)
    row = F.shiftleft("number", 40) + F.col("at")
    others = [c for c in rows.columns if c not in ("file", "at")]
    return rows.join(F.broadcast(files), "file").select(row.alias("row"), *others)
