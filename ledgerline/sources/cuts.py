"""Lineage cuts in the folder that all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROW_GROUP_BYTES = 32 * 1024 * 1024
ONE_PROCESS = re.compile(r"local(\[[^,\]]*(,\s*\d+)?\])?$")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder in use: set by the caller, else named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may do
    without and gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named:
            if not ONE_PROCESS.match(context.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``; a lost executor then costs no more than the steps after the cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def kept_table(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: for large cuts, since it is compressed.

    ``group_rows`` bounds the rows of a row group, for rows so long that the writer's own look at
    the bytes, after a hundred of them, comes late, or that are far longer once decoded.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4()}"
    # A writer holds a row group in memory; smaller ones leave more of an executor to the work.
    writer = df.write.option("parquet.block.size", ROW_GROUP_BYTES)
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
