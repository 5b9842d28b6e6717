"""Tables in the folder that all executors share, written to cut a long lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. A local session without one gets a temporary folder of its machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        where = tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """``df``, written and read again: what follows starts from files that survive a lost executor."""
    to = f"{shared_dir(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(to)
    return df.sparkSession.read.schema(df.schema).parquet(to)
