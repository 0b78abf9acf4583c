"""A session with the settings the operators are planned for."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def session(name: str = "readloom", **more: str) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | more).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; where it is unset, a temporary one, with a local master only."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Rows written to the shared folder and read back: computed once, and not again when executors are lost."""
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}-{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)
