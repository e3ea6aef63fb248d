"""What the operators need of the session: the shipped package and written intermediate tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cardwatch.session import ship_package


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is empty (a local session, as in tests) a folder
    under /tmp is set; a cluster without the setting is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        sc.setCheckpointDir("file:///tmp/cardwatch-scratch")
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: a plain scan that survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_columns(docs: DataFrame) -> DataFrame:
    """Only the key and the text (a null text is empty); other columns never reach an operator."""
    ship_package(docs.sparkSession)
    return docs.select(docs["doc_id"].cast(T.LongType()).alias("doc_id"), docs["text"].cast(T.StringType()).alias("text"))
