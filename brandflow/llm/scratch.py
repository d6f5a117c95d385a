"""Intermediate tables in the folder that the session names in ``spark.checkpoint.dir``.

A stage that is read more than once is written there as Parquet: it cuts the
lineage, survives lost executors and can be read with column pruning. The files
of one application lie under one folder; ``clear_scratch`` removes it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FOLDER = "brandflow-llm"


def scratch_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables.

    Only a local session (tests) may go without ``spark.checkpoint.dir``: it
    gets a temporary folder. Elsewhere executors would not see such a folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="brandflow-llm-"))
        root = sc.getCheckpointDir()
    return f"{root.rstrip('/')}/{FOLDER}/{sc.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new scratch table and read back."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables of this application. Results that read them must have been written before."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name
