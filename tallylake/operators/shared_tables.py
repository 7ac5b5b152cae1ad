"""Intermediate results written once to the folder that all executors share."""

import uuid


def shared_folder(spark):
    """The folder named by spark.checkpoint.dir, else the warehouse: both are shared by driver and executors."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return (folder or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def new_path(spark, label):
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df, label):
    """Write df once as parquet and read it back: cuts the lineage and survives the loss of any executor."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
