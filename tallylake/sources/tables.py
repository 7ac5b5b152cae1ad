"""Parquet tables, reports, SQL views and external tables."""

from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tallylake.operators.shared_tables import shared_folder
from tallylake.schemas import GOLD, PARTITIONS, ddl


def read_table(spark, path):
    return spark.read.parquet(path)


def write_table(df, path, partition_by=(), replace_all=True):
    """Overwrite a snappy parquet table.

    A partitioned table is rebalanced first: adaptive execution then merges the small months into one file each
    and splits a month that holds much of the data over several tasks. With replace_all=False only the partitions
    present in df are replaced.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        writer = writer.option("partitionOverwriteMode", "static" if replace_all else "dynamic")
    writer.parquet(path)


def write_csv_report(df, path):
    """Write a small result (a handful of groups) as a single CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_json_report(df, path):
    df.coalesce(1).write.mode("overwrite").json(path)


#: Holds the text of a report that does not fit its schema.
CORRUPT = "_corrupt_document"


def read_json_report(spark, path, schema=None):
    """JSON documents, one or several lines each. With a schema, a misfit keeps its text in _corrupt_document."""
    read = spark.read.option("multiLine", True)
    if schema is not None:
        read = read.schema(f"{schema}, {CORRUPT} string").option("columnNameOfCorruptRecord", CORRUPT)
    return read.json(path)


def write_bucketed(df, name, path, keys, buckets):
    """Store df as a catalog table over path, bucketed and sorted by keys: joins and groups by them need no exchange."""
    ordered = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    writer = ordered.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).option("compression", "snappy")
    writer.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


class Counted:
    """Row counts that writing tables yields on the way; frames of one table and layer add up."""

    def __init__(self):
        self._seen = []

    def watch(self, df, table, layer):
        seen = Observation(f"{layer} {table} {len(self._seen)}")
        self._seen.append((table, layer, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("row_count"))

    def frame(self, spark):
        """(table_name, layer, row_count) of all frames that were written."""
        sums = {}
        for table, layer, seen in self._seen:
            sums[table, layer] = sums.get((table, layer), 0) + seen.get["row_count"]
        rows = [(*key, n) for key, n in sums.items()]
        return spark.createDataFrame(rows, "table_name string, layer string, row_count bigint")


def register_views(tables):
    """Expose DataFrames to SQL: {view name: DataFrame}."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def gold_tables(spark, gold, names=GOLD):
    return {name: read_table(spark, f"{gold}/{name}") for name in names}


def run_sql(spark, text):
    """(result, None), or (None, "CONDITION: text") when the statement does not parse, resolve or run to its end.

    The statement runs here, once: its rows are checkpointed in the shared folder, in their order, so that an error in a
    row is caught and the result can be read without a second run.
    """
    try:
        result = spark.sql(text)
        if not result.columns:  # a command
            return result, None
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared_folder(spark))
        return result.checkpoint(), None
    except PySparkException as error:
        return None, f"{error.getCondition()}: {error}"


def create_gold_tables(spark, gold, database, names=GOLD):
    """Declare the Gold tables as external tables over their parquet folders and load their partitions."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in names:
        columns = GOLD[name]
        parts = PARTITIONS.get(name, [])
        partitioned = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl(columns)}) USING PARQUET {partitioned} "
            f"OPTIONS (compression 'snappy') LOCATION '{gold}/{name}'"
        )
        if parts:
            spark.sql(f"MSCK REPAIR TABLE {database}.{name}")


def audit_counts(stages):
    """Row counts per table and layer: {(table, layer): DataFrame} -> (table_name, layer, row_count)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "row_count"
        )
        for (table, layer), df in stages.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result
