"""Structured Streaming counterparts: raw orders as a stream, and deduplicated windowed revenue."""

from pyspark.sql import functions as F

from tallylake.functions.expressions import as_type, missing_to_null
from tallylake.operators.shared_tables import new_path
from tallylake.schemas import RAW

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _to_event_time(column):
    """Zone-free timestamp as an instant in UTC: watermarks need an instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), column))


def _from_event_time(column):
    seconds = (F.unix_micros(column).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def stream_raw(spark, folder, table, fmt="csv"):
    """Raw files of a table as an unbounded, typed DataFrame; new files are picked up as they arrive."""
    types = RAW[table]
    reader = spark.readStream.schema(", ".join(f"{c} string" for c in types))
    files = reader.option("header", True).csv(folder) if fmt == "csv" else reader.json(folder)
    text = {c: missing_to_null(F.col(c)) for c in types}
    return files.select(*[as_type(text[c], dtype).alias(c) for c, dtype in types.items()])


def dedup_stream(stream, keys, time, delay, copies_over=16):
    """Drop repeats of a key that arrive within the watermark delay.

    Two steps: repeats are first dropped per (key, group of input splits), which spreads the copies of a very
    frequent key over copies_over tasks, then per key, which sees at most copies_over rows of it per delay.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(copies_over))
    spread = stream.withWatermark(time, delay).withColumn("_spread", group)
    return spread.dropDuplicatesWithinWatermark([*keys, "_spread"]).drop("_spread").dropDuplicatesWithinWatermark(keys)


def windowed_revenue(events, window="1 hour", delay="1 hour", copies_over=16):
    """Events and value per tumbling window and event type, repeats of an event_id dropped. Emits closed windows."""
    timed = events.select(
        "event_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"),
        _to_event_time(F.col("ts")).alias("event_time"),
    )
    return (
        dedup_stream(timed, ["event_id"], "event_time", delay, copies_over)
        .groupBy(F.window("event_time", window), "event_type")
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("revenue"))
        .select(
            _from_event_time(F.col("window.start")).alias("window_start"),
            "event_type",
            "events",
            F.col("revenue").cast("double").alias("revenue"),
        )
    )


def session_revenue(events, gap="30 minutes", delay="1 hour", copies_over=16):
    """Events and value per user session, repeats of an event_id dropped. Emits sessions that no late event can extend.

    A session ends when a user has been silent for the gap; late events within the delay open, extend or join sessions.
    """
    timed = events.select(
        "event_id", "user_id", F.col("value").cast("decimal(18,2)").alias("value"),
        _to_event_time(F.col("ts")).alias("event_time"),
    )
    return (
        dedup_stream(timed, ["event_id"], "event_time", delay, copies_over)
        .groupBy("user_id", F.session_window("event_time", gap).alias("session"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum("value").alias("revenue"))
        .select(
            "user_id",
            _from_event_time(F.col("session.start")).alias("session_start"),
            _from_event_time(F.col("session.end")).alias("session_end"),
            "events",
            F.col("revenue").cast("double").alias("revenue"),
        )
    )


def upsert_available(stream, path, checkpoint):
    """Process everything that has arrived into a table with a folder per micro-batch, and stop.

    A batch that runs again after a failure has the number it had and overwrites its own folder: its rows are there once.
    """
    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    query = (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/batch=*")


def run_available(stream, path, checkpoint):
    """Process everything that has arrived, append the closed results to a parquet table and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_available(stream, label):
    """run_available into a new table of the shared folder, read back as a batch DataFrame."""
    spark = stream.sparkSession
    path = new_path(spark, label)
    run_available(stream, path, new_path(spark, f"{label}-progress"))
    return spark.read.schema(stream.schema).parquet(path)
