"""Topics: value-only UTF-8 messages, read from Kafka or from files of lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import files


def read_topic(
    spark: SparkSession,
    topic: str,
    *,
    bootstrap: str | None = None,
    path: str | None = None,
    group: str | None = None,
    starting: str = "latest",
    **options: str,
) -> DataFrame:
    """Streaming DataFrame with one string column ``value``.

    With ``bootstrap`` it subscribes to the Kafka topic (the Kafka package must be on the class
    path); with ``path`` it follows the text files below ``path/topic``.
    """
    if bootstrap:
        reader = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
        )
        if group:
            reader = reader.option("groupIdPrefix", group)
        return reader.options(**options).load().select(F.col("value").cast("string").alias("value"))
    if path:
        return spark.readStream.options(**options).text(f"{path}/{topic}").select("value")
    raise ValueError("read_topic needs bootstrap servers or a path")


def read_table_stream(spark: SparkSession, folder: str, name: str, **options: str) -> DataFrame:
    """The parquet table ``name`` of a folder as a stream of files.

    The path is a pattern, as a file stream takes a plain path for a directory; a table may be one
    file or a directory of files.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}/{{{name}.parquet}}")


def to_wire(df: DataFrame) -> DataFrame:
    """One JSON object per row in column ``value``; null fields are written out."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_topic(
    lines: DataFrame,
    topic: str,
    checkpoint: str,
    *,
    bootstrap: str | None = None,
    path: str | None = None,
    query_name: str | None = None,
):
    """Stream writer for a DataFrame with a ``value`` column; the caller sets trigger and starts it."""
    writer = lines.select("value").writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    if bootstrap:
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic)
        )
    if path:
        return writer.format("text").option("path", f"{path}/{topic}")
    raise ValueError("write_topic needs bootstrap servers or a path")


def publish_batch(
    lines: DataFrame, topic: str, batch_id: int, *, bootstrap: str | None = None, path: str | None = None
) -> None:
    """Write one micro-batch of messages. Files of a batch appear in one step and once, as streams may follow them."""
    lines = lines.select("value")
    if bootstrap:
        lines.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save()
    elif path:
        place, aside = f"{path}/{topic}/batch={batch_id}", f"{path}/_aside/{topic}-{batch_id}"
        if not files.exists(lines.sparkSession, place):
            lines.write.mode("overwrite").text(aside)
            files.move(lines.sparkSession, aside, place)
    else:
        raise ValueError("publish_batch needs bootstrap servers or a path")
