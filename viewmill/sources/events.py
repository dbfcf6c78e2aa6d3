"""Event sources (Kafka or files, stream or batch) and the way from payload to product view."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewmill.schemas import EVENT_SCHEMA, PRODUCT_VIEW


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    security: Mapping[str, str] | None = None,
    fail_on_data_loss: bool = False,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka connector.

    ``security`` takes ``security.protocol``, ``sasl.mechanism`` and ``sasl.jaas.config``; keep the
    secret out of code and logs. ``starting_offsets`` counts on the first run only, later runs go on
    from the checkpoint. ``max_offsets_per_trigger`` bounds a micro-batch of a stream: without it the first one from
    ``earliest`` is the whole topic. ``min_partitions`` splits large topic partitions over more tasks.
    """
    limits = {"maxOffsetsPerTrigger": max_offsets_per_trigger, "minPartitions": min_partitions}
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    options.update({name: str(value) for name, value in limits.items() if value is not None})
    options.update({f"kafka.{name}": value for name, value in (security or {}).items()})
    return options


def kafka_events(spark: SparkSession, options: Mapping[str, str], streaming: bool = True) -> DataFrame:
    """Raw records with a binary ``value``. Needs the ``spark-sql-kafka`` package on the cluster."""
    reader = spark.readStream if streaming else spark.read
    return reader.format("kafka").options(**options).load()


def file_events(
    spark: SparkSession, path: str, streaming: bool = True, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Lines of JSON text files as ``value``, the same shape as :func:`kafka_events`."""
    reader = spark.readStream if streaming else spark.read
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format("text").load(path)


def decode_payload(records: DataFrame) -> DataFrame:
    """``value`` as text in ``json_payload``; the other columns stay."""
    others = [c for c in records.columns if c != "value"]
    return records.select(*others, F.col("value").cast("string").alias("json_payload"))


def parse_events(payloads: DataFrame) -> DataFrame:
    """``json_payload`` parsed into ``data`` by the fixed event schema; bad JSON gives NULL fields."""
    others = [c for c in payloads.columns if c != "json_payload"]
    return payloads.select(*others, F.from_json("json_payload", EVENT_SCHEMA).alias("data"))


def flatten_events(parsed: DataFrame) -> DataFrame:
    """The fields of ``data`` as columns."""
    return parsed.select(*[c for c in parsed.columns if c != "data"], "data.*")


def product_views(events: DataFrame, kind: str = PRODUCT_VIEW) -> DataFrame:
    """Events of one kind, with ``id`` named ``view_id``. A NULL kind is no match."""
    return events.filter(F.col("collection") == kind).withColumnRenamed("id", "view_id")


def views_from_records(records: DataFrame, kind: str = PRODUCT_VIEW) -> DataFrame:
    """Product views from raw records.

    Records that cannot hold ``kind`` are dropped by a text search before any JSON is parsed. A
    payload can spell the kind out or hide it behind a Unicode escape, so one with an escape is kept
    for the parser to judge; the result is that of parsing everything.
    """
    payloads = decode_payload(records.select("value"))
    text = F.col("json_payload")
    likely = payloads.filter(text.contains(kind) | text.contains("\\u"))
    return product_views(flatten_events(parse_events(likely)), kind)


def preview(df: DataFrame, n: int, order_by: str) -> DataFrame:
    """``n`` rows for a look at the data; ordered so that every run shows the same ones."""
    return df.orderBy(order_by).limit(n)
