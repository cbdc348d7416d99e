"""The live source: options for Spark's Kafka connector, and its rows as messages.

The connector is a separate public package; where it is not on the class path, captures take its place. Spark plans
offset ranges on the driver, so static membership, rebalances and revoked partitions need no code of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.plans.config import Source

#: Messages of a micro-batch at most: what bounds its memory, and a first batch that starts at the oldest offset.
MAX_MESSAGES = 1_000_000


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"')


def kafka_options(source: Source, streaming: bool = True, since_ms: int | None = None, max_messages: int | None = None, linger_s: float | None = None) -> dict[str, str]:
    """Options of format("kafka") for a configured source.

    A micro-batch holds at most max_messages. Given linger_s, it begins with that many, or so long after the last one.
    """
    own = {str(k): str(v).lower() if isinstance(v, bool) else str(v) for k, v in source.consumer_config.items()}
    reset = own.pop("auto.offset.reset", "earliest")
    for managed in ("enable.auto.commit", "partition.assignment.strategy", "group.instance.id"):
        own.pop(managed, None)
    options = {
        "kafka.bootstrap.servers": source.bootstrap_servers,
        "subscribe": ",".join(source.topics),
        "includeHeaders": "true",
        "startingOffsets": "latest" if reset == "latest" else "earliest",
        "failOnDataLoss": "true",
        "kafka.group.id": source.group_id,
        "kafka.sasl.mechanism": "PLAIN",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f'username="{_quoted(source.username)}" password="{_quoted(source.password)}";'
        ),
    } | {f"kafka.{k}": v for k, v in own.items()}
    if since_ms is not None:
        del options["startingOffsets"]
        options |= {"startingTimestamp": str(since_ms), "startingOffsetsByTimestampStrategy": "latest"}
    if streaming:
        options["maxOffsetsPerTrigger"] = str(max_messages or MAX_MESSAGES)
        if linger_s:
            options |= {"minOffsetsPerTrigger": options["maxOffsetsPerTrigger"], "maxTriggerDelay": f"{int(linger_s * 1000)}ms"}
    else:
        options["endingOffsets"] = "latest"
    return options


def messages_from_kafka(rows: DataFrame) -> DataFrame:
    """The connector's rows as messages: the timestamp in epoch milliseconds."""
    ms = F.coalesce(F.unix_millis("timestamp"), F.lit(-1).cast("long"))
    return rows.select("topic", "partition", "offset", ms.alias("timestamp"), "key", "value", "headers")


def stream_kafka(spark: SparkSession, source: Source, **options) -> DataFrame:
    return messages_from_kafka(spark.readStream.format("kafka").options(**kafka_options(source, **options)).load())


def read_kafka(spark: SparkSession, source: Source, since_ms: int | None = None) -> DataFrame:
    """A bounded read, up to the offsets at its start."""
    return messages_from_kafka(spark.read.format("kafka").options(**kafka_options(source, False, since_ms)).load())
