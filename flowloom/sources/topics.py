"""Message topics: a Kafka topic, or a folder of files with the same ``value`` column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from flowloom.schemas import TOPIC_VALUE

KEY = StructField("key", StringType())


@dataclass(frozen=True)
class Topic:
    """``location`` is the bootstrap servers for Kafka, else the parent folder.

    The Kafka format needs its connector on the class path.
    """

    name: str
    location: str
    fmt: str = "kafka"
    options: dict[str, str] = field(default_factory=dict)

    @property
    def is_kafka(self) -> bool:
        return self.fmt == "kafka"

    @property
    def path(self) -> str:
        return f"{self.location}/{self.name}"

    def kafka_options(self, **defaults: str) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.location, **defaults, **self.options}


# What a batch takes at most unless told otherwise, so that the first one after an outage is no
# larger than the others can be: messages of a Kafka topic, files of a folder.
MOST_MESSAGES, MOST_FILES = 1_000_000, 1_000


def stream_messages(
    spark: SparkSession, topic: Topic, max_per_trigger: int | None = None
) -> DataFrame:
    """Unbounded read from now on; ``max_per_trigger`` bounds a batch's messages
    (files, for a folder)."""
    max_per_trigger = max_per_trigger or (MOST_MESSAGES if topic.is_kafka else MOST_FILES)
    if topic.is_kafka:
        options = topic.kafka_options(
            subscribe=topic.name, startingOffsets="latest", failOnDataLoss="false"
        )
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return spark.readStream.format("kafka").options(**options).load().select("value")
    reader = spark.readStream.format(topic.fmt).schema(TOPIC_VALUE).options(**topic.options)
    return reader.option("maxFilesPerTrigger", max_per_trigger).load(topic.path)


def batch_messages(spark: SparkSession, topic: Topic, with_key: bool = False) -> DataFrame:
    """Bounded read of everything the topic holds; ``with_key`` adds the text ``key``."""
    columns = ["value", *([F.col("key").cast("string").alias("key")] if with_key else [])]
    if topic.is_kafka:
        options = topic.kafka_options(subscribe=topic.name, startingOffsets="earliest")
        return spark.read.format("kafka").options(**options).load().select(*columns)
    schema = StructType([*TOPIC_VALUE.fields, *([KEY] if with_key else [])])
    reader = spark.read.format(topic.fmt).schema(schema).options(**topic.options)
    return reader.load(topic.path).select(*columns)


def publish_messages(
    values: DataFrame, topic: Topic, batch_id: int | None = None, key: str | None = None
) -> None:
    """Send a ``value`` column to a topic.

    With ``batch_id`` a folder topic replaces what an earlier try of the same batch
    wrote. A folder keeps the key in a column of that name. Kafka delivers at least once: give ``key`` so that readers can tell repeats.
    """
    if topic.is_kafka:
        columns = ["value"] if key is None else [F.col(key).cast("string").alias("key"), "value"]
        options = topic.kafka_options(topic=topic.name)
        values.select(*columns).write.format("kafka").options(**options).save()
        return
    kept = [] if key is None else [F.col(key).cast("string").alias("key")]
    payload = values.select(F.col("value").cast("binary").alias("value"), *kept)
    if batch_id is None:
        payload.write.format(topic.fmt).mode("append").save(topic.path)
    else:
        payload.write.format(topic.fmt).mode("overwrite").save(f"{topic.path}/batch_id={batch_id}")
