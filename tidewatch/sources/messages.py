"""Message-log side of the pipeline: read, decode, publish."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.schemas import EVENT_SCHEMA


def read_kafka_stream(
    spark: SparkSession, bootstrap_servers: str, topic: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Undecoded messages of a topic. Needs the Kafka connector package on the classpath.

    Lost offsets do not fail the query; pass ``maxOffsetsPerTrigger`` or ``minPartitions`` as options
    to bound a micro-batch or to split large topic partitions over more tasks.
    """
    reader = spark.readStream.format("kafka").options(
        **{
            "kafka.bootstrap.servers": bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": "false",
            **options,
        }
    )
    return reader.load()


def decode_messages(messages: DataFrame, schema: StructType = EVENT_SCHEMA) -> DataFrame:
    """Event columns of each JSON message, its source position, and the text it was read from.

    A malformed payload gives an all-null event that the gate quarantines; ``raw_value`` keeps its text.
    The event goes through ``inline`` so that it is parsed once per message: a plain ``event.*`` lets the
    optimizer copy the parse into every later filter and column that uses one of its fields.
    """
    text = F.col("value").cast("string")
    parsed = messages.select(
        text.alias("raw_value"),
        F.col("topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    ).select("*", F.inline(F.array(F.from_json("raw_value", schema))))
    return parsed.select(*schema.names, "topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "raw_value")


def keyed_messages(events: DataFrame, payload: StructType = EVENT_SCHEMA) -> DataFrame:
    """(key, value) messages: the actor, or the event id where no actor is set, and the event as JSON.

    A narrow projection, so rows stay in the order and partition they were read in; the log assigns
    the topic partition from the key. Nulls are written out, as the consumer schema lists every field.
    """
    key, value = _message(payload)
    return events.select(key.alias("key"), value.alias("value"))


def _message(payload: StructType) -> tuple[Column, Column]:
    key = F.coalesce(F.nullif(F.col("actor_id"), F.lit("")), F.col("event_id"))
    return key, F.to_json(F.struct(*payload.names), {"ignoreNullFields": "false"})


def _word(value: Column, low: int) -> Column:
    """A 32-bit unsigned number times the constant with the given 32 bits, modulo 2^32, in steps that a long holds."""
    mask = F.lit(0xFFFFFFFF)
    high = F.shiftleft((value * F.lit(low >> 16)).bitwiseAND(mask), 16)
    return (high + value * F.lit(low & 0xFFFF)).bitwiseAND(mask)


def log_partition(key: Column, partitions: int) -> Column:
    """The partition that the message log's producers give a text key: 32-bit Murmur2 of its bytes, without sign, modulo their number."""
    # Fixed values of the hash: multiplier, seed and shifts.
    factor, seed, shifts = 0x5BD1E995, 0x9747B28C, (24, 13, 15)
    digits, size = F.hex(F.encode(key, "UTF-8")), F.octet_length(key).cast("long")

    def byte(at: Column) -> Column:
        return F.conv(F.substring(digits, (at * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("long")

    def word(at: Column) -> Column:
        return sum(F.shiftleft(byte(at * 4 + i), 8 * i) for i in range(4))

    def mixed(k: Column) -> Column:
        k = _word(k, factor)
        return _word(k.bitwiseXOR(F.shiftright(k, shifts[0])), factor)

    count = (size / 4).cast("long")
    places = F.filter(F.sequence(F.lit(0).cast("long"), count), lambda i: i < count)
    body = F.aggregate(places, F.lit(seed).cast("long").bitwiseXOR(size), lambda h, i: _word(h, factor).bitwiseXOR(mixed(word(i))))
    rest = size % 4
    tail = sum(F.when(rest > i, F.shiftleft(byte(count * 4 + i), 8 * i)).otherwise(F.lit(0).cast("long")) for i in range(3))

    def once(value: Column, step: Callable[[Column], Column]) -> Column:
        """``step`` of a value that is worked out a single time, however often the step uses it."""
        return F.aggregate(F.array(value), F.lit(0).cast("long"), lambda _, v: step(v))

    h = once(body, lambda v: F.when(rest > 0, _word(v.bitwiseXOR(tail), factor)).otherwise(v))
    h = once(h, lambda v: _word(v.bitwiseXOR(F.shiftright(v, shifts[1])), factor))
    h = once(h, lambda v: v.bitwiseXOR(F.shiftright(v, shifts[2])))
    return (h.bitwiseAND(F.lit(0x7FFFFFFF)) % partitions).cast("int")


def ordered_messages(events: DataFrame, partitions: int, payload: StructType = EVENT_SCHEMA) -> DataFrame:
    """(key, value, partition, sequence): messages in the order in which each partition of the log gets them.

    A key's messages belong in one log partition, and one task writes it, by event time, so every actor's events arrive in order, a dominant one's too. The
    sequence number counts the messages of a log partition from 1 and depends on the events alone: publishing them again numbers them alike, so a consumer
    can tell a repeat. Equal events are numbered in any order, as they cannot be told apart.
    """
    key, value = _message(payload)
    placed = events.select(
        key.alias("key"), value.alias("value"), log_partition(F.coalesce(key, F.lit("")), partitions).alias("partition"),
        F.col("event_time").alias("_time"), F.col("event_id").alias("_id"),
    )
    order = Window.partitionBy("partition").orderBy("_time", "_id", "value")
    return placed.withColumn("sequence", F.row_number().over(order)).select("key", "value", "partition", "sequence")


def publish(events: DataFrame, bootstrap_servers: str, topic: str, partitions: int, **options: str) -> None:
    """Append messages to a topic of so many partitions, in order; the sequence number is a header (Kafka connector package required)."""
    rows = ordered_messages(events, partitions)
    number = F.struct(F.lit("sequence").alias("key"), F.encode(F.col("sequence").cast("string"), "UTF-8").alias("value"))
    writer = rows.select("key", "value", "partition", F.array(number).alias("headers")).write.format("kafka").option("includeHeaders", "true")
    writer.options(**{"kafka.bootstrap.servers": bootstrap_servers, "topic": topic, **options}).save()
