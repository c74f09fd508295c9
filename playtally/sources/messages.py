"""Message tables derived from the ``events`` table.

A message row has the shape of a Kafka record after payload extraction:
``event_id, batch_id, topic, partition, offset, line``. The lines follow the
input contract of the counting job: an optional ``message: `` prefix, blanks
and control characters around the JSON, a JSON object with ``targetId`` and
``count``. Everything here is a narrow projection, so Spark reads only the
four ``events`` columns it needs and the plan stays in one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playtally.functions.decode import PREFIX

# Fixed values of the message fixture (must stay as they are for the
# expected results): topic name, number of topic partitions, days per
# micro-batch and the divisors that make bad messages and odd numbers.
TOPIC = "dmp"
TOPIC_PARTITIONS = 4
DAYS_PER_BATCH = 5
NOT_JSON_EVERY = 101
NO_COUNT_EVERY = 103
FRACTION_EVERY = 107
EXPONENT_EVERY = 109
WIDE_EVERY = 113
QUOTED_FRACTION_EVERY = 127
NESTED_TEXT_EVERY = 131
QUOTED_NAME_EVERY = 137
NESTED_NUMBER_EVERY = 139


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _payload(target: Column, count: Column, more: str = "") -> Column:
    return F.concat(F.lit('{"targetId":'), target, F.lit(',"count":'), count, F.lit(more + "}"))


def message_lines(events: DataFrame) -> DataFrame:
    """``events`` -> message rows (one message per event, same order keys)."""
    eid = F.col("event_id")
    u = F.col("user_id").cast("string")
    k = F.get_json_object(F.col("props"), "$.k")
    part = eid % TOPIC_PARTITIONS
    line = (
        F.when(eid % NOT_JSON_EVERY == 0, F.lit(PREFIX + "not json"))
        .when(eid % NO_COUNT_EVERY == 0, F.concat(F.lit('{"targetId":'), u, F.lit("}")))
        .when(eid % FRACTION_EVERY == 0, _payload(u, F.concat(k, F.lit(".9"))))
        .when(eid % EXPONENT_EVERY == 0, _payload(u, F.concat(k, F.lit("e1"))))
        .when(eid % WIDE_EVERY == 0, _payload(u, (k.cast("bigint") + F.lit(1 << 32)).cast("string")))
        .when(eid % QUOTED_FRACTION_EVERY == 0, _payload(u, F.concat(F.lit('"'), k, F.lit('.9"'))))
        .when(eid % NESTED_TEXT_EVERY == 0, _payload(u, F.concat(k, F.lit(".9")), ',"meta":{"count":"1"}'))
        .when(eid % QUOTED_NAME_EVERY == 0,
              _payload(u, (k.cast("bigint") + F.lit(1 << 32)).cast("string"), ',"note":"see count: \'x\'"'))
        .when(eid % NESTED_NUMBER_EVERY == 0, _payload(u, F.concat(F.lit('"'), k, F.lit('.9"')), ',"meta":{"count":1}'))
        .when(part == 0, F.concat(F.lit(PREFIX), _payload(u, k)))
        .when(part == 1, F.concat(F.lit(PREFIX + "\t"), _payload(u, k), F.lit(" \r\n")))
        .when(part == 2, F.concat(F.lit('{"targetId":"'), u, F.lit('","count":"'), k,
                                  F.lit('","extra":1}')))
        .otherwise(_payload(u, k))
    )
    return events.select(
        eid.alias("event_id"),
        F.floor((F.dayofmonth("ts") - 1) / DAYS_PER_BATCH).cast("bigint").alias("batch_id"),
        F.lit(TOPIC).alias("topic"),
        part.cast("int").alias("partition"),
        F.expr(f"event_id div {TOPIC_PARTITIONS}").cast("bigint").alias("offset"),
        line.alias("line"),
    )


def read_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch message table of a scale-factor folder."""
    return message_lines(read_table(spark, sf_dir, "events"))


def spread_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, dealt over all tasks before the lines are made: a stored file may be one row
    group, or in the order of the batches, and then few tasks would make and write a batch."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props")
    return message_lines(events.repartition("event_id", "ts", "user_id"))
