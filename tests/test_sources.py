"""Sources: message table, Kafka options and row adapters, log text, JDBC options."""

import pytest
from pyspark.sql import functions as F

from playtally.sources import jdbc, kafka, logs
from playtally.sources.messages import read_messages

from conftest import SF_SMOKE


def test_message_table_shape(spark):
    m = read_messages(spark, SF_SMOKE)
    assert m.dtypes == [("event_id", "bigint"), ("batch_id", "bigint"), ("topic", "string"),
                        ("partition", "int"), ("offset", "bigint"), ("line", "string")]
    assert [r[0] for r in m.select("batch_id").distinct().orderBy("batch_id").collect()] == list(range(6))
    # Column pruning: only the four needed event columns reach the scan.
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,props:string>" in plan


def test_kafka_options():
    o = kafka.kafka_options("b:9092", ["dmp", "x"], starting_offsets='{"dmp":{"0":5}}',
                            group_id="group-dmp", max_offsets_per_trigger=1000, min_partitions=64)
    assert o == {"kafka.bootstrap.servers": "b:9092", "subscribe": "dmp,x",
                 "startingOffsets": '{"dmp":{"0":5}}', "failOnDataLoss": "true",
                 "kafka.group.id": "group-dmp", "maxOffsetsPerTrigger": "1000", "minPartitions": "64"}
    assert kafka.kafka_options("b:9092")["startingOffsets"] == "earliest"


def test_kafka_row_round_trip(spark):
    m = read_messages(spark, SF_SMOKE)
    rows = kafka.as_kafka_rows(m)
    assert [f.name for f in rows.schema] == ["key", "value", "topic", "partition", "offset",
                                             "timestamp", "timestampType"]
    back = kafka.kafka_messages(rows)
    assert back.exceptAll(m.select("topic", "partition", "offset", "line")).count() == 0
    assert back.count() == m.count()


def test_kafka_sink_rows(spark):
    df = spark.createDataFrame([(1, "a")], "target_id BIGINT, v STRING")
    out = kafka.kafka_sink_rows(df, value="v", topic="mq", partition=0)
    assert out.dtypes == [("value", "string"), ("topic", "string"), ("partition", "int")]


def test_log_text_and_read(spark, scratch):
    m = spark.createDataFrame([("a\r\n",), ("b\tc \r",), ("d",)], "line STRING")
    logs.log_text(m).write.text(f"{scratch}/logs")
    got = sorted(r.line for r in logs.read_log_lines(spark, f"{scratch}/logs", stream=False).collect())
    assert got == ["a", "b\tc ", "d"]
    sink = logs.log_to_topic(logs.read_log_lines(spark, f"{scratch}/logs", stream=False))
    assert {r.partition for r in sink.collect()} == {0} and {r.topic for r in sink.collect()} == {"dmp"}


def test_jdbc_options():
    o = jdbc.jdbc_options("jdbc:postgresql:db", "schema.t", user="u", password="p")
    assert o == {"url": "jdbc:postgresql:db", "dbtable": "schema.t", "user": "u", "password": "p",
                 "fetchsize": "10000"}
    p = jdbc.jdbc_options("jdbc:x", "t", partition_column="id", lower_bound=0, upper_bound=100,
                          num_partitions=8)
    assert p["partitionColumn"] == "id" and p["numPartitions"] == "8" and p["upperBound"] == "100"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", partition_column="id")
    with pytest.raises(ValueError):
        jdbc.read_jdbc(None, "jdbc:x", "t", style="nope")


def test_a_stored_group_of_events_is_made_and_replayed_by_several_tasks(spark, scratch):
    """One row group of events, in the order of time: many tasks make the lines, and a batch is released
    as files that several tasks read."""
    from playtally.session import partition_values
    from playtally.sources.messages import read_table, spread_messages
    from playtally.streaming.replay import StagedReplay

    (spark.range(0, 400_000, 1, 1).selectExpr("id as event_id", "timestamp_seconds(1704067200 + id * 6) as ts",
                                              "id % 1999 as user_id", "concat('{\"k\": ', id % 90, '}') as props")
     .write.parquet(f"{scratch}/events.parquet"))
    assert read_table(spark, scratch, "events").count() == 400_000
    rows = spread_messages(spark, scratch)
    assert rows.rdd.getNumPartitions() > 1
    assert rows.select(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first() == \
        read_messages(spark, scratch).select(F.count("*"), F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()
    replay = StagedReplay(spark, rows, f"{scratch}/stage", rows_per_file=10_000)
    replay.release(0)
    stored = spark.read.parquet(replay.inbox)
    assert partition_values(spark, replay.source, "batch_id") == [0, 1, 2, 3, 4, 5]
    assert stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0] <= 10_000
    assert len(stored.inputFiles()) >= stored.count() / 10_000 > 1
