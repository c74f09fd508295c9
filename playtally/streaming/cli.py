"""Run the play-count job from the command line (for ``spark-submit``).

    zip -r playtally.zip playtally
    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version> \\
        --py-files playtally.zip play_count_job.py --bootstrap host:9092 --topic dmp \\
        --out s3a://bucket/playcount --checkpoint s3a://bucket/playcount-ckpt

With ``--log-dir`` and ``--forward-to`` it streams the log lines into the topic
instead. Reads the topics (``--topic`` takes a comma-separated list; or
``--log-dir`` with rolled text files), runs the job with a processing-time
trigger (10 s by default) and waits for termination. On restart the checkpoint
resumes at the committed offsets; a first start reads from
``--starting-offsets`` (default ``earliest``). With ``--resume`` a job whose
checkpoint was lost goes on from what ``--out`` holds: a topic at the committed
positions (``--topic-partitions`` gives the partition count, one for all topics
or one each, so that partitions without a message yet start at 0), a log folder
without the files that were read.
"""

from __future__ import annotations

import argparse

from pyspark.sql import functions as F

from playtally.operators.notices import DEFAULT_LIMIT, NOTICE_QUEUE, notice_sink_rows
from playtally.operators.offsets import resume_offsets, starting_offsets_json
from playtally.session import build_session
from playtally.sources.kafka import DEFAULT_GROUP, DEFAULT_TOPIC, kafka_messages, kafka_options, read_kafka
from playtally.sources.logs import read_log_lines, start_log_to_topic
from playtally.streaming.job import DEFAULT_COMPACT_EVERY, committed_positions, start_job


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description="play-count streaming job")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--bootstrap", help="Kafka bootstrap servers")
    src.add_argument("--log-dir", help="folder of rolled log files")
    p.add_argument("--topic", default=DEFAULT_TOPIC, help="a topic, or several with commas")
    p.add_argument("--group", default=DEFAULT_GROUP, help="consumer group id")
    p.add_argument("--starting-offsets", default="earliest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=20_000_000,
                   help="messages of a micro-batch, at most")
    p.add_argument("--max-files-per-trigger", type=int, default=1000, help="log files of a micro-batch, at most")
    p.add_argument("--resume", action="store_true", help="new checkpoint on old output: go on from the ledger")
    p.add_argument("--topic-partitions", help="partitions of the topics, one number or one each (needed with --resume)")
    p.add_argument("--forward-to", help="bootstrap servers: stream --log-dir into the topic and count nothing")
    p.add_argument("--min-partitions", type=int,
                   help="split large topic partitions over at least this many tasks")
    p.add_argument("--out", help="output folder of the job")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--limit", type=int, default=DEFAULT_LIMIT)
    p.add_argument("--trigger", default="10 seconds")
    p.add_argument("--no-strip", action="store_true", help="parse raw lines (no prefix strip, no trim)")
    p.add_argument("--fail-fast", action="store_true")
    p.add_argument("--compact-every", type=int, default=DEFAULT_COMPACT_EVERY)
    p.add_argument("--keep-batches", type=int, default=10_000,
                   help="batches whose sums, ledger rows and rejected rows stay (behind the snapshots)")
    p.add_argument("--notice-topic", help=f"also send notices to this Kafka topic (e.g. {NOTICE_QUEUE})")
    args = p.parse_args(argv)
    if not args.out and not args.forward_to:
        p.error("--out is needed")
    if args.forward_to and not args.log_dir:
        p.error("--forward-to needs --log-dir")
    if args.resume and args.bootstrap and not args.topic_partitions:
        p.error("--resume needs --topic-partitions")
    if args.forward_to and "," in args.topic:
        p.error("--forward-to takes one topic")
    if args.topic_partitions:
        try:
            topic_sizes(args.topic, args.topic_partitions)
        except ValueError as exc:
            p.error(str(exc))
    return args


def topic_sizes(topics: str, partitions: str) -> dict[str, int]:
    """Partition counts: one number for all topics, or one each."""
    names, counts = topics.split(","), [int(n) for n in str(partitions).split(",")]
    if len(counts) not in (1, len(names)):
        raise ValueError("--topic-partitions needs one number, or one for each topic")
    return dict(zip(names, counts * len(names) if len(counts) == 1 else counts, strict=True))


def resume_offsets_json(spark, out: str, topics: str, partitions: int | str) -> str:
    """``startingOffsets`` for all partitions of the topics: committed positions, else 0."""
    every = spark.createDataFrame(list(topic_sizes(topics, str(partitions)).items()), "topic STRING, n INT").select(
        "topic", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("partition"))
    positions = resume_offsets(every, committed_positions(spark, out))
    return starting_offsets_json(positions).first()[0]


def kafka_notice_sender(bootstrap: str, topic: str):
    """``on_notices`` hook writing each batch's notices to a Kafka topic."""
    def send(notices, batch_id):
        (notice_sink_rows(notices, topic).write.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap).save())
    return send


def main(argv: list[str] | None = None) -> None:
    args = parse_args(argv)
    spark = build_session(app_name="playtally-job")
    if args.forward_to:
        lines = read_log_lines(spark, args.log_dir, max_files_per_trigger=args.max_files_per_trigger)
        start_log_to_topic(lines, args.checkpoint, {"kafka.bootstrap.servers": args.forward_to}, args.topic,
                           trigger={"processingTime": args.trigger}).awaitTermination()
        return
    if args.bootstrap:
        starting = args.starting_offsets
        if args.resume:
            starting = resume_offsets_json(spark, args.out, args.topic, args.topic_partitions)
        opts = kafka_options(args.bootstrap, args.topic.split(","), starting_offsets=starting, group_id=args.group,
                             max_offsets_per_trigger=args.max_offsets_per_trigger,
                             min_partitions=args.min_partitions)
        messages = kafka_messages(read_kafka(spark, opts))
    else:
        messages = read_log_lines(spark, args.log_dir, max_files_per_trigger=args.max_files_per_trigger)
    on_notices = None
    if args.notice_topic:
        if not args.bootstrap:
            raise SystemExit("--notice-topic needs --bootstrap")
        on_notices = kafka_notice_sender(args.bootstrap, args.notice_topic)
    query = start_job(messages, args.out, args.checkpoint, limit=args.limit,
                      trigger={"processingTime": args.trigger}, strip=not args.no_strip,
                      fail_fast=args.fail_fast, compact_every=args.compact_every,
                      query_name="playtally", on_notices=on_notices, resume=args.resume, keep_batches=args.keep_batches)
    query.awaitTermination()


if __name__ == "__main__":
    main()
