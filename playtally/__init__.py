"""playtally: keyed play counting on Spark DataFrames and Structured Streaming.

Messages (Kafka rows, log lines or stored tables) are decoded into
``(target_id, count)`` rows, summed per micro-batch and over all time, and a
notice is emitted once per target when its running total passes a limit.
Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own column expressions, so it runs unchanged on a batch table or a stream.
"""

from playtally.session import build_session, scratch_dir, work_root

__all__ = ["build_session", "scratch_dir", "work_root"]
