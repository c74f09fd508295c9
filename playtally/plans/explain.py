"""Print the final (adaptive) physical plans of the main batch queries.

    python -m playtally.plans.explain [sf_dir] > PLANS.md
"""

from __future__ import annotations

import sys

from playtally.functions.decode import CONTROL_AND_SPACE
from playtally.plans.batch_queries import BATCH_QUERIES
from playtally.session import build_session

SHOWN = ["decode_messages", "batch_counts", "total_counts", "running_counts", "threshold_notices",
         "unnotified", "offset_ledger", "scan_from_offsets"]


def _clean(plan: str) -> str:
    """Escape the control-character literals so plan lines stay intact."""
    return (plan.replace(CONTROL_AND_SPACE, "<U+0000..U+0020>")
            .replace("\r\n", "\\r\\n").replace("\t", "\\t"))


def main(sf_dir: str = "/root/testdata/sf0.01") -> None:
    spark = build_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Final physical plans ({sf_dir}, local[8], AQE on)\n")
    print("Generated by `python -m playtally.plans.explain`. Paths of scratch tables are shortened.\n")
    for name in SHOWN:
        df = BATCH_QUERIES[name](spark, sf_dir)
        df.collect()   # runs the frame's own plan, so AQE's final plan is shown (small sf only)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = _clean(plan)
        final = plan.split("\n+- == Initial Plan ==")[0]
        print(f"## {name}\n\n```")
        for line in final.splitlines():
            if "Location: InMemoryFileIndex" in line:
                head, _, tail = line.partition("Location: ")
                loc, _, rest = tail.partition(", PartitionFilters")
                line = head + "Location: " + (loc if "testdata" in loc else "<scratch table>") + \
                    ", PartitionFilters" + rest
            print(line)
        print("```\n")
    _job_notice_plan(spark, sf_dir)
    spark.stop()


def _job_notice_plan(spark, sf_dir: str) -> None:
    """Plan of the job's per-batch notice step for the last batch of a replay."""
    from pyspark.sql import functions as F

    from playtally.functions.decode import accepted, decode_messages
    from playtally.session import scratch_dir
    from playtally.sources.messages import read_messages
    from playtally.streaming.job import PlayCountBatch, start_job
    from playtally.streaming.replay import StagedReplay

    root = scratch_dir(spark, "explain-job")
    replay = StagedReplay(spark, read_messages(spark, sf_dir), f"{root}/stage")
    ids = replay.run(lambda s: start_job(s, f"{root}/out", f"{root}/ck", limit=3000,
                                         trigger={"availableNow": True}, compact_every=4))
    last = len(ids) - 1
    # As in the handler: the decoded batch and its deltas are cached once.
    decoded = decode_messages(replay.batch(ids[last]).drop("batch_id")).persist()
    deltas = (accepted(decoded).groupBy("target_id")
              .agg(F.sum("count").cast("bigint").alias("batch_count")).persist())
    df = PlayCountBatch(f"{root}/out", limit=3000)._notices(spark, deltas, last)
    df.collect()
    plan = _clean(df._jdf.queryExecution().executedPlan().toString()).split("\n+- == Initial Plan ==")[0]
    deltas.unpersist()
    decoded.unpersist()
    print(f"## streaming job: notice step of batch {last} (snapshot of batch 3 + deltas of batch 4)\n")
    print("Touched targets' history (latest snapshot + later deltas) semi-joined to the batch's")
    print("deltas, summed, filtered to the limit, anti-joined to earlier notices.\n\n```")
    for line in plan.splitlines():
        if "Location: InMemoryFileIndex" in line:
            head, _, tail = line.partition("Location: ")
            _, _, rest = tail.partition(", PartitionFilters")
            line = head + "Location: <job output>, PartitionFilters" + rest
        print(line)
    print("```\n")


if __name__ == "__main__":
    main(*sys.argv[1:])
