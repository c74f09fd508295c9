"""Per-batch row metrics (replaces dumping every raw row to the driver log)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playtally.functions.decode import is_accepted


def batch_metrics(decoded: DataFrame) -> DataFrame:
    """``batch_id, n_rows, n_rejected`` per batch."""
    return (decoded.groupBy("batch_id")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(~is_accepted()).alias("n_rejected")))


def observe_batch(decoded: DataFrame, name: str = "batch") -> DataFrame:
    """Attach the same metrics as an observation (visible in query progress)."""
    return decoded.observe(name, F.count(F.lit(1)).alias("n_rows"),
                           F.count_if(~is_accepted()).alias("n_rejected"))
