"""Key and payload formats of the counter and notice outputs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Key formats of the counter and the notice flag.
COUNTER_KEY_FORMAT = "view:count:%d"
NOTICE_KEY_FORMAT = "view:flag:%d"


def counter_key(target_id: Column | str = "target_id") -> Column:
    return F.format_string(COUNTER_KEY_FORMAT, F.col(target_id) if isinstance(target_id, str) else target_id)


def notice_key(target_id: Column | str = "target_id") -> Column:
    return F.format_string(NOTICE_KEY_FORMAT, F.col(target_id) if isinstance(target_id, str) else target_id)


def notice_value(target_id: Column | str = "target_id") -> Column:
    """Notice message body: a JSON object with one long field ``targetId``."""
    tid = F.col(target_id) if isinstance(target_id, str) else target_id
    return F.to_json(F.struct(tid.cast("bigint").alias("targetId")))
