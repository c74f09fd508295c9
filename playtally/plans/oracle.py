"""DuckDB SQL oracles for the registered queries (tables are pre-registered views).

Every oracle starts from the message CTEs below, which build the same message
table, decode contract, batch sums, running sums, notices and ledger in plain
SQL over ``events``. Sums are cast to BIGINT (DuckDB sums integers to HUGEINT).
"""

from __future__ import annotations

import re

# A count: a plain integer, or an unquoted number truncated to its low 32 bits.
_COUNT = r"""CASE WHEN regexp_full_match({text}, '\s*[+-]?[0-9]+\s*') AND try_cast({text} AS INTEGER) IS NOT NULL
     THEN try_cast({text} AS INTEGER)
     WHEN regexp_full_match({text}, '-?[0-9]+([.][0-9]+)?([eE][+-]?[0-9]+)?')
          AND json_type({json}, '$.count') <> 'VARCHAR'
     THEN CAST(((CAST(trunc(CAST({text} AS DECIMAL(38, 9))) AS HUGEINT) % 4294967296 + 4294967296 + 2147483648)
                % 4294967296) - 2147483648 AS INTEGER) END"""

# Fixed values used in the SQL: notice limit 3000, resume before batch 3,
# partition 3 never committed (same as playtally.plans.batch_queries).
MESSAGE_CTES = r"""
WITH K AS (
  SELECT event_id, ts, CAST(user_id AS VARCHAR) u, json_extract_string(props, '$.k') c FROM events),
M AS (
  SELECT event_id, CAST(floor((day(ts) - 1) / 5) AS BIGINT) batch_id, 'dmp' topic,
         CAST(event_id % 4 AS INTEGER) "partition", CAST(event_id // 4 AS BIGINT) "offset",
         CASE WHEN event_id % 101 = 0 THEN 'message: not json'
              WHEN event_id % 103 = 0 THEN '{"targetId":' || u || '}'
              WHEN event_id % 107 = 0 THEN '{"targetId":' || u || ',"count":' || c || '.9}'
              WHEN event_id % 109 = 0 THEN '{"targetId":' || u || ',"count":' || c || 'e1}'
              WHEN event_id % 113 = 0 THEN '{"targetId":' || u || ',"count":' || (CAST(c AS BIGINT) + 4294967296) || '}'
              WHEN event_id % 127 = 0 THEN '{"targetId":' || u || ',"count":"' || c || '.9"}'
              WHEN event_id % 131 = 0 THEN '{"targetId":' || u || ',"count":' || c || '.9,"meta":{"count":"1"}}'
              WHEN event_id % 137 = 0
              THEN '{"targetId":' || u || ',"count":' || (CAST(c AS BIGINT) + 4294967296) || ',"note":"see count: ''x''"}'
              WHEN event_id % 139 = 0 THEN '{"targetId":' || u || ',"count":"' || c || '.9","meta":{"count":1}}'
              WHEN event_id % 4 = 0 THEN 'message: {"targetId":' || u || ',"count":' || c || '}'
              WHEN event_id % 4 = 1 THEN 'message: ' || chr(9) || '{"targetId":' || u || ',"count":' || c || '} ' || chr(13) || chr(10)
              WHEN event_id % 4 = 2 THEN '{"targetId":"' || u || '","count":"' || c || '","extra":1}'
              ELSE '{"targetId":' || u || ',"count":' || c || '}' END line
  FROM K),
B AS (SELECT *, CASE WHEN starts_with(line, 'message: ') THEN substr(line, 10) ELSE line END body FROM M),
J AS (SELECT *, regexp_replace(body, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') json FROM B),
P AS (SELECT *, CASE WHEN json_valid(json) THEN json_extract_string(json, '$.targetId') END target_text,
                CASE WHEN json_valid(json) THEN json_extract_string(json, '$.count') END count_text FROM J),
A AS (SELECT *, try_cast(target_text AS BIGINT) target_id, @COUNT(json, count_text)@ "count" FROM P),
D AS (SELECT * FROM A WHERE target_id IS NOT NULL AND "count" IS NOT NULL),
C AS (SELECT batch_id, target_id, CAST(sum("count") AS BIGINT) batch_count FROM D GROUP BY ALL),
R AS (SELECT batch_id, target_id,
             CAST(sum(batch_count) OVER (PARTITION BY target_id ORDER BY batch_id) AS BIGINT) view_count FROM C),
N AS (SELECT batch_id, target_id, 'view:flag:' || target_id notice_key, view_count FROM R WHERE view_count > 3000
      QUALIFY row_number() OVER (PARTITION BY target_id ORDER BY batch_id) = 1),
L AS (SELECT batch_id, topic, "partition", min("offset") from_offset, max("offset") + 1 until_offset FROM M GROUP BY ALL),
RS AS (
  SELECT p.topic, p."partition", coalesce(c.until_offset, 0) from_offset
  FROM (SELECT DISTINCT topic, "partition" FROM M) p
  LEFT JOIN (SELECT topic, "partition", max(until_offset) until_offset FROM L
             WHERE batch_id < 3 AND "partition" <> 3 GROUP BY ALL) c
    ON p.topic = c.topic AND p."partition" = c."partition"),
NS AS (
  SELECT batch_id,
         try_cast(CASE WHEN json_valid(line) THEN json_extract_string(line, '$.targetId') END AS BIGINT) target_id,
         @COUNT(line, (CASE WHEN json_valid(line) THEN json_extract_string(line, '$.count') END))@ "count"
  FROM M)
"""

TOTALS = """SELECT target_id, CAST(sum("count") AS BIGINT) view_count FROM D GROUP BY target_id"""

STATE = f"""SELECT 'total' AS kind, CAST(-1 AS BIGINT) AS batch_id, target_id AS k, view_count AS v FROM ({TOTALS})
UNION ALL SELECT 'notice', batch_id, target_id, view_count FROM N
UNION ALL SELECT 'ledger', batch_id, CAST("partition" AS BIGINT), until_offset FROM L"""

# Without offsets: totals and notices.
LOGGED = f"""SELECT 'total' AS kind, CAST(-1 AS BIGINT) AS batch_id, target_id AS k, view_count AS v FROM ({TOTALS})
UNION ALL SELECT 'notice', batch_id, target_id, view_count FROM N"""

# The same over six batches cut by event_id, of the messages for which {kept} holds; the ledger is of all.
CUT = """SELECT 'total' AS kind, CAST(-1 AS BIGINT) AS batch_id, target_id AS k, CAST(sum("count") AS BIGINT) AS v
FROM D WHERE {kept} GROUP BY target_id
UNION ALL (
  SELECT 'notice', nb, target_id, view_count FROM (
    SELECT nb, target_id, CAST(sum(c) OVER (PARTITION BY target_id ORDER BY nb) AS BIGINT) view_count FROM (
      SELECT event_id * 6 // (SELECT max(event_id) + 1 FROM M) nb, target_id, sum("count") c FROM D WHERE {kept} GROUP BY ALL))
  WHERE view_count > 3000 QUALIFY row_number() OVER (PARTITION BY target_id ORDER BY nb) = 1)
UNION ALL (
  SELECT 'ledger', event_id * 6 // (SELECT max(event_id) + 1 FROM M) nb, CAST("partition" AS BIGINT), max("offset") + 1
  FROM M GROUP BY nb, "partition")"""

_BODIES = {
    "message_value": 'SELECT topic, "partition", "offset", line FROM M',
    "topic_partitions": 'SELECT DISTINCT topic, "partition" FROM M',
    "strip_prefix": "SELECT event_id, body FROM B",
    "trim_control": "SELECT event_id, json FROM J",
    "parse_json": "SELECT event_id, target_text, count_text FROM P",
    "decode_messages": 'SELECT event_id, target_id, "count" FROM D',
    "rejected_messages": 'SELECT event_id, line FROM A WHERE target_id IS NULL OR "count" IS NULL',
    "format_keys": ("SELECT DISTINCT target_id, 'view:count:' || target_id AS counter_key, "
                    "'view:flag:' || target_id AS notice_key FROM D"),
    "batch_counts": "SELECT batch_id, target_id, batch_count FROM C",
    "batch_counts_nostrip": ('SELECT batch_id, target_id, CAST(sum("count") AS BIGINT) batch_count FROM NS '
                             'WHERE target_id IS NOT NULL AND "count" IS NOT NULL GROUP BY batch_id, target_id'),
    "running_counts": "SELECT batch_id, target_id, view_count FROM R",
    "total_counts": ("SELECT target_id, 'view:count:' || target_id AS counter_key, "
                     'CAST(sum("count") AS BIGINT) view_count FROM D GROUP BY target_id'),
    "over_threshold": "SELECT batch_id, target_id, view_count FROM R WHERE view_count > 3000",
    "threshold_notices": "SELECT batch_id, target_id, notice_key, view_count FROM N",
    "unnotified": ("SELECT r.target_id, r.view_count FROM R r "
                   "WHERE r.batch_id = (SELECT max(batch_id) FROM M) AND r.view_count > 3000 "
                   "AND NOT EXISTS (SELECT 1 FROM N n WHERE n.target_id = r.target_id "
                   "AND n.batch_id < (SELECT max(batch_id) FROM M))"),
    "notice_payload": """SELECT target_id, '{"targetId":' || target_id || '}' AS value FROM N""",
    "offset_ledger": 'SELECT batch_id, topic, "partition", from_offset, until_offset FROM L',
    "committed_offsets": 'SELECT topic, "partition", max(until_offset) until_offset FROM L GROUP BY ALL',
    "resume_offsets": 'SELECT topic, "partition", from_offset FROM RS',
    "scan_from_offsets": ('SELECT m.event_id, m."partition", m."offset" FROM M m JOIN RS r '
                          'ON m.topic = r.topic AND m."partition" = r."partition" AND m."offset" >= r.from_offset'),
    "batch_metrics": ('SELECT batch_id, count(*) n_rows, '
                      'count(*) FILTER (WHERE target_id IS NULL OR "count" IS NULL) n_rejected '
                      'FROM A GROUP BY batch_id'),
    # Streaming forms: the same results as their batch counterparts.
    "stream_scan": 'SELECT topic, "partition", "offset", line FROM M',
    "log_ingest": "SELECT replace(replace(line, chr(13), ''), chr(10), '') AS line FROM M",
    "stream_running_counts": ("SELECT batch_id, target_id, view_count FROM R "
                              f"UNION ALL SELECT CAST(-1 AS BIGINT), target_id, view_count FROM ({TOTALS})"),
    "stream_threshold_notices": "SELECT batch_id, target_id, notice_key, view_count FROM N",
    "stream_job": TOTALS,
    "stream_job_notices": "SELECT batch_id, target_id, notice_key, view_count FROM N",
    "stream_job_ledger": 'SELECT batch_id, topic, "partition", from_offset, until_offset FROM L',
    "stream_job_metrics": ('SELECT batch_id, count(*) n_rows, '
                           'count(*) FILTER (WHERE target_id IS NULL OR "count" IS NULL) n_rejected '
                           'FROM A GROUP BY batch_id'),
    "stream_job_deltas": "SELECT batch_id, target_id, batch_count FROM C",
    "stream_job_rejected": 'SELECT batch_id, event_id, line FROM A WHERE target_id IS NULL OR "count" IS NULL',
    "stream_replay": STATE,
    "stream_resume": CUT.format(kept="true"),
    "stream_log_resume": LOGGED,
    "stream_topic_ranges": CUT.format(
        kept='NOT ("partition" = 3 AND event_id * 6 // (SELECT max(event_id) + 1 FROM M) = 4)'),
    "stream_empty_batch": ('SELECT batch_id, count(*) n_rows, '
                           'count(*) FILTER (WHERE target_id IS NULL OR "count" IS NULL) n_rejected '
                           'FROM A WHERE batch_id <> 2 GROUP BY batch_id'),
    "stream_split_job": "SELECT batch_id, target_id, notice_key, view_count FROM N",
    "stream_delivery": 'SELECT event_id, target_id, "count" FROM D',
    "counter_table": ("SELECT target_id, 'view:count:' || target_id AS counter_key, "
                      'CAST(sum("count") AS BIGINT) view_count FROM D GROUP BY target_id'),
}


def _with_counts(sql: str) -> str:
    """Write the count rule out for each ``@COUNT(json, text)@``."""
    def rule(found: re.Match) -> str:
        json, _, text = found[1].partition(", ")
        return _COUNT.format(json=json, text=text)

    return re.sub(r"@COUNT\((.*)\)@", rule, sql)


def oracle_sql() -> dict[str, str]:
    ctes = _with_counts(MESSAGE_CTES)
    return {name: ctes + body for name, body in _BODIES.items()}
