"""Delivery of small result rows to an outside service, one client per partition.

The job's outputs are tables; when a service must also be told (a counter
store, a notice queue), deliver the *result* rows (notices, touched totals,
never raw messages) with one client per partition, opened on the executor:

* batch or inside ``foreachBatch``: :func:`deliver_partitions` uses
  ``DataFrame.foreachPartition``;
* with a record of what was sent: :func:`send_acknowledged` returns the sent rows;
* streaming: :class:`PartitionWriter` is a ``writeStream.foreach`` writer
  (open / process / close per partition and epoch).

``make_client()`` must build the client on the executor (clients do not
pickle); ``send(client, rows)`` gets rows in chunks of ``chunk`` so calls can
be pipelined or batched. Delivery is at-least-once: Spark may re-run a task,
so ``send`` should be idempotent (e.g. SET a flag, not INCR a counter).
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Row

from playtally.session import share_package

LOG = logging.getLogger(__name__)


def _chunks(rows: Iterable[Row], size: int):
    buf: list[Row] = []
    for row in rows:
        buf.append(row)
        if len(buf) >= size:
            yield buf
            buf = []
    if buf:
        yield buf


def send_acknowledged(df: DataFrame, make_client: Callable[[], Any],
                      send: Callable[[Any, list[Row]], None], chunk: int = 500) -> DataFrame:
    """The rows of ``df`` that were sent: the task that writes a row of the result has sent it.

    Each partition sends its rows in chunks through its own client. A chunk whose ``send`` raises
    is logged and left out, and the next one gets a new client, so one bad row or a lost
    connection costs its chunk only (``chunk=1``: its row). The send happens when the result is
    written; a task that runs again after a lost executor sends again.
    """
    share_package(df.sparkSession)
    schema = df.schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        client = None
        try:
            for batch in batches:
                sent: list[pa.RecordBatch] = []
                for start in range(0, len(batch), chunk):
                    part = batch.slice(start, chunk)
                    try:
                        client = make_client() if client is None else client
                        send(client, [Row(**r) for r in part.to_pylist()])
                    except Exception:
                        LOG.exception("%d rows were not sent", len(part))
                        _close(client)
                        client = None
                        continue
                    sent.append(part)
                yield from sent
        finally:
            _close(client)

    return df.mapInArrow(run, schema)


def _close(client: Any) -> None:
    close = getattr(client, "close", None)
    if callable(close):
        close()


def deliver_partitions(df: DataFrame, make_client: Callable[[], Any],
                       send: Callable[[Any, list[Row]], None], chunk: int = 500) -> None:
    """Send every row of ``df`` through one client per partition."""
    def run(rows: Iterable[Row]) -> None:
        client = make_client()
        try:
            for part in _chunks(rows, chunk):
                send(client, part)
        finally:
            _close(client)

    df.foreachPartition(run)


class PartitionWriter:
    """``writeStream.foreach`` writer: one client per partition and epoch."""

    def __init__(self, make_client: Callable[[], Any], send: Callable[[Any, list[Row]], None],
                 chunk: int = 500):
        self.make_client = make_client
        self.send = send
        self.chunk = chunk
        self._client = None
        self._buf: list[Row] = []

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._client = self.make_client()
        self._buf = []
        return True

    def process(self, row: Row) -> None:
        self._buf.append(row)
        if len(self._buf) >= self.chunk:
            self.send(self._client, self._buf)
            self._buf = []

    def close(self, error: BaseException | None) -> None:
        try:
            if error is None and self._buf:
                self.send(self._client, self._buf)
        finally:
            self._buf = []
            if self._client is not None:
                _close(self._client)
            self._client = None
