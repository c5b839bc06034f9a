"""A buffer as state with a lifetime: rows are inserted once, consumed, and expire by event-time timers.

Each link has one state: its row, its expiry and whether a report has used it. ``buffer_actions``
turns a stream of inserts and consumptions into a stream of what they did:

    inserted   the first row of a link that the buffer does not hold
    consumed   a held row that a report used; it never expires
    expired    a row that nobody used until the watermark passed its expiry; its link may come again

State lives in the RocksDB store (``STORE``) and survives restarts with the checkpoint; it holds one small row
a link that is open or consumed. Replaying the actions gives the table (``table_of``).
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
#: A stream's rows: kind is ``insert`` or ``consume``; at is the time that counts (of publication, of the report).
INPUT = "link string, kind string, at timestamp, payload string"
ACTIONS = "link string, action string, at timestamp, payload string, expires timestamp"
_STATE = "payload string, at long, expires long, used boolean"


class Lifetime(StatefulProcessor):
    """One link's life; ``days`` from the time of its row."""

    def __init__(self, days: int) -> None:
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", _STATE)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        link, first, used = key[0], None, None
        for r in rows:  # one pass: the earliest insert and the earliest consumption of the batch
            if r.at is None:
                continue
            if r.kind == "insert" and (first is None or (r.at, r.payload or "") < (first.at, first.payload or "")):
                first = r
            elif r.kind == "consume" and (used is None or r.at < used.at):
                used = r
        now = self.held.get() if self.held.exists() else None
        if now is None and first is not None:
            at = int(first.at.timestamp() * 1000)
            now = (first.payload, at, at + self.days * 86_400_000, False)
            self.held.update(now)
            self.handle.registerTimer(now[2])
            yield self._row(link, "inserted", at, now)
        if now is not None and used is not None and not now[3]:
            now = (now[0], now[1], now[2], True)
            self.held.update(now)
            yield self._row(link, "consumed", int(used.at.timestamp() * 1000), now)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = self.held.get() if self.held.exists() else None
        if now is not None and not now[3] and now[2] <= expiredTimerInfo.getExpiryTimeInMs():
            self.held.clear()
            yield self._row(key[0], "expired", now[2], now)

    def close(self) -> None:
        pass

    def _row(self, link: str, action: str, at: int, held) -> Row:
        from datetime import datetime

        return Row(link=link, action=action, at=datetime.fromtimestamp(at / 1000), payload=held[0], expires=datetime.fromtimestamp(held[2] / 1000))


def buffer_actions(rows: DataFrame, days: int = 56, late: str = "1 day") -> DataFrame:
    """rows: a stream of ``INPUT``; rows later than ``late`` are dropped, rows without a link too."""
    keyed = rows.where("link is not null").withWatermark("at", late).groupBy("link")
    return keyed.transformWithState(Lifetime(days), ACTIONS, "Append", "EventTime")


def run_buffer(spark: SparkSession, rows: DataFrame, path: str, checkpoint: str, days: int = 56, late: str = "1 day") -> StreamingQuery:
    """Process what is there, append the actions to Parquet and stop; reruns go on where it stopped."""
    before = spark.conf.get(STORE[0], None)
    spark.conf.set(*STORE)
    try:
        q = buffer_actions(rows, days, late).writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
        q.awaitTermination()
        return q
    finally:
        spark.conf.unset(STORE[0]) if before is None else spark.conf.set(STORE[0], before)


def table_of(actions: DataFrame) -> DataFrame:
    """The buffer after all actions: link, payload, expires, used; of a link that came again its last life counts."""
    last = actions.groupBy("link").agg(F.max_by(F.struct("action", "payload", "expires"), F.struct("expires", (F.col("action") != "inserted").alias("later"))).alias("a"))
    return last.where("a.action <> 'expired'").select("link", "a.payload", "a.expires", (F.col("a.action") == "consumed").alias("used"))
