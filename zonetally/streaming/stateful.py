"""Per-key state: HIT or MISS on a live stream whose rows come out of order.

Rows wait in a list per key until the watermark has passed them, so none that is earlier can still
come; a timer then judges them in order of time. The rest of the state is one number, the end of the
stored answer, which a second timer removes. So the state holds what came within the watermark's delay
and answers that are still valid, not all keys ever seen.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

REUSE_OUT = "request_id bigint, cache_key string, cache string"
WAITING = "request_id bigint, us bigint, ttl_us bigint"
UNTIL = "valid_until_us bigint"
#: Rows of an output frame.
FRAME = 10_000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Judge(StatefulProcessor):
    """Keeps the rows of a key until their time is over, then says which of them find a valid answer."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.until = handle.getValueState("until", UNTIL)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for pdf in rows:
            usable = pdf[["request_id", "us", "ttl_us"]].dropna().astype("int64")
            if key[0] is None or usable.empty:
                continue
            self.waiting.appendList([tuple(map(int, r)) for r in usable.itertuples(index=False)])
            self.handle.registerTimer(int(usable["us"].min()) // 1000 + 1)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted(self.waiting.get(), key=lambda r: (r[1], r[0])) if self.waiting.exists() else []
        due = [r for r in waiting if r[1] <= passed]
        rest = waiting[len(due):]
        until = self.until.get()[0] if self.until.exists() else None
        ids, answers = [], []
        for request, us, ttl in due:
            miss = until is None or us >= until
            if miss:
                until = us + ttl
            ids.append(request)
            answers.append("MISS" if miss else "HIT")
        if due:
            if rest:
                self.waiting.put(rest)
                self.handle.registerTimer(rest[0][1] // 1000 + 1)
            else:
                self.waiting.clear()
            self.until.update((until,))
            self.handle.registerTimer(max(until, passed) // 1000 + 1)
        elif not rest and until is not None and until <= passed:
            self.until.clear()
        for start in range(0, len(ids), FRAME):
            part = slice(start, start + FRAME)
            yield pd.DataFrame({"request_id": ids[part], "cache_key": key[0], "cache": answers[part]})

    def close(self) -> None:
        pass


def hit_or_miss_stream(requests: DataFrame, delay: str = "2 minutes") -> DataFrame:
    """HIT or MISS per request (append mode); needs request_id, cache_key, us and ttl_us.

    A request is judged when the watermark has passed its time, as if all requests had come in order. Later ones are
    dropped and counted (`late_rows`). Rows without a key, an id or a time-to-live get no answer (`hit_or_miss` labels them
    null) but their times move the watermark: a source that falls silent sends such rows to have its last
    requests judged. The session's state store becomes the one that timers and lists need.
    """
    requests.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    timed = requests.withColumn("event_time", F.timestamp_micros("us")).withWatermark("event_time", delay)
    return timed.groupBy("cache_key").transformWithStateInPandas(Judge(), REUSE_OUT, "append", "eventTime")


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after the watermark had passed them, over the reports that the query still keeps."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)
