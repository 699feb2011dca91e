"""Streaming intake of postings: the first row of each key, once, from files as they arrive."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import timedelta

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STATE = "starts array<bigint>, ends array<bigint>, places array<bigint>, rows array<string>"

#: A session: first event time, the time up to which a row joins it (both in milliseconds), and the place and text of its best row.
Session = tuple[int, int, int, str]


def joined(sessions: list[Session], new: Session) -> list[Session]:
    """The sessions of a key with one more, which becomes one with those it touches."""
    start, end, *best = new
    apart = []
    for s in sessions:
        if s[0] <= end and start <= s[1]:
            start, end, best = min(start, s[0]), max(end, s[1]), min(best, [s[2], s[3]])
        else:
            apart.append(s)
    return [*apart, (start, end, *best)]


def keep_first_stream(rows: DataFrame, keys: Sequence[str], order: Column, event_time: str, delay: str = "1 hour",
                      horizon: timedelta = timedelta(hours=1)) -> DataFrame:
    """For each key the row of least ``order`` (a bigint, null last; then the row's text), emitted when its time is over.

    Rows of a key within ``horizon`` of each other belong together, as a session. A session is emitted, and its state dropped, once the
    watermark, ``delay`` behind the latest ``event_time``, passes its last row by the horizon: state is bounded by the sessions of a horizon and a
    delay. For rows that are not late, in whatever order they arrive, this is what ``keep_first`` gives for each session of the whole table. Late rows are
    dropped and counted by Spark, see ``late_rows``; rows without an event time are left out. Null keys form groups of their own. A task takes
    the rows of a key one by one and holds its open sessions only; a hot key sends it as many as the trigger lets into a micro-batch.
    """
    schema = rows.schema
    whole = {"ignoreNullFields": "false"}
    packed = rows.where(F.col(event_time).isNotNull()).select(
        F.to_json(F.struct(*keys), whole).alias("key"), F.col(event_time).cast("timestamp").alias("at"),
        F.coalesce(order.cast("bigint"), F.lit((1 << 63) - 1)).alias("place"), F.to_json(F.struct(*rows.columns), whole).alias("row"))
    wait = int(horizon.total_seconds() * 1000)

    def update(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        sessions: list[Session] = list(zip(*state.get)) if state.exists else []
        if not state.hasTimedOut:
            for f in frames:
                for at, place, row in zip(f["at"], f["place"], f["row"]):
                    start = at.value // 1_000_000
                    sessions = joined(sessions, (start, start + wait, int(place), row))
        now = state.getCurrentWatermarkMs()
        done = sorted(s for s in sessions if s[1] < now)
        still = [s for s in sessions if s[1] >= now]
        if still:
            state.update(tuple(map(list, zip(*still))))
            state.setTimeoutTimestamp(min(s[1] for s in still) + 1)
        elif state.exists:
            state.remove()
        yield pd.DataFrame({"row": [s[3] for s in done]})

    out = packed.withWatermark("at", delay).groupBy("key").applyInPandasWithState(
        update, "row string", _STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return out.select(F.from_json("row", schema).alias("row")).select("row.*")


@dataclass
class Intake:
    """What a run took in: rows read, rows too late, and rows written."""

    read: int
    late: int
    batches: int


def late_rows(query: StreamingQuery) -> Intake:
    """Counts over the recorded batches of a query that has ended."""
    progress = query.recentProgress
    late = sum(s["numRowsDroppedByWatermark"] for p in progress for s in p["stateOperators"])
    return Intake(sum(p["numInputRows"] for p in progress), late, len(progress))


def run_intake(stream: DataFrame, target: str, checkpoint: str, **options) -> Intake:
    """Take in all files there are, in micro-batches, append the result to Parquet files, and stop.

    Called again with the same ``checkpoint`` it goes on where it ended, whether that was in good order or not; the file sink writes
    each micro-batch once. ``options`` are those of ``keep_first_stream``. Both folders must be shared by the executors.
    """
    kept = keep_first_stream(stream, **options)
    query = kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start(target)
    query.awaitTermination()
    return late_rows(query)
