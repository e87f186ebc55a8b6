"""Streaming form of buffering-interval pairing, in event time.

Window functions are refused on streams, and a pairing in order of arrival is
wrong as soon as events come late or from several logs. Here a
``transformWithState`` processor keeps a session's starts and ends in slots of
event time; a slot is paired, in the total order of the batch form, once the
watermark has passed its end. What stays per session is its open slots and one
pending start. Each use of state is a call from Python to the JVM, so a session
has one timer at a time, and its rows go to their slots only by thousands.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from playback_qos.schema import EVT_BUFFER_END, EVT_BUFFER_START, INTERVALS, TELEMETRY_ORDER

#: How late an event may come (event time, against the newest event seen) and still be paired.
LATE = "10 minutes"
#: Width of a slot.
SLOT_MS = 60_000
#: Starts and ends of a session that are held in one list before they go to their slots.
SLICE = 4096


def _in_order(mark: tuple) -> tuple:
    """Sort key of (order columns, type): nulls first, as Spark sorts."""
    return tuple((v is not None, v) for v in mark)


class BufferingPairing(StatefulProcessor):
    """Emit (sessionId, started_at, ended_at, duration_ms) at each end whose previous start/end event is a start."""

    def __init__(self, marks: T.StructType, slot_ms: int = SLOT_MS, pending_ms: int | None = None):
        self.marks, self.slot_ms, self.pending_ms = marks, int(slot_ms), pending_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        held = T.StructType([T.StructField("marks", T.ArrayType(self.marks))])
        self.slots = handle.getMapState("slots", "slot long", held)
        self.few = handle.getListState("few", self.marks)  # marks that are in no slot yet: fewer than SLICE
        self.pending = handle.getValueState("pending_start", "started_at long")
        self.due = handle.getValueState("due", "at long, few long")  # the session's earliest timer, the length of few

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        at, n = self.due.get() or (None, 0)
        first, marks = at, []
        for r in rows:
            marks.append(tuple(r)[1:-1])  # without key and event time
            end = self._end(r[1] // self.slot_ms)
            first = end if first is None or end < first else first
            if n + len(marks) >= SLICE:
                self._keep([*map(tuple, self.few.get()), *marks] if n else marks)
                self.few.clear()
                n, marks = 0, []
        if marks:
            self.few.appendList(marks)
        if first != at:
            self.handle.registerTimer(first)  # no event of the slot is on time then
        self.due.update((first, n + len(marks)))
        return iter(())

    def _end(self, slot: int) -> int:
        return (slot + 1) * self.slot_ms - 1

    def _by_slot(self, marks: Iterable[tuple]) -> dict[int, list[tuple]]:
        slots: dict[int, list[tuple]] = {}
        for mark in map(tuple, marks):
            slots.setdefault(mark[0] // self.slot_ms, []).append(mark)
        return slots

    def _keep(self, marks: list[tuple]) -> None:
        for slot, own in self._by_slot(marks).items():
            if self.slots.containsKey((slot,)):
                own = [*map(tuple, self.slots.getValue((slot,))[0]), *own]
            self.slots.updateValue((slot,), (own,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # one timer closes all that the watermark has passed, in order of event time
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        at, n = self.due.get() or (None, 0)
        if at is not None and at > now:
            return  # that has been done already
        few = self._by_slot(self.few.get()) if n else {}
        held = {k[0] for k in self.slots.keys()}
        slots = sorted(held | few.keys())
        found = self.pending.get()
        before = started = None if found is None else found[0]
        while slots and self._end(slots[0]) <= now:
            slot = slots.pop(0)
            started = self._unless_old(started, self._end(slot) - 1)
            marks = few.pop(slot, [])
            if slot in held:
                marks += map(tuple, self.slots.getValue((slot,))[0])
                self.slots.removeKey((slot,))
            for mark in sorted(marks, key=_in_order):
                if mark[-1] == EVT_BUFFER_START:
                    started = mark[0]
                elif started is not None:
                    yield Row(sessionId=key[0], started_at=started, ended_at=mark[0], duration_ms=mark[0] - started)
                    started = None
        started = self._unless_old(started, now)
        if started is None:
            if before is not None:
                self.pending.clear()
        elif started != before:
            self.pending.update((started,))
        left = [mark for own in few.values() for mark in own]
        if left and len(left) < n:
            self.few.put(left)
        elif not left and n:
            self.few.clear()
        ahead = [self._end(slots[0])] if slots else []
        if started is not None and self.pending_ms is not None:
            ahead.append(started + self.pending_ms)
        if ahead:
            self.handle.registerTimer(min(ahead))
            self.due.update((min(ahead), len(left)))
        else:
            self.due.clear()

    def _unless_old(self, started: int | None, now: int) -> int | None:
        """A start, unless it is to be forgotten by ``now``."""
        return None if started is not None and self.pending_ms is not None and started + self.pending_ms <= now else started

    def close(self) -> None:
        pass


def buffering_intervals_stream(
    telemetry: DataFrame,
    order=TELEMETRY_ORDER,
    late: str = LATE,
    slot_ms: int = SLOT_MS,
    pending_days: int | None = None,
) -> DataFrame:
    """Streaming telemetry (typed) -> interval rows, append mode; the same rows as the batch form.

    ``order`` is event time (epoch ms) and then what tells apart events of one
    millisecond. Events may arrive in any order, ``late`` behind the newest one;
    those that come later still are dropped, and Spark counts them
    (``numRowsDroppedByWatermark``, see ``streaming.audit``). An interval comes
    out when the watermark has passed the slot of its end, so a run that drains
    its input keeps the last ``late`` of it in state for the next one.

    One slot of one session is in memory at a time, and up to ``SLICE`` other rows.
    Only starts and ends are shuffled. With ``pending_days`` a start whose end
    does not follow within so many days of event time is forgotten, so a session
    that ends on a start leaves nothing behind; a checkpoint keeps the choices it
    was made with.
    """
    order = list(order)
    if len(order) < 2:
        raise ValueError("events of one millisecond need a second order column")
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package
    marks = telemetry.filter(
        F.col("event_type").isin(EVT_BUFFER_START, EVT_BUFFER_END)
        & F.col("sessionId").isNotNull()
        & F.col(order[0]).isNotNull()
    )
    columns = [*order, "event_type"]
    kinds = T.StructType([T.StructField(c, telemetry.schema[c].dataType) for c in columns])
    return (
        marks.select("sessionId", *columns, F.timestamp_millis(order[0]).alias("_event_time"))
        .withWatermark("_event_time", late)
        .groupBy("sessionId")
        .transformWithState(
            statefulProcessor=BufferingPairing(kinds, slot_ms, None if pending_days is None else int(pending_days) * 86_400_000),
            outputStructType=INTERVALS,
            outputMode="Append",
            timeMode="EventTime",
        )
    )
