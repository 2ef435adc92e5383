"""Keyed state of the intent job on transformWithState."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.schemas import DAY_MS, HOUR_MS, WEEK_MS
from tidemark.streaming.behaviour import Behaviour, Session, Txn, may_keep

# Event time that state is kept for beyond its last use, for rows that come that late.
GRACE_MS = DAY_MS

# `output` is 'intent' or 'late'; a late row carries the event as JSON.
OUTPUT_SCHEMA = (
    "output string, customer_id string, product string, pattern_name string, pattern_metric double, "
    "propensity_score double, event_ts_ms bigint, session_window_ms bigint, "
    "category_spend_7d map<string,double>, is_late boolean, raw_event string"
)
SEQUENCE_SCHEMA = (
    "customer_id string, first_event_id bigint, first_ts_ms bigint, second_event_id bigint, second_ts_ms bigint"
)
OUTPUT_FIELDS = [field.split()[0] for field in OUTPUT_SCHEMA.split(", ")]


def _row(**values) -> Row:
    return Row(**{name: values.get(name) for name in OUTPUT_FIELDS})


def newest_snapshot(snapshots: list[tuple[int | None, dict[str, float]]]) -> tuple[int | None, dict[str, float]]:
    """The snapshot with the highest time, whatever order they come in; of equal times the content decides.

    A snapshot without a time is older than any that has one.
    """
    told = {ms: [scores for t, scores in snapshots if t == ms] for ms, _ in snapshots}
    ms = max(told, key=lambda t: -1 if t is None else t)
    return ms, max(told[ms], key=lambda scores: sorted((p, s is not None, s or 0.0) for p, s in scores.items()))


class IntentProcessor(StatefulProcessor):
    """Events and score snapshots of one customer, in; kept intents and late events, out.

    Rows of a micro-batch are taken in event order.  Late rows are reported and processed all the same.

    The week of transactions lies in chunks by (day, number): a micro-batch adds one chunk to each day it touches, and no
    chunk is written again.  A timer, one for each customer with such state, drops the days, the session and
    the kept intents that the watermark has left behind, so a customer who falls silent keeps only scores.  Timers run on
    the clock (the mode that lets late rows in): the next one is set for when event time, at its usual pace, will have got
    there, or after `tick_ms` where that is given.
    """

    def __init__(self, tick_ms: int | None = None) -> None:
        self.tick_ms = tick_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.snapshot = handle.getValueState("snapshot", "ms bigint, products array<string>, scores array<double>")
        self.week = handle.getMapState(
            "week", "day bigint, number int",
            "ms array<bigint>, category array<string>, cents array<bigint>, salary array<boolean>, card array<boolean>")
        self.session = handle.getValueState("session", "cents bigint, start bigint, last bigint")
        self.kept = handle.getMapState("kept", "product string", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        events, snapshots = [], []
        for row in rows:
            if row.kind == "score":
                snapshots.append((row.score_ts_ms, dict(row.scores or {})))
            else:
                events.append(row)
        base = self._scores(snapshots)
        if not events:
            return
        watermark = timerValues.getCurrentWatermarkInMs()
        session = Session(*self.session.get()) if self.session.exists() else None
        txns, chunks = [], {}
        for (day, number), columns in self.week.iterator():
            txns += map(Txn._make, zip(*columns))
            chunks[day] = max(chunks.get(day, 0), number + 1)
        behaviour = Behaviour(txns, session)
        added: dict[int, list[Txn]] = {}
        for row in sorted(events, key=lambda r: (r.event_ts_ms, r.kind, r.merchant_category or "", r.amount or 0)):
            ms = row.event_ts_ms
            is_late = 0 < watermark and ms < watermark
            if is_late:
                yield _row(output="late", customer_id=key[0], event_ts_ms=ms, is_late=True, raw_event=row.raw_event)
            txn = None
            if row.kind == "txn":
                txn = Txn(ms, row.merchant_category or "unknown", round(float(row.amount) * 100),
                          row.transaction_type == "salary" or row.merchant_category == "salary",
                          (row.has_credit_card or 0) > 0)
                added.setdefault(ms // DAY_MS, []).append(txn)
            for signal in behaviour.observe(ms, txn):
                name = (signal.product,)
                if not may_keep(self.kept.getValue(name)[0] if self.kept.containsKey(name) else None, ms):
                    continue
                self.kept.updateValue(name, (ms,))
                yield _row(
                    output="intent", customer_id=key[0], product=signal.product, pattern_name=signal.pattern,
                    pattern_metric=signal.metric, propensity_score=base.get(signal.product), event_ts_ms=ms,
                    session_window_ms=signal.session_ms, category_spend_7d=behaviour.category_spend(),
                    is_late=is_late,
                )
        for day, new in added.items():
            self.week.updateValue((day, chunks.get(day, 0)), tuple(list(column) for column in zip(*new)))
        if behaviour.session is not None:
            self.session.update(tuple(behaviour.session))
        elif self.session.exists():
            self.session.clear()
        if not any(True for _ in self.handle.listTimers()):
            first = min(row.event_ts_ms for row in events)
            self._wake_after(first // DAY_MS * DAY_MS + DAY_MS + WEEK_MS, watermark, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        left = []
        for day, number in list(self.week.keys()):
            self._drop_if_past(day * DAY_MS + DAY_MS + WEEK_MS, watermark, left, lambda: self.week.removeKey((day, number)))
        if self.session.exists():
            self._drop_if_past(self.session.get()[2] + WEEK_MS, watermark, left, self.session.clear)
        for (product,), (ms,) in list(self.kept.iterator()):
            self._drop_if_past(ms + DAY_MS, watermark, left, lambda: self.kept.removeKey((product,)))
        if left:
            self._wake_after(min(left), watermark, timerValues)
        yield from ()

    def _drop_if_past(self, end: int, watermark: int, left: list[int], drop) -> None:
        if end + GRACE_MS < watermark:
            drop()
        else:
            left.append(end)

    def _wake_after(self, end: int, watermark: int, timerValues) -> None:
        ahead = end + GRACE_MS - watermark if watermark > 0 else WEEK_MS
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + (self.tick_ms or max(HOUR_MS, ahead)))

    def _scores(self, snapshots: list[tuple[int | None, dict[str, float]]]) -> dict[str, float]:
        """Current scores, after the newest of the snapshots that have come has replaced those held, if it is newer.

        Without a time of its own a snapshot replaces one without, as it has come later.
        """
        held_ms, held = None, {}
        exists = self.snapshot.exists()
        if exists:
            held_ms, products, scores = self.snapshot.get()
            held = dict(zip(products, scores))
        if not snapshots:
            return held
        ms, scores = newest_snapshot(snapshots)
        if exists and held_ms is not None:
            ms, scores = newest_snapshot([(held_ms, held), (ms, scores)])
        if not exists or (ms, scores) != (held_ms, held):
            self.snapshot.update((ms, list(scores), list(scores.values())))
        return scores

    def close(self) -> None:
        pass


class SequenceProcessor(StatefulProcessor):
    """First events of one customer that a second event follows within the period, each with the nearest later one.

    A second event waits for the watermark to pass it, so that no earlier one can follow any more; then it answers all
    first events before it.  A first event that nothing has answered is dropped, a timer on full hours of event time sees to it.
    """

    def __init__(self, within_ms: int) -> None:
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.firsts = handle.getMapState("firsts", "ms bigint, id bigint", "due bigint")
        self.seconds = handle.getMapState("seconds", "ms bigint", "id bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for row in rows:
            ms, event = row.event_ts_ms, row.event_id
            if row.is_first:
                due = ((ms + self.within_ms) // HOUR_MS + 1) * HOUR_MS
                self.firsts.updateValue((ms, event), (due,))
                self.handle.registerTimer(due)
            if row.is_second:
                if not self.seconds.containsKey((ms,)) or event < self.seconds.getValue((ms,))[0]:
                    self.seconds.updateValue((ms,), (event,))
                self.handle.registerTimer(ms)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        second = self.seconds.getValue((now,))[0] if self.seconds.containsKey((now,)) else None
        for ms, event in sorted(self.firsts.keys()):
            if second is not None and ms < now <= ms + self.within_ms:
                yield Row(customer_id=key[0], first_event_id=event, first_ts_ms=ms, second_event_id=second, second_ts_ms=now)
            elif ms + self.within_ms >= now:
                continue
            self.firsts.removeKey((ms, event))
        if second is not None:
            self.seconds.removeKey((now,))

    def close(self) -> None:
        pass
