"""Home-spend sessions: amounts add up until they pass the limit, which fires once and starts over.

The running state depends on every earlier event of the customer, so it is a fold.  Customers with up
to `fold_rows` home transactions are folded by a built-in array aggregate.  The rows of a larger
customer are cut by their rank into slices of at most `slice_rows`; each slice is reduced, in parallel, to
what it does to any state it may start with.  Up to FAN neighbouring summaries are combined into one until
each customer has at most FAN; from there the start states are handed down again, and the slices are replayed
in parallel from their known start.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidemark.operators.slices import by_rank, mark_hot, parts
from tidemark.schemas import HOME_CATEGORIES, HOME_SESSION_LIMIT, WEEK_MS

FOLD_ROWS = 10_000
SLICE_ROWS = 100_000
FAN = 16
LIMIT_CENTS = HOME_SESSION_LIMIT * 100

TRIGGER = "event_ts_ms bigint, event_id bigint, spend_cents bigint, session_window_ms bigint"
STATE = "struct<spend:bigint,start:bigint,last:bigint>"
SUMMARY = (
    f"customer_id string, slice bigint, first_ms bigint, last_ms bigint, total bigint, debt bigint, tops array<bigint>, "
    f"states array<{STATE}>, paused boolean, after_pause {STATE}"
)


def home_transactions(events: DataFrame) -> DataFrame:
    return events.where((F.col("kind") == "txn") & F.col("merchant_category").isin(HOME_CATEGORIES)).select(
        "customer_id", "event_ts_ms", "event_id", (F.col("amount").cast("decimal(18,2)") * 100).cast("bigint").alias("cents")
    )


def home_session_triggers(events: DataFrame, fold_rows: int = FOLD_ROWS, slice_rows: int = SLICE_ROWS,
                          largest: int | None = None) -> DataFrame:
    """Events at which a customer's session passes the limit, with the spend and the session length.

    `largest` is the number of events of the busiest customer where the caller knows it.
    """
    home = home_transactions(events)
    if largest is not None and largest <= fold_rows:
        fired = _fold(home)
    else:
        small, large = parts(mark_hot(home, ["customer_id"], fold_rows))
        fired = _fold(small).unionByName(_replay_slices(large, slice_rows))
    return fired.selectExpr("customer_id", "event_id", "event_ts_ms", "spend_cents / 100 as spend", "session_window_ms")


def _fold(home: DataFrame) -> DataFrame:
    zero = F.struct(
        F.lit(0).cast("bigint").alias("spend"),
        F.lit(None).cast("bigint").alias("start"),
        F.lit(None).cast("bigint").alias("last"),
        F.array().cast("array<struct<ms:bigint,id:bigint,spend:bigint,length:bigint>>").alias("fired"),
    )

    def step(acc, x):
        fresh = acc["start"].isNull() | (x["event_ts_ms"] - acc["last"] > WEEK_MS)
        start = F.when(fresh, x["event_ts_ms"]).otherwise(acc["start"])
        spend = F.when(fresh, F.lit(0)).otherwise(acc["spend"]) + x["cents"]
        event = F.struct(x["event_ts_ms"].alias("ms"), x["event_id"].alias("id"), spend.alias("spend"),
                         (x["event_ts_ms"] - start).alias("length"))
        fires = spend > LIMIT_CENTS
        return F.struct(
            F.when(fires, F.lit(0)).otherwise(spend).alias("spend"),
            F.when(~fires, start).alias("start"),
            x["event_ts_ms"].alias("last"),
            F.when(fires, F.array_append(acc["fired"], event)).otherwise(acc["fired"]).alias("fired"),
        )

    ordered = F.sort_array(F.collect_list(F.struct("event_ts_ms", "event_id", "cents")))
    return (
        home.groupBy("customer_id")
        .agg(ordered.alias("rows"))
        .select("customer_id", F.inline(F.aggregate("rows", zero, step)["fired"]))
        .toDF("customer_id", "event_ts_ms", "event_id", "spend_cents", "session_window_ms")
    )


class _Slice:
    """One customer's rows of one slice, in event order."""

    def __init__(self, rows: pd.DataFrame):
        rows = rows.sort_values(["event_ts_ms", "event_id", "cents"])
        self.ms = rows["event_ts_ms"].to_numpy("int64")
        self.ids = rows["event_id"].to_numpy("int64")
        cents = rows["cents"].to_numpy("int64")
        self.n = len(cents)
        self.sums = np.cumsum(cents)
        self.rising = bool((cents >= 0).all())
        self.breaks = np.append(np.flatnonzero(np.diff(self.ms) > WEEK_MS) + 1, self.n)

    def end_of(self, i: int) -> int:
        """Where the run of events without a long pause that holds i ends."""
        return int(self.breaks[np.searchsorted(self.breaks, i, "right")])

    def fires_at(self, i: int, before: int, end: int) -> int:
        """First index from i on whose sum exceeds `before` by more than the limit; `end` if none."""
        if self.rising:
            return min(end, int(np.searchsorted(self.sums, before + LIMIT_CENTS, "right")))
        over = np.flatnonzero(self.sums[i:end] > before + LIMIT_CENTS)
        return i + int(over[0]) if over.size else end

    def before(self, i: int) -> int:
        return int(self.sums[i - 1]) if i else 0

    def exit_state(self, i: int, known: dict) -> tuple | None:
        """State after the slice when a new session starts at i; `known` is shared between calls."""
        path = []
        while i < self.n and i not in known:
            path.append(i)
            end = self.end_of(i)
            j = self.fires_at(i, self.before(i), end)
            if j < end:
                i = j + 1
            elif end < self.n:
                i = end
            else:
                known[i] = (int(self.sums[-1]) - self.before(i), int(self.ms[i]), int(self.ms[-1]))
        state = known.get(i)
        known.update(dict.fromkeys(path, state))
        return state

    def fired(self, state: tuple | None):
        """Triggers of the slice when it starts in `state`."""
        i, before, start = 0, 0, int(self.ms[0])
        if state is not None and self.ms[0] - state[2] <= WEEK_MS:
            before, start = -state[0], state[1]
        while i < self.n:
            end = self.end_of(i)
            j = self.fires_at(i, before, end)
            if j < end:
                yield int(self.ms[j]), int(self.ids[j]), int(self.sums[j]) - before, int(self.ms[j]) - start
            i = j + 1 if j < end else end
            if i < self.n:
                before, start = self.before(i), int(self.ms[i])


def _summary(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """What the slice does to a state: the state it leaves, by the sum that makes the first trigger fire.

    Which event fires first depends only on how much is still missing; it is the first event whose
    sum within the slice exceeds that, so only new maxima of the sum matter.  Neighbouring maxima
    that leave the same state are merged.  A state misses between nothing and the limit plus `debt`, all refunds
    of the customer; maxima that this range cannot reach are dropped.
    """
    part, known = _Slice(rows), {}
    end = part.end_of(0)
    peaks = np.maximum.accumulate(part.sums[:end])
    records = np.flatnonzero(np.append(True, peaks[1:] > peaks[:-1]))
    debt = int(rows["debt"].iloc[0])
    tops, states = _entries(((int(peaks[r]), part.exit_state(int(r) + 1, known)) for r in records), debt)
    return pd.DataFrame([{
        "customer_id": key[0], "slice": key[1], "first_ms": int(part.ms[0]), "last_ms": int(part.ms[-1]),
        "total": int(part.sums[-1]), "debt": debt, "tops": tops, "states": [_named(s) for s in states],
        "paused": end < part.n, "after_pause": _named(part.exit_state(end, known) if end < part.n else None),
    }])


def _entries(found: Iterable[tuple[int, tuple | None]], debt: int) -> tuple[list, list]:
    """Rising sums and the states they leave, without those that no state can look up; equal neighbours are merged."""
    tops, states = [], []
    for top, state in found:
        if top <= (tops[-1] if tops else 0):
            continue
        if states and states[-1] == state:
            tops[-1] = top
        else:
            tops.append(top)
            states.append(state)
        if top > LIMIT_CENTS + debt:
            break
    return tops, states


def _named(state: tuple | None) -> dict | None:
    return None if state is None else dict(zip(("spend", "start", "last"), state))


def _state(named) -> tuple | None:
    return None if named is None else (int(named["spend"]), int(named["start"]), int(named["last"]))


def _after(s, state: tuple | None) -> tuple | None:
    """State after the rows of summary `s`."""
    held, begun = 0, s.first_ms
    if state is not None and s.first_ms - state[2] <= WEEK_MS:
        held, begun = state[0], state[1]
    at = bisect_right(s.tops, LIMIT_CENTS - held)
    if at < len(s.tops):
        return _state(s.states[at])
    if s.paused:
        return _state(s.after_pause)
    return held + s.total, begun, s.last_ms


def _combine(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
    """One summary of neighbouring ones."""
    done = None
    for s in slices.sort_values("slice").itertuples():
        entries = list(zip((int(t) for t in s.tops), map(_state, s.states)))
        if done is None:
            done = {"first_ms": s.first_ms, "total": s.total, "entries": entries, "paused": bool(s.paused),
                    "after_pause": _state(s.after_pause)}
        else:
            both = [(top, _after(s, state)) for top, state in done["entries"]]
            if done["paused"]:
                done["after_pause"] = _after(s, done["after_pause"])
            elif s.first_ms - last > WEEK_MS:
                done["paused"], done["after_pause"] = True, _after(s, None)
            else:
                # a session that has not fired so far goes on in this slice
                both += [(done["total"] + top, state) for top, state in entries]
                done["total"] += s.total
                done["paused"], done["after_pause"] = bool(s.paused), _state(s.after_pause)
            done["entries"] = list(zip(*_entries(both, s.debt)))
        last = s.last_ms
    return pd.DataFrame([{
        "customer_id": key[0], "slice": key[1], "first_ms": done["first_ms"], "last_ms": last, "total": done["total"],
        "debt": s.debt, "tops": [t for t, _ in done["entries"]], "states": [_named(x) for _, x in done["entries"]],
        "paused": done["paused"], "after_pause": _named(done["after_pause"]),
    }])


def _chain(key: tuple, slices: pd.DataFrame) -> pd.DataFrame:
    """Start state of each of a few neighbouring slices, from that of the first and their summaries."""
    slices = slices.sort_values("slice")
    rows, state = [], _state(slices["entry"].iloc[0])
    for s in slices.itertuples():
        rows.append((key[0], s.slice, _named(state)))
        state = _after(s, state)
    return pd.DataFrame(rows, columns=["customer_id", "slice", "entry"])


def _replay(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    state = _state(rows["entry"].iloc[0])
    fired = [(key[0], *t) for t in _Slice(rows).fired(state)]
    return pd.DataFrame(
        fired, columns=["customer_id", "event_ts_ms", "event_id", "spend_cents", "session_window_ms"]
    )


def _by_rank(home: DataFrame, slice_rows: int) -> DataFrame:
    return by_rank(home, ["customer_id", "event_ts_ms", "event_id", "cents"], slice_rows)


def _replay_slices(home: DataFrame, slice_rows: int) -> DataFrame:
    rows, keys, group = _by_rank(home, slice_rows), ["customer_id", "slice"], F.expr(f"slice div {FAN}")
    # one row for each hot customer
    debts = rows.groupBy("customer_id").agg(F.sum(-F.least("cents", F.lit(0))).alias("debt"))
    levels = [rows.join(debts, "customer_id").groupBy(*keys).applyInPandas(_summary, SUMMARY).checkpoint()]
    span = (levels[0].agg(F.max("slice")).first()[0] or 0) + 1
    while span > FAN:
        levels.append(levels[-1].groupBy("customer_id", group).applyInPandas(_combine, SUMMARY).checkpoint())
        span = -(-span // FAN)
    start = f"customer_id string, slice bigint, entry {STATE}"
    top = levels.pop().withColumn("entry", F.lit(None).cast(STATE))
    starts = top.groupBy("customer_id").applyInPandas(_chain, start)
    for lower in reversed(levels):
        above = starts.withColumnRenamed("slice", "_group")
        entered = lower.withColumn("_group", group).join(above, ["customer_id", "_group"])
        starts = entered.groupBy("customer_id", "_group").applyInPandas(_chain, start)
    return rows.join(starts, keys).groupBy(*keys).applyInPandas(_replay, f"customer_id string, {TRIGGER}")
