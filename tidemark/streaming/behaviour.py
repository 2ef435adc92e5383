"""What one customer's recent events say: the state and the rules of the intent job for a single key.

A small helper without Spark in it; `IntentProcessor` loads it from and saves it to the state store.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import Counter
from operator import itemgetter
from typing import NamedTuple

from tidemark.schemas import (
    DAY_MS,
    HOME_CATEGORIES,
    HOME_SESSION_LIMIT,
    LARGE_CREDIT_AMOUNT,
    LIFESTYLE_CATEGORIES,
    PATTERN_NAMES,
    QUIET_MS,
    RETAIL_BURST_COUNT,
    WEEK_MS,
)


class Txn(NamedTuple):
    ms: int
    category: str
    cents: int
    salary: bool
    card: bool


class Session(NamedTuple):
    cents: int
    start: int
    last: int


class Signal(NamedTuple):
    product: str
    pattern: str
    metric: float
    session_ms: int | None


_time = itemgetter(0)


class Behaviour:
    """Transactions of the last seven days in time order, with running counts, and the open home session."""

    def __init__(self, txns: list[Txn], session: Session | None):
        self.txns: list[Txn] = []
        self.times: list[int] = []
        self.retail: list[int] = []
        self.large: list[int] = []
        self.counts: Counter = Counter()
        self.spend: Counter = Counter()
        self.uses: Counter = Counter()
        self.session = session
        for txn in sorted(txns, key=_time):
            self._add(txn)

    def _marks(self, txn: Txn) -> dict[str, int]:
        return {"card": txn.card, "salary": txn.salary, "lifestyle": txn.category in LIFESTYLE_CATEGORIES}

    def _add(self, txn: Txn) -> None:
        insort(self.txns, txn, key=_time)
        insort(self.times, txn.ms)
        if txn.category == "retail":
            insort(self.retail, txn.ms)
        if txn.salary and txn.cents >= LARGE_CREDIT_AMOUNT * 100:
            insort(self.large, txn.ms)
        self.counts.update(self._marks(txn))
        self.spend[txn.category] += txn.cents
        self.uses[txn.category] += 1

    def _forget_before(self, ms: int) -> None:
        cut = bisect_left(self.times, ms)
        for txn in self.txns[:cut]:
            self.counts.subtract(self._marks(txn))
            self.spend[txn.category] -= txn.cents
            self.uses[txn.category] -= 1
        del self.txns[:cut], self.times[:cut]
        for times in (self.retail, self.large):
            del times[:bisect_left(times, ms)]

    def observe(self, ms: int, txn: Txn | None = None) -> list[Signal]:
        """Take in one event (a product event has no transaction) and name the patterns that hold."""
        if txn is not None:
            self._add(txn)
        self._forget_before(ms - WEEK_MS)
        signals = []
        if txn is not None and txn.category in HOME_CATEGORIES:
            signals += self._home_spend(txn)
        burst = len(self.retail) - bisect_left(self.retail, ms - DAY_MS)
        if burst >= RETAIL_BURST_COUNT and not self.counts["card"]:
            signals.append(self._signal("credit_card", burst))
        if self.counts["lifestyle"] and self.counts["salary"]:
            signals.append(self._signal("personal_loan", self.counts["lifestyle"]))
        if any(self._quiet_after(credit) for credit in self.large if ms >= credit + QUIET_MS):
            signals.append(self._signal("fixed_deposit", 1))
        return signals

    def _signal(self, product: str, metric: float, session_ms: int | None = None) -> Signal:
        return Signal(product, PATTERN_NAMES[product], float(metric), session_ms)

    def _home_spend(self, txn: Txn) -> list[Signal]:
        held = self.session
        if held is None or txn.ms - held.last > WEEK_MS:
            held = Session(0, txn.ms, txn.ms)
        held = Session(held.cents + txn.cents, held.start, txn.ms)
        if held.cents > HOME_SESSION_LIMIT * 100:
            self.session = None
            return [self._signal("home_loan", held.cents / 100, txn.ms - held.start)]
        self.session = held
        return []

    def _quiet_after(self, credit: int) -> bool:
        following = bisect_right(self.times, credit)
        return following == len(self.times) or self.times[following] > credit + QUIET_MS

    def category_spend(self) -> dict[str, float]:
        return {category: self.spend[category] / 100 for category, n in self.uses.items() if n > 0}


def may_keep(last_kept: int | None, ms: int) -> bool:
    return last_kept is None or ms - last_kept >= DAY_MS
