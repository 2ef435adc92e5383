"""Periodic runs of words: stretches that repeat themselves at least four times, found by a suffix automaton.

Words are appended one by one to a suffix automaton whose suffix-link tree is held as preferred paths in splay trees
(link-cut access).  All states of a path last occurred at the same end.  Appending word i accesses the path from the new
state to the root: on each path segment it meets, the longest state of length l with last end e says that the l words up
to i also ended at e.  If l covers the distance p = i - e, the two occurrences form a square of period p; the square is
extended to both sides to its run, and the segments are recoloured with end i.

Only windows that can hold a run are appended: inside a run of period q every short stretch of words occurred no more than q
words before, so a dyadic scale of q needs a long unbroken line of such positions.  Hashes may only let windows in that hold
nothing; words are compared themselves in the automaton.
"""

from __future__ import annotations

from array import array
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidemark.llm.common import map_rows

# A run has at least so many words and repeats its period at least so often.
LEAST_WORDS = 6
LEAST_REPEATS = 4
# Words whose stretch is hashed to judge a position; half the period where that is less.
GRAM = 8
# Words an automaton takes at once, or 16 of the scale's periods; neighbours overlap by 4 periods.
WINDOW = 1 << 15
# Words that are looked at together, whether of one text or of many.
BATCH_WORDS = 1 << 18


class Run(NamedTuple):
    start: int
    length: int
    period: int


class Automaton:
    """Suffix automaton of a sequence; `append` returns where the suffixes occurred last."""

    def __init__(self) -> None:
        # state 0 is none, 1 the empty word; `parent` is the splay parent or, at a splay root, the path's tree parent
        self.length, self.link = array("q", [0, 0]), array("q", [0, 0])
        self.first, self.target = array("q", [0, 0]), array("q", [0, 0])  # a state's first transition; 0: none
        self.more: dict[int, dict[int, int]] = {}  # its others
        self.parent, self.left, self.right = array("q", [0, 0]), array("q", [0, 0]), array("q", [0, 0])
        self.end = array("q", [-1, -1])  # last end of a path, kept at its splay root
        self.whole = 1

    def _state(self, length: int, link: int) -> int:
        for column, value in ((self.length, length), (self.link, link), (self.first, 0), (self.target, 0),
                              (self.parent, link), (self.left, 0), (self.right, 0), (self.end, -1)):
            column.append(value)
        return len(self.length) - 1

    def _next(self, state: int, word: int) -> int:
        if self.target[state] and self.first[state] == word:
            return self.target[state]
        more = self.more.get(state)
        return more.get(word, 0) if more else 0

    def _put(self, state: int, word: int, target: int) -> None:
        if not self.target[state] or self.first[state] == word:
            self.first[state], self.target[state] = word, target
        else:
            self.more.setdefault(state, {})[word] = target

    def append(self, word: int, at: int) -> list[tuple[int, int]]:
        """Take in the word at place `at`; (length, last end) of the longest state on each segment that was recoloured."""
        before, new = self.whole, self._state(self.length[self.whole] + 1, 0)
        self.whole = new
        while before and not self._next(before, word):
            self._put(before, word, new)
            before = self.link[before]
        if not before:
            above = 1
        else:
            above = self._next(before, word)
            if self.length[above] != self.length[before] + 1:
                above = self._split(before, word, above)
        self.link[new] = self.parent[new] = above
        return self._access(new, at)

    def _split(self, before: int, word: int, old: int) -> int:
        """Make the state of `old`'s shorter strings; it stands on the same path, just above."""
        clone = self._state(self.length[before] + 1, self.link[old])
        self.first[clone], self.target[clone] = self.first[old], self.target[old]
        if old in self.more:
            self.more[clone] = dict(self.more[old])
        self._splay(old)
        upper = self.left[old]
        self.left[clone] = upper
        if upper:
            self.parent[upper] = clone
        self.left[old], self.parent[clone] = clone, old
        self.link[old] = clone
        while before and self._next(before, word) == old:
            self._put(before, word, clone)
            before = self.link[before]
        return clone

    def _rotate(self, x: int) -> None:
        parent, left, right = self.parent, self.left, self.right
        p = parent[x]
        g = parent[p]
        if left[p] == x:
            moved = right[x]
            left[p], right[x] = moved, p
        else:
            moved = left[x]
            right[p], left[x] = moved, p
        if moved:
            parent[moved] = p
        parent[p], parent[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def _splay(self, x: int) -> None:
        """Bring x to the root of its path's splay tree; the path's last end moves with the root."""
        parent, left, right, end = self.parent, self.left, self.right, self.end
        while (p := parent[x]) and (left[p] == x or right[p] == x):
            g = parent[p]
            if g and (left[g] == p or right[g] == p):
                end[x] = end[g]  # only a root's end counts, and the last one passed is the root's
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
            else:
                end[x] = end[p]
            self._rotate(x)

    def _access(self, new: int, at: int) -> list[tuple[int, int]]:
        parent, right, end = self.parent, self.right, self.end
        seen, deeper, x = [], new, parent[new]
        while x:
            self._splay(x)
            below = right[x]
            if below:
                end[below] = end[x]
            right[x] = deeper
            seen.append((self.length[x], end[x]))
            deeper, x = x, parent[x]
        end[deeper] = at
        return seen


def _matching(words: np.ndarray, at: int, period: int, step: int) -> int:
    """How many words from `at` on, forwards (step 1) or backwards (-1), equal the word a period before them."""
    count, block = 0, 64
    while True:
        first = at + step * count
        if step > 0:
            same = words[first:first + block] == words[first - period:first - period + block][:max(0, len(words) - first)]
        else:
            low = max(period, first - block + 1)
            same = (words[low:first + 1] == words[low - period:first + 1 - period])[::-1]
        if len(same) == 0:
            return count
        differs = np.flatnonzero(~same)
        if len(differs):
            return count + int(differs[0])
        count, block = count + len(same), block * 2


def runs_within(words: np.ndarray, low: int, high: int, found: dict[tuple[int, int], Run]) -> None:
    """Add the runs of the whole sequence of which `low:high` holds a square long enough."""
    automaton, done = Automaton(), {}
    for at, word in enumerate(words[low:high].tolist(), low):
        for length, last in automaton.append(word, at):
            period = at - last
            if last < 0 or length < (LEAST_REPEATS - 1) * period or length + period < LEAST_WORDS or at < done.get(period, 0):
                continue
            left = at - length - period + 1
            start = left - _matching(words, left - 1 + period, period, -1)
            done[period] = at + 1 + _matching(words, at + 1, period, 1)
            found[start, period] = Run(start, done[period] - start, period)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _distances(key: np.ndarray) -> np.ndarray:
    """Distance to the nearest earlier place with the same key; the largest number where there is none."""
    bits = np.uint64(max(1, len(key)).bit_length())
    placed = np.sort(((key >> bits) << bits) | np.arange(len(key), dtype=np.uint64))
    place = (placed & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = np.flatnonzero((placed[1:] >> bits) == (placed[:-1] >> bits)) + 1
    far = np.full(len(key), np.iinfo(np.int64).max)
    far[place[same]] = place[same] - place[same - 1]
    return far


def windows(hashes: np.ndarray, text: np.ndarray, begin: np.ndarray) -> list[tuple[int, int, int]]:
    """Disjoint (low, high, largest period): every run of any text lies in one of them.

    `hashes` are those of the words of several texts, `text` numbers their texts, `begin` is where each word's text begins.
    """
    if not len(hashes):
        return []
    place = np.arange(len(hashes)) - begin
    longest = int(place.max()) + 1
    found, gram, hashed, spots, far = [], 0, hashes, None, None
    scale = 1
    while scale == 1 or scale // 2 + 1 <= longest // LEAST_REPEATS:
        wanted = min(GRAM, max(1, scale // 2))
        if wanted != gram:
            if gram:
                longer = np.zeros_like(hashed)
                longer[gram:] = _mixed(hashed[:-gram] * np.uint64(3)) + hashed[gram:]
                hashed = longer
            gram = wanted
            far = _distances(_mixed(_mixed(hashed) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))
            spots = np.flatnonzero((far < len(far)) & (place >= gram - 1))
            far = far[spots]
        least = scale // 2 + 1
        need = max(LEAST_WORDS, LEAST_REPEATS * least) - least - gram + 1
        near = spots[far <= scale]
        if len(near) >= need:
            edges = np.flatnonzero(np.diff(near) != 1)
            first, last = near[np.concatenate(([0], edges + 1))], near[np.concatenate((edges, [len(near) - 1]))]
            long = last - first + 1 >= need
            low = np.maximum(begin[first[long]], first[long] - scale - gram + 1)
            found += zip(low.tolist(), (last[long] + 1).tolist(), [scale] * int(long.sum()))
        scale *= 2
    merged: list[tuple[int, int, int]] = []
    for low, high, scale in sorted(found):
        if merged and low < merged[-1][1]:
            held = merged[-1]
            merged[-1] = held[0], max(high, held[1]), max(scale, held[2])
        else:
            merged.append((low, high, scale))
    return merged


def text_runs(texts: list[list[bytes]]) -> list[list[Run]]:
    """All runs of each text (its words), by start, then period."""
    counts = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(counts)
    number = np.repeat(np.arange(len(texts)), counts)
    hashes = np.fromiter((hash(w) for t in texts for w in t), dtype=np.int64, count=int(counts.sum())).view(np.uint64)
    found: dict[int, tuple[np.ndarray, dict]] = {}
    for low, high, scale in windows(hashes, number, (ends - counts)[number]):
        which = int(number[low])
        if which not in found:
            ids: dict[bytes, int] = {}
            found[which] = np.fromiter((ids.setdefault(w, len(ids)) for w in texts[which]), np.int64, len(texts[which])), {}
        words, runs = found[which]
        offset = int(ends[which] - counts[which])
        size, overlap = max(WINDOW, 16 * scale), max(LEAST_WORDS, LEAST_REPEATS * scale)
        for at in range(low - offset, high - offset, size - overlap):
            runs_within(words, at, min(at + size, high - offset), runs)
            if at + size >= high - offset:
                break
    return [sorted(found[i][1].values(), key=lambda r: (r.start, r.period)) if i in found else [] for i in range(len(texts))]


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words joined by one space, of each run only its first period."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for run in runs:
            kept[run.start + run.period:run.start + run.length] = False
        words = [words[i] for i in np.flatnonzero(kept).tolist()]
    return b" ".join(words)


RUN_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `runs` (start, length and smallest period in words; by start, then period) and `collapsed`, the text
    without what repeats.

    Words are what stands between ASCII white space.  A null or empty text has no runs and collapses to the empty text.
    Columns named like the two are replaced, all others kept; equal rows stay separate.  Whole texts are looked at:
    one takes some 10 bytes a byte, and 150 bytes a word of the stretch that repeats itself with one period when that is
    longer than WINDOW.
    """
    kept = docs.drop(*[c for c in ("runs", "collapsed") if c != text])
    at = kept.columns.index(text)

    def looked(texts: list[str | None]) -> tuple[list[list[Run]], list[bytes]]:
        split = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
        runs = text_runs(split)
        return runs, [collapsed(w, r) for w, r in zip(split, runs)]

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at)
        runs, rest = [], []
        sizes = np.nan_to_num(np.asarray(texts.cast(pa.large_binary()).to_pandas().str.len(), dtype=np.float64)) / 6
        first = 0
        while first < batch.num_rows:
            last = first + 1
            while last < batch.num_rows and sizes[first:last + 1].sum() <= BATCH_WORDS:
                last += 1
            some = looked(texts.slice(first, last - first).to_pylist())
            runs += some[0]
            rest += some[1]
            first = last
        flat = np.array([r for some in runs for r in some], dtype=np.int64).reshape(-1, 3)
        told = pa.ListArray.from_arrays(
            pa.array(np.concatenate(([0], np.cumsum([len(r) for r in runs]))), pa.int32()),
            pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], names=["start", "length", "period"]))
        return pa.RecordBatch.from_arrays([*batch.columns, told, pa.array(rest, pa.binary()).cast(pa.string())],
                                          names=[*batch.schema.names, "runs", "collapsed"])

    return map_rows(kept, add, StructType([*kept.schema.fields, *StructType.fromDDL(f"runs {RUN_TYPE}, collapsed string").fields]))
