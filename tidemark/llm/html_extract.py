"""HTML extraction by a recurrent block labeller.

A page is a sequence of leaf blocks.  A bidirectional LSTM (numpy) reads for each block its tag path and its words as
hashed vectors and a few measures, and labels every block as main text or not, knowing the blocks before and after
it.  It is trained on a bounded sample of the pages themselves: element names that say what they hold (`article`,
`nav`, `footer`, ...) give the labels, and every sampled page is also seen with other frames around its text and with
notices, adverts, forms, comments and the like put in, so that place and neighbourhood count as well.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import hashed_share, map_rows
from tidemark.llm.html_blocks import Block, leaf_blocks

# Bounds of the training sample: pages, characters of a page, blocks of a page.
SAMPLE_PAGES = 240
SAMPLE_CHARS = 100_000
SAMPLE_BLOCKS = 120
VARIANTS = 2

PATH_BUCKETS = 1 << 14
WORD_BUCKETS = 1 << 10
INPUTS = PATH_BUCKETS + WORD_BUCKETS
MEASURES = 4
HIDDEN = 16
_BATCH = 32
# Blocks, padding included, and inputs that are held as vectors at a time.
_STEPS = 4096
_GATHER = 16_384

# What element names say about their content.
BOILERPLATE_TAGS = ["nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", "title", "search"]
BOILERPLATE_NAMES = [
    "ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "cookie",
    "cookies", "consent", "disclaimer", "discussion", "footer", "form", "header", "login", "masthead", "menu", "modal",
    "nav", "navbar", "navigation", "newsletter", "notice", "pagination", "popup", "promo", "related", "replies", "search",
    "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
]
TEXT_FRAMES = [
    ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post"), ("div", ".entry"),
    ("div", ".main"), ("div", ".article"), ("section", ".story"), ("div", ".article", ".body"), ("div",),
]
# Places a piece of main text may have inside its frame.
TEXT_PLACES = [("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("section", "p"), ("div",), ("div", "p"), ("table", "tr", "td"),
               ("h2",), ("h3",), ("dl", "dd"), ("figure", "figcaption"), ("pre",)]
# Elements that say how a block is set, not what it is.
PLAIN_LEAVES = {"p", "div", "li", "h1", "h2", "h3", "td", "span"}
TEXT_NAMES = {"article", "main", ".content", ".post", ".entry", ".main", ".article", ".story"}


def _boilerplate_names() -> set[str]:
    return set(BOILERPLATE_TAGS) | {f".{n}" for n in BOILERPLATE_NAMES}


def named_labels(blocks: list[Block]) -> np.ndarray:
    """1 for blocks that the element names tell to be main text."""
    outside = _boilerplate_names()
    framed = any(TEXT_NAMES & set(b.path) for b in blocks)
    return np.array([
        not outside & set(b.path) and (not framed or bool(TEXT_NAMES & set(b.path))) for b in blocks
    ], dtype=np.float64)


def varied(blocks: list[Block], labels: np.ndarray, strange: list[str], rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """The page with another frame around its text and with runs of boilerplate in it."""
    frame = TEXT_FRAMES[rng.integers(len(TEXT_FRAMES))]
    page = []
    for block, label in zip(blocks, labels):
        path, leaf = block.path, block.leaf
        if label and rng.random() < 0.25:
            place = TEXT_PLACES[rng.integers(len(TEXT_PLACES))]
            path, leaf = ("html", "body", *frame, *place), place[-1]
        elif label:
            path = ("html", "body", *frame, *((leaf,) if leaf not in ("article", "main") else ()))
        page.append((Block(path, leaf, block.pieces, block.linked), label))
    for _ in range(rng.integers(1, 5)):
        if rng.random() < 0.3:
            names = (BOILERPLATE_TAGS[rng.integers(len(BOILERPLATE_TAGS) - 2)],)
        else:
            names = (("div", "section", "aside", "p", "ul")[rng.integers(5)], "." + BOILERPLATE_NAMES[rng.integers(len(BOILERPLATE_NAMES))])
        leaf = ("p", "div", "li", "h2")[rng.integers(4)]
        around = frame if rng.random() < 0.5 else ()
        at = rng.integers(len(page) + 1)
        run = []
        for _ in range(rng.integers(1, 4)):
            text = strange[rng.integers(len(strange))]
            run.append((Block(("html", "body", *around, *names, leaf), leaf, [text], len(text) if rng.random() < 0.2 else 0), 0.0))
        page[at:at] = run
    return [b for b, _ in page], np.array([x for _, x in page])


def nameless(blocks: list[Block]) -> list[Block]:
    """The page as it would be with nothing but `div` around its leaves and no class, id or role."""
    return [Block(("html", "body", "div", *((b.leaf,) if b.leaf in PLAIN_LEAVES else ())),
                  b.leaf if b.leaf in PLAIN_LEAVES else "div", b.pieces, b.linked) for b in blocks]


def inputs(blocks: list[Block], cache: dict[str, int], first: int = 0, of: int | None = None
           ) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """Per block: input places, their weights, and the measures; `blocks` begin at number `first` of the page's `of`."""
    of = len(blocks) if of is None else of
    places, weights, measures = [], [], np.zeros((len(blocks), MEASURES))

    def bucket(name: str, size: int) -> int:
        found = cache.get(name)
        if found is None:
            if len(cache) > 500_000:
                cache.clear()
            found = cache[name] = xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) % size
        return found

    for i, block in enumerate(blocks):
        text = block.text
        path = {bucket(f"<{n}", PATH_BUCKETS) for n in block.path} | {bucket(f"<<{block.leaf}", PATH_BUCKETS)}
        words = text.lower().split()
        hashed = [PATH_BUCKETS + bucket(w, WORD_BUCKETS) for w in words]
        place = np.array([*path, *hashed], dtype=np.int32)
        weight = np.concatenate((np.ones(len(path)), np.full(len(words), 1 / max(1, len(words)))))
        if len(place) > INPUTS:
            sums = np.bincount(place, weight)
            place = np.flatnonzero(sums).astype(np.int32)
            weight = sums[place]
        places.append(place)
        weights.append(weight)
        measures[i] = (np.log1p(len(text)) / 8, min(1.0, block.linked / max(1, len(text))), (first + i) / of,
                       sum(text.count(c) for c in ".,;:!?") / max(1, len(words)))
    return places, weights, measures


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _forward(pre: np.ndarray, recur: np.ndarray, keep: bool = False, state: tuple | None = None):
    """LSTM over (batch, steps, 4 * hidden) inputs: the outputs, on request what the way back needs, and the state."""
    batch, steps, _ = pre.shape
    h, c = state or (np.zeros((batch, HIDDEN)), np.zeros((batch, HIDDEN)))
    outputs, kept = np.zeros((batch, steps, HIDDEN)), []
    for t in range(steps):
        z = pre[:, t] + h @ recur
        gates = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN:2 * HIDDEN], gates[:, 2 * HIDDEN:]
        g = np.tanh(z[:, 3 * HIDDEN:])
        before, earlier = c, h
        c = f * c + i * g
        squashed = np.tanh(c)
        h = o * squashed
        outputs[:, t] = h
        if keep:
            kept.append((i, f, o, g, before, earlier, squashed))
    return outputs, kept, (h, c)


def _summed(embed: np.ndarray, places: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
    """The weighted sum of the vectors of each block's inputs, gathered about _GATHER at a time."""
    ends = np.cumsum([len(p) for p in places])
    found, at = np.zeros((len(places), embed.shape[1])), 0
    while at < len(places):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - len(places[at]) + _GATHER, "right")))
        part = places[at:stop]
        starts = np.cumsum([0, *(len(p) for p in part[:-1])])
        found[at:stop] = np.add.reduceat(
            embed[np.concatenate(part)] * np.concatenate(weights[at:stop])[:, None], starts)
        at = stop
    return found


def _backward(slope: np.ndarray, kept: list, recur: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the inputs and of the recurrent weights from those of the outputs."""
    batch, steps, _ = slope.shape
    into, turn = np.zeros((batch, steps, 4 * HIDDEN)), np.zeros_like(recur)
    dh = dc = np.zeros((batch, HIDDEN))
    for t in range(steps - 1, -1, -1):
        i, f, o, g, before, earlier, squashed = kept[t]
        dh = dh + slope[:, t]
        dc = dc + dh * o * (1 - squashed ** 2)
        dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o),
                             dc * i * (1 - g ** 2)), axis=1)
        into[:, t] = dz
        turn += earlier.T @ dz
        dh, dc = dz @ recur.T, dc * f
    return into, turn


@dataclass
class Labeller:
    """Weights; the first half of the 8 * HIDDEN columns reads forwards, the second backwards."""

    embed: np.ndarray
    measure: np.ndarray
    bias: np.ndarray
    ahead: np.ndarray
    back: np.ndarray
    out: np.ndarray
    offset: np.ndarray

    @classmethod
    def fresh(cls, rows: int, seed: int = 42) -> Labeller:
        rng = np.random.default_rng(seed)
        bias = np.zeros(8 * HIDDEN)
        bias[HIDDEN:2 * HIDDEN] = bias[5 * HIDDEN:6 * HIDDEN] = 1
        # names and words that training has not seen add nothing
        return cls(np.zeros((rows, 8 * HIDDEN)), rng.normal(0, 0.2, (MEASURES, 8 * HIDDEN)), bias,
                   rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)), rng.normal(0, 0.2, (HIDDEN, 4 * HIDDEN)),
                   rng.normal(0, 0.3, 2 * HIDDEN), np.zeros(1))

    def _inputs(self, pages: list, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        steps = order.shape[1]
        pre = np.zeros((len(pages), steps, 8 * HIDDEN))
        for n, (places, weights, measures) in enumerate(pages):
            if weights is None:  # training: a matrix over the inputs that occur
                summed = places @ self.embed
            else:
                summed = _summed(self.embed, places, weights)
            pre[n, :len(places)] = summed + measures @ self.measure + self.bias
        reverse = np.take_along_axis(pre[:, :, 4 * HIDDEN:], order[:, :, None], axis=1)
        return pre[:, :, :4 * HIDDEN], reverse

    def run(self, pages: list, keep: bool = False):
        """Log-odds (pages, blocks) of pages given as `inputs`, padded to the longest."""
        lengths = np.array([len(p[0]) for p in pages])
        steps = int(lengths.max())
        at = np.arange(steps)[None, :]
        # reading backwards: the last block first, padding stays at the end
        order = np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)
        forwards, reverse = self._inputs(pages, order)
        left, kept_left, _ = _forward(forwards, self.ahead, keep)
        right, kept_right, _ = _forward(reverse, self.back, keep)
        both = np.concatenate((left, np.take_along_axis(right, order[:, :, None], axis=1)), axis=2)
        return both @ self.out + self.offset[0], (order, lengths, both, kept_left, kept_right)

    def slopes(self, pages: list, labels: list[np.ndarray]) -> dict[str, np.ndarray]:
        """Gradients of the mean cross-entropy, for pages given as matrices."""
        logits, (order, lengths, both, kept_left, kept_right) = self.run(pages, True)
        error = np.zeros_like(logits)
        for n, y in enumerate(labels):
            error[n, :len(y)] = (_sigmoid(logits[n, :len(y)]) - y) / lengths.sum()
        slope = error[:, :, None] * self.out
        left, turn_left = _backward(slope[:, :, :HIDDEN], kept_left, self.ahead)
        right, turn_right = _backward(
            np.take_along_axis(slope[:, :, HIDDEN:], order[:, :, None], axis=1), kept_right, self.back
        )
        into = np.concatenate((left, np.take_along_axis(right, order[:, :, None], axis=1)), axis=2)
        embed, measure = np.zeros_like(self.embed), np.zeros_like(self.measure)
        for n, (matrix, _, measures) in enumerate(pages):
            own = into[n, :len(matrix)]
            embed += matrix.T @ own
            measure += measures.T @ own
        return {"embed": embed, "measure": measure, "bias": into.sum((0, 1)), "ahead": turn_left, "back": turn_right,
                "out": np.einsum("bt,bth->h", error, both), "offset": np.array([error.sum()])}

    def _long(self, blocks: list[Block], cache: dict[str, int]) -> np.ndarray:
        """Log-odds of the blocks of one long page: each direction is read in stretches that hand on their state."""
        logits = np.full(len(blocks), self.offset[0])
        stretches = range(0, len(blocks), _STEPS)
        for turn, recur, out in ((1, self.ahead, self.out[:HIDDEN]), (-1, self.back, self.out[HIDDEN:])):
            columns, state = slice(0, 4 * HIDDEN) if turn == 1 else slice(4 * HIDDEN, None), None
            for at in stretches[::turn]:
                places, weights, measures = inputs(blocks[at:at + _STEPS], cache, at, len(blocks))
                pre = _summed(self.embed[:, columns], places, weights) + (measures @ self.measure + self.bias)[:, columns]
                outputs, _, state = _forward(pre[None, ::turn], recur, state=state)
                logits[at:at + len(places)] += outputs[0, ::turn] @ out
        return logits

    def labels(self, pages: list[list[Block]], cache: dict[str, int]) -> list[np.ndarray]:
        """Whether each block of each page is main text.

        Pages are read together while these, padded to the longest, have at most _STEPS blocks.
        """
        found: list[np.ndarray] = [np.zeros(0, dtype=bool)] * len(pages)
        part: list[int] = []

        def settle() -> None:
            logits, _ = self.run([inputs(pages[n], cache) for n in part])
            for row, n in enumerate(part):
                found[n] = logits[row, :len(pages[n])] >= 0
            part.clear()

        for n in sorted((n for n, p in enumerate(pages) if p), key=lambda n: len(pages[n])):
            if part and (len(part) == _BATCH or (len(part) + 1) * len(pages[n]) > _STEPS):
                settle()
            if len(pages[n]) > _STEPS:
                found[n] = self._long(pages[n], cache) >= 0
            else:
                part.append(n)
        if part:
            settle()
        return found


def _matrix(places: list[np.ndarray], weights: list[np.ndarray], used: np.ndarray) -> np.ndarray:
    found = np.zeros((len(places), len(used)), dtype=np.float32)
    for row, (p, w) in enumerate(zip(places, weights)):
        np.add.at(found[row], np.searchsorted(used, p), w)
    return found


def train(pages: list[str], epochs: int = 20, seed: int = 42) -> Labeller:
    """Fit on sampled pages by Adam; the same sample gives the same weights."""
    rng = np.random.default_rng(seed)
    parsed = [b for b in map(leaf_blocks, pages) if 0 < len(b) <= SAMPLE_BLOCKS]
    strange = [b.text for blocks in parsed for b in blocks] or ["text"]
    cache: dict[str, int] = {}
    data = []
    for blocks in parsed:
        labels = named_labels(blocks)
        data.append((inputs(blocks, cache), labels))
        for _ in range(VARIANTS):
            changed, marks = varied(blocks, labels, strange, rng)
            data.append((inputs(changed, cache), marks))
        data.append((inputs(nameless(blocks), cache), labels))
    used = np.unique(np.concatenate([p for (places, _, _), _ in data for p in places])) if data else np.zeros(0, dtype=int)
    data = [((_matrix(places, weights, used), None, measures), y) for (places, weights, measures), y in data]
    model = Labeller.fresh(len(used), seed)
    data.sort(key=lambda d: len(d[1]))
    batches = [data[at:at + _BATCH] for at in range(0, len(data), _BATCH)]
    names = list(vars(model))
    first = {n: np.zeros_like(getattr(model, n)) for n in names}
    second = {n: np.zeros_like(getattr(model, n)) for n in names}
    step = 0
    for _ in range(epochs):
        for b in rng.permutation(len(batches)):
            step += 1
            found = model.slopes([x for x, _ in batches[b]], [y for _, y in batches[b]])
            for n in names:
                first[n] += 0.1 * (found[n] - first[n])
                second[n] += 0.001 * (found[n] ** 2 - second[n])
                rate = 0.02 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                setattr(model, n, getattr(model, n) - rate * first[n] / (np.sqrt(second[n]) + 1e-8))
    embed = np.zeros((INPUTS, 8 * HIDDEN), dtype=np.float32)
    embed[used] = model.embed
    model.embed = embed
    return model


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", sample: int = SAMPLE_PAGES) -> DataFrame:
    """One row per page: key, url, text, n_chars, n_blocks, kept_blocks.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one space.  A
    null or empty page has an empty text; repeated pages and null keys stay as they are; other columns are not read.
    """
    source = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(body).alias("body"))
    fit = source.where(F.char_length("body").between(1, SAMPLE_CHARS)).select("key", "body")
    chosen = fit.where(hashed_share(sample, source.count(), "key", "body")).select("body").orderBy(F.xxhash64("body"), "body").limit(sample)
    model = train([r[0] for r in chosen.collect()])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        cache: dict[str, int] = {}
        parsed = [leaf_blocks(t) for t in batch.column(2).to_pylist()]
        labels = model.labels(parsed, cache)
        kept = [[b.text for b, yes in zip(blocks, marks) if yes] for blocks, marks in zip(parsed, labels)]
        texts = [" ".join(k) for k in kept]
        return pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([len(b) for b in parsed], pa.int64()), pa.array([len(k) for k in kept], pa.int64()),
        ], names=[key, url, "text", "n_chars", "n_blocks", "kept_blocks"])

    schema = StructType([
        StructField(key, source.schema["key"].dataType), StructField(url, source.schema["url"].dataType),
        *StructType.fromDDL("text string, n_chars long, n_blocks long, kept_blocks long").fields,
    ])
    return map_rows(source, run, schema)
