"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Test items are cut into segments, whose word n-grams are the seeds.  Training texts are searched for them; around the
hits the passage is aligned with the segment, word by word, and scored against the segment's own score.  Edited and
paraphrased copies keep some seeds and most of the alignment.

Hits are counted first.  A rare seed joins a passage with its segments by itself.  A common one, which would join every
passage that holds it with every segment that holds it, does so only beside one of the segment's rarest words: a copy
keeps so many of the words that it cannot miss all of these, so nothing is lost.  Once a pair is found, common seeds
count as evidence of where the copy lies.

The pass over the texts needs only a bitmap of fixed size on each executor, whatever the number of items: it lets
through few n-grams that are none of the items', and an exact join drops these.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.llm.common import cut, fresh, map_rows, small_side

# Words are runs of ASCII letters, digits, underscores and characters beyond ASCII that are not punctuation or space.
_WORD = re.compile(r"[0-9a-z_\u0080-\U0010ffff]+")
_MARKS = re.compile(r"[\u0080-\u00bf\u1680\u2000-\u206f\u3000-\u303f\ufeff]")
_IN_WORD = np.array([b >= 0x80 or chr(b).isalnum() or b == ord("_") for b in range(256)])
# The bitmap has 2 ** BITMAP_BITS bits, two megabytes.
BITMAP_BITS = 24
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    """gram: words of a seed.  segment: most words of an item that are aligned at once.
    rare: most pairs of a passage and a segment that a seed may make alone, for each passage with hits; changes the
    work, not the rows.
    least: share of a segment's own score that makes a passage a copy.
    match, mismatch, gap: Smith-Waterman scores."""

    gram: int = 3
    segment: int = 256
    rare: float = 0.001
    least: float = 0.5
    match: int = 2
    mismatch: int = -1
    gap: int = -1


def _normal(text: str | None) -> str:
    lowered = (text or "").lower()
    return lowered if lowered.isascii() else _MARKS.sub(" ", lowered)


def words(text: str | None) -> list[str]:
    return _WORD.findall(_normal(text))


@lru_cache(maxsize=1)
def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The first `count` powers of `base` and of its inverse modulo 2 ** 64."""
    found = []
    for factor in (base, pow(base, -1, 1 << 64)):
        steps = np.full(count, factor, dtype=np.uint64)
        steps[0] = 1
        found.append(np.cumprod(steps))
    return found[0], found[1]


class _Words:
    """Where the words of a text begin and end in its UTF-8 bytes, and a hash of each, without a Python object a word.

    The hash of bytes b0, b1, ... is the sum of (bi + 1) * BASE ** i modulo 2 ** 64.
    """

    BASE = 0x100000001B3
    # Bytes hashed at a time; the powers of the base take 16 bytes for each.
    CHUNK = 1 << 18

    def __init__(self, text: str | None):
        self.data = _normal(text).encode("utf-8", "replace")
        self.bytes = np.frombuffer(self.data, dtype=np.uint8)
        inside = np.zeros(len(self.bytes) + 2, dtype=bool)
        inside[1:-1] = _IN_WORD[self.bytes]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[0::2], edges[1::2]

    def hashes(self) -> np.ndarray:
        found = np.zeros(len(self.starts), dtype=np.uint64)
        powers, inverse = _powers(self.BASE, self.CHUNK)
        for at in range(0, len(self.bytes), self.CHUNK):
            stop = min(at + self.CHUNK, len(self.bytes))
            # words that reach into this chunk; a word that began earlier goes on where its last part ended
            first, last = np.searchsorted(self.ends, at, "right"), np.searchsorted(self.starts, stop, "left")
            if first == last:
                continue
            part = self.bytes[at:stop].astype(np.uint64) + np.uint64(1)
            sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(part * powers[:len(part)])))
            starts, ends = np.maximum(self.starts[first:last], at) - at, np.minimum(self.ends[first:last], stop) - at
            added = (sums[ends] - sums[starts]) * inverse[starts]
            if self.starts[first] < at:
                added[:1] *= np.uint64(pow(self.BASE, int(at - self.starts[first]), 1 << 64))
            found[first:last] += added
        return found

    def between(self, first: int, stop: int) -> str:
        """The words from `first` to before `stop`, with what lies between them."""
        stop = min(stop, len(self.ends))
        return self.data[self.starts[first]:self.ends[stop - 1]].decode("utf-8")


def grams(single: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all word n-grams from those of the words; none for fewer words."""
    count = max(0, len(single) - size + 1)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(size if count else 0):
        total = (total ^ single[i:i + count]) * _MIX
        total ^= total >> np.uint64(29)
    return total


def item_segments(items: DataFrame, settings: Settings) -> DataFrame:
    """(item_id, text) -> (item_id, segment, words, grams, seg): word lists of at most `segment` words and their n-grams.

    `seg` numbers the rows; it holds once they are materialised."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens = words(text)
            pieces = max(1, -(-len(tokens) // settings.segment))
            size = -(-len(tokens) // pieces)
            for i in range(pieces):
                piece = tokens[i * size:(i + 1) * size]
                found = grams(_Words(" ".join(piece)).hashes(), settings.gram).view(np.int64)
                if len(found):
                    out.append((item, i, piece, found.tolist()))
        columns = list(zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([
            pa.array(columns[0], batch.column(0).type), pa.array(columns[1], pa.int32()),
            pa.array(columns[2], pa.list_(pa.string())), pa.array(columns[3], pa.list_(pa.int64())),
        ], names=["item_id", "segment", "words", "grams"])

    schema = StructType([
        StructField("item_id", items.schema["item_id"].dataType),
        *StructType.fromDDL("segment int, words array<string>, grams array<long>").fields,
    ])
    return map_rows(items.select("item_id", "text"), run, schema).withColumn("seg", F.monotonically_increasing_id())


def bitmap(hashed: DataFrame) -> np.ndarray:
    """Bits at the top BITMAP_BITS of each `gram`, gathered by 64-bit words: at most 2 ** (BITMAP_BITS - 6) rows."""
    place = F.shiftrightunsigned("gram", 64 - BITMAP_BITS)
    rows = hashed.groupBy(F.shiftrightunsigned(place, 6).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(gram, {64 - BITMAP_BITS}) & 63 as int))")).alias("bits")
    ).toPandas()
    found = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.int64)
    found[rows["at"].to_numpy()] = rows["bits"].to_numpy()
    return found.view(np.uint64)


def _held(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0


def _hits(docs: DataFrame, key: str, bits: np.ndarray, settings: Settings, longest: int) -> DataFrame:
    """(key, row, base, grams, places, passage, spot): neighbouring hits with the words around them.

    A passage has at most 4 * reach words; `base` is the place of its first word.  `spot` numbers the passages; it holds
    once they are materialised.
    """
    reach = longest + longest // 2 + 8

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, gram, at, base, passage = [], [], [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            tokens = _Words(text)
            found = grams(tokens.hashes(), settings.gram)
            places = np.flatnonzero(_held(found, bits))
            if not len(places):
                continue
            for group in np.split(places, np.flatnonzero(np.diff(places // (2 * reach))) + 1):
                start = max(0, int(group[0]) - reach)
                piece = tokens.between(start, int(group[-1]) + settings.gram + reach)
                rows.append(i)
                gram.append(found[group].view(np.int64).tolist())
                at.append(group.tolist())
                base.append(start)
                passage.append(piece)
        taken = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_arrays([
            batch.column(0).take(taken), batch.column(1).take(taken), pa.array(base, pa.int32()),
            pa.array(gram, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32())), pa.array(passage, pa.string()),
        ], names=["key", "row", "base", "grams", "places", "passage"])

    source = docs.select(F.col(key).alias("key"), row_mark().alias("row"), "text")
    schema = StructType([StructField("key", source.schema["key"].dataType), *StructType.fromDDL(
        "row long, base int, grams array<long>, places array<int>, passage string").fields])
    return map_rows(source, run, schema).withColumn("spot", F.monotonically_increasing_id())


def row_mark() -> Column:
    """Tells rows of one key with different texts apart."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def align(a: np.ndarray, b: np.ndarray, settings: Settings) -> tuple[int, int]:
    """Best local alignment score of the word ids `a` and `b`, and the place in `b` where it ends."""
    scores = np.zeros(len(b) + 1, dtype=np.int64)
    ramp = np.arange(len(b) + 1, dtype=np.int64) * -settings.gap
    best, end = 0, -1
    for word in a:
        step = np.where(b == word, settings.match, settings.mismatch)
        fresh = np.zeros_like(scores)
        fresh[1:] = np.maximum(0, np.maximum(scores[:-1] + step, scores[1:] + settings.gap))
        # a gap in `a` carries the best earlier score along, less for each step
        scores = np.maximum(fresh, np.maximum.accumulate(fresh + ramp) - ramp)
        at = int(scores.argmax())
        if scores[at] > best:
            best, end = int(scores[at]), at - 1
    return best, end


def aligned_span(item: list[str], passage: list[str], settings: Settings) -> tuple[float, int, int]:
    """Score as a share of the item's own score, first and last word of the copy in the passage."""
    ids: dict[str, int] = {}
    a = np.array([ids.setdefault(w, len(ids)) for w in item])
    b = np.array([ids.get(w, -1) for w in passage])
    score, end = align(a, b, settings)
    if end < 0:
        return 0.0, 0, 0
    _, back = align(a[::-1], b[:end + 1][::-1], settings)
    return score / (settings.match * len(item)), end - back, end


def may_reach(item: list[str], passage: list[str], settings: Settings) -> bool:
    """False where so few words of the item occur in the passage that no alignment has the least score."""
    held = set(passage)
    return sum(w in held for w in item) >= settings.least * len(item)


def _word_hashes(text: str) -> np.ndarray:
    """One-word grams, so that words are spread over the bitmap as n-grams are."""
    return grams(_Words(text).hashes(), 1)


def _segment_words(crowded: DataFrame) -> DataFrame:
    """(seg, size, word): the hashed words of the segments, repeats included."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [_word_hashes(" ".join(w)).view(np.int64).tolist() for w in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int64()))], names=["seg", "words"])

    return map_rows(crowded.select("seg", "words"), run, "seg long, words array<long>").select(
        "seg", F.size("words").alias("size"), F.explode("words").alias("word"))


def _held_words(hits: DataFrame, seeds: np.ndarray, vocabulary: np.ndarray) -> DataFrame:
    """(spot, words): of the passages that hold an n-gram of `seeds`, the different hashed words that are in `vocabulary`."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams_of, passages = batch.column(1), batch.column(2)
        taken, found = [], []
        for i in range(batch.num_rows):
            if _held(grams_of[i].values.to_numpy().view(np.uint64), seeds).any():
                single = np.unique(_word_hashes(passages[i].as_py()))
                taken.append(i)
                found.append(single[_held(single, vocabulary)].view(np.int64))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(taken, pa.int32())), pa.array(found, pa.list_(pa.int64()))], names=["spot", "words"])

    return map_rows(hits.select("spot", "grams", "passage"), run, "spot long, words array<long>")


def _rarest_words(placed: DataFrame, held: DataFrame, settings: Settings) -> DataFrame:
    """(seg, word, n): of each segment so many of its rarest words that a copy holds one; `n` passages hold the word.

    A copy holds at least `least` of a segment's words, repeats counted; it cannot do without one more than the others.
    """
    known = held.groupBy("word").agg(F.count("*").alias("n"))
    return (
        placed.join(known, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("seg").orderBy("n", "word")))
        .where(F.col("_rank") <= F.col("size") - F.ceil(F.col("size") * settings.least) + 1)
        .select("seg", "word", "n").distinct()
    )


def candidates(hits: DataFrame, segments: DataFrame, settings: Settings) -> DataFrame:
    """(spot, seg, low, high) of passages and segments that may be copies; where the segment may begin in the text.

    Both tables are materialised.  A segment with common seeds is searched by its seeds all the same where they make
    fewer pairs than its rarest words.
    """
    seeded = cut(segments.select("seg", F.posexplode("grams").alias("item_at", "gram")))
    each = hits.select("spot", F.inline(F.arrays_zip(F.col("grams").alias("gram"), F.col("places").alias("at"))))
    owners = small_side(seeded.groupBy("gram").agg(F.count("*").alias("owners")))
    counted = cut(each.join(owners, "gram").groupBy("gram", "owners").agg(F.count("*").alias("n")))
    common = F.col("n") * F.col("owners") > settings.rare * hits.count()

    def placed(pairs: DataFrame) -> DataFrame:
        shift = F.col("at") - F.col("item_at")
        return pairs.groupBy("spot", "seg").agg(F.min(shift).alias("low"), F.max(shift).alias("high"))

    if counted.where(common).isEmpty():
        return placed(each.join(small_side(seeded), "gram"))
    met = cut(seeded.join(counted.withColumn("common", common).select("gram", "n", "common"), "gram"))
    crowded = met.where("common").groupBy("seg").agg(F.sum("n").alias("by_gram")).join(segments.select("seg", "words"), "seg")
    placed_words = cut(_segment_words(crowded))
    told = cut(_held_words(hits, bitmap(counted.where(common).select("gram")),
                           bitmap(placed_words.select(F.col("word").alias("gram")))))
    held = told.select("spot", F.explode("words").alias("word"))
    rarest = cut(_rarest_words(placed_words, held, settings))
    by_word = rarest.groupBy("seg").agg(F.sum("n").alias("by_word"))
    worded = cut(crowded.join(by_word, "seg").where("by_word < by_gram").select("seg"))
    alone = met.join(worded, "seg", "left_anti")
    found = (
        held.join(small_side(rarest.join(worded, "seg").select("seg", "word")), "word").select("spot", "seg")
        .unionByName(each.join(small_side(met.where("not common").join(worded, "seg").select("seg", "gram")), "gram").select("spot", "seg"))
        .distinct()
    )
    evidence = found.join(each, "spot").join(seeded, ["seg", "gram"])
    return placed(each.join(small_side(alone.select("seg", "gram", "item_at")), "gram")).unionByName(placed(evidence))


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """(key, row, item_id, segment, score, first_word, last_word) of every copy, the best of each document and segment.

    Words are compared in lower case, without punctuation.  A copy in which no `gram` words of the segment still stand
    together is not found.  Items with fewer words than a seed, null and empty texts match nothing.  Repeated documents each match (equal key and text: once); a null key is
    kept as null.  Other columns are not read.
    """
    segments = cut(item_segments(items.distinct(), settings))
    longest = segments.agg(F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0]
    hits = cut(_hits(docs, key, bitmap(segments.select(F.explode("grams").alias("gram"))), settings, longest))
    # the passages, the widest column, join last and only once
    pairs = hits.join(small_side(candidates(hits, segments, settings)), "spot").join(segments, "seg").select(
        "key", "row", "item_id", "segment", "low", "high", "base", "passage", "words")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        low, high, base = (batch.column(i).to_pylist() for i in (4, 5, 6))
        score, first, last = [], [], []
        for i, (passage, item) in enumerate(zip(batch.column(7).to_pylist(), batch.column(8).to_pylist())):
            tokens, slack = _WORD.findall(passage), len(item) // 2 + 8
            start = max(0, low[i] - slack - base[i])
            near = tokens[start:high[i] + len(item) + slack - base[i]]
            share, a, b = aligned_span(item, near, settings) if may_reach(item, near, settings) else (0.0, 0, 0)
            score.append(share)
            first.append(base[i] + start + a)
            last.append(base[i] + start + b)
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:4], pa.array(score), pa.array(first, pa.int32()), pa.array(last, pa.int32())],
            names=[*batch.schema.names[:4], "score", "first_word", "last_word"],
        )

    schema = StructType([*pairs.schema.fields[:4], *StructType.fromDDL("score double, first_word int, last_word int").fields])
    found = map_rows(pairs, run, schema).where(F.col("score") >= settings.least)
    return found.groupBy("key", "row", "item_id", "segment").agg(
        F.max(F.struct("score", (-F.col("first_word")).alias("order"), "last_word")).alias("best")
    ).select(
        F.col("key").alias(key), "row", "item_id", "segment", F.col("best.score").alias("score"),
        (-F.col("best.order")).alias("first_word"), F.col("best.last_word").alias("last_word"),
    )


def clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """Documents without a copy of any test item; all columns and repeated rows are kept."""
    mark = fresh(docs, "_mark")
    bad = small_side(matches(docs, items, key, settings).select(F.struct(key, "row").alias("bad")).distinct())
    same = F.col(f"d.{key}").eqNullSafe(F.col(f"b.bad.{key}")) & (F.col(f"d.{mark}") == F.col("b.bad.row"))
    return docs.withColumn(mark, row_mark()).alias("d").join(bad.alias("b"), same, "left_anti").drop(mark)
