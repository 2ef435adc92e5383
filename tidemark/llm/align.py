"""Alignment of two tokenizers by interval coalescing.

Tokens of both are byte ranges of the same text.  All of them are lexsorted by start, the running maximum of their ends is
accumulated, and a group breaks where a start reaches it: there both tokenizers end a token.  Within a group, tokens are linked
where their ranges end together (or, by choice, where they overlap).

Both vocabularies let a text be cut before a single space between two characters that are not white space: no token goes
over such a place.  So the same stretches return all over a corpus, and each task aligns a stretch it has met only once.

How often a pair of ids is linked is counted over the corpus.  Looking a pair up has two ways, both always taken: pairs that hold
at least 1 / COMMON of all links (COMMON pairs at most) are broadcast, all others are joined by a shuffle in which
none of them can be hot.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tidemark.llm.common import cut, fresh, shared_folder

# A broadcast holds at most so many pairs of ids.
COMMON = 50_000
# Stretches that a task remembers, and the longest of them.
REMEMBERED = 250_000
LONGEST = 256
# Stretches that are tokenized in one call.
JOINED = 2048
# Bytes of text after which a batch of rows is given out.
FLUSH = 1 << 21

_CUT = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: visible ones stand for themselves, others from 256 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAC + 1), *range(0xAE, 0xFF + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE file of the `tokenizers` library; special tokens in a text are plain text."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        told = json.loads(self.tokenizer.to_str())
        before = told["pre_tokenizer"] or {}
        if before.get("type") != "ByteLevel" or not before.get("use_regex") or before.get("add_prefix_space") or told["normalizer"]:
            raise ValueError("only byte-level vocabularies that keep a text as it is can be cut at spaces")
        letters = byte_letters()
        self.bytes = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            self.bytes[i] = bytes(letters[c] for c in token)

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text with a space before it."""
        return [e.ids for e in self.tokenizer.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)]


class Pieces:
    """A sentencepiece file that adds a space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.vocab_size()):
            piece = self.model.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a vocabulary with pieces over spaces cannot be cut at them")
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Tokenizers:
    """Paths of the two files; they must be there on every machine."""

    a: str
    b: str

    def load(self) -> tuple[ByteLevel, Pieces]:
        return ByteLevel(self.a), Pieces(self.b)


def coalesced(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the tokens by start (A, side 0, first) and, in that order, the number of each one's group."""
    order = np.lexsort((side, start))
    reached = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), dtype=np.int64)
    breaks[1:] = start[order][1:] >= reached[:-1]
    return order, np.cumsum(breaks) - 1


def ending_together(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the A and B tokens of each link.  Tokens of one side do not overlap, so an end belongs to one of them."""
    return np.intersect1d(end_a, end_b, assume_unique=True, return_indices=True)[1:]


def overlapping(start_a, end_a, start_b, end_b) -> tuple[np.ndarray, np.ndarray]:
    """The same for all pairs whose ranges share a byte."""
    first = np.searchsorted(end_b, start_a, side="right")
    count = np.maximum(0, np.searchsorted(start_b, end_a, side="left") - first)
    a = np.repeat(np.arange(len(start_a)), count)
    within = np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)
    return a, first[a] + within


class Stretch(NamedTuple):
    """What is known of a stretch: token counts, its groups as told, and its linked pairs of ids as bytes of 64-bit numbers.

    `groups` is None where the tokens do not spell the stretch.
    """

    n_a: int
    n_b: int
    n_groups: int
    groups: bytes | None
    pairs: bytes


UNSPELT = Stretch(0, 0, 0, None, b"")


class Aligner:
    def __init__(self, a, b, links=ending_together) -> None:
        self.sides, self.links = (a, b), links
        self.lengths = [np.array([len(x) for x in s.bytes], dtype=np.int64) for s in self.sides]
        self.known: dict[str, Stretch] = {}

    def stretches(self, texts: list[str]) -> list[list[Stretch]]:
        """The stretches of each text, none for an empty one."""
        split = [_CUT.split(t) if t else [] for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({p for parts in split for p in parts if p not in known})
        # stretches with white space at an end can't be joined by a space
        new.sort(key=lambda p: p[0].isspace() or p[-1].isspace())
        told = dict(zip(new, self._aligned(new)))
        known.update((p, s) for p, s in told.items() if len(p) <= LONGEST)
        return [[told[p] if p in told else known[p] for p in parts] for parts in split]

    def _encoded(self, side: int, stretches: list[str], expected: list[bytes]) -> tuple[list[int], list[int]]:
        """Ids of all stretches and how many each has, -1 for one that the ids do not spell."""
        tokens, model = [], self.sides[side]
        counts: list[int] = []
        for at in range(0, len(stretches), JOINED):
            some, spelt = stretches[at:at + JOINED], expected[at:at + JOINED]
            if not (some[-1][0].isspace() or some[-1][-1].isspace()):
                ids = model.encode([" ".join(some)])[0]
                if b"".join(map(model.bytes.__getitem__, ids)) == b"".join(spelt):
                    ends = np.cumsum(self.lengths[side][ids])
                    bounds = np.cumsum([len(e) for e in spelt])
                    places = np.searchsorted(ends, bounds)
                    if (ends[places] == bounds).all():
                        tokens += ids
                        counts += np.diff(places, prepend=-1).tolist()
                        continue
            for ids, e in zip(model.encode(some), spelt):
                right = b"".join(map(model.bytes.__getitem__, ids)) == e
                tokens += ids if right else []
                counts.append(len(ids) if right else -1)
        return tokens, counts

    def _aligned(self, stretches: list[str]) -> list[Stretch]:
        expected = [f" {p}".encode("utf-8", "surrogatepass") for p in stretches]
        flat, counts = zip(*[self._encoded(side, stretches, expected) for side in (0, 1)])
        flat, counts = [np.array(f, dtype=np.int64) for f in flat], np.array(counts, dtype=np.int64).reshape(2, -1)
        right = (counts >= 0).all(axis=0)
        # tokens of a stretch that only one side spells are left out
        flat = [f[np.repeat(right, np.maximum(c, 0))] for f, c in zip(flat, counts)]
        n_a, n_b = counts[:, right]
        # one axis for all: a stretch begins where the one before it ends
        ends = [np.cumsum(lengths[f]) for lengths, f in zip(self.lengths, flat)]
        starts = [e - lengths[f] for e, lengths, f in zip(ends, self.lengths, flat)]
        bounds = np.cumsum([len(e) for e, r in zip(expected, right) if r])
        side = np.repeat([0, 1], [len(flat[0]), len(flat[1])])
        order, group = coalesced(np.concatenate(starts), np.concatenate(ends), side)
        # a group's A tokens, then its B tokens
        shown = order[np.lexsort((side[order], group))]
        group, side, token = np.sort(group), side[shown], np.concatenate(flat)[shown]
        signs = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
        words = [f"{t}{',|;'[s]}" for t, s in zip(token.tolist(), [*signs.tolist(), 2])]
        last = np.cumsum(n_a + n_b)
        opens = np.append(True, signs == 2)[:len(token)]
        n_groups = np.diff(np.append(0, np.cumsum(opens))[np.append(0, last)])
        in_a, in_b = self.links(starts[0], ends[0], starts[1], ends[1])
        pairs = (flat[0][in_a] << 32) | flat[1][in_b]
        links = np.append(0, np.searchsorted(ends[0][in_a], bounds, side="right")) * 8
        coded = pairs.tobytes()
        told = zip(n_a.tolist(), n_b.tolist(), n_groups.tolist(), np.append(0, last[:-1]).tolist(), last.tolist(),
                   links[:-1].tolist(), links[1:].tolist())
        good = iter([Stretch(a, b, n, "".join(words[first:end])[:-1].encode(), coded[low:high]) for a, b, n, first, end, low, high in told])
        return [next(good) if r else UNSPELT for r in right.tolist()]


ALIGNED = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
           "pairs array<bigint>, times array<int>")
_NAMES = [f.split()[0] for f in ALIGNED.split(", ")]


def align(docs: DataFrame, tokenizers: Tokenizers, text: str = "text", links=ending_together) -> DataFrame:
    """`docs` with the alignment of each whole text.

    `groups` lists the ids of A and B by group (`a1,a2|b1;a3|b2,b3`), `pairs` the linked pairs of ids (A's shifted by 32 bits,
    plus B's), each once, with `times` beside it.  A null or empty text, and one that either side's tokens do not spell, has no
    tokens: zeros and empty values.  Columns of these names are replaced, all others kept; equal rows stay separate.
    A text is handled stretch by stretch; only a stretch without any space is tokenized at once however long it is.
    """
    kept = docs.drop(*[c for c in _NAMES if c != text])
    at = kept.columns.index(text)

    def told(batch: pa.RecordBatch, aligner: Aligner) -> pa.RecordBatch:
        numbers, groups, pairs, times, sizes = [], [], [], [], []
        for parts in aligner.stretches([t or "" for t in batch.column(at).to_pylist()]):
            if not all(p.groups is not None for p in parts):
                parts = []
            code, n = np.unique(np.frombuffer(b"".join([p.pairs for p in parts]), dtype=np.int64), return_counts=True)
            numbers.append((sum(p.n_a for p in parts), sum(p.n_b for p in parts), sum(p.n_groups for p in parts), int(n.sum())))
            groups.append(b";".join([p.groups for p in parts]))
            pairs.append(code)
            times.append(n.astype(np.int32))
            sizes.append(len(code))
        bounds = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        columns = [pa.array(np.array(numbers, dtype=np.int64).reshape(-1, 4)[:, i]) for i in range(4)]
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *columns, pa.array(groups, pa.binary()).cast(pa.string()),
             pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.zeros(0, np.int64), *pairs]))),
             pa.ListArray.from_arrays(bounds, pa.array(np.concatenate([np.zeros(0, np.int32), *times])))],
            names=[*batch.schema.names, *_NAMES])

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in source:
            aligner = aligner or Aligner(*tokenizers.load(), links)
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0))
            first, total = 0, 0
            for i, size in enumerate(sizes.tolist()):
                total += size
                if total >= FLUSH or i + 1 == len(sizes):
                    yield told(batch.slice(first, i + 1 - first), aligner)
                    first, total = i + 1, 0

    return kept.mapInArrow(batches, StructType([*kept.schema.fields, *StructType.fromDDL(ALIGNED).fields]))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, `held` (links of the corpus that hold it) and `best` (whether no pair of its B id is held more often)."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("held"))
    # at most as many rows a B id as A has ids
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFF_FFFF)))
    return counts.select("pair", "held", (F.col("held") == F.max("held").over(of_b)).alias("best"))


def weighed(aligned: DataFrame, row: str) -> DataFrame:
    """For each `row` with links: `n_best`, its links whose count is their B id's highest, and `count_sum`, the sum of their counts."""
    counts = cut(pair_counts(aligned))
    total = counts.agg(F.sum("held")).first()[0] or 0
    common = F.col("held") * COMMON >= F.lit(total)
    hot = F.broadcast(counts.where(common))  # each holds 1 / COMMON of the links at least
    each = aligned.select(F.col(row).alias("row"), F.explode(F.arrays_zip("pairs", "times")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.times").alias("times"))

    def summed(joined: DataFrame) -> DataFrame:
        return joined.groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("held") * F.col("times")).alias("count_sum"))

    rare = each.join(hot.select("pair"), "pair", "left_anti").join(counts.where(~common), "pair")
    return summed(each.join(hot, "pair")).unionAll(summed(rare)).groupBy("row").agg(
        F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")).withColumnRenamed("row", row)


def aligned_documents(docs: DataFrame, tokenizers: Tokenizers, text: str = "text") -> DataFrame:
    """`docs` without the text, with the numbers of its alignment and the SHA-256 of its groups (empty where it has no tokens)."""
    kept = docs.drop("groups_sha256", "n_best", "count_sum")
    row = fresh(kept, "_row")
    path = shared_folder(docs.sparkSession, "aligned")
    digest = F.when(F.col("n_a") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    align(kept, tokenizers, text).withColumns({"groups_sha256": digest, row: F.monotonically_increasing_id()}).drop(
        text, "groups").write.parquet(path)
    aligned = docs.sparkSession.read.parquet(path)
    out = aligned.drop("pairs", "times").join(weighed(aligned, row), row, "left").drop(row)
    return out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_best", "count_sum")})
