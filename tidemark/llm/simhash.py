"""SimHash near-duplicates by anchor-point covering.

Two 64-bit fingerprints that differ in at most 3 bits differ in at most one bit of the low or of the high 32 bits.
The first 31 bits of each half are covered by the Hamming(31, 26) code: it is perfect, so every point lies within
radius 1 of exactly one code word, its home anchor.  Of two points at distance 1, each therefore lies within
1 + 1 = 2 of the other's home.  Fingerprints are sent to all anchors within 2 (one or sixteen in each half) and are
compared at each anchor with those at home there, on all 64 bits.

Equal fingerprints are one row from the start.  An anchor with many home rows is split into chunks of them.  A task
keeps one chunk and streams the visitors past it; it reports links that join, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.common import cut, deal, fresh, map_rows
from tidemark.llm.graph import components

SHINGLE = 3
MAX_BITS = 3
SEED = 42
# Home rows of an anchor that one task compares with.
CHUNK = 4096
_BLOCK = 256

_LOW31 = (1 << 31) - 1
# Parity masks of the code: position i (1..31) has bit i - 1 and belongs to check b if bit b of i is set.
_CHECKS = [sum(1 << (i - 1) for i in range(1, 32) if i >> b & 1) for b in range(5)]


def _steps(syndrome: int) -> list[int]:
    """Bit patterns that lead from a point with this syndrome to every code word within 2, the home first."""
    if syndrome == 0:
        return [0]
    pairs = [(i, i ^ syndrome) for i in range(1, 32) if 0 < i < i ^ syndrome]
    return [1 << (syndrome - 1)] + [1 << (i - 1) | 1 << (j - 1) for i, j in pairs]


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bits set in more than half of the shingle hashes; 0 for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle, len(words)) - 1
    first, last = starts[: len(words) - span].tolist(), ends[span:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(first, last)], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at:at + 65536]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, name: str, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """`docs` with the fingerprint of `text` as a (signed) long column; a column of that name is replaced."""
    kept = docs.drop(name)
    at = kept.columns.index("text")

    def add(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([fingerprint(t, shingle, seed) for t in batch.column(at).to_pylist()], dtype=np.uint64)
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(values.view(np.int64))], names=[*batch.schema.names, name]
        )

    schema = StructType([*kept.schema.fields, StructField(name, LongType())])
    return map_rows(kept, add, schema)


def hex_digits(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def _at_anchors(points: DataFrame) -> DataFrame:
    """(fp) -> (half, anchor, role, fp), role 0 at the home anchor and 1 elsewhere."""
    table = F.array(*[F.array(*[F.lit(p).cast("long") for p in _steps(s)]) for s in range(32)])

    def rows(half: int) -> Column:
        low = F.shiftrightunsigned("fp", 32 * half).bitwiseAND(F.lit(_LOW31).cast("long"))
        syndrome = sum(
            ((F.bit_count(low.bitwiseAND(F.lit(mask).cast("long"))).bitwiseAND(F.lit(1))) * (1 << b)
             for b, mask in enumerate(_CHECKS)), F.lit(0)
        ).cast("int")
        return F.transform(F.element_at(table, syndrome + 1), lambda p, i: F.struct(
            F.lit(half).alias("half"), low.bitwiseXOR(p).alias("anchor"),
            F.when(i == 0, 0).otherwise(1).cast("int").alias("role"),
        ))

    return points.select("fp", F.inline(F.concat(rows(0), rows(1))))


class _Anchor:
    """Home fingerprints of one anchor chunk and the links found with them so far."""

    def __init__(self, homes: np.ndarray, bits: int):
        self.homes, self.bits = homes, bits
        self.label = np.arange(len(homes))

    def links(self, points: np.ndarray) -> Iterator[tuple[int, int]]:
        """Links from each point to one home of every group it joins; the groups become one."""
        for at in range(0, len(points), _BLOCK):
            block = points[at:at + _BLOCK]
            near = np.bitwise_count(block[:, None] ^ self.homes[None, :]) <= self.bits
            near &= block[:, None] != self.homes[None, :]
            for row in np.flatnonzero(near.any(axis=1)):
                found = np.flatnonzero(near[row])
                groups, first = np.unique(self.label[found], return_index=True)
                for home in found[first]:
                    yield int(block[row]), int(self.homes[home])
                itself = np.flatnonzero(self.homes == block[row])
                joined = np.unique(np.concatenate((groups, self.label[itself])))
                if len(joined) > 1:
                    self.label[np.isin(self.label, joined)] = joined[0]


def _compare(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, anchor, waiting = None, None, []
        for batch in batches:
            half, place, part, role = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            points = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            if not len(points):
                continue
            change = np.flatnonzero((np.diff(half) != 0) | (np.diff(place) != 0) | (np.diff(part) != 0)) + 1
            starts, stops = np.concatenate(([0], change)), np.concatenate((change, [len(points)]))
            # alone in its group, and the group cannot go on in another batch
            worth = stops - starts > 1
            worth[[0, -1]] = True
            found: list[tuple[int, int]] = []
            for i in np.flatnonzero(worth):
                a, b = starts[i], stops[i]
                here = (half[a], place[a], part[a])
                if here != key:
                    if waiting:
                        found.extend(_among(waiting, bits))
                    key, anchor, waiting = here, None, []
                home = a + np.searchsorted(role[a:b], 1)
                if home > a:
                    waiting.append(points[a:home])
                if home < b or i < len(starts) - 1:
                    if waiting:
                        homes = np.concatenate(waiting)
                        anchor, waiting = _Anchor(homes, bits), []
                        found.extend(anchor.links(homes))
                    if anchor is not None:
                        found.extend(anchor.links(points[home:b]))
            if found:
                yield _pairs(found)
        if waiting and (found := _among(waiting, bits)):
            yield _pairs(found)

    return run


def _among(homes: list[np.ndarray], bits: int) -> list[tuple[int, int]]:
    points = np.concatenate(homes)
    return list(_Anchor(points, bits).links(points))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    pairs = np.array(found, dtype=np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def links(points: DataFrame, bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """(a, b) pairs of distinct fingerprints `fp` at most `bits` (3 or fewer) apart, enough to connect all that are."""
    if not 0 <= bits <= 3:
        raise ValueError("the covering holds for 0 to 3 bits")
    dealt = deal(_at_anchors(points), ["half", "anchor"], "fp", chunk).select("half", "anchor", "part", "role", "fp")
    sorted_rows = dealt.repartition("half", "anchor", "part").sortWithinPartitions("half", "anchor", "part", "role")
    return sorted_rows.mapInArrow(_compare(bits), "a long, b long")


def near_duplicates(marked: DataFrame, name: str = "fp", key: str = "doc_id", bits: int = MAX_BITS) -> DataFrame:
    """(fp, root, component_id): every distinct fingerprint with its component's least fingerprint and smallest key.

    Null keys count after all others: a component with nothing but null keys has a null id.
    """
    reps = cut(marked.groupBy(F.col(name).alias("fp")).agg(F.min(key).alias("least")))
    roots = components(links(reps.select("fp"), bits), "a", "b")
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = cut(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def deduplicate(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """Documents (key, text, ...) of which one of each group stays: the one with the smallest key.

    All other columns are kept as they are.  Null texts have the fingerprint 0, like texts without words.  Rows that
    repeat the key and the fingerprint of the kept document, and all rows of a group without keys, are cut down to
    one row.
    """
    name = fresh(docs, "_fp")
    # fingerprints are computed once for the grouping and once more where whole rows are needed
    narrow = cut(with_fingerprint(docs.select(F.col(key).alias("key"), "text"), "fp", shingle).select("key", "fp"))
    groups = near_duplicates(narrow, "fp", "key", bits)
    owned = narrow.distinct().join(groups, "fp").where(F.col("key").eqNullSafe(F.col("component_id")))
    # several fingerprints of one component may carry its smallest key
    kept = owned.groupBy("component_id", "root").agg(F.min("fp").alias("fp"))
    rows = with_fingerprint(docs, name, shingle).alias("d").join(
        kept.alias("k"), (F.col(f"d.{name}") == F.col("k.fp")) & F.col(f"d.{key}").eqNullSafe(F.col("k.component_id"))
    ).select("d.*")
    return rows.dropDuplicates([name, key]).drop(name)
