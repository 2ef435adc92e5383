"""Embedding near-duplicates by product quantisation.

Vectors are normalised and filed in coarse inverted lists by their nearest centroid; what is left of them is coded by
subspaces.  On a unit sphere a cosine of at least t is a distance of at most d = sqrt(2 - 2 t).  If two such vectors lie
in different lists, the line between them crosses the plane halfway between the two centroids, so at least one of
them lies within d / 2 of it: every vector probes all lists whose plane is that near, and no link is lost.  In a list,
table look-ups give the distance q to each coded vector; as a code is off by a known error e, only vectors with
q <= d + e can link, and these are compared by exact cosine in double precision.

Centroids and codes are fitted on a bounded sample; every vector is indexed.  Equal vectors are one row with a count.
A crowded list is split into chunks; a task keeps one chunk and streams the probing vectors past it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, deal, hashed_share
from tidemark.llm.graph import components

SAMPLE = 20_000
SUBSPACES = 8
CODES = 256
CHUNK = 2048
_BLOCK = 128
_SLACK = 1e-6


@dataclass(frozen=True)
class Codebook:
    """coarse: (lists, dim); fine: (subspaces, codes, width) over the dimensions padded to subspaces * width."""

    coarse: np.ndarray
    fine: np.ndarray

    @property
    def dim(self) -> int:
        return self.fine.shape[0] * self.fine.shape[2]


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, (points, centres)."""
    return (points ** 2).sum(1)[:, None] - 2 * points @ centres.T + (centres ** 2).sum(1)[None, :]


def _kmeans(points: np.ndarray, count: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.choice(len(points), min(count, len(points)), replace=False)].astype(np.float64)
    for _ in range(rounds):
        near = _nearest(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        sizes = np.bincount(near, minlength=len(centres))
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def padded(vectors: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(vectors, ((0, 0), (0, dim - vectors.shape[1]))) if vectors.shape[1] < dim else vectors


def fit(sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 42) -> Codebook:
    """Codebook from unit vectors."""
    width = -(-sample.shape[1] // subspaces)
    points = padded(sample, width * subspaces)
    coarse = _kmeans(points, lists, 10, seed)
    left = points - coarse[_nearest(points, coarse).argmin(1)]
    fine = [_kmeans(left[:, i * width:(i + 1) * width], codes, 6, seed + i) for i in range(subspaces)]
    return Codebook(coarse, np.stack(fine))


def encode(points: np.ndarray, book: Codebook) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Home list, codes, coding error, and distance from the plane towards every other list (0 for the own)."""
    far = _nearest(points, book.coarse)
    home = far.argmin(1)
    between = np.sqrt(np.maximum(_nearest(book.coarse, book.coarse), 1e-12))
    plane = (far - far[np.arange(len(points)), home][:, None]) / (2 * between[home])
    left = points - book.coarse[home]
    width = book.fine.shape[2]
    parts = [left[:, i * width:(i + 1) * width] for i in range(len(book.fine))]
    codes = np.stack([_nearest(p, c).argmin(1) for p, c in zip(parts, book.fine)], axis=1)
    decoded = np.concatenate([book.fine[i][codes[:, i]] for i in range(len(book.fine))], axis=1)
    return home, codes.astype(np.int32), np.sqrt(((left - decoded) ** 2).sum(1)), plane


def table_distances(queries: np.ndarray, centre: np.ndarray, codes: np.ndarray, book: Codebook) -> np.ndarray:
    """Asymmetric distances: exact queries against coded vectors of one list, by table look-up."""
    left = queries - centre
    width = book.fine.shape[2]
    total = np.zeros((len(queries), len(codes)))
    for i, words in enumerate(book.fine):
        total += _nearest(left[:, i * width:(i + 1) * width], words)[:, codes[:, i]]
    return np.sqrt(np.maximum(total, 0))


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Each row by a power of two that brings its largest component near 1, so that squares neither vanish nor
    overflow; no digit of an ordinary vector changes."""
    _, power = np.frexp(np.abs(raw).max(1))
    return np.ldexp(raw, -power[:, None])


def _unit(raw: np.ndarray) -> np.ndarray:
    near = _scaled(raw)
    return near / np.sqrt((near * near).sum(1))[:, None]


def _file(book: Codebook, reach: float):
    """Arrow batches of (label, dim, node, copies, embedding) to rows for every list a vector is in or probes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                raw = np.zeros((batch.num_rows, book.dim))
                for i, vector in enumerate(batch.column(4)):
                    values = np.asarray(vector.values, dtype=np.float64)
                    raw[i, :len(values)] = values
                raw = _scaled(raw)
                home, codes, error, plane = encode(_unit(raw), book)
                probes = plane <= reach
                probes[np.arange(len(home)), home] = True
                row, place = np.nonzero(probes)
                own = place == home[row]
                taken = pa.array(row)
                lists = [np.flatnonzero(p).astype(np.int32) for p in probes]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(taken), batch.column(1).take(taken), pa.array(place.astype(np.int32)),
                    pa.array(np.where(own, 0, 1).astype(np.int32)), batch.column(2).take(taken), batch.column(3).take(taken),
                    pa.array(home[row].astype(np.int32)),
                    pa.array([raw[r].tobytes() for r in row], pa.binary()),
                    pa.array([codes[r].tobytes() if o else None for r, o in zip(row, own)], pa.binary()),
                    pa.array(error[row]),
                    pa.array([lists[r].tobytes() if o else None for r, o in zip(row, own)], pa.binary()),
                ], names=_FILED)

    return run


_FILED = ["label", "dim", "list", "role", "node", "copies", "home", "raw", "codes", "error", "probes"]


class _Chunk:
    """Home vectors of one list chunk, the number of links of each vector and the groups linked so far."""

    def __init__(self, rows: dict[str, np.ndarray], book: Codebook, least: float, reach: float):
        self.rows, self.book, self.least, self.reach = rows, book, least, reach
        self.unit = _unit(rows["raw"])
        self.label = np.arange(len(self.unit))
        self.counts = np.zeros(len(self.unit), dtype=np.int64)
        self.centre = book.coarse[rows["list"][0]]

    def _linked(self, visitors: dict[str, np.ndarray], unit: np.ndarray) -> np.ndarray:
        near = table_distances(unit, self.centre, self.rows["codes"], self.book)
        v, h = np.nonzero(near <= self.reach + self.rows["error"][None, :] + _SLACK)
        a, b = visitors["raw"][v], self.rows["raw"][h]
        dot = np.einsum("ij,ij->i", a, b)
        norm = np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b))
        linked = np.zeros(near.shape, dtype=bool)
        hit = dot / norm >= self.least
        linked[v[hit], h[hit]] = True
        return linked

    def meet(self, visitors: dict[str, np.ndarray], at_home: bool) -> tuple[list, list]:
        """Counts for the visitors (counts of the home rows are kept) and links; each pair is counted once."""
        counts, links = [], []
        for at in range(0, len(visitors["node"]), _BLOCK):
            block = {k: x[at:at + _BLOCK] for k, x in visitors.items()}
            linked = self._linked(block, _unit(block["raw"]))
            smaller = block["node"][:, None] < self.rows["node"][None, :]
            if at_home:
                counted = linked & smaller
            else:
                back = np.array([[h in probes for probes in self.rows["probes"]] for h in block["home"]], dtype=bool)
                counted = linked & (smaller | ~back)
            mine = counted @ self.rows["copies"]
            self.counts += block["copies"] @ counted
            counts.extend((n, c) for n, c in zip(block["node"], mine) if c)
            for i in np.flatnonzero(counted.any(1)):
                hit = np.flatnonzero(counted[i])
                groups, one = np.unique(self.label[hit], return_index=True)
                links.extend((block["node"][i], self.rows["node"][h]) for h in hit[one])
                if at_home:
                    groups = np.unique(np.append(groups, self.label[at + i]))
                if len(groups) > 1:
                    self.label[np.isin(self.label, groups)] = groups[0]
        return counts, links

    def own_counts(self) -> list:
        return [(n, c) for n, c in zip(self.rows["node"], self.counts) if c]


def _compare(book: Codebook, least: float, reach: float):
    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        plain = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in ("list", "node", "copies", "home", "error")}
        plain["raw"] = np.frombuffer(b"".join(batch.column("raw").to_pylist()), dtype=np.float64).reshape(-1, book.dim)
        return plain

    def homes(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), dtype=np.int32)
        probes = np.empty(batch.num_rows, dtype=object)
        probes[:] = [set(np.frombuffer(x, dtype=np.int32).tolist()) for x in batch.column("probes").to_pylist()]
        return arrays(batch) | {"codes": codes.reshape(batch.num_rows, -1), "probes": probes}

    def result(counts: list, links: list) -> pa.RecordBatch:
        a = np.array([x for x, _ in counts] + [x for x, _ in links], dtype=np.int64)
        b = pa.array([None] * len(counts) + [int(x) for _, x in links], pa.int64())
        n = np.array([x for _, x in counts] + [0] * len(links), dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(n)], names=["a", "b", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, chunk = None, [], None

        def settle():
            """The home rows are complete: compare them with each other."""
            rows = [homes(b) for b in waiting]
            made = _Chunk({k: np.concatenate([r[k] for r in rows]) for k in rows[0]}, book, least, reach)
            return made, made.meet(made.rows, True)

        for batch in batches:
            ids = [batch.column(n).to_pylist() for n in ("label", "dim", "list", "part")]
            keys = list(zip(*ids))
            role = batch.column("role").to_numpy(zero_copy_only=False)
            edges = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1] or role[i] != role[i - 1]]
            for start, stop in zip(edges, [*edges[1:], len(keys)]):
                if keys[start] != key:
                    if waiting:
                        chunk, found = settle()
                        yield result(*found)
                    if chunk is not None:
                        yield result(chunk.own_counts(), [])
                    key, waiting, chunk = keys[start], [], None
                piece = batch.slice(start, stop - start)
                if role[start] == 0:
                    waiting.append(piece)
                    continue
                if waiting:
                    chunk, found = settle()
                    waiting = []
                    yield result(*found)
                if chunk is not None:
                    yield result(*chunk.meet(arrays(piece), False))
        if waiting:
            chunk, found = settle()
            yield result(*found)
        if chunk is not None:
            yield result(chunk.own_counts(), [])

    return run


def usable(label: Column, vector: Column) -> Column:
    """Labelled, not empty, all components finite numbers, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = 0.93,
    sample: int = SAMPLE, lists: int | None = None, chunk: int = CHUNK,
) -> DataFrame:
    """One row per vector: key, n_links, component_id, kept.

    Only vectors with equal, known labels and equal length are compared.  Vectors that are null, empty, zero or
    hold null or non-finite components, and vectors with a null label, link with nothing and are kept.  Equal vectors link
    with each other.  Rows with a null key are compared and counted; a component of nothing but such rows has a
    null id and keeps none of them.  Other columns are not read.
    """
    kept = rows.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"), F.col(label).cast("string").alias("label"))
    good = kept.where(usable(F.col("label"), F.col("v")))
    reps = cut(good.groupBy("label", "v").agg(F.min("key").alias("least"), F.count("*").alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()
    ))
    count, dim = reps.agg(F.count("*"), F.max(F.size("v"))).first()
    alone = kept.where(~usable(F.col("label"), F.col("v"))).select(
        "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.col("key").isNotNull().alias("kept")
    )
    if not count:
        return alone.withColumnRenamed("key", key)
    fitted = reps.where(hashed_share(sample, count, "node")).select("v", "node").orderBy(
        F.xxhash64("node"), "node"
    ).limit(sample).toPandas()["v"]
    points = np.zeros((len(fitted), dim))
    for i, values in enumerate(fitted):
        points[i, :len(values)] = values
    wanted = lists or max(16, round(count ** 0.5 / 8))
    book = fit(_unit(points), max(1, min(wanted, len(points) // 10)))
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    filed = reps.select("label", F.size("v").alias("dim"), "node", "copies", "v").mapInArrow(
        _file(book, reach / 2 + _SLACK),
        "label string, dim int, list int, role int, node long, copies long, home int, raw binary, codes binary, "
        "error double, probes binary",
    )
    keys = ["label", "dim", "list"]
    dealt = deal(filed, keys, "node", chunk)
    found = cut(dealt.select(*_FILED, "part").repartition(*keys, "part").sortWithinPartitions(*keys, "part", "role").mapInArrow(
        _compare(book, least, reach), "a long, b long, n long"
    ))
    counts = found.where("b is null").groupBy("a").agg(F.sum("n").alias("others"))
    roots = components(found.where("b is not null").select("a", "b"), "a", "b")
    rooted = cut(reps.join(counts, F.col("node") == F.col("a"), "left").drop("a").join(
        roots, "node", "left"
    ).withColumn("root", F.coalesce("root", "node")).withColumn(
        "n_links", F.coalesce("others", F.lit(0)) + F.col("copies") - 1
    ))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    told = rooted.join(smallest, "root").select("label", "v", "n_links", "component_id")
    linked = good.join(told, ["label", "v"]).select(
        "key", "n_links", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept")
    ).withColumn("kept", F.col("kept") & F.col("key").isNotNull())
    return linked.union(alone).withColumnRenamed("key", key)
