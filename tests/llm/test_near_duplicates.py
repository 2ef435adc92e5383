import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import embeddings, graph, simhash


def naive_components(n, linked):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked[i][j] and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def test_components_of_chains_and_stars(spark):
    random.seed(3)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (7, 6), (7, 6), (None, 3)]
    random.shuffle(pairs)
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 1000 for i in range(1000, 1100)}}
    assert graph.components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def naive_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    pieces = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(p, seed=42).intdigest() for p in pieces]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints(spark):
    texts = [None, "", " \t\n", "One", "one TWO", "A b c d É é\u00a0x", "w " * 30_000]
    assert [simhash.fingerprint(t) for t in texts] == [naive_fingerprint(t) for t in texts]


def random_points(seed, n):
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(n)] + [0, 2 ** 64 - 1]
    for p in list(points):  # neighbours at every distance from 1 to 5
        for k in range(1, 6):
            points.append(p ^ sum(1 << b for b in rng.sample(range(64), k)))
    core = rng.getrandbits(64)  # a crowd around one point
    points += [core ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(200)]
    return sorted(set(points))


def test_links_connect_what_brute_force_connects(spark):
    points = random_points(11, 40)
    expected = naive_components(len(points), [[(a ^ b).bit_count() <= 3 for b in points] for a in points])
    signed = [(p if p < 2 ** 63 else p - 2 ** 64,) for p in points]
    frame = spark.createDataFrame(signed, "fp long")
    for chunk in (4096, 7):  # 7: crowded anchors are split
        links = simhash.links(frame, chunk=chunk)
        pairs = [(r.a % 2 ** 64, r.b % 2 ** 64) for r in links.collect()]
        assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
        roots = {r.node: r.root for r in graph.components(links, "a", "b").collect()}
        groups, plain = {}, {}
        for (p,), e in zip(signed, expected):
            groups.setdefault(roots.get(p, p), set()).add(p)
            plain.setdefault(e, set()).add(p)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_one_document_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(400))
    rows = [(3, text, 1), (2, text + " end", 1), (9, "other words here", 1), (4, None, 1), (5, "", 1), (None, "x y z q", 1),
            (None, "x y z q", 1), (2, text + " end", 1), (8, "other words here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _fp int")
    kept = simhash.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 4, 8]
    assert simhash.deduplicate(docs.limit(0)).count() == 0


def check_vectors(rows, got, least=0.93):
    n = len(rows)
    linked = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(n):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            good = all(v is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in (a, b))
            if i != j and good and la is not None and la == lb and len(a) == len(b):
                x, y = np.array(a), np.array(b)
                linked[i, j] = x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= least
    roots = naive_components(n, linked)
    for i, (key, _, _) in enumerate(rows):
        smallest = min(rows[j][0] for j in range(n) if roots[j] == roots[i])
        assert got[key].n_links == linked[i].sum()
        assert got[key].component_id == smallest and got[key].kept == (key == smallest)


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 12))
    vectors = [*base, *(base[:10] + rng.normal(scale=0.12, size=(10, 12))), *([base[0]] * 5),
               *(base[1] + rng.normal(scale=0.1, size=(40, 12)))]
    rows = [(i, [float(x) for x in v], i % 2 if i < 30 else 1) for i, v in enumerate(vectors)]
    rows += [(900, None, 1), (901, [0.0] * 12, 1), (902, [float("nan")] * 12, 1), (903, [None] * 12, 1),
             (904, rows[0][1], None), (905, [float("inf")] * 12, 1), (906, [1.0, 0.0], 1), (907, [1.0, 0.0], 1), (908, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("n_links", F.lit("mine"))
    for lists, chunk in ((None, 2048), (6, 3)):
        got = {r.vec_id: r for r in embeddings.near_duplicates(frame, lists=lists, chunk=chunk).collect()}
        assert len(got) == len(rows)
        check_vectors(rows, got)
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_vectors_of_any_size(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(60, 8))
    base[30:] = base[:30] + rng.normal(scale=0.05, size=(30, 8))
    scale = [1.0, 1e-200, 1e200, 1e-310, 1e300]
    frame = spark.createDataFrame(
        [(i, [float(x) * scale[i % 5] for x in v], 1) for i, v in enumerate(base)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r for r in embeddings.near_duplicates(frame, lists=4).collect()}
    check_vectors([(i, [float(x) for x in v], 1) for i, v in enumerate(base)], got)


def test_embeddings_of_the_sample(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in frame.collect()]
    check_vectors(rows, {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()})
