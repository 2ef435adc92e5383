"""Periodic runs beside a plain search over all periods."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import runs
from tidemark.llm.queries import QUERIES, planted


def naive_runs(words):
    found = []
    n = len(words)
    for p in range(1, n // 4 + 1):
        i = p
        while i < n:
            if words[i] != words[i - p]:
                i += 1
                continue
            first = i
            while i < n and words[i] == words[i - p]:
                i += 1
            start, length = first - p, i - first + p
            smaller = any(p % d == 0 and all(words[j] == words[j - d] for j in range(start + d, start + length)) for d in range(1, p))
            if length >= max(6, 4 * p) and not smaller:
                found.append((start, length, p))
    return sorted(found, key=lambda r: (r[0], r[2]))


def random_words(rng):
    kind, letters = rng.randrange(5), [b"w%d" % i for i in range(rng.choice([1, 2, 3, 9, 50]))]
    n = rng.choice([0, 1, 5, 6, 7, 30, 90, 300])
    some = [rng.choice(letters) for _ in range(n)]
    if kind == 1:
        some = some[: max(1, n // 5)] * rng.randint(1, 7)
    if kind == 2:
        for _ in range(rng.randint(1, 6)):
            at, q = rng.randrange(n + 1), rng.randint(1, 12)
            cycle = [rng.choice(letters) for _ in range(q)]
            some[at:at] = (cycle * 9)[: rng.randint(q, 6 * q)]
    if kind == 3:  # Fibonacci words hold many runs
        a, b = [b"a"], [b"a", b"b"]
        while len(b) < n:
            a, b = b, b + a
        some = b[:n]
    return some


def test_runs_equal_a_plain_search(monkeypatch):
    rng = random.Random(5)
    texts = [random_words(rng) for _ in range(500)]
    expected = [naive_runs(t) for t in texts]
    assert sum(map(len, expected)) > 250
    assert [[tuple(r) for r in f] for f in runs.text_runs(texts)] == expected
    monkeypatch.setattr(runs, "WINDOW", 24)  # overlapping windows find the same
    assert [[tuple(r) for r in f] for f in runs.text_runs(texts)] == expected


def test_last_ends_on_the_path_equal_a_plain_search():
    rng = random.Random(6)
    for _ in range(60):
        words, automaton = [rng.randrange(3) for _ in range(40)], runs.Automaton()
        for at, word in enumerate(words):
            told = automaton.append(word, at)
            # for each suffix length, the last earlier end of the same words
            last = {}
            for length in range(1, at + 1):
                ends = [e for e in range(length - 1, at) if words[e - length + 1:e + 1] == words[at - length + 1:at + 1]]
                if ends:
                    last[length] = ends[-1]
            longest = {}
            for length, end in last.items():
                longest[end] = max(longest.get(end, 0), length)
            assert {e: n for n, e in told if n} == longest


def test_long_periods_and_long_texts():
    rng = random.Random(7)
    cycle = [b"v%d" % rng.randrange(5000) for _ in range(9000)]
    text = [b"x"] * 3 + (cycle * 5)[:40_000] + [b"end"]
    (found,) = runs.text_runs([text])
    assert (3, 40_000, 9000) in [tuple(r) for r in found]
    (found,) = runs.text_runs([[b"a", b"b"] * 150_000])
    assert [tuple(r) for r in found] == [(0, 300_000, 2)]


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (None, "a " * 9, 2), (3, " b c\td e\n", 3), (3, " b c\td e\n", 3), (4, "x y " * 3 + "x", 4), (5, "w" * 200_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumn("_n", F.lit(1))
    got = runs.find_runs(docs).collect()
    assert len(got) == len(rows) and got[0]._n == 1
    told = {r.doc_id: r for r in got}
    assert told[1].runs == [] and told[1].collapsed == "" == told[2].collapsed
    assert [tuple(r) for r in told[None].runs] == [(0, 9, 1)] and told[None].collapsed == "a"
    assert told[3].collapsed == "b c d e" and told[4].runs == [] and len(told[5].collapsed) == 200_000
    assert runs.find_runs(docs.limit(0)).count() == 0
    assert np.all([r.collapsed is not None for r in got])


def planted_words(doc_id, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    return words


def expected_row(doc_id, words):
    found = naive_runs(words)
    best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + n for s, n, p in found)]
    told = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    return (doc_id, len(found), *best, best[1] and 1000 * best[1] // best[2], hashlib.sha256(told.encode()).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest())


def test_query_equals_a_plain_version(spark, tmp_path):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    docs = [(d, t) for d, t in docs if len((t or "").split()) < 900]
    rng = random.Random(9)
    docs += [(10_000 + i, b" ".join(random_words(rng)).decode()) for i in range(60)]
    docs += [(20_000 + i, " \tlead " + "a b " * i) for i in range(60)] + [(31, None), (32, ""), (None, "x " * 20), (33, " \n")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    told = {r.doc_id: (r.text or "").encode().split() for r in planted(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()}
    assert told == {d: planted_words(d, t) for d, t in docs}
    assert sum(told[d] != (t or "").encode().split() for d, t in docs) > 10
    got = sorted((tuple(r) for r in QUERIES["op12_runs"](spark, str(tmp_path)).collect()), key=lambda r: r[0] or 0)
    assert got == sorted((expected_row(d, planted_words(d, t)) for d, t in docs), key=lambda r: r[0] or 0)
    assert sum(r[1] > 0 for r in got) > 50
