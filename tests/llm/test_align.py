"""Token alignment beside a plain version that encodes whole texts."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import align
from tidemark.llm.queries import QUERIES, TOKENIZERS


@pytest.fixture(scope="module")
def sides():
    return TOKENIZERS.load()


def naive_alignment(text, sides):
    """Ids of both, groups and links; None where a side does not spell the text."""
    if not text:
        return None
    a, b = (s.encode([text])[0] for s in sides)
    expected = (" " + text).encode()
    if any(b"".join(s.bytes[i] for i in ids) != expected for s, ids in zip(sides, (a, b))):
        return None
    ends = [{}, {}]
    for side, ids, found in zip(sides, (a, b), ends):
        at = 0
        for i in ids:
            at += len(side.bytes[i])
            found[at] = i
    both = sorted(set(ends[0]) & set(ends[1]))
    groups, last = [], 0
    for cut in both:
        groups.append("|".join(",".join(str(found[e]) for e in sorted(found) if last < e <= cut) for found in ends))
        last = cut
    return len(a), len(b), groups, [(ends[0][e], ends[1][e]) for e in both]


def naive_rows(docs, sides):
    found = [(d, naive_alignment(t, sides)) for d, t in docs]
    held = Counter(link for _, f in found if f for link in f[3])
    best = {}
    for (_, b), n in held.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for d, f in found:
        if f is None:
            rows.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        rows.append((d, n_a, n_b, len(groups), len(links), sum(held[x] == best[x[1]] for x in links), sum(held[x] for x in links),
                     hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return rows


ODD = [None, "", " ", "  ", "a", " a  b ", "x\n\ny", "▁ a", "a▁b", "don't  stop now été", "<|endoftext|> <s> </s> <0x41> <unk>",
       "　a   b", "\U0001f600 中文 م", "tab\tand \x1c sep \x85 nel", "w" * 5000, "1 2 3", "a ​ b", "﻿x", "it 's we' ll", "a\x00b"]


def test_query_equals_a_plain_version(spark, sides, tmp_path, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    docs = docs[:80] + list(enumerate(ODD, 9000)) + [(None, docs[0][1]), docs[0]]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = sorted(naive_rows(docs, sides), key=str)
    assert sum(r[1] == 0 for r in expected) == 4 and sum(r[5] for r in expected) < sum(r[4] for r in expected)
    for common in (align.COMMON, 40):  # all pairs are broadcast, or most are shuffled
        monkeypatch.setattr(align, "COMMON", common)
        got = QUERIES["op11_alignment"](spark, str(tmp_path))
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        assert sorted((tuple(r) for r in got.collect()), key=str) == expected


def test_cut_texts_have_the_tokens_of_whole_ones(sides):
    rng = random.Random(3)
    letters = list("ab1.,'!-_é中 ") + [" ", "  ", "\n", "\t", " ", "\x1f", "　", "'s", "<s>", "́"]
    for side in sides:
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 25)))
            parts = align._CUT.split(text)
            assert [i for ids in side.encode(parts) for i in ids] == side.encode([text])[0], repr(text)


def test_groups_and_links_of_random_intervals():
    rng = np.random.default_rng(4)
    for _ in range(200):
        n = rng.integers(1, 30)
        inner = [np.flatnonzero(rng.random(n) < 0.6) for _ in range(2)]
        ends = [np.unique(np.append(i, n)) for i in inner]
        ends = [e[e > 0] for e in ends]
        starts = [np.append(0, e[:-1]) for e in ends]
        side = np.repeat([0, 1], [len(ends[0]), len(ends[1])])
        order, group = align.coalesced(np.concatenate(starts), np.concatenate(ends), side)
        both = np.intersect1d(*ends)
        assert (group == np.searchsorted(both, np.concatenate(ends)[order])).all()
        a, b = align.overlapping(starts[0], ends[0], starts[1], ends[1])
        plain = {(i, j) for i in range(len(ends[0])) for j in range(len(ends[1]))
                 if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]}
        assert set(zip(a.tolist(), b.tolist())) == plain and len(a) == len(plain)
        a, b = align.ending_together(starts[0], ends[0], starts[1], ends[1])
        assert [(ends[0][i], ends[1][j]) for i, j in zip(a, b)] == [(e, e) for e in both]


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "mine"), (1, "a b", 5, "mine"), (2, None, 6, "x")], "_row long, text string, pairs int, n_best string")
    got = align.aligned_documents(docs, TOKENIZERS)
    assert got.count() == 3 and {(r._row, r.n_links) for r in got.collect()} == {(1, 2), (2, 0)}
    assert align.aligned_documents(docs.limit(0), TOKENIZERS).count() == 0
    told = align.align(docs.withColumn("k", F.lit(1)), TOKENIZERS).where("_row = 1").first()
    assert told.k == 1 and told.groups.count(";") == 1 and len(told.pairs) == 2
