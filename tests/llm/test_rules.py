"""The rule ensemble: statistics and rules beside plain versions, and held-out accuracy."""

import math
import random
import unicodedata
import zlib

import regex
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tidemark.llm import rules
from tidemark.llm.queries import QUERIES


def naive_statistics(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    lines = [x for x in text.split("\n") if x]
    kind = [unicodedata.category(c) for c in text]
    share = lambda a, b: a / b if b else 0.0
    sign = [k[0] not in "LN" and not c in " \t\n\x0b\x0c\r" for c, k in zip(text, kind)]
    doubled = len(regex.findall(r"([^\p{L}\p{N} \t\n\x0b\f\r])\1", text))
    ends = sum(c in ".!?" and (i + 1 == len(text) or text[i + 1] in " \t\n\x0b\x0c\r") for i, c in enumerate(text))
    return {
        "n_words": len(words), "chars_a_word": share(sum(map(len, words)), len(words)), "distinct_words": share(len(set(words)), len(words)),
        "same_as_before": share(sum(a == b for a, b in zip(words, words[1:])), len(words)), "n_lines": len(lines),
        "distinct_lines": share(len(set(lines)), len(lines)), "chars_a_line": share(len(text), len(lines)),
        "letters": share(sum(k[0] == "L" for k in kind), len(text)), "upper": share(kind.count("Lu"), len(text)),
        "digits": share(sum(k[0] == "N" for k in kind), len(text)), "signs": share(sum(sign), len(text)),
        "doubled_signs": share(doubled, len(words)), "markup": share(sum(c in "|{}<>\\=_#" for c in text), len(text)),
        "sentence_ends": share(ends, len(words)),
    }


def fit_small(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [rng.choice(["lorem", "ipsum", "dolor", "sit", "amet."]) + str(rng.randrange(40)) for _ in range(rng.randint(5, 80))]
        kind = rng.randrange(6)
        text = " ".join(words)
        if kind == 0:
            text = text.upper() + "!!"
        elif kind == 1:
            text = " ".join([words[0]] * len(words))
        rows.append((i, text, int(kind > 1)))
    return rows


def test_statistics_equal_a_plain_version(spark):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + [
        None, "", " \n\t", "a", "A!! b?? <|x|> Été ½٣ c.\nc.\n\nc. ", "x " * 4000, "中文。"]
    docs = spark.createDataFrame(list(enumerate(texts)), "_n_words long, text string")  # an id with a clashing name
    told, names = rules.with_statistics(docs)
    assert told.columns == ["_n_words", "text", *names]
    for r in told.collect():
        for name, value in zip(rules.STATISTICS, r[2:]):
            assert abs(naive_statistics(r.text)[name] - value) < 1e-9, (r.text[:50], name)


def test_held_out_accuracy_and_compiled_rules(spark):
    rows = fit_small(spark)
    docs = spark.createDataFrame([(i, t, "mine") for i, t, _ in rows], "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i < 400], "doc_id long, quality int")
    ensemble = rules.train(docs, labels)
    assert 0 < len(ensemble.rules) < 200 and any(len(r) > 1 for r in ensemble.rules)
    scored = {r.doc_id: r for r in rules.score(docs, ensemble).collect()}
    assert sum(scored[i].predicted != q for i, _, q in rows[400:]) <= 4
    for i, text, _ in rows[::20]:
        told = list(naive_statistics(text).values())
        logit = ensemble.bias + sum(w for rule, w in zip(ensemble.rules, ensemble.weights)
                                    if all((told[c.at] > c.bound) == c.above for c in rule))
        assert abs(scored[i].score - 1 / (1 + math.exp(-logit))) < 1e-6


def test_paths_become_narrow_rules():
    class Split:
        def __init__(self, at, bound):
            self.featureIndex, self.threshold = lambda: at, lambda: bound

    class Node:
        def __init__(self, split=None, left=None, right=None):
            self.split, self.leftChild, self.rightChild = lambda: split, lambda: left, lambda: right
            self.subtreeDepth = lambda: int(split is not None)

    tree = Node(Split(2, 5.0), Node(Split(2, 3.0), Node(), Node()), Node())
    low, mid, high = rules.Condition(2, False, 5.0), rules.Condition(2, False, 3.0), rules.Condition(2, True, 5.0)
    assert rules.tree_rules(tree) == {(low,), (mid,), (low, rules.Condition(2, True, 3.0)), (high,)}


def test_odd_rows_and_labels(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (2, ""), (3, "w" * 300_000), (4, "a b " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in rules.score(docs, rules.train(docs, none)).collect()} == {0.5}
    alike = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 0), (77, 0)], "doc_id long, quality int")
    assert {r.predicted for r in rules.score(docs, rules.train(docs, alike)).collect()} == {1}
    both = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (3, 1)], "doc_id long, quality int")
    got = rules.score(docs, rules.train(docs, both)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert rules.score(docs.limit(0), rules.train(docs, both)).count() == 0


def test_query_on_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    got = QUERIES["op13_quality"](spark, SMALL).collect()
    assert len(got) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in labels]
    assert sum(r.predicted != labels[r.doc_id] for r in held) <= 0.1 * len(held)
