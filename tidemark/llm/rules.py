"""Quality by a sparse rule ensemble.

Shallow trees of a random forest are grown on statistics of labelled texts.  Every path from a root to a node is a
conjunctive rule (`upper_share > 0.4 and n_lines <= 2`).  A logistic model with an L1 penalty weighs the rules and sets
most weights to zero; what is left is compiled into one column expression.  Statistics and scores are column expressions
too, so scoring is one pass over the texts without Python.

Forest and lasso are Spark's own, on at most `rows` labelled texts, so training costs the same at every corpus size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import cut, fresh, hashed_share

# At most so many labelled texts are used for training, taken by a hash of their key.
TRAINING_ROWS = 20_000
TREES = 24
DEPTH = 3
# Share of a tree's rows that a node holds at least.
LEAST_SHARE = 0.002
PENALTY = 0.0005
PARTITIONS = 8

SPACES = r"[\x20\x09-\x0D]+"
SEED = 13


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _follows(words: Column) -> Column:
    """For every word but the first, whether it is the word before."""
    return F.zip_with(F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1))), words, lambda a, b: a == b)


# Name -> expression of text, words and lines.  All are 0 where there is nothing to count.
STATISTICS = {
    "n_words": lambda t, w, l: F.size(w).cast("double"),
    "chars_a_word": lambda t, w, l: _share(F.char_length(F.array_join(w, "")), F.size(w)),
    "distinct_words": lambda t, w, l: _share(F.size(F.array_distinct(w)), F.size(w)),
    "same_as_before": lambda t, w, l: _share(F.size(F.filter(_follows(w), lambda same: same)), F.size(w)),
    "n_lines": lambda t, w, l: F.size(l).cast("double"),
    "distinct_lines": lambda t, w, l: _share(F.size(F.array_distinct(l)), F.size(l)),
    "chars_a_line": lambda t, w, l: _share(F.char_length(t), F.size(l)),
    "letters": lambda t, w, l: _share(_count(t, r"\p{L}"), F.char_length(t)),
    "upper": lambda t, w, l: _share(_count(t, r"\p{Lu}"), F.char_length(t)),
    "digits": lambda t, w, l: _share(_count(t, r"\p{N}"), F.char_length(t)),
    "signs": lambda t, w, l: _share(_count(t, r"[^\p{L}\p{N}\s]"), F.char_length(t)),
    "doubled_signs": lambda t, w, l: _share(_count(t, r"([^\p{L}\p{N}\s])\1"), F.size(w)),
    "markup": lambda t, w, l: _share(_count(t, r"[|{}<>\\=_#]"), F.char_length(t)),
    "sentence_ends": lambda t, w, l: _share(_count(t, r"[.!?](?=\s|$)"), F.size(w)),
}


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with a column for each statistic of the whole text, and the names of these columns, which are new ones.

    A null text counts as empty.
    """
    own, words, lines = (fresh(docs, f"_{n}") for n in ("text", "words", "lines"))
    names = [fresh(docs, f"_{n}") for n in STATISTICS]
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.withColumns({
        own: whole,
        words: F.array_remove(F.split(whole, SPACES), ""),
        lines: F.array_remove(F.split(whole, r"\n"), ""),
    })
    # a generator keeps the optimizer from copying the statistics into every rule
    made = F.array(F.struct(*[f(F.col(own), F.col(words), F.col(lines)).alias(n) for n, f in zip(names, STATISTICS.values())]))
    return split.select(*docs.columns, F.inline(made)), names


class Condition(NamedTuple):
    """Statistic number `at` lies above `bound`, or not."""

    at: int
    above: bool
    bound: float


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float


def holds(rule: Rule, names: Sequence[str]) -> Column:
    return reduce(and_, [F.col(names[c.at]) > c.bound if c.above else F.col(names[c.at]) <= c.bound for c in rule])


def _added(terms: list[Column]) -> Column:
    """A sum whose expression is only as deep as the logarithm of its length."""
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + terms[len(terms) // 2 * 2:]
    return terms[0]


def probability(ensemble: Ensemble, names: Sequence[str]) -> Column:
    told = [F.when(holds(r, names), w).otherwise(0.0) for r, w in zip(ensemble.rules, ensemble.weights)]
    return 1 / (1 + F.exp(-_added([F.lit(ensemble.bias), *told])))


def _narrowed(path: list[Condition]) -> Rule:
    """The path with one bound for each statistic and side, in a fixed order."""
    bounds: dict[tuple[int, bool], float] = {}
    for c in path:
        held = bounds.get((c.at, c.above))
        bounds[c.at, c.above] = c.bound if held is None else (max if c.above else min)(held, c.bound)
    return tuple(Condition(at, above, bound) for (at, above), bound in sorted(bounds.items()))


def tree_rules(root) -> set[Rule]:
    """A rule for every node below the root of one of Spark's decision trees."""
    found, open_nodes = set(), [(root, [])]
    while open_nodes:
        node, path = open_nodes.pop()
        if path:
            found.add(_narrowed(path))
        if node.subtreeDepth():
            at, bound = node.split().featureIndex(), node.split().threshold()
            open_nodes += [(node.leftChild(), [*path, Condition(at, False, bound)]),
                           (node.rightChild(), [*path, Condition(at, True, bound)])]
    return found


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = TRAINING_ROWS) -> Ensemble:
    """Fit on at most `rows` labelled texts.

    `labels` has the key and a 0/1 column; rows without either are left out, of repeated labels the largest counts, of
    texts with one key one is used.  Where all labels are alike, or there are none, no rule is needed.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key")).agg(
        F.max(F.when(F.col(label) > 0, 1.0).otherwise(0.0)).alias("label"))
    sample = cut(known.where(hashed_share(rows, known.count(), "key")).orderBy(F.xxhash64("key"), "key").limit(rows))
    # at most `rows` narrow rows, so the broadcast is bounded
    texts = docs.select(F.col(key).alias("key"), "text").join(F.broadcast(sample), "key")
    told, names = with_statistics(texts)
    one = told.groupBy("key", "label").agg(F.min(F.struct(*names)).alias("told")).select("key", "label", "told.*")
    rows_in = cut(one.repartition(PARTITIONS, "key").sortWithinPartitions("key"))
    count = {r["label"]: r["count"] for r in rows_in.groupBy("label").count().collect()}
    if len(count) < 2:
        n1, n0 = count.get(1.0, 0), count.get(0.0, 0)
        return Ensemble((), (), float(n1 > 0) * 4.0 - float(n0 > 0) * 4.0)
    forest = RandomForestClassifier(
        featuresCol="told", labelCol="label", numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.5, featureSubsetStrategy="onethird",
        minInstancesPerNode=max(1, int(LEAST_SHARE * sum(count.values()))), seed=SEED,
    ).fit(rows_in.select("label", array_to_vector(F.array(*names)).alias("told")))
    rules = sorted(set().union(*[tree_rules(t._java_obj.rootNode()) for t in forest.trees]))
    if not rules:
        rules = [(Condition(0, True, -1.0),)]
    ruled = cut(rows_in.select("label", array_to_vector(F.array(*[holds(r, names).cast("double") for r in rules])).alias("told")))
    lasso = LogisticRegression(featuresCol="told", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(ruled)
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients.toArray()) if w]
    return Ensemble(tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso.intercept))


def score(docs: DataFrame, ensemble: Ensemble, threshold: float = 0.5) -> DataFrame:
    """`docs` with `score`, the probability of label 1, and `predicted`, 1 where it reaches the threshold, else 0.

    Columns of these names are replaced, all others kept; null and empty texts are scored by statistics of 0.
    """
    kept = docs.drop(*[c for c in ("score", "predicted") if c != "text"])
    told, names = with_statistics(kept)
    return told.withColumn("score", probability(ensemble, names)).withColumn(
        "predicted", F.when(F.col("score") >= threshold, 1).otherwise(0)).drop(*names)
