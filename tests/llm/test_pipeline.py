"""The pipeline on the smallest data, beside plain versions of its stages."""

from collections import Counter

import corpus_pipeline as pipeline
from tests.conftest import SMALL
from tests.llm.test_near_duplicates import naive_components, naive_fingerprint
from tests.llm.test_sharding_mixing import naive_shard, naive_targets
from tidemark.llm.decontaminate import Settings, aligned_span, words


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    columns, by_stage, before = docs.columns, {}, docs
    for name, stage in pipeline.STAGES:
        after = stage(spark, before, SMALL)
        rows = after.collect()
        by_stage[name] = rows
        before = spark.createDataFrame(rows, after.schema)
    raw = docs.collect()
    kept = {r.doc_id for r in by_stage["toxicity"]}
    wrong = sum((labels[r.doc_id] == 1) == (r.doc_id in kept) for r in raw if r.doc_id in labels)
    assert wrong <= 0.05 * len(labels), wrong

    source = sorted(by_stage["toxicity"], key=lambda r: r.doc_id)
    prints = [naive_fingerprint(r.text) for r in source]
    roots = naive_components(len(source), [[(a ^ b).bit_count() <= 3 for b in prints] for a in prints])
    assert {r.doc_id for r in by_stage["simhash_dedup"]} == {source[i].doc_id for i in set(roots)}

    def leaked(text):
        return any(aligned_span(item, words(text), Settings())[0] >= Settings().least for item in items if len(item) > 2)

    expected = {r.doc_id for r in by_stage["simhash_dedup"] if not leaked(r.text)}
    assert {r.doc_id for r in by_stage["decontamination"]} == expected

    sizes, taken, largest = Counter(), Counter(), Counter()
    for r in by_stage["decontamination"]:
        sizes[r.source] += len(r.text.encode().split())
        largest[r.source] = max(largest[r.source], len(r.text.encode().split()))
    for r in by_stage["mixing"]:
        taken[r.source] += len(r.text.encode().split())
    targets = naive_targets(dict(sizes), (3, 1, 2), 1.5, 2)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    assert max(Counter(r.doc_id for r in by_stage["mixing"]).values()) <= 2

    assert Counter(r.doc_id for r in by_stage["sharding"]) == Counter(r.doc_id for r in by_stage["mixing"])
    assert all(r.shard == naive_shard(r.doc_id, [1.0] * 24) for r in by_stage["sharding"])
    assert all(set(columns) <= set(r.asDict()) for r in by_stage["sharding"])


def test_run_equals_its_stages_and_odd_rows(spark, tmp_path):
    folder = str(tmp_path)
    rows = [(1, None, "en", None, None), (2, "", None, "a", 0), (None, "a b c d", "en", "a", 7), (3, "a b c d", "en", "a", 7),
            (3, "a b c d", "en", "a", 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = pipeline.run(spark, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in pipeline.STAGES:
        stage(spark, docs, folder).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    assert got.columns == docs.columns
    rows = Counter(map(tuple, got.collect()))
    assert rows == Counter(map(tuple, docs.collect())) and rows
    # the equal texts are not lost, whichever of them stays
    assert {r[0] for r in rows} <= {1, 2, 3} and any(r[1] == "a b c d" for r in rows) and all(0 <= r.shard < 24 for r in got.collect())
