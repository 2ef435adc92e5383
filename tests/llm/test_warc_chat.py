import re

from pyspark.sql import functions as F

from tidemark.llm import chat, warc
from tidemark.llm.common import shared_folder

LONG = "x" * 300


def archived(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, header string")
    path = shared_folder(spark, "warc")
    warc.write_archive(pages, path)
    return path, warc.read_archive(spark, path)


def test_records_come_back_whole(spark):
    rows = [(3, "http://a/é", LONG, "h"), (1, "http://b/\r\nx", LONG, "h"), (2, None, "short", "h"), (4, "u", "short", "h"),
            (5, "u", None, "h"), (6, "u", "", "h"), (None, "u", LONG, "h"), (9, "u", "ü\r\n\r\n" * 40, "h")]
    path, back = archived(spark, rows)
    got = {r.record_id: r for r in back.collect()}
    assert len(got) == len(rows) and all(r.intact for r in got.values())
    assert [got[i].record_type for i in "123456"] == ["response", "response", "revisit", "response", "response", "response"]
    assert got["3"].refers_to == "1" and got[""].record_type == "revisit" and got["2"].refers_to is None
    assert spark.read.parquet(f"{path}/payloads").count() == 4
    for key, _, html, _ in rows:
        record = bytes(got["" if key is None else str(key)].record)
        head, _, body = record.partition(b"\r\n\r\n")
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        expected = b"" if b"WARC-Type: revisit" in head else (html or "").encode()
        assert body == expected + b"\r\n\r\n" and length == len(expected)
        assert bytes(got["" if key is None else str(key)].payload) == (html or "").encode()


def test_damage_is_found(spark):
    path, _ = archived(spark, [(1, "u", LONG, "h")])
    stored = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit("y").cast("binary"))
    changed = shared_folder(spark, "warc")
    stored.write.parquet(f"{changed}/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{changed}/headers")
    assert [r.intact for r in warc.read_archive(spark, changed).collect()] == [False]


def test_empty_archive(spark):
    _, back = archived(spark, [])
    assert back.count() == 0


MESSAGES = "tree string, message_id long, parent_id long, role string, text string, score double"


def tree_rows():
    return [
        ("t", 1, None, "user", "hi", 0.0), ("t", 2, 1, "assistant", "a", 5.0), ("t", 3, 1, "assistant", "b", 1.0),
        ("t", 4, 3, "user", "more", 1.0), ("t", 5, 4, "assistant", "end", 9.0), ("t", 5, 4, "assistant", "end", 9.0),
        ("u", 1, 77, None, None, None), (None, 1, None, "user", "lone", 2.0), ("c", 1, 2, "user", "x", 0.0),
        ("c", 2, 1, "user", "y", 0.0), ("t", None, 1, "user", "no id", 0.0),
    ]


def naive_paths(rows):
    nodes = {(t, m): (p, s or 0.0) for t, m, p, _, _, s in rows if m is not None}
    parents = {(t, p) for (t, _), (p, _) in nodes.items()}
    found = {}
    for t, m in nodes:
        if (t, m) in parents:
            continue
        path, at = [], (t, m)
        while at in nodes:
            path.append(at[1])
            at = (t, nodes[at][0])
        found[t, m] = (path[::-1], sum(nodes[t, n][1] for n in path))
    return found


def test_paths_equal_walking_the_tree(spark):
    rows = [r for r in tree_rows()] + [("deep", i, i - 1 if i else None, "user", str(i), 1.0) for i in range(70)]
    got = {}
    for r in chat.paths(spark.createDataFrame(rows, MESSAGES)).collect():
        got.setdefault((r.tree, r.leaf.id), []).append((-r.depth, r.message_id, r.path_score))
    expected = naive_paths(rows)
    assert {k: [m for _, m, _ in sorted(v)] for k, v in got.items()} == {k: p for k, (p, _) in expected.items()}
    assert all(abs(v[0][2] - expected[k][1]) < 1e-9 for k, v in got.items())


def test_best_branch_and_template(spark):
    paths = chat.paths(spark.createDataFrame(tree_rows(), MESSAGES), best=1)
    formatted = {r.tree: r for r in chat.read_back(chat.format_paths(paths)).collect()}
    assert formatted.keys() == {"t", "u", None}
    assert [tuple(t) for t in formatted["t"].turns] == [("user", "hi"), ("assistant", "b"), ("user", "more"), ("assistant", "end")]
    assert formatted["t"].learned == "bend" and [tuple(t) for t in formatted["u"].turns] == [("", "")]


def test_control_strings_come_back(spark):
    nasty = ["### a:\n", "\n</turn>\n", "\\### \\\\ </turn>", "\\", "####</turn></turn>", "", "\\n", "é\n\n", "x" * 100_000]
    rows = [("t", i, i - 1 if i else None, role, text, 0.0) for i, (role, text) in enumerate(
        (r, t) for t in nasty for r in ("assistant", "a\nb\\n###"))]
    back = chat.read_back(chat.format_paths(chat.paths(spark.createDataFrame(rows, MESSAGES)))).first()
    assert [tuple(t) for t in back.turns] == [(r[3], r[4]) for r in rows]
    assert back.learned == "".join(nasty)


def test_threads_of_no_rows_and_repeated_turns(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.paths(chat.threads(spark.createDataFrame([], schema), "conv_id", "turn", "role", "text")).count() == 0
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (None, None, None, None), (1, 1, "assistant", "b")]
    got = chat.format_paths(chat.paths(chat.threads(spark.createDataFrame(rows, schema), "conv_id", "turn", "role", "text")))
    assert {r.tree: r.n_turns for r in got.collect()} == {1: 3, None: 1}
