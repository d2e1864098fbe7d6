"""Reply trees, their paths and the chat template."""

from __future__ import annotations

import random

import pytest

from tickloom.llm import reply_trees

MESSAGES = "tree_id string, message_id long, parent_id long, role string, text string, score double, key string, node string, tree string"


def messages(spark, rows):
    return spark.createDataFrame([(*row, "k", "n", "t") for row in rows], MESSAGES)


def brute_paths(rows):
    """Root-to-leaf paths per tree, by walking up from each leaf."""
    trees = {}
    for tree, message, parent, role, text, score in rows:
        trees.setdefault(tree, {})[message] = (parent, role or "", text or "", score or 0.0)
    out = {}
    for tree, nodes in trees.items():
        answered = {parent for parent, *_ in nodes.values()}
        branches = []
        for leaf in nodes:
            if leaf in answered:
                continue
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(nodes[at])
                at = nodes[at][0]
            if at in nodes:
                continue  # hangs from a circle
            branches.append((sum(n[3] for n in path) / len(path), len(path), str(leaf), [(n[1], n[2]) for n in reversed(path)]))
        branches.sort(key=lambda b: (-b[0], -b[1], b[2]))
        out[tree] = branches
    return out


def test_paths_equal_a_walk(shipped):
    draw = random.Random(5)
    rows = []
    for tree in ("a", "b", None):
        for i in range(60):
            parent = draw.choice([None, *range(i)]) if i and draw.random() < 0.3 else (i - 1 if i else None)
            rows.append((tree, i, parent, draw.choice(["user", "assistant", None]), draw.choice(["x", "### y", "\\</turn>", None, ""]), draw.choice([None, 0.25, 0.5, 1.0])))
    for best in (1, 3):
        chats = reply_trees.format_trees(messages(shipped, rows), best=best).collect()
        want = brute_paths(rows)
        for tree, branches in want.items():
            got = sorted((c for c in chats if c["tree_id"] == tree), key=lambda c: c["branch"])
            assert [c["branch"] for c in got] == list(range(1, min(best, len(branches)) + 1))
            for c, (score, steps, leaf, turns) in zip(got, branches):
                assert (c["score"], c["n_turns"], c["leaf"]) == (pytest.approx(score), steps, leaf)
                assert reply_trees.parse_chat(c["text"]) == turns
                assert reply_trees.learnt_texts(c["text"], c["loss"]) == [text for role, text in turns if role == "assistant"]


def test_odd_messages(shipped):
    rows = [
        ("circle", 1, 2, "user", "a", 1.0),
        ("circle", 2, 1, "user", "b", 1.0),
        ("circle", 3, 2, "user", "c", 1.0),
        ("orphan", 1, 99, "user", "a", float("nan")),
        ("twice", 1, None, "user", "b", 0.0),
        ("twice", 1, None, "user", "a", 0.0),
        ("twice", 1, None, "user", "a", 0.0),
        ("noid", None, None, "user", "a", 0.0),
        ("tie", 1, None, "user", "a", 1.0),
        ("tie", 2, 1, "assistant", "b", 1.0),
        ("tie", 3, 1, "assistant", "c", 1.0),
    ]
    chats = {c["tree_id"]: c for c in reply_trees.format_trees(messages(shipped, rows)).collect()}
    assert sorted(chats) == ["noid", "orphan", "tie", "twice"]
    assert reply_trees.parse_chat(chats["twice"]["text"]) == [("user", "a")]
    assert chats["noid"]["leaf"] is None and chats["orphan"]["score"] == 0.0 and chats["tie"]["leaf"] == "2"


def test_a_deep_chain_and_a_wide_tree(shipped):
    deep = [("deep", i, i - 1 if i else None, "user", str(i), 0.0) for i in range(1500)]
    wide = [("wide", 0, None, "user", "root", 0.0), *[("wide", i, 0, "assistant", str(i), float(i)) for i in range(1, 3000)]]
    chats = {c["tree_id"]: c for c in reply_trees.format_trees(messages(shipped, deep + wide)).collect()}
    assert [text for _, text in reply_trees.parse_chat(chats["deep"]["text"])] == [str(i) for i in range(1500)]
    assert chats["wide"]["leaf"] == "2999"


TEXTS = ["", "#", "##", "###", "####", "#####", "\\", "\\\\", "\\#", "#\\#", "</turn>", "<\\/turn>", "\n</turn>\n", " ###\n", "### user ###\n", "##\\#", "a\n### b ###\n", "😀 ###"]


def test_escapes_are_reversible(shipped):
    from pyspark.sql import functions as F

    rows = [(text, other) for text in TEXTS for other in TEXTS]
    both = shipped.createDataFrame(rows, "a string, b string").withColumn("t", F.concat("a", "b"))
    for row in both.withColumn("e", reply_trees.escape(F.col("t"))).collect():
        assert reply_trees.unescape(row["e"]) == row["t"]
        assert "###" not in row["e"] and "</turn>" not in row["e"]


def test_conversations_with_odd_rows(shipped):
    rows = [(1, None, None, None), (1, 0, "user", t := "x ### y"), (1, 0, "user", t), (1, 5, "assistant", "a</turn>"), (1, 7, "assistant", "b"), (None, 1, "a ###\nb", "no id")]
    rows += [(2, 0, "assistant", "long " * 100_000)]
    table = shipped.createDataFrame([(*r, "k", 1.0) for r in rows], "conv_id long, turn long, role string, text string, tree string, score double")
    chats = {c["tree_id"]: c for c in reply_trees.format_conversations(table).collect()}
    assert reply_trees.parse_chat(chats[1]["text"]) == [("", ""), ("user", t), ("user", t), ("assistant", "a</turn>"), ("assistant", "b")]
    assert reply_trees.learnt_texts(chats[1]["text"], chats[1]["loss"]) == ["a</turn>", "b"]
    assert reply_trees.parse_chat(chats[None]["text"]) == [("a ###\nb", "no id")]
    digests = {d["conv_id"]: d for d in reply_trees.chat_digests(table).collect()}
    assert digests[2]["loss_chars"] == 500_000 and digests[1]["n_turns"] == 5
    assert reply_trees.chat_digests(table.limit(0)).count() == 0
