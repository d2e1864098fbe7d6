"""Chat formatting: root-to-leaf paths of reply trees as conversations.

A message answers its parent, so the messages of a tree make root-to-leaf paths, one for each leaf. The
paths come from self-joins in rounds: after round k every message knows the ancestor 2^k above it and
the scores up to there, so a tree of depth d takes log2(d) rounds and a message is one narrow row in
each. The branches of a tree are ranked by their mean score, and only the chosen ones are unfolded, again
by these jumps, the long ones first, so that no row is made that is not on a chosen path. Texts move
when the paths are known.

Template: ``### role ###`` and a line break, the text, a line break, ``</turn>`` and a line break. Within
roles and texts a backslash is put before each backslash, before the third and each further ``#`` in a
row, and before the slash of ``</turn>``; neither control string can then stand there, and taking those
backslashes away gives the text again. The loss mask is a list of ``start, end`` (code points, end
exclusive): the texts of assistant turns, without role or marks.

Defined results: NULL role or text is empty. A message whose parent is not there (or NULL) is a root;
a NULL tree id is a tree of its own. Messages of one tree with the same id are one message, the
least by parent, role and text; messages without id are told apart by their content. Messages in a
circle of replies, and replies to them, have no root and stand on no path. NULL and NaN scores count
as 0; equal scores: the longer branch first, then the smaller leaf id. A conversation is one record of
the output and has to fit one (2 GB). No messages, no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.batches import slices
from tickloom.llm.skew import lookup
from tickloom.llm.turns import positions
from tickloom.session import run_folder, store

LEARNT_ROLE = "assistant"
HEAD, HEAD_END, END = "### ", " ###\n", "\n</turn>\n"
# Backslashes, hashes after two others, the slash of an end mark.
CONTROL = r"\\|(?<=##)#|(?<=<)/(?=turn>)"
ESCAPED = re.compile(r"\\([\\#/])")

CHAT = "tree_id, leaf, branch, score, n_turns, text, loss"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$0")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


# --- paths --------------------------------------------------------------------------------------


def _key(*names: str) -> Column:
    return F.struct(*[F.col(name) for name in names])


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """``levels[k]``: ``tree, node, up`` for messages with an ancestor 2^k above them. And for each message
    under a root its ``score`` (sum) and ``steps`` (messages) from there on down, ``up`` NULL."""
    n = nodes.count()
    parents = nodes.filter("parent is not null").groupBy("tree", "parent").agg(F.count("*").alias("asked"))
    there = nodes.select("tree", F.col("node").alias("parent")).join(parents, ["tree", "parent"])
    first = lookup(
        nodes.withColumn("_k", _key("tree", "parent")),
        there.select(_key("tree", "parent").alias("_k"), F.col("parent").alias("up"), "asked"),
        "_k",
        "asked",
        ["node"],
    )
    state = store(first.select("tree", "node", "up", "score", F.lit(1).cast("long").alias("steps")), "climb")
    levels: list[DataFrame] = []
    done = state.filter("up is null")
    active = state.filter("up is not null")
    # After k rounds a message knows 2^k ancestors; who knows more than there are is in a circle.
    while active.head(1) and 2 ** len(levels) <= n:
        levels.append(active.select("tree", "node", "up"))
        asked = active.groupBy("tree", F.col("up").alias("node")).agg(F.count("*").alias("asked"))
        above = active.unionByName(done).join(asked, ["tree", "node"])
        met = lookup(
            active.withColumn("_k", _key("tree", "up")).drop("up"),
            above.select(
                _key("tree", "node").alias("_k"),
                "up",
                F.col("score").alias("more"),
                F.col("steps").alias("further"),
                "asked",
            ),
            "_k",
            "asked",
            ["node"],
        )
        state = store(
            met.select("tree", "node", "up", (F.col("score") + F.col("more")).alias("score"), (F.col("steps") + F.col("further")).alias("steps")),
            "climb",
        )
        done = done.unionByName(state.filter("up is null"))
        active = state.filter("up is not null")
    return levels, done


def _paths(nodes: DataFrame, best: int) -> DataFrame:
    """``tree, leaf, branch, mean, steps, node, at``: the messages of the ``best`` branches of each tree."""
    levels, done = _climb(nodes)
    asked = nodes.select("tree", F.col("parent").alias("node")).filter("node is not null").distinct()
    leaves = done.join(asked, ["tree", "node"], "left_anti")
    mean = F.col("score") / F.col("steps")
    # Spark cuts each task's rows to the first ``best`` of a tree before they are sent.
    order = Window.partitionBy("tree").orderBy(F.desc("mean"), F.desc("steps"), "node")
    chosen = (
        leaves.select("tree", "node", mean.alias("mean"), "steps")
        .withColumn("branch", F.row_number().over(order))
        .filter(F.col("branch") <= best)
        .select("tree", F.col("node").alias("leaf"), "branch", "mean", "steps", "node", F.col("steps").alias("at"))
    )
    # Jumps of 2^k from every member: with falling k each message of a path is met once.
    for k in reversed(range(len(levels))):
        met = chosen.join(levels[k], ["tree", "node"], "left")
        two = F.array(
            F.struct(F.col("node"), F.col("at")),
            F.struct(F.col("up").alias("node"), (F.col("at") - 2**k).alias("at")),
        )
        both = F.filter(two, lambda m: m["node"].isNotNull())
        chosen = met.select("tree", "leaf", "branch", "mean", "steps", F.inline(both))
    return chosen


# --- format -------------------------------------------------------------------------------------


def _formatted(nodes: DataFrame, best: int) -> DataFrame:
    """Chats from ``tree, node, parent, score, tree_id, role, text``, one row per (tree, node)."""
    nodes = store(nodes, "messages")
    head = F.concat(F.lit(HEAD), escape(F.col("role")), F.lit(HEAD_END))
    body = escape(F.col("text"))
    turns = _paths(nodes.drop("role", "text", "tree_id"), best).join(
        nodes.select("tree", "node", "tree_id", (F.col("role") == LEARNT_ROLE).alias("learnt"), head.alias("head"), body.alias("body")),
        ["tree", "node"],
    )
    size = F.length("head") + F.length("body") + len(END)
    path = Window.partitionBy("tree", "leaf").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(path), F.lit(0)) + F.length("head")
    # Offsets are added up in the order of turns, so nothing is measured twice however long a path is.
    placed = turns.withColumn("start", start).withColumn("end", F.col("start") + F.length("body"))
    piece = F.struct("at", F.concat("head", "body", F.lit(END)).alias("piece"), "learnt", "start", "end")
    listed = placed.groupBy("tree", "tree_id", "leaf", "branch", "mean").agg(F.sort_array(F.collect_list(piece)).alias("turns"))
    learnt = F.filter("turns", lambda t: t["learnt"])
    return listed.select(
        "tree_id",
        "leaf",
        "branch",
        F.col("mean").alias("score"),
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("text"),
        F.transform(learnt, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias("loss"),
    )


def _tree(value: Column) -> Column:
    """A text that tells trees apart, NULL included."""
    return F.to_json(F.struct(value.alias("t")))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def format_trees(
    messages: DataFrame,
    tree: str = "tree_id",
    message: str = "message_id",
    parent: str = "parent_id",
    role: str = "role",
    text: str = "text",
    score: str | None = "score",
    best: int = 1,
) -> DataFrame:
    """The ``best`` branches of each reply tree as chats: ``tree_id, leaf`` (id of the last message, as text),
    ``branch`` (rank from 1), ``score`` (mean of the branch), ``n_turns, text, loss``."""
    value = F.lit(0.0) if score is None else F.coalesce(F.nanvl(F.col(score).cast("double"), F.lit(0.0)), F.lit(0.0))
    content = F.to_json(F.struct(F.col(parent).alias("p"), F.col(role).alias("r"), F.col(text).alias("t")))
    rows = messages.select(
        _tree(F.col(tree)).alias("tree"),
        F.coalesce(F.concat(F.lit("="), F.col(message).cast("string")), F.concat(F.lit("?"), F.sha2(content, 256))).alias("node"),
        F.concat(F.lit("="), F.col(parent).cast("string")).alias("parent"),
        value.alias("score"),
        F.col(tree).alias("tree_id"),
        _text(role).alias("role"),
        _text(text).alias("text"),
    )
    same = Window.partitionBy("tree", "node").orderBy("parent", "role", "text", "score")
    one = rows.withColumn("_n", F.row_number().over(same)).filter("_n = 1").drop("_n")
    chats = _formatted(one, best)
    known = F.col("leaf").startswith("=")
    return chats.withColumn("leaf", F.when(known, F.substring("leaf", 2, 1 << 30)))


def format_conversations(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations as trees without branches: each turn answers the one before. ``tree_id`` is the
    conversation; turns with one number follow each other by role and text, and all of them stay."""
    rows = conversations.select(
        _tree(F.col(conv)).alias("tree"), F.col(turn).cast("long").alias("turn"), F.col(conv).alias("tree_id"), _text(role).alias("role"), _text(text).alias("text")
    )
    placed = positions(rows, "tree", "turn", ["role", "text"])
    nodes = placed.select(
        "tree",
        F.col("at").alias("node"),
        F.when(F.col("at") > 1, F.col("at") - 1).alias("parent"),
        F.lit(0.0).alias("score"),
        "tree_id",
        "role",
        "text",
    )
    return _formatted(nodes, 1)


# --- files --------------------------------------------------------------------------------------


def write_chats(chats: DataFrame, path: str) -> None:
    chats.write.mode("overwrite").parquet(path)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parse_chat(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a formatted chat."""
    turns = []
    for piece in text.split(END)[:-1]:
        close = piece.index(HEAD_END, len(HEAD))
        turns.append((unescape(piece[len(HEAD) : close]), unescape(piece[close + len(HEAD_END) :])))
    return turns


def learnt_texts(text: str, loss: list[dict]) -> list[str]:
    """The texts under the loss mask, in order, unescaped."""
    return [unescape(text[span["start"] : span["end"]]) for span in loss]


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            rows: dict[str, list] = {name: [] for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for text, loss in zip(part.column(1), part.column(2), strict=True):
                chat = text.as_py()
                turns, learnt = parse_chat(chat), learnt_texts(chat, loss.as_py())
                every, masked = hashlib.sha256(), hashlib.sha256()
                for role, said in turns:
                    every.update(f"{role}\n{said}\n".encode())
                for said in learnt:
                    masked.update(said.encode())
                values = (len(turns), every.hexdigest(), sum(map(len, learnt)), masked.hexdigest(), len(chat))
                for name, value in zip(rows, values, strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, rows.values())], ["conv_id", *rows])


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Format conversations, write the chats, read them back, and give digests of what stands there."""
    spark = conversations.sparkSession
    path = run_folder(spark, "chats")
    write_chats(format_conversations(conversations), path)
    kind = dict(conversations.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return read_chats(spark, path).select("tree_id", "text", "loss").mapInArrow(_read_back, schema)
