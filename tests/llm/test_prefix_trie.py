"""The prefix trie against a plain one, over shapes that need several bands and levels."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

from tickloom.llm import prefix_trie, turns

SCHEMA = "conv_id long, turn long, role string, text string, key string, conv string, depth long"


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said = text or ""
            own[conv].append((turn is not None, turn or 0, role or "", hashlib.sha256(said.encode()).hexdigest(), said))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in own.items()}
    parent, last, depth, step = [None], [""], [0], {}
    members, ends, children = defaultdict(list), defaultdict(list), Counter()
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (abs(conv) % 5) * (1 if conv >= 0 else -1)
        at = 0
        members[0].append(conv)
        for turn in own.get(base, [])[:h] + own[conv][h:]:
            if (at, turn) not in step:
                step[at, turn] = len(parent)
                children[at] += 1
                parent.append(at)
                last.append(turn[1])
                depth.append(depth[at] + 1)
            at = step[at, turn]
            members[at].append(conv)
        ends[at].append(conv)
    leaves, saved = Counter(), Counter()
    for n in reversed(range(len(parent))):
        leaves[n] += children[n] == 0
        saved[n] += (len(members[n]) - 1) * len(last[n].encode())
        if n:
            leaves[parent[n]] += leaves[n]
            saved[parent[n]] += saved[n]
    return {
        (
            members[n][0],
            depth[n],
            members[parent[n]][0] if n else None,
            len(members[n]),
            children[n],
            leaves[n],
            saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n in range(len(parent))
        if members[n]
    }


def check(spark, rows):
    table = spark.createDataFrame([(*r, "k", "c", 3) for r in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in prefix_trie.prefix_trie(table).collect()]
    assert len(got) == len(set(got))
    assert set(got) == brute(rows)


def test_random_tries(shipped):
    draw = random.Random(3)
    rows = []
    for conv in range(-20, 200):
        for turn in range(draw.choice([1, 2, 3, 8, 9, 17])):
            rows.append((conv, turn, draw.choice("ua"), draw.choice(["x", "yy", "ü"])))
    check(shipped, rows)


def test_depths_of_several_levels(shipped):
    """600 turns: bands, bands of bands and bands of these."""
    rows = [(conv, turn, "u", "t" if turn < 400 else f"t{conv % 2}") for conv in (0, 5, 10, 11) for turn in range(600)]
    rows += [(15, turn, "u", "t") for turn in range(64)] + [(20, turn, "u", "t") for turn in range(63)] + [(25, 0, "u", "t")]
    check(shipped, rows)


def test_one_conversation_copied_often(shipped):
    """Lists of members in several pieces, a node with most of the nodes as children."""
    rows = [(conv * 5, turn, "u", f"same{turn}") for conv in range(1500) for turn in range(3)]
    rows += [(10_000 + conv * 5, 0, "u", f"other{conv}") for conv in range(500)]
    check(shipped, rows)


def test_odd_rows(shipped):
    rows = [(0, None, None, None), (0, 1, "a", ""), (0, 1, "a", ""), (0, 1, "a", "b"), (None, 1, "u", "x"), (7, 0, "", "long " * 50_000), (8, 0, "a:", "b"), (9, 0, "a", ":b")]
    check(shipped, rows)
    empty = shipped.createDataFrame([], SCHEMA)
    assert prefix_trie.prefix_trie(empty).count() == 0
    assert prefix_trie.prefix_trie(shipped.createDataFrame([(None, 1, "u", "x", "", "", 1)], SCHEMA)).count() == 0


def test_positions_across_buckets(shipped):
    rows = [("a", t, str(i)) for i, t in enumerate([None, -5000, -1, 0, 0, 1023, 1024, 5000, 10**15])]
    draw = random.Random(1)
    mixed = draw.sample(rows, len(rows))
    placed = turns.positions(shipped.createDataFrame(mixed, "key string, turn long, tie string"), "key", "turn", ["tie"]).collect()
    assert [r["tie"] for r in sorted(placed, key=lambda r: r["at"])] == [r[2] for r in rows]
