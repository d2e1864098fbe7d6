from __future__ import annotations

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter

import pandas as pd
import pytest

from tickloom.llm import queries, toxicity


@pytest.fixture(scope="module")
def case(spark):
    """English insults and stems of an invented language; clean texts share all other words."""
    dice = random.Random(6)
    docs, labels = [], []
    for i in range(900):
        # Drawn at random: near-copies would count once in the sample.
        filler = [f"{dice.choice('abcdefgh')}wort{dice.randrange(40)}" for _ in range(30)]
        toxic = i % 4 == 0
        if toxic and i % 8 == 0:
            filler[5], filler[20] = f"zarku{'abcde'[i % 5]}", f"zarku{'fghij'[(i // 8) % 5]}"
        elif toxic:
            filler[7], filler[9] = "stupid", "idiot"
        docs.append((i, " ".join(filler[:15]) + ". " + " ".join(filler[15:]) + ".", "xx", f"s{i % 2}"))
        labels.append((i, 1, int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: t for i, _, t in labels},
    )


def test_held_out_rows_are_told_apart(shipped, case):
    docs, labels, truth = case
    rows = toxicity.classify(docs, labels).collect()
    assert len(rows) == 900
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"]]
    assert sum(p == t for p, t in held) / len(held) > 0.98


def test_held_out_labels_are_not_read(shipped, case):
    docs, labels, _ = case
    turned = labels.withColumn("toxic", (toxicity.held_out(labels["doc_id"]).cast("int") + labels["toxic"]) % 2)
    a = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, labels).collect()}
    assert a == {r["doc_id"]: r["score"] for r in toxicity.classify(docs, turned).collect()}


def test_grammar_scopes():
    machine = toxicity.Grammar({"=idiot": 2.0, "^zarku": 3.0})
    assert machine.clause("you are an idiot".split()) == (2.0, 2.0, 0.0, 0)
    assert machine.clause("this is not an idiot".split()) == (0.0, 0.0, 2.0, 0)
    assert machine.clause("they said idiot".split()) == (0.0, 0.0, 2.0, 0)
    assert machine.clause("zarkuben zarku".split()) == (6.0, 0.0, 0.0, 0)
    assert machine.clause("i will kill you".split())[3] == 1
    assert machine.clause("i will not kill you".split())[3] == 0
    assert machine.figures("Fine words. Not here! anidiot") == (0.0, 0.0, 0.0, 0.0, 0.0)


def test_stems_need_many_words():
    found = {"^dis": (7.0, 100), "=disgusting": (7.0, 100), "^zarku": (6.0, 90), "^zar": (6.0, 91), "=zarkuben": (5.0, 20)}
    assert set(toxicity._pruned(found)) == {"=disgusting", "^zarku", "=zarkuben"}


def test_odd_rows(odd_docs, no_docs, case):
    rows = toxicity.classify(odd_docs, case[1]).collect()
    assert len(rows) == odd_docs.count() and all(r["predicted"] == 0 for r in rows)
    kept = toxicity.drop_toxic(odd_docs, case[1])
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert toxicity.classify(odd_docs, case[1].limit(0)).count() == odd_docs.count()
    assert toxicity.classify(no_docs, case[1]).count() == 0


def test_query(spark, small):
    rows = queries.op2_toxicity(spark, small)
    assert rows.columns == ["doc_id", "held_out", "score", "predicted"] and rows.count() == 200


def plain_score(text: str | None, arcs: dict[str, float], curve: tuple[float, ...]) -> float:
    """Every clause, every word, every scope looked up by position; the lexicon and the curve are given."""
    t = toxicity
    direct = aimed = muted = best = threats = 0
    for clause in re.split(r"[.!?;\n]", (text or "").lower()):
        words = re.findall(r"[^\W\d_]+(?:'[^\W\d_]+)?", clause)

        def within(names, i, scope, words=words):
            return any(w in names for w in words[max(i - scope, 0) : i + 1])

        own, aims, pending = 0.0, 0.0, None
        for i, word in enumerate(words):
            hushed = within(t.NEGATIONS, i, t.NEGATION_SCOPE) or within(t.REPORTS, i, len(words))
            if word in t.TARGETS and pending is not None and i - pending <= t.THREAT_SCOPE:
                threats, pending = threats + 1, None
            if word in t.THREATS and not hushed:
                pending = i
            weight = max([0.0, arcs.get("=" + word, 0.0)] + [arcs.get("^" + word[:n], 0.0) for n in t.STEM if n <= len(word)])
            if hushed:
                muted += weight
            else:
                own += weight
                aims += weight * within(t.TARGETS, i, t.TARGET_SCOPE)
        direct, aimed, best = direct + own, aimed + aims, max(best, own)
    figures = (math.log1p(direct), math.log1p(aimed), math.log1p(muted), best, math.log1p(threats))
    return 1 / (1 + math.exp(-curve[0] - sum(f * w for f, w in zip(figures, curve[1:], strict=True))))


def test_query_against_a_plain_walk(spark, small):
    docs = queries.table(spark, small, "documents")
    arcs, curve = toxicity.learn(docs, queries.table(spark, small, "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = queries.op2_toxicity(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["score"] == pytest.approx(plain_score(texts[r["doc_id"]], arcs, curve), abs=1e-9)
        assert r["predicted"] == (r["score"] >= 0.7) and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


@pytest.mark.parametrize(
    "text",
    [
        "You are not an idiot. You idiot!",
        "he said you are a stupid moron; you stupid moron",
        "I will kill not you. I will kill you and hurt them, then crush it all for nobody",
        "kill kill you you. never hurt him. trash\nTRASH clown's idiots x idiot2 2idiot",
        "", None,
    ],
)
def test_scopes_against_a_plain_walk(text):
    arcs = {"=" + w: v for w, v in toxicity.INSULTS.items()} | {"^idiot": 3.0}
    figures = toxicity.grammar(arcs).figures(text or "")
    constant, *weights = toxicity.PRIOR
    score = 1 / (1 + math.exp(-constant - sum(f * w for f, w in zip(figures, weights, strict=True))))
    assert score == pytest.approx(plain_score(text, arcs, toxicity.PRIOR), abs=1e-9)


def test_counting_holds_little_memory():
    texts = [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + d % 26)}{chr(97 + d // 26)}word{chr(97 + i // 676)}" for i in range(1400)) for d in range(40)]
    rows = pd.DataFrame({"text": texts + texts[:2], "toxic": [d % 2 for d in range(42)], "half": [d // 2 % 2 for d in range(42)]})
    want = Counter((item, 2 * t + h) for text, t, h in zip(*rows.values.T, strict=True) for item in toxicity._items(text))
    got = Counter()
    tracemalloc.start()
    try:
        held = tracemalloc.get_traced_memory()[0]
        for frame in toxicity._counter(iter([rows])):
            assert tracemalloc.get_traced_memory()[1] - held < 24 << 20
            tracemalloc.stop()
            for item, *counts in frame.itertuples(index=False):
                got.update({(item, n): c for n, c in enumerate(counts) if c})
            tracemalloc.start()
            held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert got == want and len({item for item, _ in want}) > 100_000
