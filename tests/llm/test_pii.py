from __future__ import annotations

import hashlib
import random
import re

import pandas as pd
import pytest

from tickloom.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    total = 0
    for at, digit in enumerate(reversed([int(c) for c in text if c.isdigit()])):
        total += digit if at % 2 == 0 else 2 * digit - 9 * (digit > 4)
    return total % 10 == 0


def holds(kind, match):
    n = len(re.sub("[^0-9]", "", match))
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    return {"email": True, "card": 13 <= n <= 19 and luhn(match), "phone": 9 <= n <= 15}[kind]


def plain(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if holds(k, m.group())]


def written(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(rows, texts):
    for r in rows:
        base = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(written(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        spans = [s for s in r["spans"].split(",") if s]
        assert set(written(base).split(",")) - {""} <= set(spans)
        order = [(list(PATTERNS).index(k), int(a)) for k, a, _ in (s.split(":") for s in spans)]
        assert order == sorted(order)


def test_query_against_patterns(spark, small):
    docs = pd.read_parquet(f"{small}/documents.parquet")
    check(queries.op4_pii(spark, small).collect(), dict(zip(docs["doc_id"], docs["text"], strict=True)))


def test_random_and_hostile_texts(spark):
    dice = random.Random(3)
    alphabet = "0123456789" * 3 + " --..+()@ab%_é😀\n"
    texts = ["".join(dice.choice(alphabet) for _ in range(dice.randrange(120))) for _ in range(1500)]
    texts += [None, "", "a@b.c@d.e", "a@b.c_d@e.f x.y@z.w", "1 2 3 " * 3000, "9" * 50_000, "1.2.3.4.5.6.7.8", "0255.00001.1.1"]
    texts += ["a." * 20_000 + "@" + "b." * 3000 + "c", "+" * 1000 + "1 " * 500]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    check(pii.digests(frame).collect(), dict(enumerate(texts)))


def test_swallowed_numbers_are_added(spark):
    card, phone = "4111 1111 1111 1111", "+1 (269) 555-3296"
    texts = [f"n{i} call {phone[:-1]}{i % 10} or pay {card} a{i}@mail.example.com 10.0.{i}.7 end" for i in range(60)]
    texts.append("Des +1 (826) 555-4081 190.137.223.204 and 4539578763621486 4716258050958645 too")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    last = {r["doc_id"]: r for r in pii.digests(frame).collect()}[60]
    text = texts[60]
    found = {text[int(a) : int(b)] for _, a, b in (s.split(":") for s in last["spans"].split(","))}
    assert {"+1 (826) 555-4081", "4539578763621486", "4716258050958645"} <= found


def test_estimate_finds_the_good_labelers():
    counts = [((1, 1, 1), 90.0), ((1, 1, 0), 45.0), ((0, 0, 1), 40.0), ((0, 0, 0), 80.0), ((1, 0, 1), 4.0), ((0, 1, 0), 4.0)]
    chance = pii.estimate(counts)
    assert chance[1, 1, 0] > 0.9 and chance[0, 0, 1] < 0.1  # the third votes like a coin


def test_odd_rows(odd_docs, no_docs):
    rows = pii.digests(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r["doc_id"]: r["n_email"] for r in rows}[6] == 1
    assert all(r["spans"] == "" for r in rows if r["doc_id"] in (0, 1, 2))
    assert pii.digests(no_docs).count() == 0


@pytest.mark.parametrize("kind", pii.KINDS)
def test_no_python_in_the_plan(odd_docs, kind):
    plan = pii.find_spans(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
