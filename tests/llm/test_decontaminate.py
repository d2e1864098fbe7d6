from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tickloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(docs, items, window=13):
    """Straight from the rule: (n_words, n_hit, sorted item ids) of each document."""

    def words(text):
        return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))

    out = {}
    for doc_id, text in docs:
        ws, hit, names = words(text), set(), set()
        for item_id, item in items:
            its = words(item)
            n = min(len(its), window)
            if not n:
                continue
            runs = {tuple(its[i : i + n]) for i in range(len(its) - n + 1)}
            for s in range(len(ws) - n + 1):
                if tuple(ws[s : s + n]) in runs:
                    hit.update(range(s, s + n))
                    names.add(str(item_id))
        out[doc_id] = (len(ws), len(hit), sorted(names))
    return out


def found(docs, items):
    rows = decontaminate.contamination(docs, items).collect()
    return {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows}, rows


@pytest.fixture(scope="module")
def case(spark):
    body = [f"w{i}" for i in range(200)]
    items = [
        (0, " ".join(body[:40])),
        (1, "Short Item here"),
        (2, "one"),
        (3, "the the the the the the the the the the the the the the"),
        (4, None),
        (5, "..."),
        (6, " ".join(body[20:33])),
        (7, " ".join(body[:40])),
        (8, " ".join(body[100:112])),
    ]
    docs = [
        (0, " ".join(body)),
        (1, "x " + " ".join(body[5:17]) + " y"),  # twelve words of an item: not a window
        (2, "x " + " ".join(body[5:18]).upper() + "! y"),
        (3, "a short ITEM, here one"),
        (4, "the " * 300),
        (5, None),
        (6, ""),
        (7, " ".join(body[27:40]) + " gap " + " ".join(body[100:112])),
        (8, " ".join(body[0:13]) + " " + " ".join(f"z{i}" for i in range(260))),
        (9, "w0 w1 w2"),
    ]
    return docs, items


def test_against_the_rule(spark, case):
    docs, items = case
    got, _ = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == plain(docs, items)


def test_shuffled_items_give_the_same(spark, case):
    docs, items = case
    rows = decontaminate.contamination(
        spark.createDataFrame(docs + docs[:3], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), limit=-1
    ).collect()
    assert len(rows) == len(docs) + 3
    assert {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == plain(docs, items)


@pytest.mark.parametrize("window", [1, 2, 4, 13, 31])
def test_other_windows(spark, case, window):
    docs, items = case
    rows = decontaminate.contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), window=window
    ).collect()
    assert {r["id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows} == plain(docs, items, window)


def test_matches_are_found_before_words_are_copied(spark, case):
    """The join's filter is compiled with the generator and the join; nothing that is not goes in between."""
    docs, items = case
    seen = []
    spy = decontaminate.store
    try:
        decontaminate.store = lambda rows, name: (seen.append(rows) if name == "windows" else None) or spy(rows, name)
        decontaminate.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    finally:
        decontaminate.store = spy
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Filter" in line and "i_key" in line)
    assert "lambda" not in join


def test_share_decides(spark, case):
    docs, items = case
    _, rows = found(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    for r in rows:
        assert r["contaminated"] == (r["n_hit"] > 0 and 20 * r["n_hit"] >= r["n_words"])


def test_odd_rows(spark, odd_docs, no_docs, case):
    items = spark.createDataFrame(case[1] + [(None, "hello there")], "item_id long, text string")
    rows = decontaminate.contamination(odd_docs, items)
    assert rows.count() == odd_docs.count()
    assert rows.filter("id in (3, 4) and contaminated").count() == 3
    kept = decontaminate.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 3
    assert decontaminate.contamination(no_docs, items).count() == 0
    clean = decontaminate.contamination(odd_docs, items.limit(0))
    assert clean.count() == odd_docs.count() and clean.filter("contaminated or n_hit > 0").count() == 0


def test_no_python_in_the_plan(spark, case):
    docs, items = case
    plan = decontaminate.drop_contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    ).select(F.col("doc_id"))
    assert not re.search("Python|Pandas|Arrow", plan._jdf.queryExecution().executedPlan().toString())
