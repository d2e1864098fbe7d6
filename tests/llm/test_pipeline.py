from __future__ import annotations

import shutil

import pandas as pd
import pytest
import sentencepiece
import test_decontaminate
import test_line_dedup
import test_simhash
import test_toxicity
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import simhash, toxicity
from tickloom.llm.queries import table, tokenizer
from tickloom.session import store

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, small):
    docs = table(spark, small, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], small), name))
    return out


def test_stages_keep_columns_and_only_drop_rows(steps):
    for before, after in zip(steps[:-2], steps[1:-1], strict=True):
        assert after.columns == COLUMNS
        assert after.join(before, "doc_id", "left_anti").count() == 0
    assert steps[-1].columns == [*COLUMNS, "ids", "decoded"]
    assert steps[0].count() > steps[-1].count() > 0


def test_decisions_took_effect(steps):
    lines = [line for r in steps[2].collect() for line in (" ".join(x.split()).lower() for x in r["text"].split("\n")) if line]
    assert len(lines) == len(set(lines))
    assert steps[2].filter(F.length("text") != F.col("n_chars")).count() == 0
    groups = simhash.near_duplicates(steps[3]).groupBy("component").count()
    assert groups.filter("count > 1").count() == 0
    assert steps[4].count() <= steps[3].count()
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    for r in steps[5].collect():
        assert r["ids"] == library.encode(r["text"]) + [library.eos_id()] and r["decoded"] == r["text"]


def test_near_copies_and_passages_go(spark, small):
    """Cases planted into a few documents of their own."""
    item = table(spark, small, "benchmark").filter(F.length("text") > 150).first()["text"]
    body = " ".join(f"unique{i} words{i * 7 % 113}" for i in range(80))
    # Whether two near copies are within the radius is a matter of bits; take an addition that is.
    mark = lambda text: simhash.fingerprint(text)
    near_copy = next(body + f" end{i}" for i in range(1000) if 0 < (mark(body) ^ mark(body + f" end{i}")).bit_count() <= 2)
    rows = [
        (0, body, "en", "s", 0),
        (1, near_copy, "en", "s", 0),
        (2, f"Before. {item} After.", "en", "s", 0),
        (3, " ".join(f"other{i} thing{i * 5 % 97}" for i in range(80)), "en", "s", 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    near = corpus_pipeline.near_dedup_stage(spark, docs, small)
    assert sorted(r["doc_id"] for r in near.collect()) == [0, 2, 3]
    clean = corpus_pipeline.decontamination_stage(spark, docs, small)
    assert sorted(r["doc_id"] for r in clean.collect()) == [0, 1, 3]
    assert sorted(r["doc_id"] for r in corpus_pipeline.toxicity_stage(spark, docs, small).collect()) == [0, 1, 2, 3]


def test_stages_take_odd_rows(spark, small, odd_docs, no_docs):
    wide = odd_docs.withColumn("source", F.lit("s")).withColumn("n_chars", F.length("text").cast("long"))
    for docs in (wide, wide.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, small), name)
    assert docs.count() == 0


@pytest.fixture(scope="module")
def planted(small, tmp_path_factory):
    """The small tables with cases of their own: id to the stage that the document does not outlive."""
    folder = tmp_path_factory.mktemp("planted")
    docs = pd.read_parquet(f"{small}/documents.parquet")
    bench = pd.read_parquet(f"{small}/benchmark.parquet")
    item = max(bench["text"], key=len)
    words = [f"unique{i} thing{i * 7 % 113}" for i in range(90)]
    broken = lambda n: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    clean = " ".join(f"other{i} plain{i * 5 % 97}" for i in range(80))
    cases = [
        (5000, "You stupid worthless idiot! You pathetic scum, I will kill you. You are a moron, you disgusting clown.", "toxicity"),
        (5001, broken(9), None),
        (5002, broken(13), "simhash_near_dedup"),  # the same words, other lines
        (5003, clean, None),
        (5004, clean.upper(), "line_dedup"),
        (5005, f"Before all of it.\n{item}\nAfter all of it.", "decontamination"),
        (5006, "They never said that the yard is large, nor that it is small.", None),
        (5007, "", "simhash_near_dedup"),
        (5008, None, "simhash_near_dedup"),
        (-9, "", None),
    ]
    extra = pd.DataFrame([(i, t, "en", "planted", len(t or "")) for i, t, _ in cases], columns=docs.columns)
    pd.concat([docs, extra]).to_parquet(folder / "documents.parquet", index=False)
    for name in ("labels", "benchmark"):
        shutil.copy(f"{small}/{name}.parquet", folder / f"{name}.parquet")
    return str(folder), {i: stage for i, _, stage in cases}


def test_run_against_plain_python(spark, shipped, planted, monkeypatch):
    folder, cases = planted
    kept = {}

    def recording(rows, name):
        kept[name.removeprefix("pipeline-")] = out = store(rows, name)
        return out

    monkeypatch.setattr(corpus_pipeline, "store", recording)
    result = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    monkeypatch.undo()
    got = {name: {r["doc_id"]: r["text"] for r in rows.collect()} for name, rows in kept.items()}
    assert list(got) == [name for name, _ in corpus_pipeline.STAGES]

    docs = table(spark, folder, "documents")
    model = toxicity.learn(docs, table(spark, folder, "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    texts = {i: t for i, t in texts.items() if test_toxicity.plain_score(t, *model) < 0.7}
    assert got["toxicity"] == texts

    shorter = test_line_dedup.plain(list(texts.items()))
    some = lambda t: any(line.strip() for line in (t or "").split("\n"))
    texts = {i: t if t is None else shorter[i] for i, t in texts.items() if not some(t) or some(shorter[i])}
    assert got["line_dedup"] == texts

    ids = sorted(texts)
    least = test_simhash.plain_components([test_simhash.plain_fingerprint(texts[i]) for i in ids])
    texts = {i: texts[i] for at, i in enumerate(ids) if least[at] == at}
    assert got["simhash_near_dedup"] == texts

    items = [(r["item_id"], r["text"]) for r in table(spark, folder, "benchmark").collect()]
    figures = test_decontaminate.plain(texts.items(), items)
    texts = {i: t for i, t in texts.items() if not (figures[i][1] and 20 * figures[i][1] >= figures[i][0])}
    assert got["decontamination"] == texts

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    assert got["sentencepiece"] == texts
    for i, text in texts.items():
        wanted = library.encode(text or "") + [library.eos_id()]
        assert result[i]["ids"] == wanted and result[i]["decoded"] == library.decode(wanted)
        assert result[i]["n_chars"] == (None if text is None else len(text))

    order = [name for name, _ in corpus_pipeline.STAGES]
    for i, stage in cases.items():
        gone = next((name for name in order if i not in got[name]), None)
        assert gone == stage, (i, gone, stage)
