from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tickloom.llm import line_dedup, queries
from tickloom.session import store


def shingles(line, size=9):
    return frozenset(line[i : i + size] for i in range(max(len(line) - size + 1, 1)))


def plain(docs, limit=0.8):
    """Texts after deduplication by comparison of all pairs of lines."""
    docs = sorted(docs, key=lambda d: d[0])
    places = [(i, p, " ".join(line.split()).lower()) for i, t in docs for p, line in enumerate((t or "").split("\n")) if line.strip()]
    first = {}
    for i, p, line in places:
        first.setdefault(line, (i, p))
    lines = list(first)
    sets = [shingles(line) for line in lines]
    label = list(range(len(lines)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(lines)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and common >= limit * (len(sets[a]) + len(sets[b]) - common):
                label[root(a)] = root(b)
    kept = {}
    for i, line in enumerate(lines):
        kept[root(i)] = min(kept.get(root(i), first[line]), first[line])
    stays = {line: kept[root(i)] for i, line in enumerate(lines)}
    gone = {(i, p) for i, p, line in places if stays[line] != (i, p)}
    return {i: "\n".join(line for p, line in enumerate((t or "").split("\n")) if (i, p) not in gone) for i, t in docs}


@pytest.fixture(scope="module")
def near_copies():
    """A family of lines that differ in a few characters, copies, short and blank lines."""
    dice = random.Random(4)
    base = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix a strange green potion in the yard"
    docs = []
    for i in range(60):
        line = list(base)
        for _ in range(dice.randrange(3)):
            line[dice.randrange(len(line))] = dice.choice("xyz")
        own = " ".join(dice.choice("abcdefgh") * dice.randrange(2, 6) for _ in range(20))
        docs.append((i, "\n".join([own, "".join(line), "", "Ok.", "  " + base.upper() if i % 5 == 0 else own[::-1]])))
    return docs


@pytest.mark.parametrize("tile", [4, 1024])
def test_against_all_pairs(spark, shipped, near_copies, tile):
    frame = spark.createDataFrame(near_copies, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(frame, tile=tile).collect()}
    expected = plain(near_copies)
    assert sum(got[i] != expected[i] for i in expected) <= 1  # banding finds a pair at the limit in 998 of 1000


def test_query_against_exact_copies(spark, small):
    """No line is left twice, and nothing but lines is lost."""
    rows = queries.op5_line_dedup(spark, small).collect()
    texts = dict(pd.read_parquet(f"{small}/documents.parquet")[["doc_id", "text"]].values.tolist())
    left = [" ".join(line.split()).lower() for r in rows for line in r["text"].split("\n") if line.strip()]
    assert len(left) == len(set(left))
    every = {" ".join(line.split()).lower() for t in texts.values() for line in t.split("\n") if line.strip()}
    assert set(left) <= every and len(rows) == len(texts)
    for r in rows:
        assert r["n_lines"] - r["n_dropped"] == sum(bool(line.strip()) for line in r["text"].split("\n"))


def test_signatures_agree_with_similarity():
    dice = random.Random(2)
    base = "".join(dice.choice("abcdefghij ") for _ in range(600))
    near = base[:300] + "#" + base[301:]
    bands = line_dedup.signatures([base, near, base[::-1], "x", "x"])
    assert (bands[0] == bands[1]).any() and not (bands[0] == bands[2]).any() and (bands[3] == bands[4]).all()


def test_signatures_do_not_depend_on_neighbours(monkeypatch):
    lines = ["alpha beta gamma delta", "x", "漢字 😀 and more words here", "q" * 5000]
    together = line_dedup.signatures(lines)
    monkeypatch.setattr(line_dedup, "BLOCK_CHARS", 1)
    assert (together == line_dedup.signatures(lines)).all()


def test_odd_rows(odd_docs, no_docs):
    rows = line_dedup.dedup_lines(odd_docs)
    assert rows.count() == odd_docs.count()
    got = {r["doc_id"]: r for r in rows.collect()}
    assert got[0]["text"] is None and got[1]["text"] == "" and got[2]["text"] == "  \n "
    assert got[3]["text"] == "Hello there." and got[4]["text"] == "" and got[4]["n_dropped"] == 1
    assert got[5]["text"] == odd_docs.filter("doc_id = 5").first()["text"]
    assert line_dedup.dedup_lines(no_docs).count() == 0


@pytest.mark.parametrize("shared", [None, 7])
def test_rows_that_share_an_id_but_not_a_text(spark, shipped, shared):
    """Each row loses its own repeated lines only, and no line is left twice or lost."""
    texts = ["x\ny", "z\nx", "same place\na", "same place\nb", "x\nalone", None]
    rows = [(shared, t) for t in texts] + [(9, "y\nnine")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = line_dedup.dedup_lines(frame).collect()
    left = [line for r in got for line in (r["text"] or "").split("\n") if line]
    assert sorted(left) == ["a", "alone", "b", "nine", "same place", "x", "y", "z"]
    assert sum(r["n_lines"] for r in got) == 12 and sum(r["n_dropped"] for r in got) == 4
    assert all(r["n_lines"] - r["n_dropped"] == len((r["text"] or "").split("\n")) for r in got if r["text"])


def test_texts_of_lines_are_stored_small(spark, shipped, near_copies, monkeypatch):
    """They are the largest table that the job writes."""
    stored = {}

    def kept(rows, name, compression=None):
        stored[name] = compression
        return store(rows, name, compression)

    monkeypatch.setattr(line_dedup, "store", kept)
    line_dedup.line_decisions(spark.createDataFrame(near_copies[:5], "doc_id long, text string"))
    assert stored["lines"] == "zstd"


def bands_of(names):
    """By plain Python: line and band, for bands that several lines have."""
    lines = {}
    for i, own in enumerate(names.view("int64").tolist()):
        for band in own:
            lines.setdefault(band, set()).add(i)
    return sorted((i, band) for band, own in lines.items() if len(own) > 1 for i in own)


@pytest.mark.parametrize("bin_rows", [40, 1 << 19])
def test_bands_of_one_line_are_not_kept(spark, shipped, near_copies, bin_rows):
    """Whether the bands are in one bin or in many."""
    lines = [line for _, text in near_copies for line in text.split("\n")[:2]]
    frame = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string").repartition(3)
    rows = line_dedup._with_bands(frame, line_dedup.BANDS, line_dedup.ROWS, line_dedup.SHINGLE, bin_rows).collect()
    expected = bands_of(line_dedup.signatures(lines))
    assert expected and sorted((r["line_id"], r["band"]) for r in rows) == expected


@pytest.mark.parametrize("limit", [0, 7, 1 << 20])
def test_a_band_of_very_many_lines_is_told_in_pieces(limit):
    """However seldom the rows are sifted, each row of a shared band comes out once; the others never do."""
    dice = np.random.default_rng(6)
    bands = np.where(dice.random(400) < 0.5, 5, dice.integers(10, 500, 400))
    pieces = np.array_split(np.arange(400), 23)
    packed = pa.RecordBatch.from_pylist([{"bin": 0, "ids": p.tobytes(), "bands": bands[p].tobytes()} for p in pieces])
    got = [r for out in line_dedup._sharing(limit)(iter([packed.slice(0, 9), packed.slice(9)])) for r in out.to_pylist()]
    times = np.bincount(bands)
    assert sorted((r["line_id"], r["band"]) for r in got) == [(i, b) for i, b in enumerate(bands.tolist()) if times[b] > 1]


def test_no_lines_have_no_bands(spark, shipped):
    none = spark.createDataFrame([], "line_id long, line string")
    assert line_dedup._with_bands(none, line_dedup.BANDS, line_dedup.ROWS, line_dedup.SHINGLE).count() == 0


def test_tile_links_against_all_pairs():
    """Lines that share much but not enough are refuted without losing a link."""
    dice = random.Random(8)
    base = "".join(dice.choice("abcdefghij ") for _ in range(400))
    lines = [base[:cut] + "".join(dice.choice("klmnop") for _ in range(400 - cut)) for cut in range(20, 400, 9)]
    sets = line_dedup.all_shingle_hashes(lines)
    linked = line_dedup._tile_links(list(range(len(lines))), sets, [0] * len(lines), 0.8)
    close = {frozenset((a, b)) for a in range(len(lines)) for b in range(a) if len(shingles(lines[a]) & shingles(lines[b])) >= 0.8 * len(shingles(lines[a]) | shingles(lines[b]))}
    assert close and {frozenset(link) for link in linked} <= close
    group = list(range(len(lines)))
    for links in (close, linked):
        label = list(range(len(lines)))
        for a, b in map(sorted, links):
            label = [label[a] if own == label[b] else own for own in label]
        assert links is close or [label.index(own) for own in label] == group
        group = [label.index(own) for own in label]


def test_a_run_is_hashed_as_a_polynomial():
    codes = np.random.default_rng(7).integers(0, 1 << 20, 60).astype(np.uint64)
    for size in (1, 2, 5, 9, 16):
        got = line_dedup._rolling(codes, size).tolist()
        for at, own in enumerate(got):
            value = 0
            for code in codes[at : at + size].tolist():
                value = (value * 0x100000001B3 + code) % (1 << 64)
            assert own == (value ^ (value >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)
        assert len(got) == 61 - size
