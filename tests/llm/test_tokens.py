from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import pieces, queries, token_orc
from tickloom.session import run_folder

PIECES = str(public_tokenizers.path("piece_bpe_32k.model"))
BYTES = str(public_tokenizers.path("byte_bpe_50k.json"))
ALPHABET = "aeiou thsre \n\t \r▁€ßñ漢😀<0x0A></s>'s'll...  12 3ABC ​ é"


@pytest.fixture(scope="module")
def texts() -> list[str]:
    dice = random.Random(1)
    made = ["".join(dice.choice(ALPHABET) for _ in range(dice.randrange(40))) for _ in range(3000)]
    return made + ["", " ", "   a", " " * 500, "▁", "a" * 3000, "the" * 2000, "x \n\n y", "=  " * 50, "\x00a"]


def test_backtracking_is_exact(texts):
    model, library = pieces.pieces(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in texts:
        ids = library.encode(text) + [library.eos_id()]
        assert model.encode(text) == ids
        assert model.round_trip(text) == (" ".join(map(str, ids)), library.decode(ids))
        assert model.decode(ids) == library.decode(ids)


def test_backtracking_equals_merging_and_steps_back():
    model = pieces.pieces(PIECES)
    words = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")["text"].str.split(" ").explode().unique()[:4000]
    for word in words:
        if word and all(c in model.ids for c in word):
            marked = pieces.MARK + word
            assert model.backtrack(marked) == [model.ids[p] for p in model.merge(marked)]


def test_small_cache_changes_nothing(texts, monkeypatch):
    whole = [pieces.Pieces(PIECES).round_trip(t) for t in texts[-300:]]
    monkeypatch.setattr(pieces, "CACHE", 20)
    model = pieces.Pieces(PIECES)
    assert [model.round_trip(t) for t in texts[-300:]] == whole


def test_piece_query(spark, small):
    rows = queries.op6_sentencepiece(spark, small).toPandas().set_index("doc_id")
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for doc in pd.read_parquet(f"{small}/documents.parquet").itertuples():
        ids = library.encode(doc.text) + [library.eos_id()]
        got = rows.loc[doc.doc_id]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_rows(odd_docs, no_docs):
    rows = pieces.encoded_and_decoded(odd_docs, PIECES)
    assert rows.count() == odd_docs.count() and rows.columns.count("ids") == 1
    assert rows.filter("coalesce(text, '') <> decoded").count() == 0
    assert [r["ids"] for r in rows.filter("text is null").collect()] == [[2], [2]]
    again = pieces.decode_documents(pieces.encode_documents(odd_docs, PIECES), PIECES)
    assert again.filter("coalesce(text, '') <> decoded").count() == 0
    assert pieces.digests(no_docs, PIECES).count() == 0


def _encoded(encoder: token_orc.WordEncoder, texts: list[str]) -> list[list[int]]:
    rows, ids = encoder.encode(pa.array(texts, type=pa.large_string()))
    found = dict(zip(rows.tolist(), ids.to_pylist(), strict=True))
    return [found[i] for i in range(len(texts))]


def test_word_encoder_equals_the_library(texts, monkeypatch):
    library = Tokenizer.from_file(BYTES)
    made = texts + ["x<|endoftext|>y z", "<|endoftext|> a", "a\n \nb", "a \n b"]
    expected = [library.encode(t, add_special_tokens=False).ids for t in made]
    assert _encoded(token_orc.WordEncoder(BYTES), made) == expected
    monkeypatch.setattr(token_orc, "CACHE", 50)
    small = token_orc.WordEncoder(BYTES)
    assert [ids for at in range(0, len(made), 100) for ids in _encoded(small, made[at : at + 100])] == expected


def test_words_on_both_sides_of_an_end_of_line_take_the_short_way(monkeypatch):
    words = ["esre.\nOning,", "a\nb", "Paoi\u00e9...\n\u00c9airepa", "one", "x" * 200]
    library, encoder = Tokenizer.from_file(BYTES), token_orc.WordEncoder(BYTES)
    monkeypatch.setattr(encoder, "_words", lambda plain: [] if not plain else pytest.fail(f"{plain} went to the library"))
    found = encoder.entries(words)
    assert found[4] is token_orc.ODD and words[4] not in encoder.words and encoder.entries(words) == found
    for word, ids in zip(words[:4], found, strict=False):
        assert np.frombuffer(ids, "<i4").tolist() == library.encode(" " + word, add_special_tokens=False).ids


def test_orc_query(spark, small):
    rows = queries.op8_token_orc(spark, small).toPandas().sort_values("doc_id")
    docs = pd.read_parquet(f"{small}/documents.parquet").sort_values("doc_id")
    library = Tokenizer.from_file(BYTES)
    ids = [library.encode(t, add_special_tokens=False).ids + [0] for t in docs["text"]]
    sizes = np.array([len(i) for i in ids])
    assert rows["n_tokens"].tolist() == sizes.tolist()
    assert rows["start"].tolist() == (np.cumsum(sizes) - sizes).tolist()
    assert rows["ids_crc32"].tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]


def test_orc_of_odd_rows(shipped, odd_docs, no_docs):
    path = run_folder(shipped, "tokens-test")
    token_orc.write_tokens(odd_docs, path, BYTES)
    back = token_orc.read_tokens(shipped, path)
    assert back.count() == odd_docs.count()
    index = token_orc.token_index(shipped, path).toPandas().sort_values("start")
    assert index["start"].tolist() == (index["n_tokens"].cumsum() - index["n_tokens"]).tolist()
    assert index["doc_id"].isna().tolist()[:2] == [True, True]  # NULL ids come first
    assert sorted(index["doc_id"].dropna()) == index["doc_id"].dropna().tolist()
    assert token_orc.token_digests(no_docs, BYTES).count() == 0


def test_orc_files_have_filters_that_are_pushed_down(shipped, small):
    path = run_folder(shipped, "tokens-test")
    token_orc.write_tokens(queries.table(shipped, small, "documents"), path, BYTES)
    found = token_orc.read_tokens(shipped, path, [3, 150])
    assert sorted(r["doc_id"] for r in found.collect()) == [3, 150]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    raw = shipped.read.format("binaryFile").load(path).filter(F.col("length") > 0).select("content").first()["content"]
    assert raw[:3] == b"ORC"
