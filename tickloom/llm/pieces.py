"""SentencePiece encoding and decoding of merge-type (BPE) models, exact, by backtracking.

A merge-type model encodes a text by repeatedly joining the best-scored pair of neighbours. The result
is the only sequence of pieces in which every two neighbours would be left apart by that process, so it
can be found without merging the text: take the longest piece that starts here (from one Aho-Corasick
pass over the word), keep it if it is compatible with the piece before it, else try the next shorter
one; if none is left, mark the position as failed in a bitfield and step back. Compatibility of two
pieces is found by merging just these two and is remembered.

No piece has a space mark after another character, so no merge crosses the start of a word, and each
different word is encoded once and kept in a bounded cache. Runs of space marks (whose pieces share one
score, so that position breaks the tie) are merged in full; characters that the model lacks become byte
pieces.

Edge cases: NULL is treated as the empty text, which gives the end id alone; repeated rows give
repeated results; an empty table gives an empty result. The length of texts is not limited.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.batches import slices

MARK = "▁"
CACHE = 100_000  # words in each of two generations; workers keep them between tasks
PAIRS = 300_000
SLICE_BYTES = 2 << 20
CHUNKS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Pieces:
    """A model's vocabulary with encoder and decoder."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "a  B\nﬁ"
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("only models without normalisation, with a space put first, are supported")
        size = model.get_piece_size()
        self.end = model.eos_id()
        self.text = [model.id_to_piece(i) for i in range(size)]
        self.special = {i for i in range(size) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        octets = [i for i in range(size) if model.is_byte(i)]
        self.octet = {i: int(self.text[i][3:5], 16) for i in octets}
        self.of_octet = {b: i for i, b in self.octet.items()}
        plain = [i for i in range(size) if i not in self.special and i not in self.octet]
        self.ids = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: model.get_score(i) for i in plain}
        self.length = [len(t) for t in self.text]
        self.find = ahocorasick.Automaton()
        for i in plain:
            self.find.add_word(self.text[i], i)
        self.find.make_automaton()
        # The next shorter piece that starts a piece; -1 if there is none.
        self.shorter = [-1] * size
        for i in plain:
            text = self.text[i]
            self.shorter[i] = next((self.ids[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.ids), -1)
        self.apart: dict[tuple[int, int], bool] = {}
        self.words: dict[str, tuple[str, str]] = {}
        self.older: dict[str, tuple[str, str]] = {}
        self.chunks: dict[str, tuple[str, str]] = {}

    def merge(self, text: str) -> list[str]:
        """The definition: join the best-scored neighbours, the leftmost of equals, until none is left."""
        parts: list[str | None] = list(text)
        before = list(range(-1, len(parts) - 1))
        after = [*range(1, len(parts)), -1]
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j >= 0:
                joined = parts[i] + parts[j]
                if joined in self.score:
                    heapq.heappush(heap, (-self.score[joined], i, j, joined))

        for i in range(len(parts) - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, joined = heapq.heappop(heap)
            if parts[i] is None or parts[j] is None or after[i] != j or len(parts[i]) + len(parts[j]) != len(joined):
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in parts if p is not None]

    def compatible(self, first: int, second: int) -> bool:
        """Whether merging leaves these two pieces apart (``first`` -1: leaves the second whole)."""
        known = self.apart.get((first, second))
        if known is None:
            pair = [self.text[second]] if first < 0 else [self.text[first], self.text[second]]
            known = self.merge("".join(pair)) == pair
            if len(self.apart) >= PAIRS:
                self.apart.clear()
            self.apart[first, second] = known
        return known

    def backtrack(self, word: str) -> list[int]:
        """The pieces of a word all of whose characters the model has."""
        n = len(word)
        longest = [0] * n
        length, shorter, apart = self.length, self.shorter, self.apart
        for end, piece in self.find.iter(word):
            longest[end + 1 - length[piece]] = piece  # ends ascend: the longest stays
        failed = bytearray(n + 1)
        found: list[int] = []
        at, last, piece = 0, -1, longest[0]
        while True:
            end = at + length[piece]
            fits = not failed[end]
            if fits:
                known = apart.get((last, piece))
                fits = self.compatible(last, piece) if known is None else known
            if fits:
                found.append(piece)
                if end == n:
                    return found
                at, last, piece = end, piece, longest[end]
            elif shorter[piece] >= 0:
                piece = shorter[piece]
            else:
                failed[at] = 1
                if not found:
                    raise ValueError(f"no encoding of {word[:100]!r}")
                piece = found.pop()
                at -= length[piece]
                last = found[-1] if found else -1

    def encode_chunk(self, chunk: str) -> list[int]:
        """Ids of one word with the space marks before it."""
        if chunk[0] == MARK and chunk[1:2] in ("", MARK):
            return self._with_octets(self.merge(chunk))
        if all(map(self.ids.__contains__, chunk)):
            return self.backtrack(chunk)
        found: list[int] = []
        start = 0
        for i, character in enumerate(chunk):
            if character not in self.ids:
                if i > start:
                    found += self.backtrack(chunk[start:i])
                found += self._octets(character)
                start = i + 1
        if start < len(chunk):
            found += self.backtrack(chunk[start:])
        return found

    def _octets(self, character: str) -> list[int]:
        return [self.of_octet[b] for b in character.encode()]

    def _with_octets(self, parts: list[str]) -> list[int]:
        found: list[int] = []
        for part in parts:
            found += [self.ids[part]] if part in self.ids else self._octets(part)
        return found

    def encode(self, text: str) -> list[int]:
        """Ids of a text and the end id."""
        marked = (MARK + text.replace(" ", MARK)) if text else ""
        return [i for chunk in CHUNKS.findall(marked) for i in self.encode_chunk(chunk)] + [self.end]

    def _spell(self, ids: list[int]) -> str:
        parts: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.octet:
                held.append(self.octet[i])
                continue
            if held:
                parts.append(held.decode("utf-8", "replace"))
                held.clear()
            if i not in self.special:
                parts.append(self.text[i].replace(MARK, " "))
        if held:
            parts.append(held.decode("utf-8", "replace"))
        return "".join(parts)

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space put first by the encoder is taken away."""
        text = self._spell(ids)
        first = next((i for i in ids if i not in self.special), None)
        return text[1:] if first is not None and self.text[first].startswith(MARK) else text

    def _entry(self, chunk: str) -> tuple[str, str]:
        ids = self.encode_chunk(chunk)
        return " ".join(map(str, ids)), self._spell(ids)

    def _word(self, word: str) -> tuple[str, str]:
        """A word that the cache lacks. A full cache becomes the older generation, whose words return when
        they are met again."""
        if len(self.words) >= CACHE:
            self.older, self.words = self.words, {}
        entry = self.words[word] = self.older.get(word) or self._entry(MARK + word)
        return entry

    def _chunk(self, chunk: str) -> tuple[str, str]:
        if len(self.chunks) >= CACHE // 10:
            self.chunks.clear()
        entry = self.chunks[chunk] = self._entry(chunk)
        return entry

    def round_trip(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by one space, end id included, and the text decoded from them."""
        if not text:
            return str(self.end), ""
        words = text.split(" ")
        if "" in words or MARK in text:
            keys = CHUNKS.findall(MARK + text.replace(" ", MARK))
            got = [self.chunks.get(k) or self._chunk(k) for k in keys]
        else:
            got = list(map(self.words.get, words))
            if None in got:
                got = [e or self.words.get(w) or self._word(w) for w, e in zip(words, got, strict=True)]
        ids = " ".join([e[0] for e in got])
        return f"{ids} {self.end}", "".join([e[1] for e in got])[1:]


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model at a path, loaded once in each worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``ids``, the ids of the whole text with the end id."""

    @F.pandas_udf("array<int>")
    def of(texts: pd.Series) -> pd.Series:
        model = pieces(path)
        ids = [np.fromstring(model.round_trip(t or "")[0], dtype=np.int32, sep=" ") for t in texts]
        return pd.Series(ids, dtype=object)

    return docs.withColumn("ids", of(F.col(text)))


def encoded_and_decoded(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Add ``ids`` and ``decoded`` (or replace columns of these names), both from one pass over the words."""

    others = [c for c in docs.columns if c not in ("ids", "decoded")]
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    at = others.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for whole in batches:
            for batch in slices(whole, at, SLICE_BYTES):
                trips = [model.round_trip(t or "") for t in batch.column(at).to_pylist()]
                ids = [np.fromstring(i, dtype=np.int32, sep=" ") for i, _ in trips]
                bounds = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(ids)))
                decoded = pa.array([d for _, d in trips], type=pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, decoded], [*others, "ids", "decoded"])

    return docs.select(*others).mapInArrow(run, T.StructType([*docs.select(*others).schema.fields, *added]))


def decode_documents(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of the ids."""

    @F.pandas_udf("string")
    def of(rows: pd.Series) -> pd.Series:
        model = pieces(path)
        return pd.Series([model.decode(list(r)) for r in rows], dtype=object)

    return encoded.withColumn("decoded", of(F.col(ids)))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: number of ids and the SHA-256 of ids and decoded text."""

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def of(texts: pd.Series) -> pd.DataFrame:
        model = pieces(path)
        rows = []
        for t in texts:
            ids, decoded = model.round_trip(t or "")
            rows.append((ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(id_col), of(F.col(text)).alias("_d")).select(id_col, "_d.*")
