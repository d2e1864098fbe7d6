"""Token ids of documents as ORC: stripes with run-length encoded integers, row indexes, and Bloom
filters on the document ids.

Rows are dealt by ranges of the id, encoded, sorted inside each range and written as one file per range.
``row`` numbers them: its upper bits are the range, its lower 33 bits the place in it, so the order over
all files is the order of ``row``. A reader takes stripes in parallel; a look-up of ids skips files,
stripes and row groups by the statistics and the Bloom filters.

Texts are cut at spaces, where the byte-level pre-tokenizer always cuts if the space stands between other
characters, and each different word of a run of texts is looked up once in a bounded cache of the worker.
Words that the cache lacks go to the library's model if they are letters and punctuation, which the
pre-tokenizer only cuts in between, else through the whole library; so do, as a whole, texts with white
space on both sides of a cut or with a word too long to be kept.

Edge cases: NULL is treated as the empty text, which gives the end id alone; a NULL id sorts first;
documents of equal id are ordered by the hash of their text; an empty table gives an empty folder of files.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.batches import short_batches, slices
from tickloom.session import run_folder, store

END = 0
CACHE = 500_000  # words in each of two generations
TOGETHER = 16
PLACE_BITS = 33
ODD = False
LONGEST = 100  # characters of a word that is kept
MARKS = 10_000  # runs of punctuation that are kept
# Letters that every version of Unicode knows as such, then punctuation without the apostrophe; the same again after
# one end of line.
_WORD = r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f\u0400-\u0481\u048a-\u04ff]+)([!-&(-/:-@\[-`{-~]*)"
SIMPLE = re.compile(rf"{_WORD}(?:\n{_WORD})?")
# How byte-level tokenizers write bytes: printable ones as themselves, the others from U+0100 on in their order.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTES = {b: chr(b) if b in _PRINTED else chr(0x100 + sum(o not in _PRINTED for o in range(b))) for b in range(256)}
SPACE = "\u0120"  # the space in names of byte-level tokens
LINE = BYTES[10]
STRIPE_BYTES = 16 << 20
ROWS_PER_INDEX = 1000
SCHEMA = "row long, doc_id long, ids array<int>"


class WordEncoder:
    """Ids of texts as little-endian 32-bit integers."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.words: dict[str, bytes | bool] = {}
        self.older: dict[str, bytes | bool] = {}
        names = self.library.get_vocab()
        self.spaced = np.zeros(max(names.values()) + 1, dtype=bool)
        self.spaced[[i for name, i in names.items() if name[0] == SPACE]] = True
        self.model = self.library.model
        self.marks: dict[str, list[int]] = {}
        # Whether this tokenizer cuts and writes words as the short way takes for granted.
        tried = [SIMPLE.fullmatch(word) for word in ("word", "Longerword,", "\u00e9t\u00e9?!", "\u043f\u0440\u0438...", "x(", "a.\nWord,", "\u00e9t\u00e9\n\u00c9t\u00e9")]
        self.short = [self._simple(*m.groups()) for m in tried] == self._encode([f" {m[0]}" for m in tried])

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<i4").tobytes() for e in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words with the space before them. Some are encoded in one call; each of them starts at
        a token that starts with the space, as no word holds one."""
        done: list[bytes] = []
        groups = [words[at : at + TOGETHER] for at in range(0, len(words), TOGETHER)]
        for group, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups]), strict=True):
            starts = (np.flatnonzero(self.spaced[np.frombuffer(ids, dtype="<i4")]) * 4).tolist()
            if len(starts) == len(group):
                done += [ids[a:b] for a, b in zip(starts, [*starts[1:], len(ids)], strict=True)]
            else:
                done += self._encode([" " + w for w in group])
        return done

    def _mark_ids(self, marks: str) -> list[int]:
        known = self.marks.get(marks)
        if known is None:
            known = [token.id for token in self.model.tokenize(marks)]
            if len(self.marks) < MARKS:
                self.marks[marks] = known
        return known

    def _simple(self, letters: str, marks: str, letters_after: str | None = None, marks_after: str | None = None) -> bytes:
        """Ids of letters with the space before them, of the marks after, and of what follows an end of line: pieces to
        the tokenizer, which its model encodes by themselves. Non-ASCII letters are given as the tokenizer writes
        their bytes."""
        if not letters.isascii():
            letters = letters.encode().decode("latin-1").translate(BYTES)
        ids = [token.id for token in self.model.tokenize(BYTES[32] + letters)]
        if marks:
            ids += self._mark_ids(marks)
        if letters_after is not None:
            if not letters_after.isascii():
                letters_after = letters_after.encode().decode("latin-1").translate(BYTES)
            ids += self._mark_ids(LINE)
            ids += [token.id for token in self.model.tokenize(letters_after)]
            if marks_after:
                ids += self._mark_ids(marks_after)
        return array("i", ids).tobytes()

    def entries(self, words: list[str]) -> list[bytes | bool]:
        """Ids of different words with the space before them, ODD for odd ones. Words that the cache lacks are put into
        it. When it is full, it becomes the older generation, whose words return when they are met again."""
        found = list(map(self.words.get, words))
        lost = [at for at, ids in enumerate(found) if ids is None]
        if not lost:
            return found
        if len(self.words) + len(lost) > CACHE:
            self.older, self.words = self.words, {}
        cache, older, simple, fullmatch, short = self.words, self.older.get, self._simple, SIMPLE.fullmatch, self.short
        plain = []
        for at in lost:
            word = words[at]
            if len(word) > LONGEST:  # such as texts without spaces: left to the library and not kept
                found[at] = ODD
                continue
            ids = older(word)
            if ids is None:
                if short and (parts := fullmatch(word)):
                    ids = simple(*parts.groups())
                elif not word or word[0].isspace() or word[-1].isspace():
                    ids = ODD
                else:
                    plain.append(at)
                    continue
            found[at] = cache[word] = ids
        for at, ids in zip(plain, self._words([words[at] for at in plain]), strict=True):
            found[at] = cache[words[at]] = ids
        return found

    def encode(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, pa.ListArray]:
        """Row numbers and their ids, followed by ``end``; rows that go to the library whole come last."""
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        words = lists.flatten().dictionary_encode()
        codes = words.indices.to_numpy().astype(np.int32)
        rows = np.arange(len(texts))
        heads = words.dictionary.take(pa.array(codes[offsets[:-1]])).to_pylist()
        known = self.entries(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        odd = np.array([ids is ODD for ids in known], dtype=bool)[codes]
        odd[offsets[:-1]] = [not h or h[-1].isspace() for h in heads]
        odd[offsets[:-1]] &= np.diff(offsets) > 1
        whole = np.logical_or.reduceat(odd, offsets[:-1]) if len(rows) else np.zeros(0, dtype=bool)
        # The first word of a text has no space before it; an entry of its own stands for it, and one more
        # for the end.
        parts = [b"" if ids is ODD else ids for ids in known] + self._encode(heads) + [end]
        codes[offsets[:-1]] = len(known) + rows
        codes = np.insert(codes, offsets[1:], len(parts) - 1)
        ends = offsets[1:] + rows + 1
        if whole.any():
            parts += [ids + end for ids in self._encode([texts[int(i)].as_py() for i in rows[whole]])]
            keep = ~np.repeat(whole, np.diff(np.concatenate([[0], ends])))
            codes = np.concatenate([codes[keep], np.arange(len(parts) - whole.sum(), len(parts))])
            sizes = np.concatenate([np.diff(np.concatenate([[0], ends]))[~whole], np.ones(whole.sum(), dtype=np.int64)])
            ends = np.cumsum(sizes)
            rows = np.concatenate([rows[~whole], rows[whole]])
        joined = pa.array(parts, type=pa.large_binary()).take(pa.array(codes))
        upto = np.frombuffer(joined.buffers()[1], dtype=np.int64)[: len(joined) + 1] // 4
        bounds = upto[np.concatenate([[0], ends])].astype(np.int32)
        values = pa.Array.from_buffers(pa.int32(), int(upto[-1]), [None, joined.buffers()[2]])
        return rows, pa.ListArray.from_arrays(pa.array(bounds), values)


_loaded: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def _encoder(path: str, end: int):
    mark = np.array([end], dtype="<i4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for whole in batches:
            for batch in slices(whole, 1):
                texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
                rows, ids = words.encode(texts, mark)
                taken = [batch.column(at).take(pa.array(rows)) for at in (0, 2)]
                yield pa.RecordBatch.from_arrays([*taken, ids], ["doc_id", "key", "ids"])

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_col: str = "doc_id",
    text: str = "text",
    end: int = END,
    stripe_bytes: int = STRIPE_BYTES,
    rows_per_index: int = ROWS_PER_INDEX,
) -> None:
    """Write the ids of all documents, each with the end id, as ORC files in ascending order of ``id_col``."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("key"))
    # Rows with one id, or without, may be many: the hash of the text cuts them into several ranges.
    dealt = rows.repartitionByRange("doc_id", "key")
    encoded = dealt.mapInArrow(_encoder(tokenizer, end), "doc_id long, key long, ids array<int>")
    ordered = encoded.sortWithinPartitions("doc_id", "key", "ids")
    ordered.select(F.monotonically_increasing_id().alias("row"), "doc_id", "ids").write.option(
        "compression", "zstd"
    ).option("orc.stripe.size", stripe_bytes).option("orc.create.index", "true").option(
        "orc.row.index.stride", rows_per_index
    ).option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: Sequence[int] | None = None) -> DataFrame:
    """``row, doc_id, ids``; with ``ids`` those documents only, by a filter that reaches the files."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows if ids is None else rows.filter(F.col("doc_id").isin(list(ids)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(2)
        offsets = ids.offsets.to_numpy()
        values = np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), dtype="<u4")
        counts = (offsets[1:] - offsets[:-1]).astype(np.int64)
        sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets, offsets[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts), pa.array(sums, type=pa.int64())],
            ["row", "doc_id", "n_tokens", "ids_crc32"],
        )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the documents in the files; ``start`` counts the ids of
    all documents before. Running sums stay inside a range; ranges meet by their totals only, one row
    for each file."""
    found = read_tokens(spark, path).mapInArrow(_sums, "row long, doc_id long, n_tokens long, ids_crc32 long")
    counted = store(found.withColumn("part", F.shiftright("row", PLACE_BITS)), "token-index")
    totals = counted.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return placed.join(offsets, "part").select(
        "doc_id", (F.col("offset") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the ids of all documents to a fresh shared folder and describe what is read back."""
    path = run_folder(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, id_col, text)
    return token_index(docs.sparkSession, path)
