"""Fuzzy line deduplication: MinHash over character shingles, banding, exact Jaccard, union-find.

Lines are compared in lower case with white space collapsed. Equal lines become one row first, so a line
that occurs everywhere costs one row. Each different line gets a MinHash signature (of least and greatest values),
whose bands put it into buckets; twelve bands of four values find a pair of similarity 0.8 with probability 0.998 and
one of 0.85 with 0.9998. Nearly all bands belong to one line only and go first, bin by bin. Lines that share a
bucket are compared exactly by the Jaccard similarity of their shingle sets (of 64-bit hashes of the shingles);
buckets with the same members are compared once, large buckets are cut into tiles, all pairs of which are read, and
pairs that cannot reach the limit by 16 bits of each hash are settled by these. Within a tile, lines already joined
are not compared again, and what leaves a task is a forest of links. Components are found by distributed union-find,
and of each component the line that comes first (by document id, then text hash, then position) stays; all other
occurrences go.

Edge cases: NULL text is the empty text; blank lines are no lines and stay; a line shorter than a shingle
is one shingle, so only equal lines match it; a row is known by its id and a hash of its text, so rows that
share an id (NULL as well) but not a text are documents of their own, and repeated rows get equal results, as
they name the same places; a NULL id comes first; an empty table gives an empty result. Texts and lines are
read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.batches import slices
from tickloom.llm.components import components
from tickloom.llm.skew import lookup
from tickloom.operators.joins import checked_broadcast
from tickloom.session import store

SHINGLE = 9
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
SPACES = " \t\r\x0b\x0c"
TILE = 1024
SEED = 20
KEY = ["key", "check"]
BIN_ROWS = 1 << 19  # bands in a bin, on average
BLOCK_ROWS = 256  # lines hashed together
BLOCK_CHARS = 1 << 16  # what the working arrays of a block take stays in the cache


def _odd(text: Column) -> Column:
    """Whether a text may hold white space that has to be collapsed."""
    odd = F.lit(False)
    for space in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | text.contains(space)
    return odd


def normal(line: Column, odd: Column) -> Column:
    """White space collapsed. Few texts (``odd``) hold any that has to be, and few of their lines, so the
    pattern runs on these."""
    return F.trim(F.when(odd & _odd(line), F.regexp_replace(line, r"\s+", " ")).otherwise(line))


def _blank(line: Column) -> Column:
    # Trimmed on the left only, which stops at the first other character.
    return F.ltrim(line, F.lit(SPACES)) == ""


def text_key(text: str) -> Column:
    """Tells the texts of one id apart."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("hash"), F.octet_length(whole).alias("length"))


def _lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, text_key, pos, key, check, line``: the lines that are not blank. ``key`` and ``check``, 128 bits
    together, stand for the normal form."""
    # What concerns the text is made before it is cut, once for all of its lines.
    whole = docs.select(F.col(id_col).alias("id"), text_key(text).alias("text_key"), F.lower(F.coalesce(text, F.lit(""))).alias("text"))
    marked = whole.select("id", "text_key", "text", _odd(F.col("text")).alias("odd"))
    every = marked.select("id", "text_key", "odd", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    # Blank lines are told by the raw text: a filter on the normal form would make it twice.
    some = every.filter(~_blank(F.col("raw")))
    rows = some.select("id", "text_key", "pos", normal(F.col("raw"), F.col("odd")).alias("line"))
    return rows.select("id", "text_key", "pos", F.xxhash64("line").alias("key"), F.xxhash64(F.lit(SEED), "line").alias("check"), "line")


def _rolling(codes: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` characters."""
    # A polynomial of the run's characters; that of a run is made of those of its two halves.
    found, length = codes, 1
    for bit in bin(size)[3:]:
        for own, more in ((found, length), (codes, 1))[: 1 + int(bit)]:
            factor = np.uint64(pow(0x100000001B3, more, 1 << 64))
            found, length = found[: len(found) - more] * factor + own[length:], length + more
    found = found ^ (found >> np.uint64(29))
    found *= np.uint64(0xBF58476D1CE4E5B9)
    return found


def _codes(lines: list[str]) -> np.ndarray:
    return np.frombuffer("".join(lines).encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.uint64)


def shingle_hashes(line: str, size: int = SHINGLE) -> np.ndarray:
    """The different shingles of a line as 64-bit hashes, in order."""
    hashes = np.sort(_rolling(_codes([line if len(line) >= size else line.ljust(size, "\0")]), size))
    return hashes[np.concatenate([[True], hashes[1:] != hashes[:-1]])]


def all_shingle_hashes(lines: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """:func:`shingle_hashes` of many lines, hashed together."""
    found: list[np.ndarray] = []
    start = 0
    while start < len(lines):
        end, chars = start, 0
        while end < len(lines) and (end == start or chars + len(lines[end]) <= BLOCK_CHARS):
            chars += len(lines[end])
            end += 1
        padded = [line if len(line) >= size else line.ljust(size, "\0") for line in lines[start:end]]
        hashes = _rolling(_codes(padded), size)
        first = 0
        for line in padded:
            own = np.sort(hashes[first : first + len(line) - size + 1])
            first += len(line)
            again = own[1:] == own[:-1]
            found.append(own[np.concatenate([[True], ~again])] if again.any() else own)
        start = end
    return found


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many hashes two lines share."""
    at = np.searchsorted(b, a)
    return int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))


def signatures(lines: list[str], bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> np.ndarray:
    """A 64-bit name for each band of each line: of the least and the greatest value of its shingles (min-max
    hashing) under half as many hash functions as a band has values, rounded up."""
    dice = np.random.default_rng(SEED)
    functions = (rows + 1) // 2
    factors = (dice.integers(1, 1 << 31, bands * functions, dtype=np.uint64) * 2 + 1).astype(np.uint32)
    terms = dice.integers(0, 1 << 32, bands * functions, dtype=np.uint64).astype(np.uint32)
    names = np.zeros((len(lines), bands), dtype=np.uint64)
    start = 0
    while start < len(lines):
        end, chars = start, 0
        while end < len(lines) and (end == start or chars + len(lines[end]) <= BLOCK_CHARS):
            chars += len(lines[end])
            end += 1
        padded = [line if len(line) >= size else line.ljust(size, "\0") for line in lines[start:end]]
        codes = _codes(padded)
        lengths = np.array([len(p) for p in padded])
        firsts = np.cumsum(lengths) - lengths
        hashes = (_rolling(codes, size) >> np.uint64(32)).astype(np.uint32)
        # Runs that cross into the next line belong to no line: they repeat the line's first run instead.
        crossing = firsts[1:, None] - np.arange(1, size)
        hashes[crossing] = hashes[firsts[:-1], None]
        mixed = np.empty_like(hashes)
        for band in range(bands):
            name = np.full(end - start, band + 1, dtype=np.uint64)
            for row in range(rows):
                if row % 2 == 0:
                    p = band * functions + row // 2
                    np.multiply(hashes, factors[p], out=mixed)
                    np.add(mixed, terms[p], out=mixed)
                extreme = np.maximum if row % 2 else np.minimum
                name = name * np.uint64(0x9E3779B97F4A7C15) + extreme.reduceat(mixed, firsts)
            names[start:end, band] = name ^ (name >> np.uint64(31))
        start = end
    return names


def _bander(bins: int, bands: int, rows: int, size: int):
    """Deals the bands of lines out to bins: one row for each bin and batch, with packed 64-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                names = signatures(part.column(1).to_pylist(), bands, rows, size).ravel()
                ids = np.repeat(part.column(0).to_numpy(), bands)
                into = (names >> np.uint64(32)) % np.uint64(bins)
                order = np.argsort(into.astype(np.uint16) if bins <= 1 << 16 else into, kind="stable")
                found, firsts = np.unique(into[order], return_index=True)
                ends = pa.py_buffer((np.append(firsts, len(into)) * 8).astype(np.int32))
                ids, names = (
                    pa.Array.from_buffers(pa.binary(), len(found), [None, ends, pa.py_buffer(column[order])])
                    for column in (ids, names)
                )
                yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), ids, names], ["bin", "ids", "bands"])

    return run


def _sifted(ids: np.ndarray, bands: np.ndarray, told: np.ndarray) -> tuple[pa.RecordBatch, list[np.ndarray]]:
    """The rows of bands that have several, without those ``told`` before; one row of each band, told if it has been now."""
    order = np.argsort(bands)
    ids, bands, told = ids[order], bands[order], told[order]
    first = np.ones(len(bands), dtype=bool)
    first[1:] = bands[1:] != bands[:-1]
    several = ~first
    several[:-1] |= ~first[1:]
    out = several & ~told
    rows = pa.RecordBatch.from_arrays([pa.array(ids[out]), pa.array(bands[out])], ["line_id", "band"])
    return rows, [ids[first], bands[first], (told | several)[first]]


def _sharing(limit: int):
    """Of the packed rows of a bin, the bands that several lines have. What is held is ``limit`` rows and one for
    each different band, however many lines have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for ids, bands in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                n += len(ids) // 8
                waiting.append([np.frombuffer(ids, np.int64), np.frombuffer(bands, np.int64), np.zeros(len(ids) // 8, dtype=bool)])
                if n > limit:
                    rows, kept = _sifted(*map(np.concatenate, zip(*waiting, strict=True)))
                    yield rows
                    waiting, n = [kept], 0
        if waiting:
            yield _sifted(*map(np.concatenate, zip(*waiting, strict=True)))[0]

    return run


def _with_bands(different: DataFrame, bands: int, rows: int, size: int, bin_rows: int = BIN_ROWS) -> DataFrame:
    """``line_id, band``, without the bands that one line only has, which are nearly all. The others are told by
    bins, one to a task; their number grows with the lines. A line has ``bands`` bands, mostly in as many bins, so
    no bin gets more than one in ``bands`` of all rows for the sake of one band."""
    bins = different.count() * bands // bin_rows + 1
    packed = different.select("line_id", "line").mapInArrow(_bander(bins, bands, rows, size), "bin int, ids binary, bands binary")
    return packed.repartitionById(bins, "bin").mapInArrow(_sharing(4 * bin_rows), "line_id long, band long")


def _may_reach(i: int, others: list[int], upper: list[np.ndarray], marks: np.ndarray, limit: float) -> list[int]:
    """``others`` without those that share too few hashes with ``i`` even by the ``upper`` 16 bits, of which no
    fewer are met than of whole hashes. ``marks`` has a place for each value of these and is left as it was."""
    marks[upper[i]] = True
    found = []
    for at in range(0, len(others), BLOCK_ROWS):
        some = others[at : at + BLOCK_ROWS]
        sizes = np.array([len(upper[j]) for j in some])
        met = marks[np.concatenate([upper[j] for j in some])]
        most = np.add.reduceat(met, np.cumsum(sizes) - sizes, dtype=np.int64)
        enough = most >= limit * (len(upper[i]) + sizes - most)
        found += [j for j, ok in zip(some, enough.tolist(), strict=True) if ok]
    marks[upper[i]] = False
    return found


def _tile_links(ids: list[int], sets: list[np.ndarray], sides: list[int], limit: float) -> list[tuple[int, int]]:
    """Links that join the lines of a tile (one side) or of two tiles (pairs across)."""
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    across = any(sides)
    order = sorted(range(len(ids)), key=lambda i: len(sets[i]))
    pair = len(ids) == 2
    upper = [] if pair else [(s >> np.uint64(48)).astype(np.uint16) for s in sets]
    marks = np.zeros(0 if pair else 1 << 16, dtype=bool)
    found = []
    for rank, i in enumerate(order):
        most = len(sets[i]) / limit
        own = root(i)
        others = []
        for j in order[rank + 1 :]:
            if len(sets[j]) > most:
                break
            if not (across and sides[i] == sides[j]) and root(j) != own:
                others.append(j)
        for j in _may_reach(i, others, upper, marks, limit) if len(others) > 1 else others:
            if root(i) == root(j):
                continue
            shared = common(sets[i], sets[j])
            if shared >= limit * (len(sets[i]) + len(sets[j]) - shared):
                parent[root(j)] = root(i)
                found.append((ids[i], ids[j]))
    return found


def _comparer(limit: float, size: int):
    """Streams tile pairs, which arrive sorted."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, ids, sets, sides = None, [], [], []
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = [batch[name].tolist() for name in ("bucket", "a", "b", "side", "line_id")]
            hashed = (s for at in range(0, len(batch), BLOCK_ROWS) for s in all_shingle_hashes(batch["line"][at : at + BLOCK_ROWS].tolist(), size))
            for bucket, a, b, side, line_id, hashes in zip(*columns, hashed, strict=True):
                if (bucket, a, b) != key:
                    if len(ids) > 1:
                        found += _tile_links(ids, sets, sides, limit)
                    key, ids, sets, sides = (bucket, a, b), [], [], []
                ids.append(line_id)
                sets.append(hashes)
                sides.append(side)
            yield pd.DataFrame(found, columns=["x", "y"], dtype="int64")
        if len(ids) > 1:
            yield pd.DataFrame(_tile_links(ids, sets, sides, limit), columns=["x", "y"], dtype="int64")

    return run


def similar_lines(
    different: DataFrame, limit: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE, tile: int = TILE
) -> DataFrame:
    """``x, y``: links between lines (``line_id, line``, each text once) of at least the similarity."""
    banded = store(_with_bands(different, bands, rows, size), "line-bands")
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(line_id))").alias("members"))
    # Buckets with the same members are one.
    once = store(buckets.groupBy("n", "members").agg(F.min("band").alias("band")).select("band", "n"), "line-buckets")
    cuts = F.ceil(F.col("n") / tile).cast("int")
    members = banded.join(checked_broadcast(once), "band").select(
        F.col("band").alias("bucket"), "line_id", F.pmod(F.xxhash64("line_id"), cuts).cast("int").alias("own"), cuts.alias("cuts")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    pairs = members.select("bucket", "line_id", "own", other).select(
        "bucket",
        F.least("own", "other").alias("a"),
        F.greatest("own", "other").alias("b"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "line_id",
    )
    dealt = pairs.join(different, "line_id").repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b")
    return dealt.mapInPandas(_comparer(limit, size), "x long, y long")


def line_decisions(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: float = SIMILARITY, tile: int = TILE
) -> DataFrame:
    """``id, text_key, dropped``: positions of the lines that go, for each id and text that loses any."""
    lines = _lines(docs, id_col, text)
    place = F.struct("id", "text_key", "pos")
    different = store(
        lines.groupBy(*KEY)
        .agg(F.min(F.struct("id", "text_key", "pos", "line")).alias("first"), F.count("*").alias("n"))
        .select(
            F.monotonically_increasing_id().alias("line_id"), *KEY, F.col("first.id").alias("id"),
            F.col("first.text_key").alias("text_key"), F.col("first.pos").alias("pos"), F.col("first.line").alias("line"), "n",
        ),
        "lines", "zstd",
    )
    links = store(similar_lines(different.select("line_id", "line"), limit, tile=tile), "line-links")
    roots = components(links, "x", "y", "line-components")
    joined = different.select("line_id", *KEY, place.alias("place"), "n").join(
        roots, F.col("line_id") == F.col("node"), "left"
    )
    # Lines that neither repeat nor resemble another are most, and stay.
    joined = store(joined.filter("root is not null or n > 1"), "line-roots")
    linked = joined.filter("root is not null")
    first = linked.groupBy("root").agg(F.min("place").alias("kept"), F.count("*").alias("size"))
    decided = (
        lookup(linked, first, "root", "size", ["line_id"], "inner").select(*KEY, "kept", "n")
        .union(joined.filter("root is null").select(*KEY, F.col("place").alias("kept"), "n"))
    )
    # Only lines that repeat or resemble another are looked up again.
    occurrences = lookup(
        lines.select("id", "text_key", "pos", *KEY), store(decided, "line-keepers"), KEY, "n", ["id", "text_key", "pos"], "inner"
    )
    gone = occurrences.filter(~place.eqNullSafe(F.col("kept")))
    return gone.groupBy("id", "text_key").agg(F.collect_set("pos").alias("dropped"))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", limit: float = SIMILARITY, tile: int = TILE
) -> DataFrame:
    """The documents with the text of the lines that stay, and ``n_lines, n_dropped`` (columns of these
    names are replaced)."""
    gone = store(line_decisions(docs, id_col, text, limit, tile), "lines-dropped")
    gone = gone.withColumnsRenamed({"id": "gone_id", "text_key": "gone_key"})
    # The row travels as one value, so its column names cannot clash with those used here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"), text_key(text).alias("text_key"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key"))
    met = rows.join(checked_broadcast(gone), same, "left")
    raw = F.split(F.coalesce("text", F.lit("")), "\n")
    stays = F.filter(raw, lambda line, at: ~F.array_contains("dropped", at))
    lines = F.size(F.filter(raw, lambda line: ~_blank(line)))
    changed = F.col("dropped").isNotNull()
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    new_text = F.when(changed, F.array_join(stays, "\n")).otherwise(F.col("text"))
    return met.select(
        *[new_text.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in others],
        lines.cast("long").alias("n_lines"),
        F.when(changed, F.size("dropped")).otherwise(0).cast("long").alias("n_dropped"),
    )
