"""SimHash near-duplicates by exact, tiled comparison of fingerprints.

A fingerprint has 64 bits: bit i is 1 if it is set in more than half of the document's shingle
hashes. Fingerprints link at ``radius`` or fewer differing bits, and every pair within the radius is
found.

Tiles hold fingerprints of equal population counts. The counts are taken of the four 16-bit quarters;
the sum of their differences bounds the Hamming distance from below, so tile pairs whose counts differ
by more than the radius are never built. (Counts of all 64 bits do the same but crowd around 32: half
of all pairs would stay; with quarters it is about one in eighty.) Tiles of more than ``tile``
fingerprints are cut. Equal fingerprints are one row, so a group of copies costs nothing here, and a
task emits a spanning forest of the links it finds, not the links.

The comparison is quadratic in the number of different fingerprints with a small factor; it is the
price of exactness at any radius.

Edge cases: NULL, empty and blank texts have fingerprint zero and link like any other; a text of one
or two words is one shingle; repeated rows give repeated results; a NULL id never names a component
unless no other id is in it (then the component is NULL); an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.components import components
from tickloom.llm.skew import lookup
from tickloom.operators.joins import checked_broadcast
from tickloom.session import store

SEED = 42
SHINGLE = 3
RADIUS = 2
TILE = 2048
QUARTERS = 4
BLOCK = 1 << 16


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        octets = hashes[at : at + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < size:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    ones = _bit_counts(hashes) * 2 > len(hashes)
    return int(np.packbits(ones, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Add ``_fp``, the fingerprint of the text."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, size) for t in texts], dtype="int64")

    return docs.withColumn("_fp", of(F.col(text)))


def hex_text(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _counts(fp: Column) -> list[Column]:
    mask = (1 << 16) - 1
    return [F.bit_count(F.shiftrightunsigned(fp, 16 * q).bitwiseAND(F.lit(mask))) for q in range(QUARTERS)]


def _key(counts: list[Column]) -> Column:
    key = F.lit(0)
    for count in counts:
        key = key * 17 + count
    return key.cast("int")


def _neighbours(counts: list[Column], radius: int) -> Column:
    """Keys of all tiles whose counts differ by no more than the radius, the own tile included."""
    steps = [s for s in product(range(-radius, radius + 1), repeat=QUARTERS) if sum(map(abs, s)) <= radius]
    keys = [
        F.when(
            F.greatest(*[c + d for c, d in zip(counts, s, strict=True)]).between(0, 16)
            & (F.least(*[c + d for c, d in zip(counts, s, strict=True)]) >= 0),
            _key([c + d for c, d in zip(counts, s, strict=True)]),
        )
        for s in steps
    ]
    return F.array_compact(F.array(*keys))


def _forest(left: np.ndarray, right: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between n nodes: each node and its smallest reachable one."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    nodes = np.flatnonzero(label != np.arange(n))
    return nodes, label[nodes]


def _compare(fps: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within one tile (all on side 0) or between two tiles."""
    bits = fps.view(np.uint64)
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1)
    within = len(second) == 0
    if within:
        second = first
    near = np.bitwise_count(bits[first][:, None] ^ bits[second][None, :]) <= radius
    i, j = np.nonzero(near)
    i, j = first[i], second[j]
    if within:
        once = i < j
        i, j = i[once], j[once]
    if len(i) >= len(fps):
        i, j = _forest(i, j, len(fps))
    return fps[i], fps[j]


def _links(radius: int):
    """Streams tile pairs, which arrive sorted; the last pair of a batch is carried into the next."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None

        def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            fps, side = rows["fp"].to_numpy(), rows["side"].to_numpy()
            a, b = rows["a"].to_numpy(), rows["b"].to_numpy()
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            edges = [0, *cuts.tolist(), len(fps)]
            lefts, rights = [], []
            for start, end in zip(edges, edges[1:], strict=False):
                # A pair of two tiles needs rows of both.
                if end - start < 2 or (a[start] != b[start] and not 0 < side[start:end].sum() < end - start):
                    continue
                left, right = _compare(fps[start:end], side[start:end], radius)
                lefts.append(left)
                rights.append(right)
            if lefts:
                yield pd.DataFrame({"a": np.concatenate(lefts), "b": np.concatenate(rights)})

        for rows in batches:
            if rest is not None:
                rows = pd.concat([rest, rows], ignore_index=True)
            if not len(rows):
                continue
            last = (rows["a"] == rows["a"].iloc[-1]) & (rows["b"] == rows["b"].iloc[-1])
            rest = rows[last]
            if len(rest) < len(rows):
                yield from found(rows[~last])
        if rest is not None and len(rest):
            yield from found(rest)

    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """``a, b``: links that join all fingerprints (column ``fp``, each once) within the radius, directly
    or through others."""
    counts = [F.col(f"_c{q}") for q in range(QUARTERS)]
    rows = fps.select("fp", *[c.alias(f"_c{q}") for q, c in enumerate(_counts(F.col("fp")))])
    keyed = rows.select("fp", *counts, _key(counts).alias("key"))
    # At most 17^4 keys exist, so this table has a fixed bound.
    tiles = keyed.groupBy("key").agg(F.ceil(F.count("*") / tile).cast("int").alias("cuts"))
    own = F.broadcast(tiles.select("key", F.col("cuts").alias("own_cuts")))
    other = F.broadcast(tiles.select(F.col("key").alias("other"), F.col("cuts").alias("other_cuts")))
    spread = keyed.join(own, "key").select(
        "fp",
        "key",
        F.pmod(F.xxhash64("fp"), F.col("own_cuts")).alias("cut"),
        F.explode(_neighbours(counts, radius)).alias("other"),
    )
    met = spread.join(other, "other").select(
        "fp", "key", "cut", "other", F.explode(F.sequence(F.lit(0), F.col("other_cuts") - 1)).alias("other_cut")
    )
    # A tile's number: key and cut. The smaller one of a pair is side 0.
    mine = F.col("key").cast("long") * (1 << 40) + F.col("cut")
    theirs = F.col("other").cast("long") * (1 << 40) + F.col("other_cut")
    pairs = met.select(
        "fp", F.least(mine, theirs).alias("a"), F.greatest(mine, theirs).alias("b"), (mine > theirs).cast("int").alias("side")
    )
    dealt = pairs.repartition("a", "b").sortWithinPartitions("a", "b")
    return dealt.mapInPandas(_links(radius), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    size: int = SHINGLE,
    tile: int = TILE,
) -> DataFrame:
    """``id, fingerprint (64-bit number), component``: the component is the smallest id within reach."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    marked = store(with_fingerprints(rows, "text", size).select("id", F.col("_fp").alias("fp")), "simhash")
    # Very many texts may have one fingerprint, such as that of no words.
    met = lookup(marked, _classes(marked, radius, tile), "fp", "n", ["id"], "inner")
    return met.select("id", F.col("fp").alias("fingerprint"), "component")


def _classes(marked: DataFrame, radius: int, tile: int) -> DataFrame:
    """``fp, n, component, keeper`` for each fingerprint of ``marked`` (id, fp): its rows, the smallest id of
    the component and whether this fingerprint is the one that holds it."""
    groups = store(marked.groupBy("fp").agg(F.min("id").alias("first_id"), F.count("*").alias("n")), "simhash-groups")
    links = store(fingerprint_links(groups.select("fp"), radius, tile), "simhash-links")
    roots = components(links, "a", "b", "simhash-components")
    rooted = groups.join(roots, groups["fp"] == roots["node"], "left").select(
        "fp", "first_id", "n", F.coalesce("root", "fp").alias("root")
    )
    # The smallest id; a NULL only if there is no other.
    order = F.struct(F.col("first_id").isNull().alias("none"), F.col("first_id").alias("id"), F.col("fp"))
    best = rooted.groupBy("root").agg(F.min(order).alias("best"), F.count("*").alias("fps"))
    return lookup(rooted, best, "root", "fps", ["fp"], "inner").select(
        "fp", "n", F.col("best.id").alias("component"), (F.col("best.fp") == F.col("fp")).alias("keeper")
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    radius: int = RADIUS,
    size: int = SHINGLE,
    tile: int = TILE,
) -> DataFrame:
    """One document of each component: that with the smallest id. Columns stay as they are; of repeated
    rows of that document one stays."""
    # The row travels as one value, so its column names cannot clash with those used here.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), F.col(text).alias("text"))
    full = store(with_fingerprints(rows, "text", size).drop("text"), "simhash-rows")
    marked = full.select("id", F.col("_fp").alias("fp"))
    counted = marked.groupBy("fp", "id").agg(F.count("*").alias("copies"))
    # Decided on ids and fingerprints alone. Named are documents that go and those that are there repeatedly;
    # the rows of all others stay where they are.
    placed = lookup(counted, _classes(marked, radius, tile), "fp", "n", ["id"], "inner")
    keeps = F.col("keeper") & F.col("id").eqNullSafe(F.col("component"))
    named = placed.select("fp", "id", F.when(~keeps, "goes").when(F.col("copies") > 1, "once").alias("_what")).filter("_what is not null")
    named = checked_broadcast(store(named, "simhash-named").withColumnsRenamed({"fp": "named_fp", "id": "named_id"}))
    same = (F.col("_fp") == F.col("named_fp")) & F.col("id").eqNullSafe(F.col("named_id"))
    met = full.join(named, same, "left")
    alone = met.filter("_what is null").select("row.*")
    return alone.unionByName(met.filter("_what = 'once'").dropDuplicates(["_fp", "id"]).select("row.*"))
