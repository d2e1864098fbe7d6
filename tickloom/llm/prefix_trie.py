"""Conversation prefix trie: what conversations share from their first turn on, rolled up by bands of depth.

Every distinct sequence of first turns is a node. A node is known by a key, 128 bits of a SHA-256 over the
sequence, made in bands as well: a key is the hash of what stands before its band and of the turns in
its band up to it, and what stands before a band is found the same way over the digests of whole bands.
No list is longer than ``HEIGHT``, however long a conversation is.

Totals of subtrees (``rollup``): a node sends its values only to its ancestors within its own band of
``HEIGHT`` depths. The sums at band tops make a trie of their own, ``HEIGHT`` times lower, which is
rolled up first, by the same rule; its completed totals then go from each band top to the nodes of the
band above. So a trie of depth d takes log(d) / log(HEIGHT) rounds, and no node makes more than HEIGHT + 1
rows. All sums have a map-side part, so the root and common first turns are no hot keys.

Defined results: rows without a conversation id take no part. NULL turn numbers come first, equal turn
numbers follow each other by role and a hash of the text; repeated rows are turns of their own. NULL role or text is
empty. The remainder of a negative id is negative, as in SQL. An empty table has no nodes. Other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.skew import lookup
from tickloom.llm.turns import positions
from tickloom.session import store

# Depths in a band: 2 to the power of SHIFT.
SHIFT = 3
HEIGHT = 1 << SHIFT
# Ids in one piece of a list of members: 2 to the power of this.
ID_SHIFT = 9
# Conversations of one group start alike; the number of turns they share is below SHARED.
GROUP, SHARED = 5, 9


def _hash(text: Column) -> Column:
    """16 bytes of the SHA-256 of binary data."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _joined(pieces: Column) -> Column:
    """Binary pieces of one length, one after the other."""
    return F.unhex(F.array_join(F.transform(pieces, F.hex), ""))


def _in(name: str) -> Column:
    """Place within a band."""
    return F.col(name).bitwiseAND(HEIGHT - 1).cast("int")


# --- sequences ----------------------------------------------------------------------------------


def turn_digests(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv, at`` (from 1), ``digest`` of role and text, ``bytes`` of the text."""
    who, said = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (role, text))
    sized = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    rows = conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        _hash(F.encode(sized, "utf-8")).alias("digest"),
        F.octet_length(said).cast("long").alias("bytes"),
        who.alias("who"),
        # Ties alone are ordered by the text; its digest is as good and keeps texts out of the shuffle.
        F.sha2(said, 256).alias("said"),
    )
    return positions(rows, "conv", "turn", ["who", "said"]).select("conv", "at", "digest", "bytes")


def rebuilt(turns: DataFrame, group: int = GROUP, shared: int = SHARED) -> DataFrame:
    """Conversations that start as the first of their ``group`` does: ``conv, depth, digest, bytes``, with the
    textless root at depth 0. Conversation c takes its first h turns, h = crc32(c) mod ``shared``, from
    conversation c - c mod ``group`` and goes on with its own after h."""
    convs = store(turns.groupBy("conv").agg(F.count("*").alias("n")), "convs")
    named = convs.select(
        "conv",
        "n",
        (F.col("conv") - F.col("conv") % group).alias("base"),
        (F.crc32(F.col("conv").cast("string").cast("binary")) % shared).alias("h"),
    )
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    sized = named.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    # A conversation may hold a large part of all turns; its few facts go to slices of them.
    own = lookup(turns, sized.select("conv", "h", "taken", "n"), "conv", "n", ["at"], "inner").filter("at > h")
    # At most ``shared`` - 1 turns of a base, each for the few conversations of its group.
    first = turns.filter(F.col("at") < shared).withColumnRenamed("conv", "base")
    taken = first.join(sized.select("conv", "base", "h"), "base").filter("at <= h")
    root = sized.select("conv", F.lit(0).cast("long").alias("depth"), _hash(F.lit(b"")).alias("digest"), F.lit(0).cast("long").alias("bytes"))
    return (
        own.select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("depth"), "digest", "bytes")
        .unionByName(taken.select("conv", F.col("at").alias("depth"), "digest", "bytes"))
        .unionByName(root)
    )


def _before(bands: DataFrame, last: int) -> DataFrame:
    """``conv, band, before``: a hash of all bands before this one. ``bands`` has ``conv, band, digest``,
    bands of a conversation counted from 0, the highest number ``last``."""
    if last == 0:
        return bands.select("conv", "band", F.lit(b"").alias("before"))
    one = F.struct("band", "digest")
    grouped = store(
        bands.groupBy("conv", F.shiftright("band", SHIFT).alias("group")).agg(F.sort_array(F.collect_list(one)).alias("bands")), "bands"
    )
    whole = grouped.select("conv", F.col("group").alias("band"), _hash(_joined(F.col("bands.digest"))).alias("digest"))
    outer = _before(whole, last >> SHIFT).withColumnRenamed("band", "group")
    each = grouped.join(outer, ["conv", "group"]).select("conv", "before", "bands", F.explode("bands").alias("one"))
    inner = _joined(F.slice(F.col("bands.digest"), F.lit(1), F.col("one.band").bitwiseAND(HEIGHT - 1).cast("int")))
    before = F.when(F.col("one.band") == 0, F.lit(b"")).otherwise(_hash(F.concat("before", inner)))
    return each.select("conv", "one.band", before.alias("before"))


def key_bands(sequences: DataFrame, last_depth: int) -> DataFrame:
    """``conv, band, keys, bytes``: the node keys of each conversation, in bands of ``HEIGHT`` depths."""
    one = F.struct("depth", "digest", "bytes")
    bands = store(
        sequences.groupBy("conv", F.shiftright("depth", SHIFT).alias("band")).agg(F.sort_array(F.collect_list(one)).alias("turns")), "turns"
    )
    digests = bands.select("conv", "band", _hash(_joined(F.col("turns.digest"))).alias("digest"))
    whole = bands.join(_before(digests, last_depth >> SHIFT), ["conv", "band"])
    keys = F.transform(
        F.sequence(F.lit(1), F.size("turns")),
        lambda i: _hash(F.concat("before", _joined(F.slice(F.col("turns.digest"), F.lit(1), i)))),
    )
    return whole.select("conv", "band", keys.alias("keys"), F.col("turns.bytes").alias("bytes"))


# --- nodes --------------------------------------------------------------------------------------


def _with_ancestors(nodes: DataFrame, bands: DataFrame) -> DataFrame:
    """Add ``ups``: the keys of a node's ancestors from its parent up to the top of the parent's band, the top
    first. A node has the place (conv, depth) in its smallest member, so each place is asked once."""
    parent = F.col("depth") - 1
    placed = nodes.withColumn("band", F.shiftright(parent, SHIFT))
    joined = placed.join(bands.select("conv", "band", "keys"), ["conv", "band"], "left")
    ups = F.slice("keys", F.lit(1), parent.bitwiseAND(HEIGHT - 1).cast("int") + 1)
    return joined.withColumn("ups", F.coalesce(ups, F.array().cast("array<binary>"))).drop("band", "keys")


def rollup(nodes: DataFrame, bands: DataFrame, last_depth: int, values: Sequence[str]) -> DataFrame:
    """``key`` and the sums of ``values`` over each node's subtree, the node included.

    ``nodes`` has ``key, conv, depth, ups`` and the values, ``bands`` the keys along each conversation."""
    sums = [F.sum(name).alias(name) for name in values]
    is_top = _in("depth") == 0
    own = F.when(is_top, F.array("key")).otherwise(F.concat(F.array("key"), F.col("ups")))
    sent = nodes.select(F.explode(own).alias("key"), *values)
    if last_depth >= HEIGHT:
        local = nodes.groupBy(F.when(is_top, F.col("key")).otherwise(F.get("ups", F.lit(0))).alias("key")).agg(*sums)
        tops = nodes.filter(is_top).select("key", "conv", F.shiftright("depth", SHIFT).alias("depth"), F.col("ups").alias("above"))
        top = F.struct("band", F.get("keys", F.lit(0)).alias("key"))
        lower = bands.groupBy("conv", F.shiftright("band", SHIFT).alias("group")).agg(F.sort_array(F.collect_list(top)).alias("tops"))
        top_bands = lower.select("conv", F.col("group").alias("band"), F.col("tops.key").alias("keys"))
        known = store(_with_ancestors(tops.join(local, "key"), top_bands), "tops")
        whole = rollup(known.drop("above"), top_bands, last_depth >> SHIFT, values)
        # A band top's completed total goes to its ancestors in the band above.
        passed = known.select("key", "above").join(whole, "key")
        sent = sent.unionByName(passed.select(F.explode("above").alias("key"), *values))
    return sent.groupBy("key").agg(*sums)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of lists that come in pieces, sorted by key and piece; a list is never held whole."""
    key, state = None, None

    def finished(keys: list, digests: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], ["key", "ends_sha256"])

    for batch in batches:
        keys, digests = [], []
        for at, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if at == key:
                state.update(f",{text}".encode())
                continue
            if state is not None:
                keys.append(key)
                digests.append(state.hexdigest())
            key, state = at, hashlib.sha256(text.encode())
        yield finished(keys, digests)
    if state is not None:
        yield finished([key], [state.hexdigest()])


def end_digests(bands: DataFrame) -> DataFrame:
    """``key, ends_sha256``: for nodes at which conversations end, a hash of their ids, ascending.

    Ids are gathered in pieces of one range of numbers each, which bounds a piece; the pieces of a node
    are hashed one after the other as they stream by, as one hash over all of them demands."""
    last = F.max_by(F.element_at("keys", -1), "band").alias("key")
    ends = bands.groupBy("conv").agg(last)
    pieces = ends.groupBy("key", F.shiftright("conv", ID_SHIFT).alias("piece")).agg(F.sort_array(F.collect_list("conv")).alias("ids"))
    dealt = pieces.select("key", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    sorted_pieces = dealt.repartition("key").sortWithinPartitions("key", "piece")
    return sorted_pieces.select("key", "ids").mapInArrow(_ends, "key binary, ends_sha256 string")


def trie(sequences: DataFrame) -> DataFrame:
    """The trie of ``sequences`` (``conv, depth, digest, bytes``, depths from 0 without gaps): one row per node:
    ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256``."""
    last_depth = sequences.agg(F.max("depth")).first()[0] or 0
    bands = store(key_bands(sequences, last_depth), "keys")
    each = bands.select("conv", "band", F.posexplode(F.arrays_zip("keys", "bytes")).alias("at", "turn"))
    found = each.groupBy(F.col("turn.keys").alias("key")).agg(
        F.min("conv").alias("conv"),
        F.max(F.shiftleft("band", SHIFT) + F.col("at")).alias("depth"),
        F.count("*").alias("n_convs"),
        F.max("turn.bytes").alias("bytes"),
    )
    known = _with_ancestors(found, bands).withColumn("parent", F.try_element_at("ups", F.lit(-1)))
    known = store(known, "nodes")
    children = known.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    nodes = known.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    valued = nodes.withColumns(
        {
            "n_leaves": (F.col("n_children") == 0).cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
        }
    )
    totals = rollup(valued.select("key", "conv", "depth", "ups", "n_leaves", "saved_tokens"), bands, last_depth, ["n_leaves", "saved_tokens"])
    parents = nodes.filter("n_children > 0").select(F.col("key").alias("parent"), F.col("conv").alias("parent_conv_id"), F.col("n_children").alias("_n"))
    facts = nodes.select("key", "conv", "depth", "parent", "n_convs", "n_children")
    # A node may have a large part of all nodes as its children.
    under = lookup(facts, parents, "parent", "_n", ["key"])
    whole = under.join(totals, "key").join(end_digests(bands), "key", "left")
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns = store(turn_digests(conversations), "turns")
    return trie(store(rebuilt(turns), "sequences"))
