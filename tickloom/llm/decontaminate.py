"""Benchmark decontamination by winnowing, in Spark SQL expressions only.

Words are runs of letters, digits and characters beyond ASCII, with A-Z in lower case. For a window of t
words, grams of k words are hashed, and from every run of w = t - k + 1 grams the least hash is kept:
whatever t words a document and an item share, both keep the same gram inside them. Fingerprints of
documents and items are joined on the hash, and each hit is extended over the words around it (which
travel with the fingerprint), so equal hashes of different words do no harm and every window found is
exact.

Items of ``window`` words or more use windows of that length. Shorter items are one window each; for each
length that occurs (twelve at most) documents are winnowed for that length as well.

The documents are read once and only small rows are shuffled: a row for each document and each window
found. Items are broadcast if their fingerprints, measured first, are small (``limit``); else the numbers of
fingerprints are shuffled, and the words of just those documents that meet an item.

Edge cases: NULL and empty texts have no words and are never contaminated; items without words match
nothing; NULL item ids count as items but are not named; repeated items each count; repeated documents
get equal results (a document is known by id and text); an empty benchmark leaves all documents clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.joins import BROADCAST_LIMIT, checked_broadcast, is_small
from tickloom.session import store

WINDOW = 13
SHARE = 20  # contaminated from one word in so many
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Cut at what stands between words, which is four times as fast as matching the words; an empty piece may be
    left at either end."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BETWEEN), "")


def gram_length(window: int) -> int:
    """The power of two up to half a window: long enough to be rare, short enough that few grams are kept,
    and windows of several lengths share their grams."""
    return 1 << (((window + 1) // 2).bit_length() - 1)


# A fingerprint in one number: 32 bits of the gram's hash, 5 bits of window length, 27 bits of position (an array
# of Spark holds fewer words). The least number of a run is the least hash, the first of equal ones.
PLACE_BITS, LENGTH_BITS = 27, 5
HASH_MASK = -(1 << (PLACE_BITS + LENGTH_BITS))
PLACE_MASK = (1 << PLACE_BITS) - 1


def _shifted(values: str, by: int, size: Column) -> Column:
    """``size`` values from position ``by`` on."""
    return F.slice(F.col(values), F.lit(by + 1), F.greatest(size, F.lit(0)))


def _winnowed(rows: DataFrame, tokens: str, windows: list[int]) -> DataFrame:
    """Add ``fps``: for each window length the grams that are the least of some window, as numbers.

    All steps are element-wise on whole arrays, each in a column of its own, so that nothing is computed
    twice: hashes of longer grams from those of shorter ones, least values of longer runs from shorter ones.
    """
    n = F.size(tokens)
    rows = rows.withColumn("_g1", F.transform(tokens, lambda word: F.xxhash64(word)))
    found = []
    for k in sorted({gram_length(t) for t in windows}):
        half = 1
        while half < k:  # grams of twice the length
            if f"_g{2 * half}" not in rows.columns:
                size = n - 2 * half + 1
                both = F.zip_with(_shifted(f"_g{half}", 0, size), _shifted(f"_g{half}", half, size), lambda a, b: F.xxhash64(a, b))
                rows = rows.withColumn(f"_g{2 * half}", both)
            half *= 2
        rows = rows.withColumn(f"_m{k}_1", F.transform(f"_g{k}", lambda h, i: h.bitwiseAND(F.lit(HASH_MASK)).bitwiseOR(i.cast("long"))))
        have = 1
        for t in sorted(t for t in windows if gram_length(t) == k):
            w = t - k + 1
            while have < w:
                step = min(have, w - have)
                size = n - k + 1 - (have - 1) - step
                least = F.zip_with(_shifted(f"_m{k}_{have}", 0, size), _shifted(f"_m{k}_{have}", step, size), lambda a, b: F.least(a, b))
                rows = rows.withColumn(f"_m{k}_{have + step}", least)
                have += step
            kept = F.array_distinct(F.col(f"_m{k}_{w}"))
            found.append(_with_length(kept, t))
    return rows.withColumn("fps", F.concat(*found)).drop(*[name for name in rows.columns if name.startswith(("_g", "_m"))])


def _with_length(kept: Column, window: int) -> Column:
    return F.transform(kept, lambda v: v.bitwiseOR(F.lit(window << PLACE_BITS)))


def _key(fingerprint: Column) -> Column:
    """Hash and window length: what a document's and an item's fingerprint have to share."""
    return F.shiftright(fingerprint, PLACE_BITS)


def _around(rows: DataFrame, fingerprint: str, tokens: str, mark: str = "") -> DataFrame:
    """Add, with names after ``mark``, window length ``t``, gram position ``p``, the words ``near`` that windows around
    the gram can hold, the position ``first`` of the first of them, and how far a window may begin before
    the gram (``reach``)."""
    t = F.shiftright(fingerprint, PLACE_BITS).bitwiseAND((1 << LENGTH_BITS) - 1).cast("int")
    p = F.col(fingerprint).bitwiseAND(PLACE_MASK).cast("int")
    before = F.array(*[F.lit(n - gram_length(n) if n else 0) for n in range(1 << LENGTH_BITS)])
    placed = rows.withColumns({f"{mark}t": t, f"{mark}p": p})
    placed = placed.withColumn(f"{mark}reach", F.get(before, F.col(f"{mark}t")))
    placed = placed.withColumn(f"{mark}first", F.greatest(F.col(f"{mark}p") - F.col(f"{mark}reach"), F.lit(0)))
    length = F.col(f"{mark}p") + F.col(f"{mark}t") - F.col(f"{mark}first")
    return placed.withColumn(f"{mark}near", F.slice(tokens, F.col(f"{mark}first") + 1, length))


def _items(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """``item, name, ws, t``: items with words. Repeated items stay apart by a number of their own."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("name"), words(F.col(text)).alias("ws"))
    some = rows.filter(F.size("ws") > 0)
    return some.withColumn("item", F.monotonically_increasing_id()).withColumn("t", F.least(F.size("ws"), F.lit(window)))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    share: int = SHARE,
    limit: int = BROADCAST_LIMIT,
) -> DataFrame:
    """``id, text_key, n_words, n_hit, n_items, items (sorted ids), contaminated`` for each document;
    ``text_key`` is the hash of the text."""
    if not 0 < window < 1 << LENGTH_BITS:
        raise ValueError(f"windows of {window} words: 1 to {(1 << LENGTH_BITS) - 1} are possible")
    items = store(_items(benchmark, item_id, item_text, window), "items")
    lengths = [r["t"] for r in items.select("t").distinct().orderBy("t").collect()]  # ``window`` values at most
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text)).alias("text_key"),
        words(F.col(text)).alias("_ws"),
    ).withColumn("n_words", F.size("_ws").cast("long"))
    exploded = _winnowed(items, "ws", lengths or [window]).select("*", F.explode("fps").alias("i_v")).drop("fps")
    marks = _around(exploded, "i_v", "ws", "i_").filter("t = i_t").select("item", "name", "i_p", "i_first", "i_near", _key(F.col("i_v")).alias("i_key"))
    marks = store(marks, "item-fingerprints")
    keep = ["id", "text_key", "n_words"]
    # The number 0, which meets no item, stands for the document itself.
    fps = F.concat(F.array(F.lit(0).cast("long")), F.col("fps"))
    winnowed = _winnowed(rows, "_ws", lengths or [window])
    if is_small(marks, limit):
        # Words stay in the row that is being read and are looked at where a fingerprint meets an item.
        spread = winnowed.select(*keep, "_ws", F.explode(fps).alias("v"))
        met = spread.join(F.broadcast(marks), _key(F.col("v")) == F.col("i_key"), "left").filter("v = 0 or i_key is not null")
    else:
        # Numbers alone are shuffled; the words come back to those that meet an item.
        spread = winnowed.select(*keep, F.explode(fps).alias("v"))
        candidates = store(
            spread.join(marks, _key(F.col("v")) == F.col("i_key"), "left").filter("v = 0 or i_key is not null"), "candidates"
        )
        texts = rows.select("id", "text_key", "_ws").dropDuplicates(["id", "text_key"])
        met = candidates.alias("c").join(texts.alias("d"), _same("c", "d", ["id", "text_key"])).select("c.*", "d._ws")
    placed = _around(met, "v", "_ws")
    # Windows leave through a generator: a filter on them stays above it, and the one on matches stays next to
    # the join, so that no row with all of its words is built for a fingerprint without a match.
    found = placed.select(*keep, "item", "name", "t", F.explode_outer(_starts()).alias("start"))
    found = store(found.filter("t = 0 or start is not null"), "windows")
    every = found.filter("t = 0").groupBy("id", "text_key", "n_words").agg(F.count("*").cast("int").alias("copies"))
    return _result(every, found.filter("t > 0"), share)


def _upto(last: Column) -> Column:
    """0 .. last, nothing if last is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _starts() -> Column:
    """Extends a hit: first words of the document's windows around the gram that the item has as well."""
    t, p, q = F.col("t"), F.col("p"), F.col("i_p")

    def same(back: Column) -> Column:
        here = F.slice(F.col("near"), p - back - F.col("first") + 1, t)
        there = F.slice(F.col("i_near"), q - back - F.col("i_first") + 1, t)
        return (F.size(here) == t) & (here == there)

    # The window may begin so many words before the gram.
    reach = F.least("reach", p, q)
    backs = F.filter(_upto(reach), same)
    return F.when(F.col("i_key").isNotNull(), F.transform(backs, lambda back: p - back))


def _result(every: DataFrame, found: DataFrame, share: int) -> DataFrame:
    key = ["id", "text_key"]
    spans = found.select(*key, "start", "t").distinct()
    covered = spans.select(*key, F.explode(F.expr("sequence(start, start + t - 1)")).alias("word")).distinct()
    hits = covered.groupBy(*key).agg(F.count("*").alias("n_hit"))
    named = (
        found.select(*key, "item", "name")
        .distinct()
        .groupBy(*key)
        .agg(F.sort_array(F.collect_list("name")).alias("items"), F.count("*").alias("n_items"))
    )
    both = hits.alias("h").join(named.alias("n"), _same("h", "n", key)).select("h.*", "items", "n_items")
    joined = every.alias("e").join(both.alias("b"), _same("e", "b", key), "left")
    nothing = F.lit(0).cast("long")
    rows = joined.select(
        "e.*",
        F.coalesce("n_hit", nothing).alias("n_hit"),
        F.coalesce("n_items", nothing).alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    dirty = (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))
    # Repeated rows were counted once; each gets the result.
    return rows.select(
        *key, "n_words", "n_hit", "n_items", "items", dirty.alias("contaminated"), F.explode(F.sequence(F.lit(1), "copies"))
    ).drop("col")


def _same(a: str, b: str, key: list[str]) -> Column:
    condition = F.lit(True)
    for name in key:
        condition = condition & F.col(f"{a}.{name}").eqNullSafe(F.col(f"{b}.{name}"))
    return condition


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that are not contaminated, as they are."""
    dirty = contamination(docs, benchmark, id_col, text, **options).filter("contaminated")
    named = store(dirty.select(F.col("id").alias("_dirty_id"), F.col("text_key").alias("_dirty_key")), "contaminated")
    condition = F.col(id_col).eqNullSafe(F.col("_dirty_id")) & F.xxhash64(F.col(text)).eqNullSafe(F.col("_dirty_key"))
    return docs.join(checked_broadcast(named), condition, "left_anti")
