"""The sector dimension (a stock belongs to several sectors) and the join with it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.numbers import trimmed
from tickloom.operators.joins import BROADCAST_LIMIT, ROWS_PER_SLICE, is_small, sliced_left_join

# Fixed value: how a link shows the stock it leads to.
STOCK_LINK = r"code=(\d{6})"
# An anchor, whatever its case, quotes and inner elements; its target; markup inside its text.
ANCHOR = r"(?is)<a\b[^>]*?\bhref\s*=\s*(?:\"[^\"]*\"|'[^']*')[^>]*>.*?</a\s*>"
TARGET = r"(?is)^<a\b[^>]*?\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)')"
MARKUP = r"<[^>]*>"

SECTORS_PER_ROW = 10_000
PAGES_PER_BUCKET = 10_000


def sector_rows(entries: DataFrame) -> DataFrame:
    """One row per (stock, sector). Repeated pairs count once, empty lists give no row."""
    return entries.select("stock_code", F.explode("sectors").alias("sector"), "name").dropDuplicates()


def enrich(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Left join on the stock: all columns of ``rows`` plus ``sector`` and ``name``."""
    return rows.join(dim.select("stock_code", "sector", "name"), "stock_code", "left").select(
        *rows.columns, "sector", "name"
    )


def validity(snapshots: DataFrame, taken: str = "valid_from", since_ever: bool = True) -> DataFrame:
    """When a stock belonged to a sector: ``stock_code, sector, name, valid_from, valid_until``.

    ``snapshots`` are successive full sector lists, rows as of :func:`sector_rows` with the time each was
    ``taken``. A row holds from its list on until the first list without it (``valid_until``, exclusive; NULL
    while it is in the last one) and may come again. With ``since_ever`` the first list also holds for the
    time before it (``valid_from`` NULL). Repeated rows count once.
    """
    keys = ("stock_code", "sector", "name")
    # One row for each list; a sort of these is all that a single task does.
    times = snapshots.select(taken).distinct()
    order = Window.orderBy(taken)
    numbered = times.select(taken, F.row_number().over(order).alias("_no"), F.lead(taken).over(order).alias("_next"))
    rows = snapshots.select(*keys, taken).distinct().join(F.broadcast(numbered), taken)
    run = F.col("_no") - F.row_number().over(Window.partitionBy(*keys).orderBy("_no"))
    start = F.min(taken)
    if since_ever:
        start = F.when(F.min("_no") > 1, start)
    return (
        rows.withColumn("_run", run)
        .groupBy(*keys, "_run")
        .agg(start.alias("valid_from"), F.max_by("_next", "_no").alias("valid_until"))
        .drop("_run")
    )


def enrich_windows(stats: DataFrame, dim: DataFrame) -> DataFrame:
    """:func:`enrich` for windows: with ``valid_from, valid_until`` in ``dim`` each window gets the sectors that
    held when it started. An equi-join on the stock; a stock has few intervals, which are filtered in it."""
    if "valid_from" not in dim.columns:
        return enrich(stats, dim)
    d = dim.select("stock_code", "sector", "name", "valid_from", "valid_until").alias("d")
    start = F.col("s.window.start")
    holds = (
        (F.col("s.stock_code") == F.col("d.stock_code"))
        & (F.col("d.valid_from").isNull() | (start >= F.col("d.valid_from")))
        & (F.col("d.valid_until").isNull() | (start < F.col("d.valid_until")))
    )
    return stats.alias("s").join(d, holds, "left").select("s.*", "d.sector", "d.name")


def enrich_rows(
    rows: DataFrame,
    dim: DataFrame,
    spread_on: Sequence[str],
    limit: int = BROADCAST_LIMIT,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """:func:`enrich` for single trades, of which one stock may hold a large part.

    A dimension below ``limit`` bytes is broadcast and the trades stay where they are. Beyond that
    both sides are shuffled, hot stocks in slices. ``dim`` is measured, so it should be stored.
    """
    if is_small(dim, limit):
        return enrich(rows, F.broadcast(dim))
    wanted = dim.select("stock_code", "sector", "name")
    joined = sliced_left_join(rows, wanted, "stock_code", spread_on, rows_per_slice)
    return joined.select(*rows.columns, "sector", "name")


def sector_links(
    pages: DataFrame,
    sector: Column,
    page_order: Column,
    html: Column,
    code_pattern: str = STOCK_LINK,
    anchor_pattern: str = ANCHOR,
) -> DataFrame:
    """One row per stock link found in already fetched sector pages, with its visit position."""

    anchors = F.transform(
        F.regexp_extract_all(html, F.lit(anchor_pattern), F.lit(0)),
        lambda a: F.struct(
            F.concat(F.regexp_extract(a, TARGET, 1), F.regexp_extract(a, TARGET, 2)).alias("href"),
            trimmed(F.regexp_replace(a, MARKUP, "")).alias("text"),
        ),
    )
    links = pages.select(
        sector.alias("sector"),
        page_order.alias("page_order"),
        F.posexplode(anchors).alias("link_order", "link"),
    )
    return links.select(
        F.regexp_extract("link.href", code_pattern, 1).alias("stock_code"),
        F.col("link.text").alias("name"),
        "sector",
        "page_order",
        "link_order",
    ).filter(F.col("stock_code") != "")


def sector_map(links: DataFrame, per_row: int = SECTORS_PER_ROW, pages_per_bucket: int = PAGES_PER_BUCKET) -> DataFrame:
    """Per stock: the name seen first and its sectors in visit order.

    A stock with more than ``per_row`` links gets further rows, numbered by ``part``; a shorter list is
    always one row, wherever its pages are. Positions are counted within buckets of pages and added up
    over the few buckets of a stock, so no task sorts all links of one.
    """
    place = F.struct("page_order", "link_order")
    bucketed = links.withColumn("bucket", F.floor(F.col("page_order") / pages_per_bucket))
    sizes = bucketed.groupBy("stock_code", "bucket").agg(F.count("*").alias("links"))
    earlier = Window.partitionBy("stock_code").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("stock_code", "bucket", F.coalesce(F.sum("links").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("stock_code", "bucket").orderBy("page_order", "link_order")
    placed = bucketed.withColumn("inside", F.row_number().over(inside) - 1).join(before, ["stock_code", "bucket"])
    part = F.floor((F.col("before") + F.col("inside")) / per_row).alias("part")
    visits = F.array_sort(F.collect_list(F.struct("page_order", "link_order", "sector")))
    lists = placed.groupBy("stock_code", part).agg(
        F.transform(visits, lambda visit: visit["sector"]).alias("sectors")
    )
    names = links.groupBy("stock_code").agg(F.min_by("name", place).alias("name"))
    return lists.join(names, "stock_code").select("stock_code", "name", "sectors", "part")
