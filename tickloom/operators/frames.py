"""Raw feed frames: classify, decode per record kind, dead letters, publishable rows.

A frame is one text line ``0|TR_ID|count|v0^v1^...``; a line that starts with ``{`` is a control
message. All functions are projections and filters: no shuffle, one pass, batch or stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.layouts import EXPECTED, LAYOUTS, LEVELS, ORDER_BOOK, TRADE, Layout
from tickloom.functions.numbers import as_message_text, breaks_policy, by_policy, record_pattern


def frame_class(frame: Column) -> Column:
    first = F.substring(frame, 1, 1)
    return F.when(first == "0", "data").when(first == "{", "control").otherwise("unknown")


def classify(frames: DataFrame, frame_col: str = "frame") -> DataFrame:
    """Add ``frame_class``: data, control or unknown."""
    return frames.withColumn("frame_class", frame_class(F.col(frame_col)))


def _width(tr_id: Column, layouts: Sequence[Layout]) -> Column:
    """Values in one record of a kind; NULL for unknown kinds."""
    width = F.lit(None).cast("int")
    for layout in layouts:
        width = F.when(tr_id == layout.tr_id, layout.width).otherwise(width)
    return width


def _step(size: Column, said: Column, width: Column) -> Column:
    """Values from one record to the next: the width, or more where records have added fields."""
    count = F.when(said > 0, said)
    each = F.floor(size / count).cast("int")
    added = (size % count == 0) & (each > width) & (each % width != 0)
    return F.when(F.coalesce(added, F.lit(False)), each).otherwise(width)


def split_frames(
    frames: DataFrame,
    layouts: Sequence[Layout] = LAYOUTS,
    frame_col: str = "frame",
) -> DataFrame:
    """One row per record of a frame: ``frame_class``, ``tr_id``, ``record_no``, ``count_fits`` (the frame
    holds as many records as it says) and ``parts`` (the record's values as text).

    The payload is cut by the width of the frame's own kind. Records may have got more fields at their end
    than the layout knows: where the count that the frame gives divides its values into records that are
    longer than the layout, and not just by whole records, each is cut at that length and the added
    values are left aside. Frames of unknown kinds, lines that are no data, and frames without a
    payload stay as one row, so that they can reach the dead letters.

    Records leave through a generator, which repeats the values of the frame; each record then takes its own. The
    generator is an outer one, as Spark looks for empty lists before an inner one, for which it would split the
    frame another time; there are none.
    """
    kind = frame_class(F.col(frame_col))
    # Each step is a projection of its own, so that a frame is split once however often its parts are used.
    split = (
        frames.withColumn("_fields", F.when(kind == "data", F.split(F.col(frame_col), r"\|")))
        .withColumn("_payload", F.split(F.get("_fields", F.lit(3)), r"\^"))
        .withColumn("_tr_id", F.get("_fields", F.lit(1)))
    )
    payload, size = F.col("_payload"), F.size("_payload")
    split = split.withColumns(
        {
            "_width": F.coalesce(_width(F.col("_tr_id"), layouts), F.greatest(size, F.lit(1))),
            "_said": F.get("_fields", F.lit(2)).try_cast("int"),
        }
    )
    width, said = F.col("_width"), F.col("_said")
    split = split.withColumn("_step", _step(size, said, width))
    last = F.coalesce(F.greatest(F.floor((size - 1) / F.col("_step")), F.lit(0)), F.lit(0)).cast("int")
    split = split.withColumn("_last", last).withColumn("_numbers", F.sequence(F.lit(0), F.col("_last")))
    each = split.select(
        *frames.columns,
        kind.alias("frame_class"),
        F.col("_tr_id").alias("tr_id"),
        F.explode_outer("_numbers").alias("record_no"),
        F.coalesce(said == F.col("_last") + 1, F.lit(False)).alias("count_fits"),
        *("_payload", "_step", "_width"),
    )
    parts = F.slice(payload, (F.col("record_no") * F.col("_step") + 1).cast("int"), width)
    return each.withColumn("parts", parts).drop("_payload", "_step", "_width")


def _part(position: int) -> Column:
    return F.get(F.col("parts"), F.lit(position))


def _policies(layout: Layout) -> list[str]:
    """The policy of each position."""
    known = {i: rule for i, _, rule in layout.fields}
    return [known.get(i, "text") for i in range(layout.width)]


def _looks(layout: Layout, blanks: bool) -> Column:
    """The whole record, looked at once, has readable numbers at all places."""
    text = F.array_join("parts", "^")
    return F.coalesce(text.rlike(record_pattern(_policies(layout), "^", blanks)), F.lit(False))


def _problem(layout: Layout) -> Column:
    """Why a record cannot be decoded with this layout; NULL if it can. Its numbers are looked at one by one only
    if the record as a whole does not look right.

    The lambda has a second use: it keeps the projections that read records field by field out of whole-stage code,
    where all fields would be one method, too long for the compiler of the virtual machine."""
    rules = F.array(*[F.lit(rule) for rule in _policies(layout)])
    places = F.sequence(F.lit(0), F.lit(layout.width - 1))
    bad = F.exists(places, lambda i: breaks_policy(F.get(F.col("parts"), i), F.get(rules, i)))
    too_short = F.coalesce(F.size("parts"), F.lit(0)) < layout.width
    return (
        F.when(too_short, "short_payload")
        .when(~F.col("count_fits"), "bad_count")
        .when(_looks(layout, True), F.lit(None).cast("string"))
        .when(bad, "bad_number")
    )


def _once(rows: DataFrame, keep: Sequence[str], value: Column, name: str) -> DataFrame:
    """``keep`` and a value, where it is not NULL. It leaves through a generator, so it is computed once."""
    computed = rows.select(*keep, value.alias(f"_{name}"))
    return computed.select(*keep, F.explode(F.array(f"_{name}")).alias(name)).filter(F.col(name).isNotNull())


def decode(
    frames: DataFrame,
    layout: Layout,
    keep: Sequence[str] = (),
    frame_col: str = "frame",
) -> DataFrame:
    """Typed rows of one record kind: ``keep`` columns, the key, then the fields of the layout. All records
    of a frame are decoded; ``record_no`` counts them and can be kept.

    Frames of other kinds and undecodable frames are left out; the latter are in
    :func:`dead_letters`.
    """
    # Frames of other kinds are sorted out by their head, before anything is split.
    of_kind = frames.filter(F.col(frame_col).rlike(rf"^0[^|]*\|{layout.tr_id}(\||$)"))
    split = split_frames(of_kind, (layout,), frame_col).withColumn("_plain", _looks(layout, False))
    fields = [by_policy(_part(i), F.col("_plain"), rule).alias(name) for i, name, rule in layout.fields]
    record = F.when(_problem(layout).isNull(), F.struct(_part(0).alias("stock_code"), *fields))
    return _once(split, keep, record, "_record").select(*keep, "_record.*")


def decode_trades(frames: DataFrame, **options) -> DataFrame:
    return decode(frames, TRADE, **options)


def decode_expected(frames: DataFrame, **options) -> DataFrame:
    return decode(frames, EXPECTED, **options)


def decode_orderbook(frames: DataFrame, **options) -> DataFrame:
    return decode(frames, ORDER_BOOK, **options)


def orderbook_levels(book: DataFrame) -> DataFrame:
    """Replace the flat level columns by ``asks`` and ``bids``, arrays of (level, price, qty)."""

    def side(price: str, quantity: str) -> Column:
        return F.array(
            *[
                F.struct(
                    F.lit(n).alias("level"),
                    F.col(f"{price}{n}").alias("price"),
                    F.col(f"{quantity}{n}").alias("qty"),
                )
                for n in LEVELS
            ]
        )

    flat = [f"{name}{n}" for name in ("ASKP", "BIDP", "ASKP_RSQN", "BIDP_RSQN") for n in LEVELS]
    sides = {"asks": side("ASKP", "ASKP_RSQN"), "bids": side("BIDP", "BIDP_RSQN")}
    return book.withColumns(sides).drop(*flat)


def _reason(layouts: Sequence[Layout]) -> Column:
    """Why no layout can decode a record; NULL for decodable records and for control
    messages."""
    known = F.coalesce(F.col("tr_id").isin([layout.tr_id for layout in layouts]), F.lit(False))
    reason = F.when(F.col("frame_class") == "unknown", "unknown_frame").when(
        (F.col("frame_class") == "data") & ~known, "unknown_tr"
    )
    for layout in layouts:
        reason = reason.when(F.col("tr_id") == layout.tr_id, _problem(layout))
    return reason


def dead_letters(
    frames: DataFrame,
    layouts: Sequence[Layout] = LAYOUTS,
    frame_col: str = "frame",
) -> DataFrame:
    """Records that no layout can decode, with their frame, ``record_no`` and ``reason``. Control messages
    are not among them. A frame whose number of records differs from the one it gives is not trusted: its
    whole records come here as ``bad_count``."""
    split = split_frames(frames, layouts, frame_col)
    return _once(split, [*frames.columns, "frame_class", "tr_id", "record_no"], _reason(layouts), "reason")


def publish_rows(
    frames: DataFrame,
    layouts: Sequence[Layout] = LAYOUTS,
    frame_col: str = "frame",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Kafka-ready rows ``topic, key, value``: topic = record kind, key = stock code, value = JSON.

    Numbers stay the text that was received, so no digit is added or lost. All kinds are handled
    in one pass over the frames. ``keep`` names further columns of the frames, or ``record_no``.
    """
    split = split_frames(frames, layouts, frame_col)
    plain, value = F.lit(False), F.lit(None).cast("string")
    for layout in layouts:
        message = F.struct(
            *[as_message_text(_part(i), F.col("_plain"), rule).alias(name) for i, name, rule in layout.fields]
        )
        text = F.to_json(message, {"ignoreNullFields": "false"})
        of_kind = F.col("tr_id") == layout.tr_id
        plain = F.when(of_kind, _looks(layout, False)).otherwise(plain)
        value = F.when(of_kind, text).otherwise(value)
    good = F.when((F.col("frame_class") == "data") & _reason(layouts).isNull(), value)
    rows = _once(split.withColumns({"topic": F.col("tr_id"), "key": _part(0), "_plain": plain}), ["topic", "key", *keep], good, "value")
    return rows.select("topic", "key", "value", *keep)
