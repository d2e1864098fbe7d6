"""Feeds and dimensions derived from general tables, so that the operators run on whole tables.

events -> trades: stock = user, price = value in cents, volume = ``k`` of the properties.
customer and orders -> sectors: name = customer name, sectors = order priorities of the customer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.layouts import EXPECTED, ORDER_BOOK, TRADE, Layout

EVENTS = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


# The user whose trades come without a key.
KEYLESS = 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events_stream(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` as a stream. A file stream takes a folder or a pattern, hence the pattern."""
    return spark.readStream.schema(EVENTS).parquet(f"{folder}/events.parque*")


def stock() -> Column:
    return F.col("user_id").cast("string")


def cents() -> Column:
    return F.round(F.col("value") * 100).cast("long")


def quantity() -> Column:
    return F.get_json_object("props", "$.k").try_cast("long")


def _message(volume: Column) -> Column:
    """The seven-field trade message, all values text."""
    texts = {
        "stck_prpr": cents(),
        "cntg_vol": volume,
        "acml_vol": F.col("event_id"),
        "acml_tr_pbmn": cents() * F.col("event_id"),
        "cttr": F.lit("100.00"),
        "total_askp_rsqn": F.lit("5000"),
        "total_bidp_rsqn": F.lit("5000"),
    }
    return F.to_json(F.struct(*[text.cast("string").alias(name) for name, text in texts.items()]))


def _records(events: DataFrame, topic: Column, time: str, text: Column | None = None) -> DataFrame:
    """Records of one stock have no key, so that missing keys are part of the data."""
    message = _message(quantity()) if text is None else text
    return events.select(
        F.when(F.col("user_id") != KEYLESS, F.encode(stock(), "utf-8")).alias("key"),
        F.encode(message, "utf-8").alias("value"),
        topic.alias("topic"),
        F.pmod(F.col("user_id"), F.lit(8)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast(time).alias("timestamp"),
    )


def trade_records(events: DataFrame, time: str = "timestamp_ntz") -> DataFrame:
    """Events as Kafka-shaped trade records. Streams need ``time="timestamp"``."""
    return _records(events, F.lit(TRADE.tr_id), time)


def _topic() -> Column:
    return (
        F.when(F.col("event_type") == "view", EXPECTED.tr_id)
        .when(F.col("event_type") == "click", ORDER_BOOK.tr_id)
        .otherwise(TRADE.tr_id)
    )


def topic_records(events: DataFrame, time: str = "timestamp") -> DataFrame:
    """The same records spread over the three topics by event type."""
    return _records(events, _topic(), time)


def dense_records(events: DataFrame) -> DataFrame:
    """Trade records whose offsets follow each other in each partition, without those of error events."""
    return trade_records(events.filter("event_type <> 'error'"), "timestamp").withColumns(
        {"partition": F.pmod("offset", F.lit(8)).cast("int"), "offset": F.shiftright("offset", 3)}
    )


# From when on messages have a venue, a number in place of text, and lack a member: midnights in Seoul on arrival.
NEW_FIELD, NEW_TYPE, NO_FIELD = "2024-01-11 14:59:58", "2024-01-17 14:59:58", "2024-01-23 14:59:58"


def changing_records(events: DataFrame) -> DataFrame:
    """Records of the three topics whose messages change their form three times."""

    def since(moment: str) -> Column:
        return F.col("ts") >= F.lit(moment).cast("timestamp_ntz")

    def message(venue: bool, number: bool, bid: bool) -> Column:
        members = [cents().cast("string").alias("stck_prpr"), quantity().alias("cntg_vol")]
        members.append(F.lit(100).alias("cttr") if number else F.lit("100.00").alias("cttr"))
        if bid:
            members.append(F.lit("5000").alias("total_bidp_rsqn"))
        if venue:
            members.append(F.lit("K").alias("venue"))
        return F.to_json(F.struct(*members))

    text = (
        F.when(since(NO_FIELD), message(True, True, False))
        .when(since(NEW_TYPE), message(True, True, True))
        .when(since(NEW_FIELD), message(True, False, True))
        .otherwise(message(False, False, True))
    )
    return _records(events, _topic(), "timestamp", text)


def broken_records(events: DataFrame) -> DataFrame:
    """Trade records where the messages of error events lack their last character and those of
    signups are a JSON string in place of an object."""
    message = _message(quantity())
    text = (
        F.when(F.col("event_type") == "error", F.substring(message, F.lit(1), F.length(message) - 1))
        .when(F.col("event_type") == "signup", F.lit('"no trade"'))
        .otherwise(message)
    )
    return _records(events, F.lit(TRADE.tr_id), "timestamp_ntz", text)


def record_count() -> Column:
    """One to three records in a frame."""
    return (1 + F.pmod(F.col("event_id"), F.lit(3))).cast("int")


def has_added_field() -> Column:
    """Frames whose count or length is off are left out: theirs cannot be told from a wrong count."""
    return (F.pmod(F.col("event_id"), F.lit(7)) == 0) & ~F.col("event_type").isin("signup", "click")


#: Most records in a frame.
MOST_RECORDS = 3


def _record(layout: Layout, fixed: dict[int, Column], blank: tuple[int, ...], cut: int | None, k: int) -> Column:
    """Record ``k`` of a frame. Numbers are cents plus position plus a thousand for each record before, odd
    positions with a fraction; error events leave the ``blank`` positions empty, the last record of signups
    ends before position ``cut``. Fixed values are those of the first record. Records of every seventh
    event have a field more than the layout knows."""
    as_text = [i for i, _, policy in layout.fields if policy == "text"]

    def part(i: int) -> Column:
        number = (F.col("_cents") + (i + 1000 * k)).cast("string")
        if i in fixed and (k == 0 or i != 2):
            value = fixed[i]
        elif i in as_text:
            value = F.concat("event_type", F.lit(str(i)))
        else:
            value = F.concat(number, F.lit(".25")) if i % 2 == 1 else number
        return F.when(F.col("event_type") == "error", "").otherwise(value) if i in blank else value

    parts = [part(i) for i in range(layout.width)]
    if cut is not None:
        short = (F.col("event_type") == "signup") & (record_count() == k + 1)
        parts[cut:] = [F.when(short, F.lit(None)).otherwise(F.array(*parts[cut:]))]
    return F.concat(F.concat_ws("^", *parts), F.when(has_added_field(), "^added").otherwise(""))


def _with_frame(
    events: DataFrame, layout: Layout, fixed: dict[int, Column], blank: tuple[int, ...], cut: int | None
) -> DataFrame:
    """The frame leaves through a generator, so that filters above do not build it again. The count is one
    too high in every fifth frame of clicks.

    Every part of a record is written out, as an expression over the parts one by one is interpreted for each of
    them. ``_numbers`` is computed beside the records, as its lambda keeps that projection out of whole-stage
    code: there all records would be one method, too long for the compiler of the virtual machine.
    """
    records = [F.when(record_count() > k, _record(layout, fixed, blank, cut, k)).alias(f"_record{k}") for k in range(MOST_RECORDS)]
    numbers = F.transform(F.sequence(F.lit(1), record_count()), lambda n: n).alias("_numbers")
    built = events.withColumn("_cents", cents()).select(*events.columns, *records, numbers)
    wrong = (F.col("event_type") == "click") & (F.pmod(F.col("event_id"), F.lit(5)) == 0)
    count = F.lpad((F.size("_numbers") + wrong.cast("int")).cast("string"), 3, "0")
    payload = F.concat_ws("^", *[f"_record{k}" for k in range(MOST_RECORDS)])
    frame = F.concat(F.lit(f"0|{layout.tr_id}|"), count, F.lit("|"), payload)
    return built.select(*events.columns, F.explode(F.array(frame)).alias("frame"))


def trade_frames(events: DataFrame) -> DataFrame:
    fixed = {
        0: stock(),
        1: F.date_format("ts", "HHmmss"),
        2: F.col("_cents").cast("string"),
        12: quantity().cast("string"),
        33: F.date_format("ts", "yyyyMMdd"),
    }
    return _with_frame(events, TRADE, fixed, (4,), 40)


def expected_frames(events: DataFrame) -> DataFrame:
    signup_text = F.when(F.col("event_type") == "signup", "n/a").otherwise((F.col("_cents") + 6).cast("string"))
    fixed = {0: stock(), 1: F.date_format("ts", "HHmmss"), 6: signup_text}
    return _with_frame(events, EXPECTED, fixed, (5,), None)


def orderbook_frames(events: DataFrame) -> DataFrame:
    fixed = {0: stock(), 1: F.date_format("ts", "HHmmss")}
    return _with_frame(events, ORDER_BOOK, fixed, (3, 47, 48, 49, 50), 50)


def mixed_frames(events: DataFrame) -> DataFrame:
    """Each event as one frame of every kind: the three record kinds, a record kind nobody knows,
    a control message and a line that is neither."""
    frames = events
    for n, make in enumerate((trade_frames, expected_frames, orderbook_frames)):
        frames = make(frames).withColumnRenamed("frame", f"_frame{n}")
    others = [
        F.concat(F.lit("0|H0STMKO0|001|"), stock(), F.lit("^"), F.col("event_type")),
        F.concat(F.lit('{"header":{"tr_id":"PINGPONG","datetime":"'), F.date_format("ts", "yyyyMMddHHmmss"), F.lit('"}}')),
        F.concat(F.lit("1|"), F.col("props")),
    ]
    lines = F.array("_frame0", "_frame1", "_frame2", *others)
    return frames.select("event_id", "event_type", F.posexplode(lines).alias("frame_no", "frame"))


def placed_frames(events: DataFrame) -> DataFrame:
    """Each event as a trade frame and an expected-execution frame, with their place in the source."""
    both = expected_frames(trade_frames(events).withColumnRenamed("frame", "_trade"))
    lines = both.select("event_id", "user_id", F.posexplode(F.array("_trade", "frame")).alias("_no", "frame"))
    return lines.select(
        "event_id", F.pmod("user_id", F.lit(8)).cast("int").alias("partition"), (2 * F.col("event_id") + F.col("_no")).alias("offset"), "frame"
    )


def sector_entries(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """``stock_code, name, sectors[]``; customers without orders have an empty list. There are few
    distinct priorities, so the lists are short."""
    lists = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_set("o_orderpriority")).alias("sectors"))
    return customer.join(lists, customer["c_custkey"] == lists["o_custkey"], "left").select(
        F.col("c_custkey").cast("string").alias("stock_code"),
        F.col("c_name").alias("name"),
        F.coalesce("sectors", F.array().cast("array<string>")).alias("sectors"),
    )


def lineitem_trades(lineitem: DataFrame) -> DataFrame:
    """Line items as trade rows: stock = part, price = cents per item, volume = quantity."""
    price = F.round(F.col("l_extendedprice") * 100).cast("long")
    return lineitem.select(
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_partkey").cast("string").alias("stock_code"),
        price.cast("decimal(24,4)").alias("price"),
        price.alias("whole_price"),
        F.col("l_quantity").cast("long").alias("volume"),
    )


def linked_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with stock links of several spellings added, and links that lead to no stock."""
    code = F.lpad((F.col("page_id") % 40).cast("string"), 6, "0")
    links = F.concat(
        F.lit('<A class="x" HREF=\'/item?code='), code, F.lit("'><b>stock "), code, F.lit('</b></A><a href="/item?code=12">short</a>'),
        F.lit('<a\n href="/sise?code='), F.lpad((F.col("page_id") % 7).cast("string"), 6, "9"), F.lit('">  nine </a>'),
    )
    return pages.withColumn("html", F.concat("html", links))
