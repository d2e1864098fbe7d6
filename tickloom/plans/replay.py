"""Dead letters decoded again after a layout was mended, and merged into what is published."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.layouts import Layout
from tickloom.operators import frames
from tickloom.operators.joins import checked_broadcast, is_small
from tickloom.session import store

#: What a published record is known by.
RECORD = ("frame_id", "record_no")
# For tables of frames and messages: long texts that are much alike.
COMPRESSION = "zstd"


def with_frame_id(feed: DataFrame, place: Sequence[str] = (), frame_col: str = "frame") -> DataFrame:
    """Add ``frame_id``, a hash of the frame and of its ``place`` in the source. Without a place equal frames are
    one and the same; with it (such as partition and offset) each delivery is a frame of its own."""
    text = F.to_json(F.struct(*place, F.col(frame_col).alias("frame")), {"ignoreNullFields": "false"})
    return feed.withColumn("frame_id", F.sha2(text, 256))


def frames_once(feed: DataFrame) -> DataFrame:
    """Rows, each ``frame_id`` once. Only the ids are shuffled: a frame that stands once stays where it is, and its
    records beside each other. ``feed`` is read twice, so it should be stored."""
    counts = feed.groupBy("frame_id").agg(F.count("*").alias("n"))
    repeated = store(counts.filter("n > 1").select(F.col("frame_id").alias("_repeated")), "repeated-frames")
    if not repeated.head(1):
        return feed
    if not is_small(repeated):
        return feed.dropDuplicates(["frame_id"])
    same = F.col("frame_id").eqNullSafe(F.col("_repeated"))
    again = feed.join(F.broadcast(repeated), same, "left_semi").dropDuplicates(["frame_id"])
    return feed.join(F.broadcast(repeated), same, "left_anti").unionByName(again)


def _published(feed: DataFrame, layouts: Sequence[Layout], version: int) -> DataFrame:
    return frames.publish_rows(feed, layouts, keep=RECORD).withColumn("layout_version", F.lit(version))


def _letters(feed: DataFrame, layouts: Sequence[Layout], version: int) -> DataFrame:
    found = frames.dead_letters(feed, layouts).select(*RECORD, "reason", "frame")
    return found.withColumn("layout_version", F.lit(version))


def published(feed: DataFrame, layouts: Sequence[Layout], version: int) -> DataFrame:
    """``frame_id, record_no, topic, key, value, layout_version``, each record once."""
    return _published(frames_once(feed), layouts, version)


def letters(feed: DataFrame, layouts: Sequence[Layout], version: int) -> DataFrame:
    """Dead letters to be kept: ``frame_id, record_no, reason, frame, layout_version``, each record once."""
    return _letters(frames_once(feed), layouts, version)


def dead_frames(dead: DataFrame) -> DataFrame:
    """``frame_id, frame`` of dead letters, each frame once: the one of its first dead record. That is the first of
    all as a rule; only where it is not are frames looked up by id."""
    first = dead.groupBy("frame_id").agg(F.min("record_no").alias("record_no"))
    late = store(first.filter("record_no > 0"), "late-frames")
    rest = dead.filter("record_no > 0").join(checked_broadcast(late), list(RECORD), "left_semi")
    return frames_once(dead.filter("record_no = 0").unionByName(rest.select(*dead.columns)).select("frame_id", "frame"))


def replay(dead: DataFrame, done: DataFrame, layouts: Sequence[Layout], version: int) -> tuple[DataFrame, DataFrame]:
    """Decode the frames of dead letters with other layouts: what is to be published now, stored, and the letters left.

    A frame is decoded as a whole, once however many of its records are dead, and a record that is published
    already (``done``) is left out, so a replay can be repeated and overlap with others. Both tables should be
    stored: of ``done`` only the two key columns are read and shuffled, and the records that dead frames have
    among them are broadcast if they are few, so that neither frames nor messages are shuffled.
    """
    whole = dead_frames(dead)
    known = store(done.select(*RECORD).join(dead.select("frame_id").distinct(), "frame_id", "left_semi"), "known")
    fresh = store(_published(whole, layouts, version).join(checked_broadcast(known), list(RECORD), "left_anti"), "replayed", COMPRESSION)
    return fresh, _letters(whole, layouts, version)
