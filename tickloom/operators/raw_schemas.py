"""Which fields raw messages have, by topic and day, and how that changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FIRST, APPEARS, VANISHES, CHANGES = "first day", "appears", "vanishes", "changes type"


def with_variant(documents: DataFrame, text: str = "raw_data") -> DataFrame:
    """Add ``message``: the raw text as a variant, NULL where it is no JSON."""
    return documents.withColumn("message", F.try_parse_json(F.col(text)))


def day_schemas(documents: DataFrame, day: str = "insert_day", text: str = "raw_data") -> DataFrame:
    """``topic, day, schema, documents, no_json``: the common schema of a topic's messages of a day, nested ones
    included. One pass with a map-side part; a schema is as large as a message's own."""
    rows = with_variant(documents, text)
    return rows.groupBy("topic", F.col(day).alias("day")).agg(
        F.schema_of_variant_agg("message").alias("schema"),
        F.count("*").alias("documents"),
        F.count_if(F.col("message").isNull()).alias("no_json"),
    )


def day_fields(documents: DataFrame, day: str = "insert_day", text: str = "raw_data") -> DataFrame:
    """``topic, day, field, type, documents``: the members of the messages that are objects, their common type
    over the day (VARIANT for types that have none in common) and in how many messages they stand. Decimals
    of any size are one type."""
    rows = with_variant(documents, text).select("topic", F.col(day).alias("day"), "message")
    objects = rows.filter(F.schema_of_variant("message").startswith("OBJECT"))
    session = documents.sparkSession
    members = objects.lateralJoin(session.tvf.variant_explode(F.col("message").outer()))
    kind = F.regexp_replace(F.schema_of_variant_agg("value"), r"^DECIMAL\(.*", "DECIMAL")
    return members.groupBy("topic", "day", F.col("key").alias("field")).agg(kind.alias("type"), F.count("*").alias("documents"))


def field_changes(fields: DataFrame) -> DataFrame:
    """``topic, day, field, change, type, type_before``: fields that appear, vanish or change their type, and those of
    the first day. ``fields`` comes from :func:`day_fields` (stored: it is used twice).

    A field vanishes on the first day of its topic on which no message has it. Days are those on which the
    topic has objects at all. The rows compared are one per topic, day and field."""
    days = fields.select("topic", "day").distinct()
    along = Window.partitionBy("topic").orderBy("day")
    numbered = days.select("topic", "day", F.row_number().over(along).alias("no"), F.lead("day").over(along).alias("next_day"))
    rows = fields.join(numbered, ["topic", "day"])
    history = Window.partitionBy("topic", "field").orderBy("no")
    seen = rows.withColumns(
        {"no_before": F.lag("no").over(history), "type_before": F.lag("type").over(history), "no_after": F.lead("no").over(history)}
    )
    came = F.when(F.col("no") == 1, FIRST).when(F.col("no_before").isNull() | (F.col("no_before") < F.col("no") - 1), APPEARS)
    change = came.when(F.col("type") != F.col("type_before"), CHANGES)
    here = seen.withColumn("change", change).filter("change is not null").select("topic", "day", "field", "change", "type", "type_before")
    gone = seen.filter("next_day is not null and (no_after is null or no_after > no + 1)")
    return here.unionByName(
        gone.select(
            "topic", F.col("next_day").alias("day"), "field", F.lit(VANISHES).alias("change"), F.lit(None).cast("string").alias("type"), F.col("type").alias("type_before")
        )
    )
