"""What streams remember, the order of messages, and records that are lost, late or replayed."""

from __future__ import annotations

import re
from datetime import datetime

import feed
import pytest
from pyspark.sql import functions as F
from test_plans import plan

from tickloom.functions.layouts import EXPECTED, Layout
from tickloom.operators import offsets, raw_schemas, sectors, sequence
from tickloom.plans import market, reconcile, replay
from tickloom.session import store
from tickloom.sources.archive import SCHEMA, archived_trades, compact_archive, copied_days, copy_days, list_days, read_whole_archive, write_archive
from tickloom.streaming.books import Ledger, Versions
from tickloom.streaming.publishing import start_publishing

ONCE = {"availableNow": True}


def _values(rows):
    return sorted(r[0] for r in rows.collect())


def test_versions_are_replaced_and_repeated(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "v"), "a int")
    rows = lambda *values: spark.createDataFrame([(v,) for v in values], "a int")
    assert table.last() == -1 and _values(table.before(0)) == []
    table.write(0, rows(1, 2))
    table.write(3, table.before(3).union(rows(3)))
    assert _values(table.before(3)) == [1, 2] and _values(table.before(4)) == [1, 2, 3]
    table.write(3, table.before(3).union(rows(4)))  # repeated
    assert _values(table.at(3)) == [1, 2, 4] and table.holds(3) and not table.holds(2)
    table.write(4)
    assert _values(table.before(5)) == [] and table.last() == 4
    assert _values(Versions(spark, str(tmp_path / "v"), "a int").before(4)) == [1, 2, 4]


def test_a_step_is_done_once(spark, tmp_path):
    done = []
    for batch in (0, 0, 1, 1):
        ledger = Ledger(spark, str(tmp_path / "l"))  # as after a restart
        for step in ("a", "b"):
            ledger.once(batch, step, lambda step=step, batch=batch: done.append((batch, step)))
    assert done == [(0, "a"), (0, "b"), (1, "a"), (1, "b")]
    with pytest.raises(ZeroDivisionError):
        ledger.once(2, "a", lambda: 1 / 0)
    assert not ledger.done(2, "a")


PLACED = "topic string, key string, value string, partition int, offset long, record_no int"


def test_sequence_holds_over_batches_and_drops_repeats(spark, tmp_path):
    schema = PLACED
    big = 1 << sequence.BUCKET
    batches = [
        [("t", "a", "3", 0, 2 * big, 0), ("t", "a", "1", 0, 5, 0), ("t", "a", "2", 0, 5, 1), ("t", "b", "1", 1, 0, 0), ("t", None, "1", 0, 6, 0)],
        [("t", "a", "1", 0, 5, 0), ("t", "a", "4", 0, 2 * big, 1), ("t", "a", "4", 0, 2 * big, 1), ("u", "a", "1", 0, 1, 0)],
        [],
        [("t", None, "2", 0, 7, 0), ("t", "a", "5", 1, 0, 0), ("t", "a", "6", 1, 3 * big, 0), ("t", "b", "1", 1, 0, 0)],
    ]
    got = []

    def sink(rows, batch_id):
        got.extend((r.topic, r.key, r.value, r.sequence) for r in rows.collect())

    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/feed")
    for rows in batches:
        spark.createDataFrame(rows, schema).repartition(3).write.mode("append").parquet(f"{tmp_path}/feed")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/feed")
        start_publishing(stream, f"{tmp_path}/c", sink, trigger=ONCE).awaitTermination()
    assert len(got) == 10 and all(value == str(number) for _, _, value, number in got)
    assert {(t, k) for t, k, _, _ in got} == {("t", "a"), ("t", "b"), ("t", None), ("u", "a")}


def test_sequence_survives_a_failed_sink(spark, tmp_path):
    spark.createDataFrame([("t", "a", "1", 0, 1, 0), ("t", "a", "2", 0, 2, 0)], PLACED).write.parquet(f"{tmp_path}/feed")
    got = []

    def broken(rows, batch_id):
        raise RuntimeError("down")

    def run(sink):
        stream = spark.readStream.schema(PLACED).parquet(f"{tmp_path}/feed")
        start_publishing(stream, f"{tmp_path}/c", sink, trigger=ONCE).awaitTermination()

    with pytest.raises(Exception, match="down"):
        run(broken)
    run(lambda rows, batch_id: got.extend((r.value, r.sequence) for r in rows.collect()))
    assert sorted(got) == [("1", 1), ("2", 2)]


def test_messages_are_not_shuffled_again_for_their_numbers(spark):
    rows = spark.range(200).selectExpr(
        "'t' as topic", "if(id % 9 = 0, null, string(id % 9)) as key", "repeat('x', 50) as value", "int(id % 2) as partition", "id as offset", "0 as record_no"
    )
    state = spark.createDataFrame([("t", None, 0, 18, 0, 7)], sequence.STATE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    fresh = sequence.fresh_rows(rows, state).persist()
    try:
        assert fresh.count() == 198  # of those without a key, offsets 0 and 18 of partition 0 were there before
        numbered = sequence.with_sequence(fresh, state)
        got = sorted(r["sequence"] for r in numbered.filter("key is null").collect())
        assert got == list(range(8, 8 + 21))
        moved = re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan(numbered))
        assert moved and not any("value" in columns for columns in moved)
    finally:
        fresh.unpersist()
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_missing_and_repeated_offsets(spark):
    edge = 1 << offsets.BUCKET
    rows = [("t", 0, n) for n in (*range(3, 10), *range(12, 14), *range(edge - 2, edge + 3), 5 * edge, 5 * edge + 1, 5, None)]
    rows += [("t", 1, 7), ("u", 0, 0), (None, 0, 4)]
    table = spark.createDataFrame(rows, "topic string, partition int, offset long")
    starts = spark.createDataFrame([("t", 0, 0), ("t", 2, 5), ("u", 0, 0), ("t", 1, 9)], "topic string, partition int, first_expected long")
    found = {tuple(r) for r in offsets.missing_offsets(table, starts).collect()}
    assert found == {
        ("t", 0, 0, 2, 3),
        ("t", 0, 10, 11, 2),
        ("t", 0, 14, edge - 3, edge - 16),
        ("t", 0, edge + 3, 5 * edge - 1, 4 * edge - 3),
        ("t", 2, 5, None, None),
    }
    assert [tuple(r) for r in offsets.repeated_offsets(table).collect()] == [("t", 0, 1)]
    assert offsets.missing_offsets(table.limit(0)).count() == 0


def _documents(spark, *rows):
    """Documents of (topic, offset, day of arrival)."""
    made = [("x", (topic, 0, offset, "k"), datetime(2025, 7, 1), datetime(2025, 7, 1), "", topic, day) for topic, offset, day in rows]
    return spark.createDataFrame(made, SCHEMA.replace("insert_day date", "insert_day string")).withColumn("insert_day", F.col("insert_day").cast("date"))


def test_archive_reads_each_day_from_one_place(spark, tmp_path):
    path, place = str(tmp_path / "raw"), str(tmp_path / "compacted")
    before = F.lit("2025-07-03").cast("date")

    def held(topic=None):
        return sorted(r["offset"] for r in read_whole_archive(spark, path, place, topic).select("metadata.offset").collect())

    write_archive(_documents(spark, ("A", 1, "2025-07-01"), ("B", 2, "2025-07-01"), ("A", 3, "2025-07-02"), ("A", 4, "2025-07-03")), path)
    assert held() == [1, 2, 3, 4]
    entries = copy_days(spark, path, place, before)
    assert held() == [1, 2, 3, 4]  # copied but not listed: a failure here changes nothing
    assert sorted((str(r.insert_day), r.version, r.documents) for r in entries.collect()) == [("2025-07-01", 0, 2), ("2025-07-02", 0, 1)]
    list_days(entries, place)
    assert held() == [1, 2, 3, 4] and held("B") == [2]
    write_archive(_documents(spark, ("A", 5, "2025-07-03"), ("A", 6, "2025-07-01")), path)  # one for a copied day
    assert held() == [1, 2, 3, 4, 5]
    for _ in range(2):
        compact_archive(spark, path, place, before)
        assert held() == [1, 2, 3, 4, 5, 6]
    assert sorted((str(r.insert_day), r.version, r.documents) for r in copied_days(spark, place).collect()) == [("2025-07-01", 1, 3), ("2025-07-02", 0, 1)]
    plan = read_whole_archive(spark, path, place, "A")._jdf.queryExecution().toString()
    assert plan.count("PartitionFilters: [") >= 2 and "PartitionFilters: []" not in plan
    trades = archived_trades(spark, path, "A", datetime(2025, 7, 1), datetime(2025, 7, 2), zone="UTC", compacted=place)
    assert trades.count() == 5


def test_schema_changes(spark):
    rows = [
        ("A", "2025-07-01", '{"a":1,"b":"x","n":{"z":1}}'),
        ("A", "2025-07-01", '{"a":2,"b":"x"}'),
        ("A", "2025-07-02", '{"a":"s","c":1.5,"n":{"z":1}}'),
        ("A", "2025-07-03", "[1]"),
        ("A", "2025-07-03", "{broken"),
        ("A", "2025-07-04", '{"b":"y","a":"t","n":{"z":"2"}}'),
        ("B", "2025-07-02", None),
        ("C", "2025-07-02", "{}"),
    ]
    documents = spark.createDataFrame(rows, "topic string, insert_day string, raw_data string")
    found = {(r.day, r.field, r.change): (r.type, r.type_before) for r in raw_schemas.field_changes(raw_schemas.day_fields(documents)).collect()}
    assert found == {
        ("2025-07-01", "a", "first day"): ("BIGINT", None),
        ("2025-07-01", "b", "first day"): ("STRING", None),
        ("2025-07-01", "n", "first day"): ("OBJECT<z: BIGINT>", None),
        ("2025-07-02", "a", "changes type"): ("STRING", "BIGINT"),
        ("2025-07-02", "b", "vanishes"): (None, "STRING"),
        ("2025-07-02", "c", "appears"): ("DECIMAL", None),
        ("2025-07-04", "b", "appears"): ("STRING", "STRING"),
        ("2025-07-04", "c", "vanishes"): (None, "DECIMAL"),
        ("2025-07-04", "n", "changes type"): ("OBJECT<z: STRING>", "OBJECT<z: BIGINT>"),
    }
    days = {(r.topic, r.day): (r.schema, r.documents, r.no_json) for r in raw_schemas.day_schemas(documents).collect()}
    assert days["A", "2025-07-01"] == ("OBJECT<a: BIGINT, b: STRING, n: OBJECT<z: BIGINT>>", 2, 0)
    assert days["A", "2025-07-03"] == ("ARRAY<BIGINT>", 2, 1)


def _sample(code, extra=""):
    return f"0|H0STANC0|001|{code}" + "^1" * 14 + extra


def test_replay_publishes_nothing_twice(spark):
    lines = [(0, 1, _sample("A")), (0, 2, _sample("A")), (0, 3, _sample("B", "^x")), (0, 4, "0|H0STANC0|001|C"), (0, 4, "0|H0STANC0|001|C"), (0, 5, "{}")]
    raw = spark.createDataFrame(lines, "partition int, offset long, frame string")
    feed_ = replay.with_frame_id(raw, ("partition", "offset"))
    wide = Layout(EXPECTED.tr_id, (*EXPECTED.fields, (15, "more", "text")))
    done, dead = replay.published(feed_, (wide,), 1), replay.letters(feed_, (wide,), 1)
    assert (done.count(), dead.count()) == (1, 3)
    for version in (2, 3):
        fresh, dead = replay.replay(dead, done, (EXPECTED,), version)
        done = done.unionByName(fresh)
    assert sorted((r.key, r.layout_version) for r in done.collect()) == [("A", 2), ("A", 2), ("B", 1)]
    assert [(r.reason, r.frame) for r in dead.collect()] == [("short_payload", "0|H0STANC0|001|C")]
    clean = replay.published(feed_, (EXPECTED,), 9)
    assert {(r.frame_id, r.record_no) for r in clean.collect()} == {(r.frame_id, r.record_no) for r in done.collect()}
    same = replay.with_frame_id(raw)
    assert replay.published(same, (EXPECTED,), 1).count() == 2  # without a place equal frames are one


def test_replay_moves_neither_frames_nor_messages(spark):
    record = "A" + "^1" * 14
    lines = [(0, n, f"0|H0STANC0|002|{record}^{record}") for n in range(5)]
    lines += [(0, 5, f"0|H0STANC0|002|{record}^B^1"), (0, 6, "0|H0STANC0|001|C"), (0, 6, "0|H0STANC0|001|C")]
    raw = spark.createDataFrame(lines, "partition int, offset long, frame string")
    feed_ = store(replay.with_frame_id(raw, ("partition", "offset")).filter("offset < 6"), "feed")
    done = store(replay.published(feed_, (EXPECTED,), 1), "published")
    dead = store(replay.letters(feed_, (EXPECTED,), 1), "letters")
    assert (done.count(), [r.record_no for r in dead.collect()]) == (11, [1])  # dead from its second record on
    for rows in (replay.published(feed_, (EXPECTED,), 1), replay.letters(feed_, (EXPECTED,), 1), replay.dead_frames(dead)):
        assert "Exchange hashpartitioning" not in plan(rows) and "SortAggregate" not in plan(rows)
    fresh, left = replay.replay(dead.union(dead), done, (EXPECTED,), 2)
    assert fresh.count() == 0 and [(r.record_no, r.layout_version) for r in left.collect()] == [(1, 2)]
    twice = replay.with_frame_id(raw, ("partition", "offset"))
    assert sorted(r.record_no for r in replay.letters(twice, (EXPECTED,), 1).collect()) == [0, 1]


def _reported(records):
    stats = market.market_stats(records).withColumn("report_date", F.to_date("window.start"))
    return stats.select("update_time", "stock_code", "vwap", "total_volume", "message_count", "report_date")


def test_reconciliation(spark, tmp_path):
    rows = [("1", 10, 1, 0), ("1", 20, 3, 10), (None, 10, 1, 5), ("2", 10, 1, 40), ("3", 7, 7, 90_000)]
    late = [("1", 30, 4, 20), (None, 50, 1, 6), ("4", 1, 1, 0)]
    everything = feed.records(spark, feed.trades(*rows, *late))
    path = str(tmp_path / "report")
    _reported(feed.records(spark, feed.trades(*rows))).write.partitionBy("report_date").parquet(path)
    untouched = sorted(p.name for p in (tmp_path / "report" / "report_date=2025-07-03").iterdir())
    lacking = feed.records(spark, feed.trades(*[r for r in rows + late if r[0] != "2"]))
    found = {(r.stock_code, r.reason): (r.message_count, r.archived) for r in reconcile.differences(spark.read.parquet(path), lacking).collect()}
    assert found == {
        ("1", "late records dropped"): (2, 3),
        (None, "late records dropped"): (1, 2),
        ("4", "not reported"): (0, 1),
        ("2", "archive behind"): (1, 0),
    }
    want = {tuple(r) for r in _reported(everything).collect()}
    assert {tuple(r) for r in reconcile.corrected(spark.read.parquet(path), lacking).collect()} == want
    reconcile.correct_table(spark.read.parquet(path), everything, path)
    again = spark.read.parquet(path).select("update_time", "stock_code", "vwap", "total_volume", "message_count", "report_date")
    assert {tuple(r) for r in again.collect()} == want and again.count() == len(want)
    assert sorted(p.name for p in (tmp_path / "report" / "report_date=2025-07-03").iterdir()) == untouched
    assert reconcile.differences(again, everything).count() == 0


def test_sectors_by_time(spark):
    day = lambda n: datetime(2025, 7, n)
    lists = {1: ["a", "b"], 2: ["a"], 3: ["a", "b", "b"], 5: ["c"]}
    rows = [("1", sector, "One", day(n)) for n, names in lists.items() for sector in names]
    history = sectors.validity(spark.createDataFrame(rows, "stock_code string, sector string, name string, valid_from timestamp"))
    assert {(r.sector, r.valid_from, r.valid_until) for r in history.collect()} == {
        ("a", None, day(5)),
        ("b", None, day(2)),
        ("b", day(3), day(5)),
        ("c", day(5), None),
    }
    starts = [datetime(2025, 6, 1), day(1), day(2), day(3), day(4), day(5), day(9)]
    windows = spark.createDataFrame([("1", (t, t)) for t in starts] + [(None, (day(1), day(1)))], "stock_code string, window struct<start:timestamp,end:timestamp>")
    found = {(r.stock_code, r.window.start): set() for r in windows.collect()}
    for r in sectors.enrich_windows(windows, history).collect():
        found[r.stock_code, r.window.start].add(r.sector)
    assert [found["1", t] for t in starts] == [{"a", "b"}, {"a", "b"}, {"a"}, {"a", "b"}, {"a", "b"}, {"c"}, {"c"}]
    assert found[None, day(1)] == {None}


def test_entry_takes_only_its_optional_part_for_granted():
    import __spark_entry__ as entry

    assert "tickloom" not in entry.OPTIONAL and "tickloom.llm" in entry.OPTIONAL
