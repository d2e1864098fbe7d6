from __future__ import annotations

import json

import feed
import pytest
from pyspark.sql import functions as F

from tickloom.operators import raw_messages as raw
from tickloom.operators import joins, sectors, trades, vwap
from tickloom.plans import market

SPIKE = [("005930", 70200, 150, 0), ("005930", 73000, 500, 5), ("005930", 80000, 200, 10)]
NORMAL = [("005930", 70000, 100, -40), ("005930", 70100, 120, -39)]


def _stats(spark, rows, **options):
    parsed = trades.parse_trades(feed.records(spark, rows))
    return vwap.window_stats(vwap.window_sums(parsed, **options))


def test_spike_scenario(spark):
    stats = {r.window.start: r for r in _stats(spark, feed.trades(*NORMAL, *SPIKE)).collect()}
    spike = stats[feed.START]
    assert (spike.min_price, spike.max_price, spike.avg_price, spike.total_volume) == (70200, 80000, 74400, 850)
    assert spike.vwap == 63030000 / 850 == 74152.94117647059
    assert spike.update_time == "2025-07-02T00:00:00Z"
    odd = vwap.anomalies(_stats(spark, feed.trades(*NORMAL, *SPIKE))).collect()
    assert [r.window.start for r in odd] == [feed.START]


def test_update_time_carries_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    assert _stats(spark, feed.trades(*SPIKE)).first().update_time == "2025-07-02T09:00:00+09:00"


def test_prices_compare_as_numbers(spark):
    # As text "100000" sorts before "99000".
    row = _stats(spark, feed.trades(("1", "99000", 1, 0), ("1", "100000", 1, 1))).first()
    assert (row.min_price, row.max_price) == (99000, 100000)


def test_dirty_values_do_not_end_the_job(spark):
    rows = feed.trades(("1", "85100.50", "10", 0), ("1", "85100.60", "1e1", 1), ("1", "abc", "", 2))
    rows.append(feed.record("1", "{broken", 3, 9))
    rows.append(feed.record("1", '"text"', 3, 10))
    rows.append(feed.record("1", feed.message(9223372036854775807, 9), 4, 11))
    rows += feed.trades(("2", "100", "0", 0))
    rows.append(feed.record(None, feed.message(5, 5), 0, 12))
    stats = {r.stock_code: r for r in _stats(spark, rows).collect()}
    assert stats["1"].total_volume == 29 and stats["1"].message_count == 6
    assert stats["1"].min_price == 85100 and stats["1"].max_price == 9223372036854775807
    assert stats["1"].sum_price_volume == 85100 * 20 + 9223372036854775807 * 9
    assert stats["2"].vwap is None and stats["2"].total_volume == 0
    assert stats[None].vwap == 5.0


def test_mean_is_cut_off(spark):
    row = _stats(spark, feed.trades(("1", "1", 1, 0), ("1", "2", 1, 1), ("1", "2.9999", 1, 2))).first()
    assert row.avg_price == 1


def test_zero_prices_are_no_anomaly(spark):
    assert vwap.anomalies(_stats(spark, feed.trades(("1", 0, 1, 0), ("1", 100, 1, 1)))).count() == 0


@pytest.mark.parametrize(("prices", "odd"), [((100, 105), False), ((100, 100, 105), True), ((100, 100, 104), False)])
def test_thresholds(spark, prices, odd):
    # 100, 105: spread 5 % is enough, but 105 is 2.9 % above the mean of 102 (cut off).
    rows = feed.trades(*[("1", price, 1, n) for n, price in enumerate(prices)])
    assert (vwap.anomalies(_stats(spark, rows)).count() == 1) is odd


def test_malformed_messages(spark):
    rows = feed.trades(("1", 1, 1, 0))
    rows += [feed.record("1", "{broken", 1, 8), feed.record("1", '"text"', 1, 9)]
    bad = trades.malformed_messages(feed.records(spark, rows))
    assert {r.offset for r in bad.collect()} == {8, 9}
    assert set(bad.columns) == {"key", "value", "topic", "partition", "offset", "timestamp", "reason"}


def test_message_size_counts_bytes(spark):
    row = trades.parse_trades(feed.records(spark, [feed.record("1", '{"cttr":"확인"}', 0, 0)])).first()
    assert row.message_size_bytes == len('{"cttr":"확인"}'.encode()) and row.data.cttr == "확인"


def test_day_filter_follows_the_session_zone(spark):
    rows = feed.records(spark, feed.trades(("1", 1, 1, -1), ("1", 1, 1, 0)))
    day = F.lit("2025-07-02").cast("date")
    assert trades.on_day(rows, day).count() == 1
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    assert trades.on_day(rows, day).count() == 2
    assert trades.on_day(rows).count() == 0


def test_sector_fan_out(spark):
    entries = spark.createDataFrame(
        [("1", "one", ["a", "b", "a"]), ("2", "two", []), ("1", "one", ["b"]), ("4", "four", None)],
        "stock_code string, name string, sectors array<string>",
    )
    dim = sectors.sector_rows(entries)
    assert sorted(map(tuple, dim.collect())) == [("1", "a", "one"), ("1", "b", "one")]
    rows = feed.trades(("1", 10, 1, 0), ("2", 20, 2, 0), ("3", 30, 3, 0))
    rows.append(feed.record(None, feed.message(5, 5), 0, 12))
    result = market.vwap_report(feed.records(spark, rows), dim)
    assert sorted(((r.stock_code or "", r.sector or "", r.name, r.total_volume) for r in result.collect())) == [
        ("", "", None, 5),
        ("1", "a", "one", 1),
        ("1", "b", "one", 1),
        ("2", "", None, 2),
        ("3", "", None, 3),
    ]


def test_aggregate_then_join_equals_join_then_aggregate(spark, small):
    from tickloom.plans import tables

    records = tables.trade_records(tables.table(spark, small, "events"))
    dim = sectors.sector_rows(
        tables.sector_entries(tables.table(spark, small, "customer"), tables.table(spark, small, "orders"))
    )
    rows = trades.trade_numbers(sectors.enrich(trades.parse_trades(records), dim))
    joined_first = rows.groupBy(F.window("timestamp", "1 hour"), "stock_code", "sector", "name").agg(
        F.sum(F.col("whole_price") * F.col("volume")).alias("s"), F.sum("volume").alias("v")
    )
    a = {tuple(r) for r in joined_first.select(F.col("window.start"), "stock_code", "sector", "name", "s", "v").collect()}
    stats = sectors.enrich(market.market_stats(records, "1 hour"), dim)
    b = {
        tuple(r)
        for r in stats.select(
            F.col("window.start"), "stock_code", "sector", "name", "sum_price_volume", "total_volume"
        ).collect()
    }
    assert a == b


def test_skewed_join_is_whole(spark):
    """One stock holds most rows, NULL keys hold many; slices must not lose or repeat any."""
    rows = feed.trades(*[("hot", 1, 1, n) for n in range(300)], *[("cold", 1, 1, n) for n in range(5)])
    rows += [feed.record(None, feed.message(1, 1), n, 1000 + n) for n in range(120)]
    rows = [row[:4] + (n,) + row[5:] for n, row in enumerate(rows)]
    parsed = trades.parse_trades(feed.records(spark, rows), keep=market.IDS)
    dim = feed.dim(spark, ("hot", "a", "Hot"), ("hot", "b", "Hot"), ("cold", "a", "Cold"))
    plain = sectors.enrich(parsed, dim)
    small = sectors.enrich_rows(parsed, dim, market.IDS)
    sliced = sectors.enrich_rows(parsed, dim, market.IDS, limit=0, rows_per_slice=50)
    assert sliced.columns == small.columns == plain.columns
    pick = lambda df: sorted(map(str, df.select("offset", "stock_code", "sector", "name").collect()))
    assert pick(sliced) == pick(small) == pick(plain) and len(pick(sliced)) == 300 * 2 + 5 + 120


def test_broadcast_only_below_the_limit(spark):
    dim = feed.dim(spark, ("1", "a", "one"), ("2", "b", "two"))
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in plan(joins.checked_broadcast(dim))
    assert "ResolvedHint" not in plan(joins.checked_broadcast(dim, limit=10))


def _odd_records(spark, count):
    rows = feed.trades(*[("1", 100 if n % 2 else 200, n, n * 0.1) for n in range(count)], ("2", 5, 5, 0))
    return feed.records(spark, rows)


@pytest.mark.parametrize(("list_bytes", "parts"), [(1_000_000, 1), (4_000, 4)])
def test_long_message_lists_are_cut_but_whole(spark, list_bytes, parts):
    records = _odd_records(spark, 100)
    found = vwap.anomalies(market.market_stats(records))
    parsed = trades.parse_trades(records, keep=market.IDS)
    expected = sorted(r.original_message for r in parsed.filter("stock_code = '1'").collect())
    for limit in (0, raw.BROADCAST_LIMIT):
        rows = raw.with_messages(found, parsed, list_bytes=list_bytes, rows_per_slice=9, limit=limit).collect()
        assert {r.parts for r in rows} == {parts} and len(rows) == parts
        assert sorted(m for r in rows for m in r.raw_messages) == expected

    sliced = vwap.window_sums(parsed, slices=8)
    found = vwap.anomalies(vwap.window_stats(vwap.merge_slices(sliced)))
    rows = raw.with_sliced_messages(found, sliced, list_bytes=list_bytes).collect()
    assert sorted(m for r in rows for m in r.raw_messages) == expected
    assert {r.message_count for r in rows} == {100} and all(r.messages_complete for r in rows)


@pytest.mark.parametrize("limit", [0, raw.BROADCAST_LIMIT])
def test_no_anomaly_is_lost(spark, limit):
    """A missing stock code is a stock of its own; missing messages leave a list that says so."""
    spikes = [("1", 100, 1, 0), ("1", 200, 1, 1), ("2", 100, 1, 0), ("2", 200, 1, 1)]
    rows = feed.trades(*spikes) + [feed.record(None, feed.message(p, 1), n, 10 + n) for n, p in enumerate((100, 200))]
    records = feed.records(spark, rows)
    found = vwap.anomalies(market.market_stats(records))
    parsed = trades.parse_trades(records, keep=market.IDS)
    some = parsed.filter("stock_code is null or stock_code = '1' and offset = 0")
    got = {r.stock_code: r for r in raw.with_messages(found, some, limit=limit).collect()}
    assert {k: (len(r.raw_messages), r.messages_complete) for k, r in got.items()} == {
        "1": (1, False), "2": (0, False), None: (2, True),
    }
    sliced = vwap.window_sums(parsed, slices=2)
    assert raw.with_sliced_messages(found, sliced).filter("messages_complete").count() == 3


def test_only_what_is_broadcast_is_measured(spark):
    """Figures of a window that the look-up of messages does not need count nothing against the limit."""
    records = _odd_records(spark, 10)
    found = vwap.anomalies(market.market_stats(records)).withColumn("note", F.repeat(F.lit("x"), 5000))
    rows = raw.with_messages(found, trades.parse_trades(records, keep=market.IDS), limit=1000)
    assert "slice" not in rows._jdf.queryExecution().toString()  # of the join that shuffles
    assert [len(r.raw_messages) for r in rows.collect()] == [10]


def test_report_and_anomalies_from_one_aggregate(spark):
    dim = feed.dim(spark, ("005930", "chips", "Samsung"))
    records = feed.records(spark, feed.trades(*NORMAL, *SPIKE))
    report, odd = market.report_and_anomalies(records, dim)
    assert sorted(map(str, report.collect())) == sorted(map(str, market.vwap_report(records, dim).collect()))
    assert [len(r.raw_messages) for r in odd.collect()] == [3]


def test_envelope(spark):
    dim = feed.dim(spark, ("005930", "chips", "Samsung"))
    rows = market.anomaly_envelopes(feed.records(spark, feed.trades(*SPIKE)), dim).collect()
    assert [r.key for r in rows] == ["005930"]
    value = json.loads(rows[0].value)
    assert list(value) == list(vwap.MESSAGE_FIELDS)
    assert value["avg_price"] == 74400 and value["sector"] == "chips"
    assert sorted(json.loads(m)["stck_prpr"] for m in value["raw_messages"]) == ["70200", "73000", "80000"]
    unknown = market.anomaly_envelopes(feed.records(spark, feed.trades(*SPIKE)), dim.limit(0)).first()
    assert "sector" not in json.loads(unknown.value)
