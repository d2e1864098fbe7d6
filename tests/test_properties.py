from __future__ import annotations

import feed
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickloom.operators import frames, trades, vwap
from tickloom.plans import market

trade = st.tuples(
    st.sampled_from(["a", "b"]), st.integers(1, 10**6), st.integers(0, 10**4), st.integers(0, 90)
)
some = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _by_hand(rows):
    groups = {}
    for stock, price, volume, second in rows:
        groups.setdefault((stock, second // 30), []).append((price, volume))
    found = {}
    for key, values in groups.items():
        prices = [p for p, _ in values]
        total = sum(v for _, v in values)
        price_volume = sum(p * v for p, v in values)
        mean = sum(prices) // len(prices)
        found[key] = (
            price_volume / total if total else None,
            total,
            min(prices),
            mean,
            max(prices),
            len(values),
        )
    return found


def _of(spark, rows, partitions, slices=None):
    records = feed.records(spark, feed.trades(*rows)).repartition(partitions)
    parsed = trades.parse_trades(records, keep=market.IDS)
    sums = vwap.window_sums(parsed, slices=slices)
    stats = vwap.window_stats(sums if slices is None else vwap.merge_slices(sums))
    return {
        (r.stock_code, int((r.window.start - feed.START).total_seconds()) // 30): (
            r.vwap, r.total_volume, r.min_price, r.avg_price, r.max_price, r.message_count
        )
        for r in stats.collect()
    }


@some
@given(st.lists(trade, min_size=1, max_size=40), st.randoms())
def test_statistics_do_not_depend_on_order_partitions_or_slices(spark, rows, random):
    expected = _by_hand(rows)
    shuffled = list(rows)
    random.shuffle(shuffled)
    assert _of(spark, rows, 1) == expected
    assert _of(spark, shuffled, 5) == expected
    assert _of(spark, shuffled, 3, slices=4) == expected


@some
@given(st.lists(trade, min_size=1, max_size=40))
def test_vwap_lies_between_lowest_and_highest_price(spark, rows):
    for vwap_, total, low, _, high, _ in _of(spark, rows, 2).values():
        assert vwap_ is None if total == 0 else low <= vwap_ * (1 + 1e-12) and vwap_ <= high * (1 + 1e-12)


line = st.text(alphabet="0|^{}H.STCNA1- \t", max_size=60) | st.sampled_from(
    ["0|H0STANC0|001|" + "^".join(["1"] * 15), "0|H0STANC0|001|" + "^".join([""] * 15)]
)


@some
@given(st.lists(line, min_size=1, max_size=30))
def test_each_line_is_decoded_control_or_dead_exactly_once(spark, lines):
    feed_ = spark.createDataFrame([(n, x) for n, x in enumerate(lines)], "n int, frame string")
    dead = [r.n for r in frames.dead_letters(feed_).collect()]
    control = [r.n for r in frames.classify(feed_).filter("frame_class = 'control'").collect()]
    decoded = [r.n for x in frames.LAYOUTS for r in frames.decode(feed_, x, keep=["n"]).collect()]
    assert sorted(dead + control + decoded) == list(range(len(lines)))
    assert frames.publish_rows(feed_).count() == len(decoded)
