from __future__ import annotations

import json
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tickloom.functions.clock import trade_instant
from tickloom.functions.layouts import EXPECTED, LAYOUTS, ORDER_BOOK, TRADE
from tickloom.operators import frames

# Sample payloads.
TRADE_SAMPLE = (
    "005930^090001^85000^2^1200^1.43^85100.50^84000^86000^83000^85000^84900^100^1234567^104938195000"
    "^5000^6000^1000^120.00^500000^600000^1^54.55^110.15^090000^2^1000^090500^5^-1000^090200^2^2000"
    "^20250702^2^N^1500^2500^15000^25000^1.23^1100000^112.23^0^00^85500"
)
EXPECTED_SAMPLE = "005930^085959^85000^2^1200^1.43^1234567^500^12000^8000^90000^70000^84000^86000^83000"
TRADE_RECORD = {
    "stock_code": "005930",
    "stck_cntg_hour": "090001",
    "stck_prpr": D("85000"),
    "prdy_vrss_sign": "2",
    "prdy_vrss": D("1200"),
    "prdy_ctrt": D("1.43"),
    "wghn_avrg_stck_prc": D("85100.50"),
    "stck_oprc": D("84000"),
    "stck_hgpr": D("86000"),
    "stck_lwpr": D("83000"),
    "askp1": D("85000"),
    "bidp1": D("84900"),
    "cntg_vol": D("100"),
    "acml_vol": D("1234567"),
    "acml_tr_pbmn": D("104938195000"),
    "seln_cntg_csnu": D("5000"),
    "shnu_cntg_csnu": D("6000"),
    "ntby_cntg_csnu": D("1000"),
    "cttr": D("120.00"),
    "seln_cntg_smtn": D("500000"),
    "shnu_cntg_smtn": D("600000"),
    "ccld_dvsn": "1",
    "shnu_rate": D("54.55"),
    "prdy_vol_vrss_acml_vol_rate": D("110.15"),
    "oprc_hour": "090000",
    "oprc_vrss_prpr_sign": "2",
    "oprc_vrss_prpr": D("1000"),
    "hgpr_hour": "090500",
    "hgpr_vrss_prpr_sign": "5",
    "hgpr_vrss_prpr": D("-1000"),
    "lwpr_hour": "090200",
    "lwpr_vrss_prpr_sign": "2",
    "lwpr_vrss_prpr": D("2000"),
    "bsop_date": "20250702",
    "new_mkop_cls_code": "2",
    "trht_yn": "N",
    "askp_rsqn1": D("1500"),
    "bidp_rsqn1": D("2500"),
    "total_askp_rsqn": D("15000"),
    "total_bidp_rsqn": D("25000"),
    "vol_tnrt": D("1.23"),
    "prdy_smns_hour_acml_vol": D("1100000"),
    "prdy_smns_hour_acml_vol_rate": D("112.23"),
    "hour_cls_code": "0",
    "mrkt_trtm_cls_code": "00",
    "vi_stnd_prc": D("85500"),
}


def _frames(spark, *lines):
    return spark.createDataFrame([(n, line) for n, line in enumerate(lines)], "n int, frame string")


def _frame(layout, payload):
    return f"0|{layout.tr_id}|001|{payload}"


def _with(payload, position, value):
    parts = payload.split("^")
    parts[position] = value
    return "^".join(parts)


def book_payload(**changes):
    parts = [str(1000 + i) for i in range(59)]
    parts[0], parts[1], parts[2], parts[51], parts[58] = "005930", "090001", "0", "2", "00"
    for position, value in changes.items():
        parts[int(position[1:])] = value
    return "^".join(parts)


def test_layout_sizes():
    assert [(x.tr_id, len(x.fields), x.width) for x in LAYOUTS] == [
        ("H0STCNT0", 45, 46),
        ("H0STANC0", 15, 15),
        ("H0STASP0", 59, 59),
    ]
    assert [i for i, _, rule in ORDER_BOOK.fields if rule == "null"] == [47, 48, 49, 50]


def test_trade_record(spark):
    row = frames.decode_trades(_frames(spark, _frame(TRADE, TRADE_SAMPLE))).first().asDict()
    assert row == TRADE_RECORD


def test_expected_record_and_blank_is_zero(spark):
    feed = _frames(spark, _frame(EXPECTED, EXPECTED_SAMPLE), _frame(EXPECTED, _with(EXPECTED_SAMPLE, 5, "")))
    first, second = [r.asDict() for r in frames.decode_expected(feed, keep=["n"]).orderBy("n").collect()]
    assert first["mksc_shrn_iscd"] == "005930" and first["stck_cntg_hour"] == "085959"
    assert [first[n] for _, n, rule in EXPECTED.fields if rule == "zero"] == [
        D(x) for x in "85000 1200 1.43 1234567 500 12000 8000 90000 70000 84000 86000 83000".split()
    ]
    assert second["prdy_ctrt"] == D(0)
    assert {k: v for k, v in second.items() if k not in ("n", "prdy_ctrt")} == {
        k: v for k, v in first.items() if k not in ("n", "prdy_ctrt")
    }


def test_orderbook_policies_and_levels(spark):
    feed = _frames(spark, _frame(ORDER_BOOK, book_payload(p3=" ", p47="", p50="  ", p51="", p52="")))
    book = frames.decode_orderbook(feed)
    row = book.first()
    assert row.ASKP1 == 0 and row.ASKP2 == 1004 and row.BIDP10 == 1022 and row.BIDP_RSQN10 == 1042
    assert row.ANTC_CNPR is None and row.ANTC_CNTG_VRSS is None and row.ANTC_CNQN == 1048
    assert row.ANTC_CNTG_VRSS_SIGN == "" and row.ANTC_CNTG_PRDY_CTRT == 0 and row.STCK_DEAL_CLS_CODE == "00"
    levels = frames.orderbook_levels(book).first()
    assert [(x.level, x.price, x.qty) for x in levels.asks][:2] == [(1, 0, 1023), (2, 1004, 1024)]
    assert [(x.level, x.price, x.qty) for x in levels.bids][-1] == (10, 1022, 1042)
    assert "ASKP1" not in levels.asDict()


def test_dead_letters_and_decoded_rows_share_out_the_frames(spark):
    lines = {
        _frame(TRADE, TRADE_SAMPLE): None,
        _frame(TRADE, _with(TRADE_SAMPLE, 2, "")): "bad_number",
        _frame(TRADE, _with(TRADE_SAMPLE, 12, "1x")): "bad_number",
        _frame(TRADE, "005930^090001"): "short_payload",
        "0|H0STCNT0": "short_payload",
        "0": "unknown_tr",
        _frame(EXPECTED, EXPECTED_SAMPLE): None,
        _frame(EXPECTED, _with(EXPECTED_SAMPLE, 5, "n/a")): "bad_number",
        _frame(ORDER_BOOK, book_payload(p47="")): None,
        "0|H0STMKO0|001|005930^1": "unknown_tr",
        '{"header":{"tr_id":"PINGPONG"}}': None,
        "1|H0STCNT0|001|encrypted": "unknown_frame",
        "": "unknown_frame",
    }
    feed = _frames(spark, *lines)
    found = {r.frame: r.reason for r in frames.dead_letters(feed).collect()}
    assert found == {line: reason for line, reason in lines.items() if reason}
    decoded = sum(frames.decode(feed, layout).count() for layout in LAYOUTS)
    controls = frames.classify(feed).filter("frame_class = 'control'").count()
    assert decoded + controls + len(found) == len(lines)
    assert frames.publish_rows(feed).count() == decoded


def test_several_records_in_one_frame(spark):
    two = EXPECTED_SAMPLE + "^" + EXPECTED_SAMPLE.replace("005930", "000660")
    trade = TRADE_SAMPLE + "^" + TRADE_SAMPLE + "^" + TRADE_SAMPLE
    lines = [f"0|H0STANC0|002|{two}", f"0|H0STCNT0|003|{trade}", f"0|H0STASP0|001|{book_payload()}"]
    feed = _frames(spark, *lines)
    both = frames.decode_expected(feed, keep=["record_no"]).collect()
    assert [(r.record_no, r.stock_code) for r in both] == [(0, "005930"), (1, "000660")]
    assert frames.decode_trades(feed).count() == 3 and frames.decode_orderbook(feed).count() == 1
    assert frames.dead_letters(feed).count() == 0 and frames.publish_rows(feed).count() == 6


def test_frames_with_another_number_of_records_than_they_say(spark):
    two = EXPECTED_SAMPLE + "^" + EXPECTED_SAMPLE
    lines = [f"0|H0STANC0|003|{two}", f"0|H0STANC0||{EXPECTED_SAMPLE}", f"0|H0STANC0|002|{EXPECTED_SAMPLE}^1^2"]
    feed = _frames(spark, *lines)
    found = sorted((r.frame, r.record_no, r.reason) for r in frames.dead_letters(feed).collect())
    assert found == sorted([(lines[0], 0, "bad_count"), (lines[0], 1, "bad_count"), (lines[1], 0, "bad_count"), (lines[2], 1, "short_payload")])
    assert frames.decode_expected(feed).count() == frames.publish_rows(feed).count() == 1


@pytest.mark.parametrize("layout", LAYOUTS, ids=lambda x: x.tr_id)
@pytest.mark.parametrize("records", [1, 3])
@pytest.mark.parametrize("added", [0, 1, 5])
def test_added_fields_are_left_aside(spark, layout, records, added):
    payload = {TRADE: TRADE_SAMPLE, EXPECTED: EXPECTED_SAMPLE, ORDER_BOOK: book_payload()}[layout]
    longer = "^".join([payload + "^new" * added] * records)
    plain = _frames(spark, _frame(layout, payload))
    feed = _frames(spark, f"0|{layout.tr_id}|{records:03d}|{longer}")
    assert frames.decode(feed, layout).collect() == frames.decode(plain, layout).collect() * records
    assert frames.publish_rows(feed).collect() == frames.publish_rows(plain).collect() * records
    assert frames.dead_letters(feed).count() == 0


def test_a_count_too_low_is_no_added_field(spark):
    """Twice the width is two records, whatever the frame says."""
    feed = _frames(spark, f"0|H0STANC0|001|{EXPECTED_SAMPLE}^{EXPECTED_SAMPLE}")
    assert [r.reason for r in frames.dead_letters(feed).collect()] == ["bad_count", "bad_count"]


@pytest.mark.parametrize("blank", ["", " ", "\t", "\r", " \t\r"])
def test_white_space_of_any_kind_is_blank(spark, blank):
    feed = _frames(spark, _frame(EXPECTED, _with(EXPECTED_SAMPLE, 14, blank)))
    assert frames.decode_expected(feed).first()["stck_lwpr"] == 0
    assert json.loads(frames.publish_rows(feed).first().value)["stck_lwpr"] == "0"


def test_published_message_keeps_the_received_digits(spark):
    feed = _frames(spark, _frame(TRADE, TRADE_SAMPLE), _frame(ORDER_BOOK, book_payload(p3="", p47="")))
    rows = {r.topic: r for r in frames.publish_rows(feed).collect()}
    assert rows["H0STCNT0"].key == "005930"
    message = json.loads(rows["H0STCNT0"].value)
    assert message["wghn_avrg_stck_prc"] == "85100.50" and message["cttr"] == "120.00"
    assert list(message) == [name for _, name, _ in TRADE.fields]
    book = json.loads(rows["H0STASP0"].value)
    assert book["ASKP1"] == "0" and book["ANTC_CNPR"] is None


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_trade_clock(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    decoded = frames.decode_trades(_frames(spark, _frame(TRADE, TRADE_SAMPLE)))
    moment = trade_instant(F.col("bsop_date"), F.col("stck_cntg_hour"), "Asia/Seoul")
    assert decoded.select(F.unix_seconds(moment)).first()[0] == 1751414401  # 2025-07-02T00:00:01Z
    bad = spark.createDataFrame([("2025", "xx")], "d string, t string")
    assert bad.select(trade_instant(F.col("d"), F.col("t"), "UTC")).first()[0] is None


@pytest.mark.parametrize("value", ["7", " 7\t", "+7", "7.", "7e0", "7.00000", "0" * 30 + "7"])
def test_numbers_in_any_spelling_are_read_as_alone(spark, value):
    """Records of plain digits are told at one look; others must come to the same."""
    feed = _frames(spark, _frame(TRADE, _with(TRADE_SAMPLE, 12, value)))
    assert frames.decode_trades(feed).first().asDict() == {**TRADE_RECORD, "cntg_vol": D(7)}
    assert json.loads(frames.publish_rows(feed).first().value)["cntg_vol"] == value.strip()
