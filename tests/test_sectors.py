from __future__ import annotations

import json

from pyspark.sql import functions as F

from tickloom.operators import sectors
from tickloom.sources.sectors import read_sectors, write_sectors

PAGES = [
    (0, "chips", '<a href="/item?code=005930">Samsung</a> <a href="/about">About</a> <a class="x" href="/item?code=000660">Hynix</a>'),
    (1, "phones", '<a href="/item?code=005930">SEC</a><a href="/item?code=12345">short</a>'),
    (7, "chips", '<a href="/item?code=005930">SEC</a>'),
    (8, "empty", "<p>none</p>"),
]


def _links(spark):
    pages = spark.createDataFrame(PAGES, "page int, sector string, html string").repartition(3)
    return sectors.sector_links(pages, F.col("sector"), F.col("page"), F.col("html"))


def test_sector_map_keeps_first_name_and_visit_order(spark):
    rows = {r.stock_code: r for r in sectors.sector_map(_links(spark)).collect()}
    assert set(rows) == {"005930", "000660"}
    assert rows["005930"].name == "Samsung"
    assert rows["005930"].sectors == ["chips", "phones", "chips"]


def test_long_lists_come_in_parts_and_read_back_whole(spark, tmp_path):
    entries = sectors.sector_map(_links(spark), per_row=2, pages_per_bucket=2)
    rows = sorted((r.stock_code, r.part, r.name, r.sectors) for r in entries.collect())
    assert rows == [
        ("000660", 0, "Hynix", ["chips"]),
        ("005930", 0, "Samsung", ["chips", "phones"]),
        ("005930", 1, "Samsung", ["chips"]),
    ]
    write_sectors(entries, str(tmp_path / "sectors"))
    dim = read_sectors(spark, str(tmp_path / "sectors"), multiline=False)
    assert sorted(map(tuple, dim.collect())) == [
        ("000660", "chips", "Hynix"),
        ("005930", "chips", "Samsung"),
        ("005930", "phones", "Samsung"),
    ]


def test_sector_file_as_one_array(spark, tmp_path):
    file = tmp_path / "sectors.json"
    entries = [
        {"stock_code": "005930", "name": "삼성전자", "sectors": ["반도체", "반도체", "휴대폰"]},
        {"stock_code": "000660", "name": "SK하이닉스", "sectors": []},
    ]
    file.write_text(json.dumps(entries, ensure_ascii=False, indent=4), encoding="utf-8")
    rows = sorted(map(tuple, read_sectors(spark, str(file)).collect()))
    assert rows == [("005930", "반도체", "삼성전자"), ("005930", "휴대폰", "삼성전자")]


def test_a_short_list_is_one_row_wherever_its_pages_are(spark):
    entries = sectors.sector_map(_links(spark), per_row=3, pages_per_bucket=2).collect()
    assert sorted((r.stock_code, r.part, r.sectors) for r in entries) == [
        ("000660", 0, ["chips"]),
        ("005930", 0, ["chips", "phones", "chips"]),
    ]


def test_anchors_of_any_spelling(spark):
    html = "<A class='x' HREF='/i?code=000001'><b>One</b></A><a\n href=\"/i?code=000002\" >\n Two </a><a name=x>no</a>"
    pages = spark.createDataFrame([(0, "s", html)], "page int, sector string, html string")
    links = sectors.sector_links(pages, F.col("sector"), F.col("page"), F.col("html")).collect()
    assert [(r.stock_code, r.name) for r in links] == [("000001", "One"), ("000002", "Two")]
