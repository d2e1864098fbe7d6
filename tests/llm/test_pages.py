from __future__ import annotations

import base64
import hashlib
import html
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.llm import html_text, queries, warc
from tickloom.session import run_folder

PAGES = "page_id long, url string, html string, main_text string, n long"


@pytest.fixture(scope="module")
def odd_pages(spark, shipped):
    rows = [
        (0, "http://a.example/1", None, "m", 1), (1, None, "", "m", 1), (2, "http://a.example/2", "<p>x</p>" * 20_000, "m", 1),
        (3, "http://a.example/3\nX: y", "<p>ünï &amp; 漢</p>", "m", 1), (3, "http://a.example/3\nX: y", "<p>ünï &amp; 漢</p>", "m", 1),
        (4, "not a url", "<p>ünï &amp; 漢</p>", None, None), (None, "http://b.example", "<p>only</p>", None, None),
        (None, "http://b.example", "<p>ünï &amp; 漢</p>", None, None), (2**60 + 1, "http://c.example/big", "big", None, None), (5, "http://user@B.example:80/x", "<p>cut <b>off</p", "m", 1),
    ]
    return spark.createDataFrame(rows, PAGES)


# --- main text ----------------------------------------------------------------------------------


def plain_text(page: str) -> str:
    """For the pages of the test tables: the article's blocks."""
    article = page[page.index("<article>") + 9 : page.index("</article>")]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
    blocks = [re.sub(r"\s+", " ", html.unescape(b)).strip() for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_query_against_the_article(spark, small):
    rows = {r["page_id"]: r for r in queries.op9_html_text(spark, small).collect()}
    pages = pd.read_parquet(f"{small}/pages.parquet")
    assert len(rows) == len(pages)
    for page in pages.itertuples():
        assert rows[page.page_id]["text"] == plain_text(page.html)
        assert rows[page.page_id]["n_chars"] == len(plain_text(page.html))


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("", ""),
        ("plain &lt;text&gt;", "plain <text>"),
        ("<p>a<p>b <i>c</i>\n d", "a\n\nb c d"),
        ("<ul><li>a<li>b</ul>c", "a\n\nb\n\nc"),
        ("<body><header>H</header><main><h1>T</h1><p>a<script>if(a<b)</script>b</p></main><aside>z</aside>", "T\n\nab"),
        ("<article><p>x</p><div id='comments'><p>c</p></div><div class=\"ad-slot\">buy</div></article><footer>f</footer>", "x"),
        ("<article>one</article><article class='comment'>two</article>", "one"),
        ("<body><div class='cookie-notice'>n</div><form><p>f</p></form><p hidden>h</p><p>y</p>", "y"),
        ("a < b <c", "a < b <c"),
        ("<!-- never closed", ""),
        ("<p title='a>b'>q</p><style>p{}</style>", "q"),
        ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2\n\n3"),
        ("<div>" * 3000 + "deep", "deep"),
        ("<title>t</title><p>&eacute;&#233;&nbsp;x", "éé x"),
    ],
)
def test_page(source, text):
    assert html_text.Page(source).text() == text


def site(template: str, pages: int, host: str = "s.example") -> list[tuple]:
    return [
        (i, f"https://{host}/{i}", f"<body><div class='x'>{template}</div><div class='y'><p>story {host} number {i}</p><p>shared line</p></div>")
        for i in range(pages)
    ]


def test_templates_of_a_site_go(spark, shipped):
    rows = site("<ul><li>Home</li><li>About us</li></ul>", 30) + site("rare", 3, "t.example")
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {(r["url"]): r["main_text"] for r in html_text.extract(frame).collect()}
    assert found["https://s.example/4"] == "story s.example number 4\n\nshared line"
    assert found["https://t.example/1"] == "rare\n\nstory t.example number 1\n\nshared line"


def test_rare_templates_of_a_large_host_go(spark, shipped):
    """A box on 12 of 400 pages goes as it would from a small host."""
    rows = site("box of one section", 12, "l.example") + [
        (i, f"https://l.example/{i}", f"<body><div class='y'><p>story l.example number {i}</p></div>") for i in range(12, 400)
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["main_text"] for r in html_text.extract(frame).collect()}
    assert found[3] == "story l.example number 3\n\nshared line" and found[300] == "story l.example number 300"


def test_copies_of_a_page_are_no_template(spark, shipped):
    page = "<article><div><p>the same article</p></div></article>"
    frame = spark.createDataFrame([(i, "http://c.example/x", page) for i in range(40)], "page_id long, url string, html string")
    assert {r["main_text"] for r in html_text.extract(frame).collect()} == {"the same article"}


def test_near_copies_of_a_page_are_no_template(spark, shipped):
    """An article in a section, a list and a table, with another date line and last paragraph each time."""
    words = [f"word{i * 37 % 101} term{i}" for i in range(60)]
    body = (
        f"<section><p>{' '.join(words)}</p></section><ul><li>first item of the list</li><li>second item of it</li></ul>"
        "<table><tr><td>cell one</td><td>cell two</td></tr></table>"
    )
    rows = [(i, f"https://n.example/{i}", f"<article><p>Date {i}</p>{body}<p>Copy {i} ends.</p></article>") for i in range(40)]
    rows += [
        (100 + i, f"https://n.example/{i}x", f"<article><div>a box</div><p>{' '.join(f'own{i}x{k}' for k in range(30))}</p></article>")
        for i in range(12)
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    found = {r["page_id"]: r["main_text"] for r in html_text.extract(frame).collect()}
    for i in range(40):
        assert found[i] == "\n\n".join(
            [f"Date {i}", " ".join(words), "first item of the list", "second item of it", "cell one cell two", f"Copy {i} ends."]
        )
    assert all(found[100 + i].startswith(f"own{i}x0") for i in range(12))


def test_salted_templates_give_the_same(spark, shipped, monkeypatch):
    frame = spark.createDataFrame(site("<ul><li>Home</li></ul>", 30), "page_id long, url string, html string")
    expected = sorted(r["main_text"] for r in html_text.extract(frame).collect())
    monkeypatch.setattr(html_text, "is_small", lambda rows: False)
    assert sorted(r["main_text"] for r in html_text.extract(frame).collect()) == expected


def test_text_of_odd_pages(odd_pages):
    rows = html_text.extract(odd_pages)
    assert rows.count() == 10 and rows.columns.count("main_text") == 1
    assert rows.filter("page_id in (0, 1) and main_text = ''").count() == 2
    assert rows.filter("page_id = 2").first()["main_text"] == "\n\n".join(["x"] * 20_000)
    assert rows.filter("page_id = 5").first()["main_text"] == "cut off</p"
    assert html_text.extract(odd_pages.limit(0)).count() == 0


# --- archives -----------------------------------------------------------------------------------


def plain_records(pages: list[tuple]) -> list[tuple]:
    payloads = [(p, (h or "").encode()) for p, _, h, *_ in pages]
    top = {}
    for p, payload in payloads:
        if p is not None:
            top[payload] = max(top.get(payload, p), p)
    out = []
    for p, payload in payloads:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        best = top.get(payload)
        revisit = best is not None and (p is None or p < best)
        out.append((p, len(payload), digest, "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=str)


def records(rows) -> list[tuple]:
    return sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str)


def test_round_trip_of_odd_pages(odd_pages):
    assert records(warc.archive_round_trip(odd_pages).collect()) == plain_records(odd_pages.collect())
    assert warc.archive_round_trip(odd_pages.limit(0)).count() == 0


def test_hot_payload_is_sliced(spark, shipped, monkeypatch):
    monkeypatch.setattr(warc, "lookup", lambda *a: warc_lookup(*a, rows_per_slice=7))
    from tickloom.llm.skew import lookup as warc_lookup

    rows = [(i, f"http://h.example/{i}", "same" if i % 3 else f"own {i // 6}") for i in range(200)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    assert records(warc.archive_round_trip(frame).collect()) == plain_records(rows)


def test_selected_records_are_read_by_ranges(spark, small):
    folder = run_folder(spark, "warc-test")
    pages = queries.table(spark, small, "pages")
    index = warc.write_archives(pages, folder, archive_bytes=20_000)
    assert index.count() == pages.count() and index.select("file").distinct().count() > 1
    some = warc.read_records(index.filter(F.col("page_id") % 3 == 0), folder)
    source = {r["page_id"]: r for r in pages.collect()}
    got = some.collect()
    assert {r["page_id"] for r in got} == {p for p in source if p % 3 == 0}
    for r in got:
        assert r["url"] == source[r["page_id"]]["url"]
        if r["record_type"] == "response":
            assert bytes(r["payload"]).decode() == source[r["page_id"]]["html"]


def test_damage_is_noticed():
    raw, _ = warc.record(1, "http://x", b"payload", None, warc.EPOCH)
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(raw.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"))


def test_roots_keep_their_text_whatever_their_class():
    for tag, mark in (("body", "post comments-open"), ("html", "no-js has-sidebar"), ("body", "menu-open"), ("html", "comments")):
        inner = "<article><p>Hi there</p></article>"
        page = f'<html class="{mark}"><body>{inner}</body></html>' if tag == "html" else f'<body class="{mark}">{inner}</body>'
        assert html_text.Page(page).text() == "Hi there"
    assert html_text.Page('<article class="post has-comments" hidden><p>Hi</p></article>').text() == "Hi"
    assert html_text.Page('<main id="respond"><p>Hi</p></main>').text() == "Hi"


def test_an_article_loses_only_what_is_no_article():
    kept = (
        '<h2 id="related">Related work</h2><p class="notice">Mind this</p><p hidden>Spoiler</p><noscript><p>Plain</p></noscript>'
        "<object>Shown instead</object><video>No video</video><map>A map</map>"
    )
    lost = '<div class="advert">Buy</div><ul class="comments"><li>First!</li></ul><form>Name</form><script>x()</script><nav>Home</nav>'
    text = html_text.Page(f"<body><noscript>Switch on</noscript><article>{kept}{lost}</article></body>").text()
    for words in ("Related work", "Mind this", "Spoiler", "Plain", "Shown instead", "No video", "A map"):
        assert words in text
    for words in ("Buy", "First!", "Name", "x()", "Home", "Switch on"):
        assert words not in text


def test_hostile_pages_take_linear_time():
    import time

    start = time.process_time()
    pages = {
        '<a "x' * 20_000: None,
        "<p>a</p>" + '<a "x" ' * 20_000: None,
        "<article><p>deep</p>" + "<div>" * 20_000 + "in" + "</div>" * 20_000: "deep\n\nin",
        "<nav>" * 20_000 + "gone": "",
        "<b>" * 20_000 + "<p>x</p>": "x",
        "<i>" * 10_000 + "</u>" * 10_000 + "y": "y",
    }
    for page, text in pages.items():
        found = html_text.Page(page)
        found.containers()
        assert text is None or found.text() == text
    assert time.process_time() - start < 10


def test_quotes_in_tags():
    text = lambda page: html_text.Page(page).text()
    assert text('<p title="a > b">x</p>') == "x"
    assert text("<p title='a > b' data-x=\"it's > fine\">x</p>") == "x"
    assert text('<p title="open>x</p>') == "x"
    assert text("1 < 2 <b") == "1 < 2 <b"
