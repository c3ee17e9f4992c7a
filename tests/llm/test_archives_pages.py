"""WARC bundles and HTML extraction against plain readings."""

import base64
import hashlib
import struct
import time

import pytest
import zstandard
from pyspark.sql import functions as F

from arrivo.llm import htmltext, warc
from arrivo.llm.common import table

SCHEMA = "page_id long, url string, html string, host string, digest string, bundle string"
ROWS = [(5, "http://a/x", "same"), (3, "http://a/y", "same"), (9, "http://b/\r\nz", "same"), (1, None, None), (2, "u", ""),
        (7, "u", "long é " * 400_000), (3, "http://a/y", "same"), (None, "u", "same"), (None, "u", "alone"),
        (2 ** 60 + 1, "u", "big id"), (2 ** 60 + 3, "u", "big id")]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in ROWS], SCHEMA)


def b32(t):
    return base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()


def test_round_trip(spark, pages):
    got = warc.read_bundles(warc.write_bundles(pages)).collect()
    assert len(got) == len(ROWS)
    first = {"same": 3, "": 1, "big id": 2 ** 60 + 1}
    texts = {(i, b32(t or "")): t or "" for i, _, t in ROWS}
    for r in got:
        t = texts[r.page_id, r.payload_digest]
        revisit = t in first and r.page_id != first[t]
        assert r.record_type == ("revisit" if revisit else "response")
        assert r.refers_to == (first[t] if revisit else None)
        assert r.payload_bytes == len(t.encode())
        assert r.payload is None if revisit else bytes(r.payload) == t.encode()


def test_whole_results_equal_the_sql(spark, tmp_path):
    import duckdb

    from arrivo.llm import registry
    made = spark.createDataFrame([r[:3] for r in ROWS], "page_id long, url string, html string")
    made.write.parquet(f"{tmp_path}/pages.parquet")
    for sf, files in (("/root/testdata/sf0.01", ""), (str(tmp_path), "/*.parquet")):
        con = duckdb.connect()
        con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet{files}')")
        want = con.execute(registry.ORACLE_SQL["op3_warc"])
        names = [d[0] for d in want.description]
        got = warc.op3_warc(spark, sf)
        assert got.columns == names
        assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want.fetchall()))


def test_small_payloads_are_responses(spark, pages):
    got = warc.read_bundles(warc.write_bundles(pages, min_bytes=5), with_payload=False)
    assert {r.payload_digest for r in got.filter("record_type = 'revisit'").collect()} == {b32("big id")}


def test_bundles_are_seekable_zstandard(spark):
    bundles = warc.write_bundles(table(spark, "/root/testdata/sf0.01", "pages").coalesce(1)).collect()
    name = bundles[0].bundle
    rows = sorted((r for r in bundles if r.bundle == name), key=lambda r: r.frame)
    data = b"".join(bytes(r.data) for r in rows)
    sizes = warc.read_seek_table(data)
    assert len(sizes) == len(rows) - 1
    at = 0
    for (packed, full), r in zip(sizes, rows):
        frame = zstandard.ZstdDecompressor().decompress(data[at:at + packed])
        assert len(frame) == full
        for x in r.records:
            fields = warc.parse_record(memoryview(frame)[x.offset:x.offset + x.length])
            assert fields["WARC-Page-ID"] == str(x.page_id)
        at += packed
    assert struct.unpack("<I", data[at:at + 4])[0] == warc.SKIPPABLE
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") >= sum(len(r.records) for r in rows)


def test_read_some_records(spark, pages):
    bundles = warc.write_bundles(pages)
    wanted = spark.createDataFrame([(7,), (1,), (1,)], "page_id long")
    assert sorted(r.page_id for r in warc.read_records(bundles, wanted).collect()) == [1, 7]


def test_http_records():
    head = warc.record_bytes(1, "HTTP://a/x", b"<p>a</p>", "D", None)
    assert b"\r\nContent-Type: application/http; msgtype=response\r\n" in head
    assert head.endswith(b"\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                         b"Content-Length: 8\r\n\r\n<p>a</p>\r\n\r\n")
    assert warc.parse_record(memoryview(head))["payload"] == b"<p>a</p>"
    again = warc.record_bytes(2, "http://a/y", b"<p>a</p>", "D", 1)
    assert warc.parse_record(memoryview(again))["payload"] == b""
    other = warc.record_bytes(3, None, b"HTTP/1.1 \r\n\r\n", "D", None)
    assert warc.parse_record(memoryview(other))["payload"] == b"HTTP/1.1 \r\n\r\n"


def test_files(spark, pages, tmp_path):
    bundles = warc.write_bundles(pages)
    folder = f"file://{tmp_path}/archives"
    for _ in range(2):  # a rerun leaves the same files
        made = {r.bundle: r.bytes for r in warc.write_files(bundles, folder).collect()}
    files = {f.name: f for f in (tmp_path / "archives").iterdir() if not f.name.endswith(".crc")}
    assert {n: f.stat().st_size for n, f in files.items()} == made
    for f in files.values():
        data = f.read_bytes()
        at = 0
        for packed, full in warc.read_seek_table(data):
            assert len(zstandard.ZstdDecompressor().decompress(data[at:at + packed])) == full
            at += packed
        records = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        assert records.startswith(b"WARC/1.1\r\n") and records.endswith(b"\r\n\r\n")
    wanted = spark.createDataFrame([(7,), (9,), (2 ** 60 + 3,)], "page_id long")
    got = {r.page_id: r for r in warc.read_files(warc.record_index(bundles), folder, wanted).collect()}
    assert set(got) == {7, 9, 2 ** 60 + 3}
    assert bytes(got[7].payload).decode() == "long é " * 400_000
    assert got[9].refers_to == 3 and got[2 ** 60 + 3].refers_to == 2 ** 60 + 1


def broken(bundles, how):
    rows = [r.asDict(recursive=True) for r in bundles.collect()]
    for r in rows if how == "size" else []:
        if r["footer"] is not None:
            sizes = warc.read_seek_table(bytes(r["footer"]))
            r["footer"] = r["data"] = warc.seek_table([(c + 1, d) for c, d in sizes])
    if how == "magic":
        rows = [r | ({"footer": bytes(r["footer"])[:-1] + b"x"} if r["footer"] is not None else {}) for r in rows]
    if how == "no footer":
        rows = [r for r in rows if r["footer"] is None]
    if how == "no frame":
        rows = [r for r in rows if r["footer"] is not None or r["frame"] > 0]
    return bundles.sparkSession.createDataFrame(rows, warc.FRAMES)


@pytest.mark.parametrize("how", ["size", "magic", "no footer", "no frame"])
def test_broken_bundles_raise(spark, pages, how):
    bundles = broken(warc.write_bundles(pages), how)
    with pytest.raises(Exception, match="seek table"):
        warc.read_bundles(bundles).collect()


def test_seek_tables_are_read_without_frames(spark, pages):
    bundles = warc.write_bundles(pages)
    plan = bundles.filter("footer IS NOT NULL").select("bundle", "footer")._jdf.queryExecution().toString()
    scan = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert scan and not any("data" in line.split("ReadSchema")[1] for line in scan)


def test_empty_tables(spark, pages):
    none = pages.limit(0)
    assert warc.read_bundles(warc.write_bundles(none)).count() == 0
    assert htmltext.extract(none).count() == 0


CASES = [
    ("<p>One <b>two</b>\n three<p>Four&nbsp;five &lt;x&gt;", "One two three\n\nFour five <x>"),
    ("<html><body><header>Site</header><nav><a href=/>x</a></nav><article><header><h1>T</h1></header><p>a<br>b</p>"
     "<div class='share-bar'>Share</div><section id=comments><p>nice</p></section></article><footer>f</footer>", "T\n\na b"),
    ("<body><main><h2>A &amp; B</h2><form><p>mail</p></form><ul><li>x<li>y</ul></main><aside>s</aside>", "A & B\n\nx\n\ny"),
    ("<body><div class='cookie-notice'>c</div><div id=text><p>t</p></div><div class=ad>buy</div>"
     "<ul><li><a>m1</a><li><a>m2</a></ul><div class=sidebar>s</div>", "t"),
    ("<article>a<script>if (1<2) {'</p>'}</script> b<style>p{}</style><!-- <p>no</p> -->c</article>", "a bc"),
    ("<table><tr><td>x<td>y<tr><td>z</table>", "x\n\ny\n\nz"),
    ("<div hidden>h</div><div style='display: none'>h</div><div aria-hidden=true>h</div><p>seen", "seen"),
    ("<article><p>cut off &am", "cut off &am"), ("plain text < 5", "plain text < 5"), ("", ""), ("<nav>only</nav>", ""),
    ("<article class=comment><p>no</p></article><article><p>yes</p></article>", "yes"),
    ("<p>" + "w " * 300_000 + "</p>", ("w " * 300_000).strip()),
    ("<a title='x > y'>t</a><p class=\"unclosed>u</p>", "t"),
]


@pytest.mark.parametrize("html,text", CASES[:-1])
def test_main_text(html, text):
    assert htmltext.main_text(html) == text


NAMED = [
    ("<div class='site no-sidebar'><article><p>a</p></article><div class=sidebar-left><p>s</p></div></div>", "a"),
    ("<div id=page class='content has-sidebar'><p>a</p><div class='left-sidebar'>s</div></div>", "a"),
    ("<article class='post share-enabled'><section id='related-work'><h2 id='social-history'>T</h2>"
     "<p class='notice-text'>a</p></section><div class='post-comments'><p>no</p></div></article>", "T\n\na"),
    ("<div class=widget><main><p>a</p></main></div><p>b</p>", "a"),
    ("<div class='page modal'><article><p>a</p></article></div><div class=related><p>r</p></div>", "a"),
    ("<article><p>a</p></article><div class=related-posts><article><p>r</p></article></div>", "a"),
    ("<article><h1>T</h1><div class='x-widget'><p>long text</p></div><div class='x-widget'><p>more</p></div></article>",
     "T\n\nlong text\n\nmore"),
    ("<p>post</p><div class=comments><p>a longer comment</p></div><div class='social-links'>x</div>", "post"),
    ("<p>t</p><ol><li><a>Smith and Jones, On the growth of trees</a><li><a>Miller, A history of the wheel</a></ol>"
     "<ul><li><a>About us</a><li><a>Contact</a></ul>",
     "t\n\nSmith and Jones, On the growth of trees\n\nMiller, A history of the wheel"),
]


@pytest.mark.parametrize("html,text", NAMED)
def test_names_do_not_take_the_article(html, text):
    assert htmltext.main_text(html) == text


def test_broken_markup_does_not_raise():
    for html in (CASES[-1][0], "<", "<>", "</p></div>", "<!--", "<script>", "<p " + "a=' " * 999, "<b>" * 5000 + "deep"):
        assert isinstance(htmltext.main_text(html), str)
        list(htmltext.style_nodes(htmltext.parse(html)))


def site(i):
    return (f"<body><div class=top{i}><p>Welcome to our site</p><span>Best offers</span></div><div class=text><p>Story {i} "
            f"tells {i * 7}</p><p>Shared passage</p></div><div><div class=foot><p>All rights</p></div></div></body>")


def test_style_tree_removes_what_a_site_repeats(spark):
    rows = [(i, f"http://Big.example/{i}", site(i)) for i in range(40)] + [(100 + i, None, site(i)) for i in range(3)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
           .collect()}
    assert all(got[i] == f"Story {i} tells {i * 7}\n\nShared passage" for i in range(40))
    assert got[101].startswith("Welcome")  # too few pages to judge


def test_declared_articles_stay_whole(spark):
    page = "<body><div class=x>Menu words</div><article><h1>Same title</h1><p>Same story</p></article></body>"
    rows = [(i, "http://copies.example/", page) for i in range(30)] + [(99, "http://copies.example/", None)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.text for r in got.filter("page_id < 99").collect()} == {"Same title\n\nSame story"}
    last = got.filter("page_id = 99").first()
    assert (last.text, last.n_chars) == ("", 0)


PAGE = "page_id long, url string, html string"


def test_copies_keep_their_text(spark):
    copy = "<body><div class=content><p>A</p><p>B</p></div></body>"
    unique = "<body><div class=content>" + "".join(f"<p>Unique {{0}} {k}</p>" for k in range(5)) + "</div></body>"
    rows = [(i, "http://hot.example/", copy) for i in range(2000)] + [(i, None, copy) for i in range(2000, 2010)]
    rows += [(5000 + i, "http://hot.example/", unique.format(i)) for i in range(100)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert len(got) == len(rows) and {got[i] for i in range(2010)} == {"A\n\nB"}
    assert all(got[5000 + i] == "\n\n".join(f"Unique {i} {k}" for k in range(5)) for i in range(100))


def test_wrapped_articles_and_main_branches_stay(spark):
    # the same story on pages that differ elsewhere, with and without a declared article
    wrapped = "<body><p>Day {0}</p><article><div class=wrap><section><p>Same story</p></section></div></article></body>"
    plain = ("<body><div class=top>Welcome</div><div class=day>Day {0}</div><div class=story><h2>Same title</h2>"
             "<div class=part>Same long story</div><div class=part>It goes on and on</div></div></body>")
    rows = [(i, "http://a.example/", wrapped.format(i)) for i in range(30)]
    rows += [(100 + i, "http://b.example/", plain.format(i)) for i in range(30)]
    got = {r.page_id: r.text for r in htmltext.extract(spark.createDataFrame(rows, PAGE)).collect()}
    assert all(got[i] == "Same story" for i in range(30))
    assert all(got[100 + i] == f"Day {i}\n\nSame title\n\nSame long story\n\nIt goes on and on" for i in range(30))


def test_importance_formula(spark):
    rows = [(i, "http://h.example/", f"<body><div><p>{'a' if i % 4 else i}</p></div></body>") for i in range(16)]
    noise = htmltext.site_noise(spark.createDataFrame(rows, "page_id long, url string, html string"))
    # texts: one seen 12 times, four seen once; layouts all alike
    assert noise.count() == 1 and noise.select(F.size("noisy")).first()[0] >= 2


def test_pages_of_the_table(spark):
    import re
    got = htmltext.op10_html_extraction(spark, "/root/testdata/sf0.01").collect()
    html = {r.page_id: r.html for r in table(spark, "/root/testdata/sf0.01", "pages").collect()}
    assert len(got) == len(html)
    for r in got:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", html[r.page_id], re.S)[1]
        words = re.sub(r"<[^>]*>", " ", inner)
        assert len(words.split()) == len(r.text.split()) and r.n_chars == len(r.text)


@pytest.mark.parametrize("opened", ["font", "div", "p", "li", "ul><li", "b><h2", "table><tr><td", "main", "a",
                                    "div class=menu", "div class=menu><p"])
def test_deep_nesting(opened):
    """No recursion, and work that grows with the page's length."""
    tags = opened.split("><")
    page = f"<{opened}>" * 5000 + "<article><p>deep text</p></article>" + "".join(
        f"</{t.split()[0]}>" for t in tags[::-1]) * 5000
    assert htmltext.main_text(page) == "deep text"
    assert len(list(htmltext.style_nodes(htmltext.parse(page)))) > 1
    long = (f"<{opened}>x " * (300_000 // (len(opened) + 4))) + "</b></i>" * 20_000
    began = time.process_time()
    nodes = frozenset(n[0] for n in htmltext.style_nodes(htmltext.parse(long)))
    for noisy in (frozenset(), nodes):
        htmltext.main_text(long, noisy)
    assert time.process_time() - began < 20


def test_deep_page_among_others(spark):
    rows = [(1, "http://a.b/1", "<font>" * 1500 + "<article>deep</article>"), (2, "http://a.b/2", "<p>plain text</p>")]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {1: "deep", 2: "plain text"}


def test_teasers_are_no_article():
    story = "<article><h1>Head</h1><p>Long story <a href=x>with a link</a> in it.</p></article>"
    teasers = "".join(f"<article><a href={i}>teaser {i}</a></article>" for i in range(3))
    assert htmltext.main_text(story + teasers) == "Head\n\nLong story with a link in it."
    assert htmltext.main_text(teasers) == "teaser 0\n\nteaser 1\n\nteaser 2"
    assert htmltext.main_text(story + story) == "\n\n".join(["Head\n\nLong story with a link in it."] * 2)
