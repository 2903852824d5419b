"""WARC files, url filter and HTML text."""

import base64
import hashlib
import io
import random
import re
import zlib
from hashlib import sha256

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import htmltext, urls, warc
from marquee.llm.frames import table
from marquee.llm.queries import URL_RULES, op5_warc, op7_url_filter, op9_html_text

SF = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, verdict int"


def members(raw, start, end):
    return list(warc.members(pa.PythonFile(io.BytesIO(raw), "r"), start, end))


@pytest.fixture(scope="module")
def archive():
    rng = random.Random(4)
    bodies = [rng.randbytes(n) + warc.MAGIC + b"WARC/1.1\r\n" for n in (0, 10, 5000, 70_000, 300, 2000)]
    bodies += [zlib.compressobj(0, zlib.DEFLATED, 31).compress(b"WARC/9") + b"x" * 40, b"", warc.MAGIC * 500]
    records = [warc.record(i, f"http://x/{i} %\r\né", b, sha256(b).hexdigest(), None) for i, b in enumerate(bodies)]
    return bodies, records, b"".join(records)


@pytest.mark.parametrize("read_bytes", [7, 100, 1 << 20])
def test_any_split_owns_the_records_that_start_in_it(archive, monkeypatch, read_bytes):
    monkeypatch.setattr(warc, "READ_BYTES", read_bytes)
    bodies, records, raw = archive
    starts = [sum(map(len, records[:i])) for i in range(len(records))]
    for size in (97, 1000, 20_000, len(raw)) if read_bytes > 7 else (20_000,):
        got = [(a, warc.parse(c)) for a in range(0, len(raw), size) for c in members(raw, a, min(a + size, len(raw)))]
        assert [r["block"].partition(b"\r\n\r\n")[2] for _, r in got] == bodies
        assert [a for a, _ in got] == [s // size * size for s in starts]


def test_damage_costs_only_the_damaged_record(archive):
    bodies, records, raw = archive
    cut = len(records[0]) + len(records[1])
    broken = bytearray(raw)
    broken[cut + 600:cut + 640] = b"\0" * 40
    got = [warc.parse(c)["warc-record-id"] for c in members(bytes(broken), 0, len(raw))]
    assert got == [f"<urn:page:{i}>" for i in range(len(records)) if i != 2]
    assert len(members(raw[:-5], 0, len(raw))) == len(records) - 1


def plain_records(rows):
    first = {}
    for page, _, html in rows:
        raw = (html or "").encode()
        if len(raw) >= 100 and page is not None:
            first[raw] = min(page, first.get(raw, page))
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        refers = first.get(raw) if page is not None and first.get(raw) != page else None
        out.append((page, len(raw), sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers, True))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    rows = [(r["page_id"], r["url"], r["html"]) for r in table(spark, SF, "pages").collect()]
    rows += [(9000 + k, f"http://copy/{k}", "é" * 50) for k in range(40)]     # 100 bytes, one group
    rows += [(9100 + k, None, "x" * 99) for k in range(3)]                    # too short to revisit
    rows += [(9200, "http://a\r\nInjected: 1", None), (9201, "", ""), (9000, "http://again", "é" * 50),
             (None, "u", "no id " * 40), (-7, "u", "no id " * 40)]
    pages = spark.createDataFrame([(*r, "", 1) for r in rows], PAGES)
    out = warc.round_trip(pages)
    got = sorted((tuple(r)[:1] + tuple(r)[2:] for r in out.collect()), key=str)
    assert got == plain_records(rows)
    assert sorted((r["url"] for r in out.collect()), key=str) == sorted((u for _, u, _ in rows), key=str)
    assert warc.round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_long_headers_and_foreign_records(spark, tmp_path):
    url = "http://long/" + "x" * 120_000
    pages = spark.createDataFrame([(1, "http://a", "one" * 50, "", 0), (2, url, "two" * 50, "", 0), (3, url + "y", None, "", 0)], PAGES)
    archives = warc.write(pages, str(tmp_path / "long"))
    for size in (500, 1 << 20):  # also where a range looks at such a header first
        got = {r["page_id"]: r["url"] for r in warc.read(archives, size).collect()}
        assert got == {1: "http://a", 2: url, 3: url + "y"}

    def member(version, head, block):
        coder = zlib.compressobj(6, zlib.DEFLATED, 31)
        lines = "".join(f"{k}: {v}\r\n" for k, v in head.items())
        return coder.compress(f"WARC/{version}\r\n{lines}Content-Length: {len(block)}\r\n\r\n".encode() + block
                              + b"\r\n\r\n") + coder.flush()
    body = b"<p>hello</p>"
    http = b"HTTP/1.0 200 OK\r\nServer: x\r\n\r\n" + body
    sha1 = base64.b32encode(hashlib.sha1(body).digest()).decode()
    raw = member("1.0", {"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:uuid:1>"}, b"software: y\r\n")
    raw += member("1.0", {"WARC-Type": "request", "WARC-Record-ID": "<urn:uuid:2>", "WARC-Target-URI": "http://f/%20",
                          "Content-Type": "application/http; msgtype=request"}, b"GET / HTTP/1.0\r\n\r\n")
    raw += member("1.0", {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:3>", "WARC-Target-URI": "http://f/%20",
                          "Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": f"sha1:{sha1}"}, http)
    raw += member("1.1", {"WARC-Type": "response", "WARC-Record-ID": "<urn:uuid:4>",
                          "Content-Type": "application/http;\r\n msgtype=response", "WARC-Payload-Digest": "sha1:WRONG"}, http)
    raw += member("1.1", {"WARC-Type": "revisit", "WARC-Record-ID": "<urn:uuid:5>", "WARC-Payload-Digest": f"sha1:{sha1}"}, b"")
    (tmp_path / "foreign.warc.gz").write_bytes(raw)
    foreign = spark.createDataFrame([(str(tmp_path / "foreign.warc.gz"), len(raw))], "path string, bytes long")
    rows = sorted(warc.read(foreign, 200).collect(), key=lambda r: (r["record_type"], r["intact"]))
    assert [r["record_type"] for r in rows] == ["request", "response", "response", "revisit", "warcinfo"]
    assert [r["intact"] for r in rows] == [True, False, True, True, True] and {r["page_id"] for r in rows} == {None}
    assert rows[2]["url"] == "http://f/%20" and rows[2]["payload_digest"] == sha256(body).hexdigest()
    assert rows[2]["payload_bytes"] == len(body) and rows[3]["payload_bytes"] is None


def test_warc_query_has_the_contract_columns(spark):
    assert op5_warc(spark, SF).columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


# -- urls -----------------------------------------------------------------------


def plain_url(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.partition("://")[2], re.S).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.where), default=None)


URLS = [None, "", "no scheme", "http://", "://x", "http://EXAMPLE.org/es/1", "https://a.example.org/en/1?x#y",
        "http://example.org", "http://example.org/en/2", "http://notexample.org/es/", "http://org/", "http://x.com/fr/9",
        "http://com/de/", "ftp://A.B.com?/de/", "http://x.com/de/http://y.org/es/", "http://ÀÉ.org/é\nz", "http://x.com:80/de/",
        "http://cheap-pills-casino.net/win/free-bets", "http://" + "a." * 3000 + "org/" + "p/" * 3000]


def test_rules_and_parts_equal_brute_force_and_plans_stay_native(spark):
    rows = [(k, u, "", "", 0) for k, u in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, PAGES).unionByName(table(spark, SF, "pages").selectExpr(
        "page_id + 1000 page_id", "url", "html", "'' text", "0 verdict"))
    out = urls.filter_urls(pages, URL_RULES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    got = {r["page_id"]: r for r in out.collect()}
    seen = {r["page_id"]: r["url"] for r in pages.collect()}
    assert got.keys() == seen.keys()
    for page, url in seen.items():
        r = got[page]
        host, path = plain_url(url)
        rule = plain_rule(host, path, URL_RULES)
        said = "block" if r["blocked_probability"] >= 0.5 else "allow"
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (
            host, path, rule and rule.where, rule.verdict if rule else said)
    assert urls.filter_urls(spark.createDataFrame([], PAGES), []).count() == 0


def test_model_tells_unseen_urls_apart(spark):
    fresh = [(0, "http://www.casino-bonus.net/play", 1), (1, "http://cheap-pills-shop.org/x", 1), (2, "http://free-bets-4u.com/", 1),
             (3, "http://www.old-library.net/en/3", 0), (4, "http://blog.mornington.org/en/88", 0), (5, "http://weather.museum.com/de/1", 0)]
    pages = spark.createDataFrame([(i, u, "", "", 0) for i, u, _ in fresh], PAGES)
    got = {r["page_id"]: r["verdict"] for r in urls.filter_urls(pages, []).collect()}
    assert got == {i: "block" if bad else "allow" for i, _, bad in fresh}


def test_url_query_runs_in_a_session_that_has_observed_something(spark):
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    assert op7_url_filter(spark, SF).count() == table(spark, SF, "pages").count()
    op7_url_filter(spark, SF).write.format("noop").mode("overwrite").save()


def test_url_query_columns(spark):
    assert op7_url_filter(spark, SF).columns[:5] == ["page_id", "host", "path", "rule", "verdict"]


# -- HTML -----------------------------------------------------------------------

LONG = "This paragraph has commas, many words, and enough length to earn its points, as articles do. "


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("plain text", "plain text"), ("<p>a<p>b", "a b"), ("a < b <3 c", "a < b <3 c"),
    ("<!-- never", ""), ("<script>var t='<p>x</p>'</script><p>y</p>", "y"), ("<table><tr><td>a<td>b</table>", "a b"),
    ("<p>one&nbsp;two &amp;lt; &#233;<br>three\n  four</p>", "one two &lt; é three four"), ("<div>" * 5000 + "deep", "deep"),
    ("<p>in<b>li</b>ne <i>tags</i> glue</p>", "inline tags glue"),
    (f"<body><nav><a href=/>Home</a></nav><header><h1>Site</h1></header><article><h1>Title</h1><p>{LONG}</p><p>Second</article>"
     f"<aside><p>{LONG}</p></aside><footer>&copy; foot</footer>", f"Title {LONG.strip()} Second"),
    (f"<div id='cookie-notice'>{LONG}</div><div class=content><div class='sidebar'><p>{LONG}</p></div><div class=post><p>{LONG}</p>"
     f"<p>Next &amp; last</p><form><p>{LONG}</p></form></div><div class='comments'><p>{LONG}{LONG}</p></div></div>",
     f"{LONG.strip()} Next & last"),
    (f"<main><article><p>{LONG}</p><ul><li>kept item</li></ul><ul><li><a href=1>link one</a></li><li><a href=2>link two</a></li></ul>"
     f"</article></main>", f"{LONG.strip()} kept item link one link two"),
    (f"<div class=c><p>{LONG}</p><p>{LONG}</p><ul><li><a href=1>menu one</a></li><li><a href=2>menu two</a></li></ul></div>",
     f"{LONG.strip()} {LONG.strip()}"),
    ("<p>Before <span class='hidden'>x</span> after it.</p>", "Before after it."),
    ("<p>Before <span class='hidden'>x <span>y</span> z</span> after <i hidden>it</i>.</p><p>Next", "Before after . Next"),
    ("<p>Before <b class='ad'>x<p>Next <i class='share'>shared</i> line", "Before Next shared line"),
    (f"<article><h1 class='post-header'>Head</h1><p class='share'>{LONG}</p><blockquote class='alert'>Said</blockquote>"
     f"<div class='post-header'>By me</div><p class='ad'>buy</p></article>", f"Head {LONG.strip()} Said By me"),
    (f"<body><div class='search-results'><p>{LONG}</p></div><div class='search-box'>find</div>", LONG.strip()),
    (f"<body><nav><a href=/>Home</a><article><p>{LONG}</p></article>", LONG.strip()),
    (f"<body><nav><ul><li><a href=/>Home</a></ul><div><p>{LONG}</p></div>", LONG.strip()),
    (f"<body><nav><a href=/>Home</a><div>Menu</div></nav><div><p>{LONG}</p></div>", LONG.strip()),
    (f"<div class='header-image'><p>{LONG}</p></div><div class='sidebar-left'>x</div><div id='leftNav'>y</div>", LONG.strip()),
    (f"<article><header><h1>Headline</h1></header><p>{LONG}<!-- ad --></p><div class='ad'>buy</div>"
     f"<noscript>no</noscript><p style='display:none'>gone</p></article>", f"Headline {LONG.strip()}"),
])
def test_pages_give_their_main_text(page, text):
    assert htmltext.main_text(page) == text


@settings(max_examples=300, deadline=None)
@given(st.recursive(st.text("ab ", min_size=1, max_size=6), lambda inner: st.tuples(
    st.sampled_from(sorted(htmltext.INLINE - {"q"})), st.sampled_from(["", " class=x", " class='share tags'", " id=header"]),
    st.lists(inner, max_size=4)), max_leaves=12))
def test_inline_tags_never_lose_text(tree):
    def page(t):
        return t if isinstance(t, str) else f"<{t[0]}{t[1]}>{''.join(map(page, t[2]))}</{t[0]}>"

    def text(t):
        return t if isinstance(t, str) else "".join(map(text, t[2]))
    assert htmltext.main_text(f"<p>first {page(tree)} last</p>") == " ".join(f"first {text(tree)} last".split())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["<b hidden>", "<span class=hidden>", "<i>", "<span>", "</b>", "</i>", "</span>"]),
                          st.text("ab", max_size=3)), max_size=10))
def test_what_is_left_out_ends_with_its_block(parts):
    page = "<p>" + "".join(tag + text for tag, text in parts) + "</p><p>kept, whatever came before</p>"
    assert htmltext.main_text(page).endswith("kept, whatever came before")


def test_html_query_over_the_given_table_keeps_whole_articles(spark):
    import html
    pages = {r["page_id"]: r["html"] for r in table(spark, SF, "pages").collect()}
    out = op9_html_text(spark, SF).collect()
    assert len(out) == len(pages)
    for r in out:
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>?", " ", b)).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r["text"] == " ".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_html_edges_in_a_frame(spark):
    rows = [(1, None, None, "x", 0), (1, None, None, "x", 0), (None, "u", "<p>" + "word " * 200_000, "x", 0)]
    got = sorted((str(r["page_id"]), r["url"], r["n_chars"]) for r in htmltext.extract(spark.createDataFrame(rows, PAGES)).collect())
    assert got == [("1", None, 0), ("1", None, 0), ("None", "u", 999_999)]
    assert htmltext.extract(spark.createDataFrame([], PAGES)).count() == 0
