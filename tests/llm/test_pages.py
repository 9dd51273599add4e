"""WARC round trips, URL rules against a plain version, main text of small pages."""

import gzip
import hashlib
import math
import time

import pytest
from llm_tables import SF_DIR
from hypothesis import given, settings, strategies as st

from claimward.llm import pagetext, urlfilter, warc
from claimward.llm.common import folder

PAGES = "page_id bigint, url string, html string, digest string, file int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "d", 1) for i, u, h in rows], PAGES)


BIG = "x" * 120


def test_records_and_revisits(spark):
    rows = [
        (5, "http://a/", BIG), (2, "http://b/", BIG), (9, None, BIG), (2, "http://b/", BIG), (None, "http://c/", BIG),
        (1, "http://d/\r\nX: y", "small"), (3, "u", "small"), (4, "u", None), (6, "u", ""), (7, "ü", "é" * 70_000),
    ]
    index = warc.write(warc.decided(pages(spark, rows)), folder(spark, "t"))
    back = warc.read(index).collect()
    assert len(back) == len(rows)
    kinds = sorted((r.page_id or -1, r.record_type, r.refers_to) for r in back)
    assert kinds == sorted(
        [(-1, "revisit", 2), (1, "response", None), (2, "response", None), (2, "response", None), (3, "response", None),
         (4, "response", None), (5, "revisit", 2), (6, "response", None), (7, "response", None), (9, "revisit", 2)],
    )
    html = {i: (h or "").encode() for i, _, h in rows}
    for r in back:
        assert r.payload_digest == hashlib.sha256(html[r.page_id]).hexdigest()
        assert r.payload_bytes == len(html[r.page_id])
        assert r.payload == (html[r.page_id] if r.record_type == "response" else None)
    one = index.filter("page_id = 7").first()
    with open(one.file.removeprefix("file:"), "rb") as source:
        source.seek(one.offset)
        assert gzip.decompress(source.read(one.length)).startswith(b"WARC/1.1\r\n")


def test_only_selected_records_are_read(spark):
    index = warc.write(warc.decided(spark.read.parquet(f"{SF_DIR}/pages.parquet")), folder(spark, "t"))
    some = index.filter("page_id % 7 = 0")
    assert warc.read(some).count() == some.count() > 0
    assert warc.read(index.filter("false")).count() == 0


def test_damage_is_noticed(spark):
    base = folder(spark, "t")
    index = warc.write(warc.decided(pages(spark, [(1, "u", BIG)])), base)
    row = index.first()
    member = warc.encode_record(
        {"page_id": 1, "url": "u", "payload": b"other", "digest": row.digest, "payload_bytes": 120,
         "record_type": "response", "refers_to": None}, "2020-01-01T00:00:00Z",
    )
    with open(row.file.removeprefix("file:"), "wb") as out:
        out.write(member)
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="damaged"):
        warc.read(index.withColumn("length", F.lit(len(member)).cast("bigint"))).collect()


def test_ranges_merge_neighbours():
    spots = [("a", 0, 10), ("a", 10, 5), ("a", 100, 5), ("b", 0, 3)]
    assert [r[:3] for r in warc.ranges(iter(spots), gap=20)] == [["a", 0, 15], ["a", 100, 105], ["b", 0, 3]]


def plain_judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [
        r for r in urlfilter.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.expression), default=None)
    return host, path, best and best.expression, best.verdict if best else "allow"


URLS = [
    None, "", "http://", "no scheme/en/", "http://NET/", "http://x.net", "http://x.net/", "http://example.net/en/1?q#f",
    "http://a.b.example.net/en/x", "http://example.net/en", "http://notexample.net/en/", "https://example.com/de/",
    "https://www.example.com/de/x/y", "https://example.com/DE/", "http://a.org/fr/", "http://org/fr/x", "http://a.org?fr/",
    "http://example.com/x/de/", "ftp://u:p@h.net:80/", "http://.net/", "http://a..net//", "http://x.net/" + "y/" * 3000,
    "http://x.net\n/de/", "x://y://z.net/",
]


def test_rules_equal_plain_version(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(3, "http://x.net/", None), (None, "http://a.org/fr/", None)]
    table = pages(spark, rows)
    judged = urlfilter.judge(table)
    assert judged.columns == [*table.columns, "host", "path", "rule", "verdict"]
    found = sorted(((r.page_id, r.url, (r.host, r.path, r.rule, r.verdict)) for r in judged.collect()), key=repr)
    assert found == sorted(((i, u, plain_judge(u)) for i, u, _ in rows), key=repr)
    assert urlfilter.judge(table.filter("false")).count() == 0


def test_deep_rules_and_given_columns(spark):
    rules = (urlfilter.Rule("block", "a.b.c.net", "/x/y/z/"), urlfilter.Rule("allow", "c.net", "/x/"), urlfilter.Rule("block", "net", "/"))
    rows = [
        (1, "http://q.a.b.c.net/x/y/z/1"), (2, "http://b.c.net/x/y/z/1"), (3, "http://c.net/y"), (4, "http://org/x/"),
        (5, "http://" + "s." * 3000 + "c.net/x" + "/y" * 500_000),
    ]
    table = spark.createDataFrame([(*r, "h", "p", "v") for r in rows], "page_id int, url string, host string, path string, verdict string")
    found = {r.page_id: (r.rule, r.verdict, r.given_host, r.given_path, r.given_verdict) for r in urlfilter.judge(table, rules).collect()}
    own = ("h", "p", "v")
    assert found == {
        1: ("a.b.c.net/x/y/z/", "block", *own), 2: ("c.net/x/", "allow", *own), 3: ("net/", "block", *own),
        4: (None, "allow", *own), 5: ("c.net/x/", "allow", *own),
    }
    assert urlfilter.judge(table, ()).filter("verdict = 'allow'").count() == 5


def test_rules_are_checked():
    for bad in (("ban", "net", "/"), ("block", "Net", "/"), ("block", "", "/"), ("block", "net", "/en")):
        with pytest.raises(ValueError):
            urlfilter.Rule(*bad)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div class="cookie-notice">We use cookies to do many things that you like.</div><!-- <p>no</p> -->
<article><h1>A  title &amp; more</h1><p><b>First &quot;part&quot;<br>goes on.<p>Second <a href=x>link</a> part&nbsp;here.
<form><input name=q><button>Go</button></form><aside>See also this long list of other things.</aside>
<ul><li>One<li>Two</ul><div class="comments"><p>First!</p></div></article>
<div id="sidebar"><p>Side text that is rather long and has no links at all.</p></div><footer>&copy; us</footer></body></html>"""


def test_page_parts():
    assert pagetext.main_text(PAGE).split("\n\n") == [
        "A title & more", 'First "part" goes on.', "Second link part here.", "One", "Two"
    ]


def test_density_without_article_element():
    body = "".join(f"<p>This is paragraph {i} with enough plain words to count as text.</p>" for i in range(6))
    links = "".join(f'<a href="/{i}">link {i}</a> ' for i in range(30))
    page = f"<body><div>{links}</div><div><div>{body}</div></div><div>{links}</div></body>"
    text = pagetext.main_text(page)
    assert text.count("paragraph") == 6 and "link" not in text


def passage(name, count):
    return "".join(f"<p>The {name} paragraph {i} has enough plain words to count as text.</p>" for i in range(count))


def test_content_outside_the_best_article_is_kept():
    links = "".join(f'<a href="/{i}">link {i}</a> ' for i in range(30))
    for page in (
        f"<main><article>{passage('one', 4)}</article><article>{passage('two', 7)}</article></main>",
        f"<article>{passage('one', 4)}</article><div>{passage('two', 7)}</div>",
        f"<div>{passage('one', 4)}</div><main>{passage('two', 7)}</main>",
        f"<section>{passage('one', 4)}</section><section>{passage('two', 7)}</section>",
    ):
        text = pagetext.main_text(f"<body><div>{links}</div>{page}<div>{links}</div></body>")
        assert (text.count("The one"), text.count("The two"), text.count("link")) == (4, 7, 0)


def test_names_do_not_cut_the_content():
    links = "".join(f'<a href="/{i}">link {i}</a> ' for i in range(30))
    for start, end in (
        ('<div class="content with-sidebar">', "</div>"),
        ('<div id="main" class="no-comments">', "</div>"),
        ('<article class="post comments-open">', "</article>"),
        ('<article class="post related">', "</article>"),
        ('<div class="page header-fixed">', "</div>"),
        ('<div class="search">', "</div>"),
        ("<form action=x>", "</form>"),
        ('<form><div class="sidebar-wrapper"><h1>The head</h1>', "</div></form>"),
        ("<main><aside></aside><form>", "</form></main>"),
    ):
        page = (
            f"<body><nav>{links}</nav>{start}{passage('one', 6)}<div class='sidebar-left'>{passage('side', 1)}</div>"
            f"<ul class='ad-container'><li>Buy</ul>{end}<footer>Foot</footer></body>"
        )
        text = pagetext.main_text(page)
        assert text.count("The one") == 6, start
        assert not any(w in text for w in ("link", "side", "Buy", "Foot")), start


def test_a_long_comment_list_is_cut():
    page = f"<article><h1>Head</h1>{passage('one', 4)}<div id='comments'>{passage('said', 9)}</div></article>"
    text = pagetext.main_text(page)
    assert (text.count("The one"), text.count("said")) == (4, 0)


def plain_density(page):
    """Densities, sums and the chosen node by the definition, one recursion per node."""
    def walk(node, test):
        found = int(test(node))
        return found + sum(walk(c, test) for c in page.children[node] if not isinstance(c, str))

    def chars(node):
        return sum(len("".join(c.split())) if isinstance(c, str) else chars(c) for c in page.children[node])

    def link_chars(node):
        if page.tag[node] == "a":
            return chars(node)
        return sum(link_chars(c) for c in page.children[node] if not isinstance(c, str))

    def density(node):
        c, lc = chars(node), link_chars(node)
        t = max(walk(node, lambda n: n != node and page.tag[n] not in ("cut", "br", "wbr")), 1)
        lt = max(walk(node, lambda n: page.tag[n] == "a"), 1)
        if not c:
            return 0.0
        base = math.log(c / max(c - lc, 1) * lc + link_chars(0) / max(chars(0), 1) * c + math.e)
        return c / t * max(math.log(max(c / max(lc, 1) * t / lt, 1.0)), 0.0) / base

    nodes = range(len(page.tag))
    densities = [density(n) for n in nodes]
    sums = [sum(densities[c] for c in page.children[n] if not isinstance(c, str) and not page.rejected[c]) for n in nodes]
    free = [n for n in nodes if not page.rejected[n]]
    return densities, sums, max(free, key=lambda n: (sums[n], densities[n], -n))


@pytest.mark.parametrize("names", [True, False])
def test_densities_sums_and_chosen_root_equal_the_definition(spark, names):
    sources = [r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").limit(20).collect()]
    links = "".join(f'<a href="/{i}">link {i}</a> ' for i in range(30))
    sources += [PAGE, f"<div>{links}</div><div>{passage('one', 4)}<aside>{passage('side', 2)}</aside></div><p>{links}"]
    for source in sources:
        page = pagetext.Page(source, names)
        densities, sums, best = plain_density(page)
        found = page.densities()
        assert found[0] == pytest.approx(densities) and found[1] == pytest.approx(sums)
        assert best in page.content()
        assert page.threshold <= found[0][best]


def test_density_finds_the_article_without_names(spark):
    sources = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    same = sum(pagetext.main_text(s) == pagetext.main_text(s, names=False) for s in sources)
    assert same >= 0.95 * len(sources)


def test_article_element_does_not_override_density():
    page = f"<body><article><p>Short teaser.</p></article><div>{passage('real', 8)}</div></body>"
    assert pagetext.main_text(page).count("The real") == 8


@pytest.mark.parametrize(
    "source",
    [
        "<p>x" + "<b>" * 30_000 + "</i></td></li>" * 60_000,
        "<div>" * 50_000 + "deep" + "</div>" * 50_000,
        "<select>" + "<b>" * 30_000 + "</i>" * 60_000 + "</select>z",
        "<table>" + "<tr><td><b>x" * 40_000,
        "<ul>" + "<li>" * 100_000 + "<p>" * 50_000,
    ],
    ids=["stray", "deep", "cut", "cells", "items"],
)
def test_work_grows_with_the_length_of_a_page(source):
    start = time.process_time()
    pagetext.main_text(source)
    assert time.process_time() - start < 20


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div class='ad'>", "<div>", "</div>", "<nav>", "</nav>", "<b>", "text ", "<!--", "-->", "<script>",
     "</script>", "<", ">", "&amp", "&#x41;", "<article>", "</article>", "<td>", "<li", "\"", "<form>", "</form>", "</x>"]
), max_size=30).map("".join))
def test_broken_markup_is_survived(source):
    text = pagetext.main_text(source)
    assert text == text.strip() and "\n\n\n" not in text


def test_extracted_rows(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (1, "u", PAGE), (None, "u", "<p>x"), (5, "u", "<div>" * 20_000 + "deep")]
    found = pagetext.extracted(pages(spark, rows)).collect()
    assert [(r.page_id, r.n_chars) for r in found] == [(1, len(found[0].text)), (2, 0), (3, 0), (1, found[0].n_chars), (None, 1), (5, 4)]
    assert pagetext.extracted(pages(spark, rows).filter("false")).count() == 0
