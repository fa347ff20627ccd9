"""URL rules and trust, and main text by wrappers, on hand-made pages."""

from __future__ import annotations

import json
import random
import re

import pytest
from llm_cases import null_last

from rankwise.llm import html_wrappers, url_filter
from rankwise.llm.queries import URL_RULES

COLUMNS = "page_id long, url string, html string, text string, rule string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], COLUMNS).repartition(3)


def naive_rule(url):
    m = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, v) for h, p, v in URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else None


def test_rules(spark):
    urls = [None, "", "no host", "http://", "https://A.Example.ORG/es/1?x#y", "http://example.org/en/1", "http://example.org/en/2",
            "http://example.org", "http://org/", "http://x.com/fr/", "http://x.com/de/9", "http://xcom/de/9", "ftp://q.net/a://b/",
            "http://u@x.com:80/de/", "http://" + "a." * 3000 + "com/de/"]
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    rows = [(k, u, None) for k, u in enumerate(urls)] + [(None, urls[5], None), (3, urls[3], None)]
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages(spark, rows), rules).collect()}
    for i, u, _ in rows:
        host, path, rule, verdict = naive_rule(u)
        assert (i, host, path, rule, verdict or "allow") in got or (verdict is None and (i, host, path, rule, "block") in got)
    assert url_filter.judge(pages(spark, rows), rules).count() == len(rows)
    assert url_filter.judge(pages(spark, rows).filter("false"), rules).count() == 0


def test_distrust_runs_against_the_links(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/x">l</a>' for h in hosts)
    rules = spark.createDataFrame([("bad.net", "/", "block"), ("good.net", "/", "allow")], "host string, path string, verdict string")
    rows = [(1, "http://bad.net/1", link("bad.net")), (2, "http://good.net/1", link("fine.net", "FINE.net")),
            (3, "http://farm.net/1", link("bad.net", "bad.net")), (4, "http://farm2.net/1", link("farm.net")),
            (5, "http://fine.net/1", link("other.net")), (6, "http://lone.net/", "<p>no links")]
    got = {r.page_id: r.verdict for r in url_filter.judge(pages(spark, rows), rules).collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "block", 5: "allow", 6: "allow"}


def page(title, paragraphs, extra="", end="</body></html>"):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return (f"<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/a>menu</a>"
            f"</li></ul></nav><div class=\"ad\">buy</div><article><h1>{title}</h1>{body}{extra}</article>"
            f"<aside>side</aside><div id='comments'><p>first!</p></div><footer>&copy; us</footer>{end}")


def test_main_text(spark):
    rows = [(1, "http://a.net/1", page("One &amp; only", ["a  b\n c", "x &lt; y<br>z", ""])),
            (2, "http://a.net/2", page("Two", ["<b>bold</b> t&eacute;xt"], "<form>search</form><div class='share'>share</div>", "")),
            (3, "http://a.net/3", page("Three", ["one", "two", "three"], "<ul><li>i<li>j</ul>")),
            (4, "http://a.net/4", page("Two", ["<b>bold</b> t&eacute;xt"])),
            (5, "http://b.net/1", "<div><div class=menu>m</div><div class=body><p>long enough text one</p><p>and two</p></div></div>"),
            (6, "http://b.net/2", "<div><div class=menu>m</div><div class=body><p>another text, differing</p></div></div>"),
            (7, "http://c.net/1", None), (8, None, "plain <i>text</i>"), (None, "http://c.net/2", ""),
            (9, "http://c.net/3", "<p>unclosed <b>tags<p>next" + "<div>" * 300 + "deep"), (3, "http://a.net/3", page("Three", ["one"]))]
    out = html_wrappers.extract(pages(spark, rows)).collect()
    assert all(r.n_chars == len(r.text) for r in out)
    want = ["One & only\na b c\nx < y z", "Two\nbold t\u00e9xt", "Three\none\ntwo\nthree\ni\nj", "Two\nbold t\u00e9xt",
            "long enough text one\nand two", "another text, differing", "", "plain text", "", "unclosed tags\nnext\ndeep", "Three\none"]
    assert null_last((r.page_id, r.url, r.text) for r in out) == null_last((i, u, t) for (i, u, _), t in zip(rows, want))
    assert html_wrappers.extract(pages(spark, rows).filter("false")).count() == 0


def own_page(i, text):
    return (f"<body class='postid-{i}'><div class='left-{i}'>about the site</div><article class='post-{i} kind-{i % 2}'>"
            f"<p>{text}</p></article><div class='tail-{i}'>all rights</div></body>")


def test_pages_whose_classes_carry_their_own_id(spark):
    plain = lambda i, text: own_page(i, text).replace("article", "section")
    texts = [" ".join(f"word{i}x{k}" for k in range(40)) for i in range(12)]
    rows = [(i, f"http://d.net/{i}", own_page(i, t)) for i, t in enumerate(texts)]
    rows += [(100 + i, f"http://e.net/{i}", plain(i, t)) for i, t in enumerate(texts)]
    rows += [(200, "http://d.net/odd", f"<body><div><div><article>{texts[0]}</article></div></div><div>x</div></body>")]
    got = {r.page_id: r.text for r in html_wrappers.extract(pages(spark, rows)).collect()}
    assert got == {i: t for i, t in enumerate(texts)} | {100 + i: t for i, t in enumerate(texts)} | {200: texts[0]}


@pytest.mark.parametrize("levels", [10, 45, 200])
def test_articles_come_out_whole_at_any_depth(spark, levels):
    texts = [" ".join(f"word{i}x{k}" for k in range(40)) for i in range(6)]

    def nested(tag, i):
        return (f"<body><div class='strap'>Site strap line and links</div>{'<div>' * levels}<{tag}><p>{texts[i]}</p>"
                f"<div class='share'>tell all</div><p>end {i}</p></{tag}>{'</div>' * levels}</body>")

    rows = [(i, f"http://deep.net/{i}", nested("article", i)) for i in range(6)]
    rows += [(10 + i, f"http://main.net/{i}", nested("main", i)) for i in range(6)]
    rows += [(20 + i, f"http://plain.net/{i}", nested("section", i)) for i in range(6)]     # no name: the heavy, varying part
    got = {r.page_id: r.text for r in html_wrappers.extract(pages(spark, rows)).collect()}
    assert got == {10 * host + i: f"{texts[i]}\nend {i}" for host in range(3) for i in range(6)}


def test_a_page_of_another_template_is_read_whole(spark):
    usual = [f"<body><div class=top>menu line</div><div class=text><p>{' '.join(f'w{i}x{k}' for k in range(50))}</p></div></body>"
             for i in range(8)]
    odd = f"<body><div class=text>see below</div><table><tr><td>{'another kind of page ' * 20}</td></tr></table></body>"
    rows = [(i, f"http://o.net/{i}", x) for i, x in enumerate([*usual, odd])]
    got = {r.page_id: r.text for r in html_wrappers.extract(pages(spark, rows)).collect()}
    assert got[8] == "see below\n" + ("another kind of page " * 20).strip()
    assert all(got[i] == " ".join(f"w{i}x{k}" for k in range(50)) for i in range(8))


def test_copies_of_a_page_keep_its_text(spark):
    text = "<div><h1>The only title</h1><p>one block of text</p></div>"
    rows = [(i, "http://f.net/1", text) for i in range(5)]
    # different pages whose texts are all the same
    rows += [(10 + i, f"http://g.net/{i}", f"{text}<script>var id = {i}</script>") for i in range(5)]
    # a template with a constant line among text that varies
    rows += [(20 + i, f"http://h.net/{i}", f"<div><h4>Read this</h4><p>{'abcde'[i] * 60} text</p><p>{'vwxyz'[i] * 60}</p></div>") for i in range(5)]
    got = {r.page_id: r.text for r in html_wrappers.extract(pages(spark, rows)).collect()}
    whole = "The only title\none block of text"
    assert got == {i: whole for i in [*range(5), *range(10, 15)]} | {20 + i: f"{'abcde'[i] * 60} text\n{'vwxyz'[i] * 60}" for i in range(5)}


def test_wrapper_does_not_grow_with_the_pages():
    rnd, whole, sizes = random.Random(1), None, []
    for i in range(300):
        tags = "".join(f"<{t} class='c{rnd.randrange(10 ** 6)}'>{rnd.random()}</{t}>" for t in rnd.choices(
            ["h2", "h3", "ul", "table", "pre", "ol", "dl", "div"], k=30))
        own = html_wrappers.skeleton(html_wrappers.parse(f"<div>{tags}</div>", frozenset()), page=i)
        whole = own if whole is None else html_wrappers.merge(whole, own)
        sizes.append(len(json.dumps(whole)))
        assert len(whole[4][0][4]) <= html_wrappers.MAX_PARTS
    assert max(sizes[100:]) <= 2 * max(sizes[:100])


def test_wrapper_has_optional_repeated_and_slot_parts():
    one, two = (html_wrappers.skeleton(html_wrappers.parse(x)) for x in
                ("<div><h1>A</h1><p>x</p><p>y</p></div>", "<div><h1>A</h1><p>z</p><table></table></div>"))
    div = html_wrappers.merge(one, two)[4][0]
    parts = {p[0]: p for p in div[4]}
    assert parts["h1"][4][0][2] is not None         # the same text on both pages: a constant
    assert parts["p"][1] == "+" and parts["p"][4][0][2] is None
    assert parts["table"][1] == "?"


@pytest.mark.parametrize("text", ["<a href='x>y", "<", "<>", "</p>", "<!-- open", "<script>never closed", "a < b", "<p <p>"])
def test_broken_markup_is_read(text):
    assert isinstance(html_wrappers.main_text(text, {"path": [], "constants": []}), str)
