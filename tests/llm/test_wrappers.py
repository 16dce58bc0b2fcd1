"""Operator 11: wrappers inferred from pages, against plain Python and planted templates."""

from __future__ import annotations

import html
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from adevents.llm import wrappers as W
from adevents.llm.wrappers import Item, Page

from .conftest import same, written


def _wrapper(sources):
    pages = [Page(s) for s in sources]
    return W._merge(W.wrapper_of(p.tokens, [W._facts(t, n) for t, n in zip(p.texts, p.linked)]) for p in pages)


def _read(sources):
    main, other = map(frozenset, W.slots(_wrapper(sources)))
    return [W.read_page(s, main, other) for s in sources]


def test_union_free_expressions_of_small_streams():
    one = "<ul><li>a</li></ul>"
    assert W.pattern(_wrapper([one])) == "<ul><li>#</></>"
    assert W.pattern(_wrapper([one, "<ul><li>a<li>b</ul>"])) == "<ul>(<li>#</>)+</>"
    assert W.pattern(_wrapper([one, "<h2>t</h2>" + one])) == "(<h2>#</>)?<ul><li>#</></>"
    assert W.pattern(_wrapper(["<dl><dt>a<dd>b<dt>c<dd>d</dl>", "<dl><dt>a<dd>b</dl>"])) == "<dl>(<dt>#</><dd>#</>)+</>"
    assert W.pattern(_wrapper(["<dl><dt>a<dd>b<dt>c<dd>d<dt>e</dl>"])) == "<dl>(<dt>#</>(<dd>#</>)?)+</>"
    assert W.pattern(_wrapper(["<div><p>a</p><ul></ul><p>b</p></div>"])) == "<div>(<p>#</>(<ul></>)?)+</>"
    assert W.pattern(_wrapper(["", "<p>a"])) == "(<p>#</>)?"


def test_slots_and_coverage_do_not_depend_on_the_order_of_alignments():
    rng = random.Random(3)
    tags = ["p", "h2", "ul", "div class=x", "div class=y", "pre"]

    def body(depth):
        return "".join(
            f"<{t}>{body(depth - 1) if depth and rng.random() < 0.4 else rng.choice('abc')}</{t.split()[0]}>"
            for t in rng.choices(tags, k=rng.randrange(0, 5))
        )

    sources = [f"<main>{body(2)}</main>" for _ in range(40)]
    base = _wrapper(sources)
    for _ in range(5):
        rng.shuffle(sources)
        halves = [_wrapper(sources[:13]), _wrapper(sources[13:20]), _wrapper(sources[20:])]
        other = W._merge([Item.load(x) for x in json.loads(json.dumps([i.dump() for i in w]))] for w in halves)
        assert sorted(W.slots(other)[0]) == sorted(W.slots(base)[0])
        facts = lambda w: sorted(map(repr, _all_facts(w, "")))
        assert facts(other) == facts(base)
        for s in sources:
            assert W.describes(other, Page(s).tokens)


def _all_facts(items, path):
    for x in items:
        if x.key == W.TEXT:
            yield path, x.facts
        else:
            yield from _all_facts(x.body, path if x.key is None else path + "/" + x.key)


ARTICLE = "<h1>Title {0}</h1><p>One &amp; {0}\n two <b>th</b>ree.<p>Line<br>four <a href=x>link</a></p><ul><li>i{0}<li>j</ul>"
WANT = "Title {0}\nOne & {0} two three.\nLine four link\ni{0}\nj"


@pytest.mark.parametrize(
    "template",
    [
        "<nav><ul><li><a href=/>Home</a></ul></nav><article>{0}</article><footer>&copy; site</footer>",
        "<header><h2>Site</h2></header><main><div class='social share-bar'>Share</div>{0}</main><aside>More</aside>",
        "<div id=menu><a href=1>a</a></div><div class='content has-sidebar'><article class='post'>{0}<div class=ad>Buy now</div></article></div>"
        "<div class='sidebar-left'>side</div><section id=comments><article class=comment><p>First!</p></article></section>",
        "<div role=banner>Top</div><div role=main>{0}<form><p>Mail <input></p></form></div><div role=contentinfo>foot</div>",
        "<div class=top-nav><a href=1>a</a></div><div class=body>{0}</div><div class='cookie-notice'>We use cookies</div>",
        "<script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><article>{0}<noscript>Enable</noscript></article>",
        "<article><header><h1>Title {1}</h1><p>by me</p></header>{2}<footer>tags</footer></article>",
    ],
)
def test_templates(template):
    inner = [ARTICLE.format(i) for i in range(4)]
    rest = [x.split("</h1>", 1)[1] for x in inner]
    sources = [f"<html><head><title>x</title></head><body>{template.format(a, i, r)}</body></html>" for i, (a, r) in enumerate(zip(inner, rest))]
    assert _read(sources) == [WANT.format(i) for i in range(4)]
    assert _read(sources[:1]) == [WANT.format(0)]


def test_pages_without_an_article_leave_out_links_and_what_all_pages_say():
    page = "<div class=a>Welcome to our site</div><div class=b><a href=1>one</a> <a href=2>two</a></div><div class=c><p>text {0}</p></div>"
    assert _read([page.format(i) for i in range(3)]) == [f"text {i}" for i in range(3)]
    copies = [page.format(0)] * 5  # nothing differs, so nothing is known to be a template
    assert _read(copies) == ["Welcome to our site\ntext 0"] * 5
    mixed = [f"<article><p>in {i}</article><div class=z>out {i}</div>" for i in range(3)] + ["<div class=z>alone</div>"]
    assert _read(mixed) == ["in 0", "in 1", "in 2", "alone"]


def test_broken_markup():
    cases = {
        "<article><p>a<p>b</article": "a\nb", "<article>a &am": "a &am", "<article>x<!-- cut <p>y": "x", "<article>a < b & c</article>": "a < b & c",
        "<article></p></div>a</b></article>": "a", "<article>a&nbsp;&nbsp;b  c</article>": "a b c", "<ARTICLE><P CLASS=Ad>x</P>y</ARTICLE>": "y",
        "<article><a title='x>y'>t</a><p data-x=\"a>b\">u</article>": "t\nu", "<article><script>if (a</b) {</article>": "", "plain": "plain",
        "<article><table><tr><td>1<td>2<tr><td>3</table>z</article>": "1\n2\n3\nz", "<article>a<script>x": "a", "": "", "<": "<",
        "<article>a<svg><p>no</p></svg>b<br/>c</article>": "ab c", "<article>&lt;p&gt; &#65;&#x42;</article>": "<p> AB",
    }
    for source, want in cases.items():
        assert _read([source])[0] == want, source
    deep = "<div>" * 3000 + "x" + "</div>" * 3000 + "<p>y</p>"
    assert _read([f"<article>{deep}</article>"]) == ["x\ny"]
    many = "".join(f"<p>{i}</p><h2>h</h2>" for i in range(5000))
    assert _read([f"<article>{many}</article>"])[0].count("\n") == 9999


def _plain(source):
    inside = re.search(r"<article>(.*?)(</article>|$)", source or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", inside[1] if inside else "")
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("limit", [W.BROADCAST_BYTES, 0])
def test_query_equals_plain_python(spark, limit, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    want = [(r.page_id, r.url, t, len(t)) for r in pages.collect() for t in [_plain(r.html)]]
    monkeypatch.setattr(W, "FAN", 2)
    got = W.extract(pages, broadcast_bytes=limit).withColumn("n_chars", F.length("text"))
    same(got, want, ["page_id", "url", "text", "n_chars"])
    if limit:
        same(W.extraction_digest(pages), want, ["page_id", "url", "text", "n_chars"])


def test_nulls_repeats_and_a_host_over_several_rounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(W, "FAN", 2)
    monkeypatch.setattr(W, "SLICE_BYTES", 300)
    rows = [(i, "http://h.org/", f"<nav>n</nav><article>{'<p>t</p>' * (i % 4)}<h1>{i}</h1></article>", "slots") for i in range(40)]
    rows += [(100, None, "<article>x</article>", "s"), (101, "http://h.org/", None, None), (102, "nohost", "", "s"), (None, None, None, None)]
    rows += [rows[3], rows[3]]
    pages = written(spark, rows, "page_id long, url string, html string, slots string", tmp_path / "p")
    want = [(i, u, "\n".join(["t"] * (i % 4) + [str(i)]) if i is not None and i < 40 else "x" if i == 100 else "") for i, u, _, _ in rows]
    same(W.extraction_digest(pages), want, ["page_id", "url", "text"])
    found = {r.host: (r.pages, W.pattern([Item.load(x) for x in json.loads(r.wrapper)])) for r in W.infer_wrappers(pages).collect()}
    assert found["h.org"] == (43, "(<nav>#</>)?(<article>(<p>#</>)*<h1>#</></>)?") and found[""][0] == 3
    empty = written(spark, [], "page_id long, url string, html string", tmp_path / "none")
    assert W.extraction_digest(empty).count() == 0
