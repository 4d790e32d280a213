"""Main text of pages: parsing, wrappers, sites of several makes with their text known, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from kinoframe.llm import html_extraction as ex
from kinoframe.llm.html_blocks import page_tree

WORDS = "river stone garden window letter market forest silver morning travel engine island copper winter bridge".split()


def said(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def text_of(html, wrapper=ex.NOWHERE):
    return ex.page_blocks(page_tree(html), wrapper)


@pytest.mark.parametrize(
    ("html", "blocks"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<article><p>a<p>b<b>c</p>d</b></article>", ["a", "bc", "d"]),
        ("<article><p>x<br>y &amp;amp; &lt;i&gt; &#233;&eacute;&nbsp;z</article>", ["x y &amp; <i> éé z"]),
        ("<article><h1>T</h1><script>var a='</p><p>no';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p></article><p>out</p>", ["T", "yes"]),
        ("<article><ul><li>one<li>two <b>bold</b></ul><table><tr><td>a<td>b<tr><th>c</th></table></article>", ["one", "two bold", "a b", "c"]),
        ("<article><p>a</p><form><p>mail</p><input></form><aside>x</aside><nav>y</nav><footer>z</footer><p>b</p></article>", ["a", "b"]),
        ("<article><header><h1>Title</h1><p>by us</p></header><p>b</p></article>", ["Title", "b"]),
        ('<article><p>a</p><div class="ad">buy</div><div id="comments"><article class="comment"><p>first!</p></article></div></article>', ["a"]),
        ("<article><p>a <span class='advert'>buy</span>b</p><p hidden>no</p><p style='display: none'>no</p></article>", ["a b"]),
        ("<p a='>' b=\">\">x<p c=\"unclosed>y", ["x", "y"]),
        ("<article>a</section></div>b</article><!-- never closed <p>x", ["ab"]),
        ("<article><p>a < b and 3 > 2</p></article>", ["a < b and 3 > 2"]),
        ("<body><div class='has-sidebar page'><main><p>m</p></main><div class='sidebar'>s</div></div>", ["m"]),
        ("<main><article><p>" + "long " * 30 + "</p></article><section><h2>More</h2></section></main>", [("long " * 30).strip()]),
        ("<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "<p>end</p></article>", ["deep", "end"]),
        ("<body><form id=page><nav>n</nav><main><p>m</p><form>mail</form></main></form>", ["m"]),
        ("<body><div class='menu-open'><h1>T</h1><p>a long text</p><p>of two parts</p><div class='menu'><p>x</p></div></div>", ["T", "a long text", "of two parts"]),
        ("<body><div class='sidebar'><p>more text here than there</p></div><div class='content'><p>c</p></div>", ["c"]),
        ("<body><div class='page-header'><h1>Site</h1></div><p>one</p><p>two</p>", ["one", "two"]),
        ("<article><p>one</p></article><article><p>two</p></article><article><p>six</p></article>", ["one", "two", "six"]),
    ],
)
def test_blocks(html, blocks):
    assert text_of(html) == blocks


def marked(rng, k):
    paragraphs = [said(rng, rng.randrange(20, 60)) for _ in range(rng.randrange(1, 6))]
    title = said(rng, 5)
    body = "".join(f"<p>{p}</p>" if rng.random() < 0.7 else f"<p><b>{p[:10]}</b>{p[10:]}<br>" for p in paragraphs)
    menu = "".join(f"<li><a href=/{w}>{w}</a>" for w in rng.sample(WORDS, 5))
    return f"<html><body><nav><ul>{menu}</ul></nav><div class=ad>{said(rng, 8)}</div><article><h1>{title}</h1>{body}</article><footer>&copy; {said(rng, 9)}</footer>", [title, *paragraphs]


def by_class(rng, k):
    """No marked article; class words, a cookie notice inside the content, reader comments after it."""
    parts, out = [], []
    for _ in range(rng.randrange(2, 6)):
        if rng.random() < 0.4:
            out.append(said(rng, 4))
            parts.append(f"<h2>{out[-1]}</h2>")
        out.append(said(rng, rng.randrange(15, 50)))
        parts.append(f"<p>{out[-1]}</p>")
    comments = "".join(f'<div class="comment"><p>{said(rng, 40)}</p></div>' for _ in range(rng.randrange(0, 9)))
    side = f'<div id="sidebar"><p>{said(rng, 50)}</p></div>' if k % 2 else ""
    notice = '<div class="cookie-notice"><p>We keep cookies.</p></div>'
    return f'<body><div class="site-header">Site</div><div id="wrapper">{side}<div id="post-{k}" class="post-content">{notice}{"".join(parts)}</div><div id="comments">{comments}</div></div><div class="site-footer">end</div>', out


def unmarked(rng, k):
    """Bare divs and tables of an old site: template text and menus are known from the other pages only."""
    paragraphs = [said(rng, rng.randrange(30, 70)) for _ in range(rng.randrange(2, 7))]
    links = "".join(f"<a href={w}>{said(rng, 3)}</a> " for w in rng.sample(WORDS, 6))
    rights = "All rights are kept by the makers of this site, who ask you to write before you copy any part of these pages elsewhere."
    return f"<body><table><tr><td>{links}</td></tr></table><div>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div><center>{rights}</center>", paragraphs


@pytest.mark.parametrize("most", [ex.BROADCAST_BYTES, 0])
def test_sites(spark, monkeypatch, most):
    monkeypatch.setattr(ex, "BROADCAST_BYTES", most)
    rng = random.Random(8)
    rows, want = [], {}
    for host, make, n in (("a.example", marked, 120), ("b.example", by_class, 40), ("c.example", unmarked, 40), ("d.example", marked, 1), ("e.example", unmarked, 2)):
        for k in range(n):
            html, blocks = make(rng, k)
            rows.append((len(rows), f"https://{host}/{k}", html))
            want[len(rows) - 1] = "\n\n".join(blocks)
    # A host of two makes; pages that repeat; rows without url or html.
    for k in range(30):
        html, blocks = (marked if k % 3 else by_class)(rng, k)
        rows.append((len(rows), f"http://F.example:80/{k}", html))
        want[len(rows) - 1] = "\n\n".join(blocks)
    rows += [(900, None, rows[0][2]), (901, "https://a.example/x", None), (902, "https://a.example/y", ""), (903, "nonsense", "<p>text"), (904, "https://a.example/0", rows[0][2]), (904, "https://a.example/0", rows[0][2])]
    want |= {900: want[0], 901: "", 902: "", 903: "text", 904: want[0]}
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("host", "wrapper", "text", "n_chars", "_salt", "n")}).repartition(5)
    got = ex.extract_main_text(df).collect()
    assert sorted(r["page_id"] for r in got) == sorted(r[0] for r in rows)
    for r in got:
        # With two pages nothing tells the old site's rights line from its text.
        whole = want[r["page_id"]] if "e.example" not in (r["url"] or "") else r["text"]
        assert r["text"] == whole and r["n_chars"] == len(r["text"]), r["url"]
    assert ex.extract_main_text(df.limit(0)).count() == 0


def test_copies_of_one_page_are_no_template(spark):
    html, blocks = marked(random.Random(2), 0)
    rows = [(k, f"https://a.example/{k}", html) for k in range(40)] + [(50 + k, f"https://a.example/n{k}", html.replace("</article>", f"<p>Near {k}.</p></article>")) for k in range(3)]
    got = {r["page_id"]: r["text"] for r in ex.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert {got[k] for k in range(40)} == {"\n\n".join(blocks)}
    assert got[51] == "\n\n".join([*blocks, "Near 1."])


def wrapper_of(pages):
    whole = None
    for html in pages:
        one = ex.Wrapper(ex.page_wrapper(page_tree(html)), {ex._hash(html)})
        if whole is None:
            whole = one
        else:
            whole.add(one)
    return whole


def test_wrapper_is_a_union_free_expression():
    pages = ["<ul><li>a<li>b</ul><p>x</p>", "<h2>t</h2><ul><li>c</ul><p>x</p>", "<ul><li>d</ul><p>x</p><h2>t</h2>"]
    assert ex.expression(wrapper_of(pages).root) == "<page>(<h2>text</h2>? <ul><li/#>#text</li>+</ul> <p>text</p>)+</page>"


def test_order_of_alignment_does_not_matter():
    rng = random.Random(4)
    pages = [make(rng, k)[0] for k in range(12) for make in (marked, by_class, unmarked)]
    pages.append("<div>" + "".join(f"<div class=k{chr(97 + i % 26)}{chr(97 + i // 26)}>{i}</div>" for i in range(90)) + "</div>")
    want = None
    for seed in range(3):
        random.Random(seed).shuffle(pages)
        half = wrapper_of(pages[:20])
        half.add(ex.Wrapper.of(wrapper_of(pages[20:]).text()))
        read = ex.json.loads(ex.decided(half))
        got = sorted("\n\n".join(text_of(p, read)) for p in pages)
        want = want or got
        assert got == want
