"""Main text extraction: the article of every page of the table, and a site with everything around it."""

import html
import os
import random
import re

import pytest

from retailprep.llm import html as operator
from retailprep.llm.html import expressions, extracted, page_places, page_wrapper, parsed, wrappers
from retailprep.llm.queries import QUERIES
from retailprep.llm.wrapper import MANY, Places, expression, from_json, matched, merged, to_json

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def article(page):
    """The blocks of the one article of a table page, by cutting it at its h1 and p tags."""
    inside = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1]
    inside = re.sub(r"</?b>", "", inside).replace("<br>", " ")
    blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1)>", inside)]
    return "\n\n".join(b for b in blocks if b)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    want = sorted((p.page_id, p.url, article(p.html), len(article(p.html))) for p in pages)
    assert sorted(tuple(r) for r in QUERIES["op9_html"](spark, SF_DIR).collect()) == want


def site(k, body, extra=""):
    return f"""<!doctype html><html><head><title>Site - {k}</title><script>if (a < b) document.write("<p>no</p>")</script></head>
    <body class="page"><header><h1>The Site</h1><ul class=menu><li><a href="/">Home</a><li>About</ul></header>
    <div class="cookie-notice"><p>We use cookies.</p><button>OK</button></div>{extra}
    <div id="content"><article><header><h2>Title {k}</h2></header>{body}<p>All rights of this story belong to the site.</p></article>
    <aside><h3>Popular</h3><p>Other story {k}</p></aside>
    <div class="comments"><article><p>First! {k}</p></article></div>
    <form action=/s><label>Search</label><input name=q></form></div>
    <footer><p>&copy; The Site {k}</p></footer></body></html>"""


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, host string, template int")


def texts(df):
    return sorted(((r.page_id, r.text) for r in df.collect()), key=str)


def test_site(spark):
    bodies = [f"<p>Story {k} &amp; more&nbsp;text<br>on <b>two</b>\n lines &lt;b&gt;.<p>Second <i>part</i> {k}" for k in range(8)]
    rows = [(k, f"https://user@Www.Site.example:80/{k}", site(k, body, "<div class=ad>Buy</div>" if k % 3 else "")) for k, body in enumerate(bodies)]
    rows.append((8, "http://www.site.example/8", site(8, "<ul><li>one<li>two</ul><blockquote>said <p>so</blockquote>tail")))
    want = [(k, f"Title {k}\n\nStory {k} & more text on two lines <b>.\n\nSecond part {k}") for k in range(8)]
    # The story's last line is the same on all pages, so it is template; with text after the list it still is.
    got = dict(texts(extracted(pages_of(spark, rows))))
    assert [(k, got[k]) for k in range(8)] == want
    assert got[8] == "Title 8\n\none\n\ntwo\n\nsaid\n\nso\n\ntail"
    known = expressions(pages_of(spark, rows)).collect()
    assert [r.host for r in known] == ["www.site.example"]
    assert "(<div class=ad # #PCDATA >div class=ad)?" in known[0].expression and "(li #PCDATA)+" in known[0].expression


WORDS = "amber birch cedar delta ember fjord grove heron inlet jetty knoll larch meadow north otter pine quartz ridge slate tern".split()


def story(seed, parts=3):
    draw = random.Random(seed)
    return [" ".join(draw.choices(WORDS, k=25)) for _ in range(parts)]


def paragraphs(parts):
    return "".join(f"<p>{x}</p>" for x in parts)


def extracted_site(spark, pages):
    rows = [(k, f"http://h.example/{k}", page) for k, page in enumerate(pages)]
    return [r.text for r in sorted(extracted(pages_of(spark, rows)).collect(), key=lambda r: r.page_id)]


@pytest.mark.parametrize("around", ['<div class="content with-sidebar">', '<div id="search-page">', '<form action="/"><div>'])
def test_names_around_the_article_do_not_count(spark, around):
    stories = [story(k) for k in range(3)]
    pages = [f"<body>{around}<article>{paragraphs(s)}</article></div><div class=comments><article><p>nice</p></article></div></body>" for s in stories]
    assert extracted_site(spark, pages) == ["\n\n".join(s) for s in stories]
    # nor around what is main without an article
    pages = [f"<body><nav><p>menu {k}</nav>{around}{paragraphs(s)}</div></body>" for k, s in enumerate(stories)]
    assert extracted_site(spark, pages) == ["\n\n".join(s) for s in stories]


def test_sibling_sections(spark):
    stories = [story(k, 4) for k in range(5)]
    pages = [
        f"<body><nav><p>menu</nav><div id=c><section id=a>{paragraphs(s[:3])}</section><section id=b>{paragraphs(s[3:])}</section></div>"
        f"<div id=d><p>see {k}</div><footer><p>end</footer></body>"
        for k, s in enumerate(stories)
    ]
    assert extracted_site(spark, pages) == ["\n\n".join(s) for s in stories]


def test_fixed_paragraph_among_others(spark):
    stories = [story(k) for k in range(5)]
    pages = [f"<article><h1>{s[0][:20]}</h1>{paragraphs([s[0], 'Subscribe now for news', *s[1:]])}</article>" for s in stories]
    assert extracted_site(spark, pages) == ["\n\n".join([s[0][:20], *s]) for s in stories]


def test_copies_of_an_article_are_no_template(spark):
    kept = story(1, 4)
    pages = [f"<nav><p>{k}</nav><article>{paragraphs([*kept[:2], f'changed {k}', *kept[2:]])}</article>" for k in range(8)]
    pages += [f"<article>{paragraphs(kept)}</article>"] * 5
    got = extracted_site(spark, pages)
    assert got == ["\n\n".join([*kept[:2], f"changed {k}", *kept[2:]]) for k in range(8)] + ["\n\n".join(kept)] * 5


def test_teaser_beside_the_article(spark):
    pages = [f"<body><article>{paragraphs(story(k))}</article><article><h3>Next</h3><p>Story {k + 1}</p></article></body>" for k in range(4)]
    assert extracted_site(spark, pages) == ["\n\n".join(story(k)) for k in range(4)]


def test_all_pages_in_groups(spark, monkeypatch):
    """Every page's parts are in the wrapper, also where groups are small and there are several rounds."""
    draw = random.Random(5)
    tags = ["p", "h2", "h3", "li", "pre", "dt"]
    pages = ["<div>" + "".join(f"<{t}>{k}" for t in draw.choices(tags, k=draw.randint(1, 12))) + "</div>" for k in range(60)]
    rows = pages_of(spark, [(k, "http://h.example/", page) for k, page in enumerate(pages)])
    monkeypatch.setattr(operator, "FAN", 4)
    (known,) = wrappers(rows).collect()
    places = Places(from_json(known.wrapper))
    assert len(places.labels) <= 1 + MANY * len(tags)
    for page in pages:
        of_boxes, of_texts = page_places(parsed(page), places)
        assert -1 not in of_boxes[1:] and -1 not in of_texts
    (found,) = expressions(rows).collect()
    assert re.sub(r"[^()]", "", found.expression).count("(") == found.expression.count(")")


ODD = [
    (1, None, None),
    (2, "", ""),
    (3, "not a url", "plain text\n only"),
    (4, "http://a.example/", "<p>cut off <b>here &amp; th"),
    (5, "http://a.example/", "<nav><p>menu</nav><div><p>Some longer main text</div><div>short</div>"),
    (5, "http://a.example/", "<nav><p>menu</nav><div><p>Some longer main text</div><div>short</div>"),
    (6, "http://a.example/", "<!-- never closed <p>x"),
    (7, "http://a.example/", "<script>never closed <p>x"),
    (8, "http://a.example/", "a < b and b > c <p title='>'>x</p></article></div>"),
    (None, "http://b.example/", "<article><p>1</p><article><p>2</p></article><p>3</article><p>outside"),
    (9, "http://b.example/", "<main>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</main>"),
    (10, "http://b.example/", "<article>" + "<p>para" * 20000 + "</article>"),
    (11, "http://b.example/", "<article>&#x41;&#66;&eacute;&unknown; x</article>"),
]


def test_odd_rows(spark):
    want = [
        (1, ""), (2, ""), (3, "plain text only"), (4, "cut off here & th"), (5, "Some longer main text\n\nshort"), (5, "Some longer main text\n\nshort"),
        (6, ""), (7, ""), (8, "a < b and b > c\n\nx"), (None, "1\n\n2\n\n3"), (9, "deep"), (10, "\n\n".join(["para"] * 20000)), (11, "ABé&unknown; x"),
    ]
    out = extracted(pages_of(spark, ODD))
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert texts(out) == sorted(want, key=str)
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_empty_table(spark):
    assert extracted(pages_of(spark, [])).count() == 0


def wrapper_of(*pages):
    out = page_wrapper(parsed(pages[0]))
    for page in pages[1:]:
        out = merged(out, page_wrapper(parsed(page)))
    assert from_json(to_json(out)) == out
    return expression(out)


@pytest.mark.parametrize(
    ("pages", "want"),
    [
        (["<ul><li>a<li>b</ul>", "<ul><li>c</ul>"], "<ul (li #PCDATA)+ >ul"),
        (["<h1>a</h1><p>b", "<h1>c</h1>"], "h1 #PCDATA (p #PCDATA)?"),
        (["<div><h2>a</h2><p>b</div>" * 3, "<div><h2>a</h2><p>b</div>"], "(<div h2 #PCDATA p #PCDATA >div)+"),
        (["<p>a", "<h1>x</h1><h2>y</h2><p>b"], "(h1 #PCDATA)? (h2 #PCDATA)? p #PCDATA"),
        (["<h2>a<p>b<p>c<h2>d<p>e", "<h1>x</h1><h2>y</h2><p>b"], "(h1 #PCDATA)? (h2 #PCDATA (p #PCDATA)+)+"),
        (["<div><h2>a</div><div><p>b</div>"], "(<div (h2 #PCDATA)? (p #PCDATA)? >div)+"),
        (["<dl>" + "".join(f"<h{k % 5 + 1}>x<p>y" for k in range(40)) + "</dl>"], None),
        (["".join(f"<div class=c{k}>x</div>" for k in range(15)) * 2], "(" + " ".join(f"<div class=c{k} # #PCDATA >div class=c{k}" for k in range(15)) + ")+"),
    ],
)
def test_wrappers(pages, want):
    assert want is None or wrapper_of(*pages) == want
    assert len(wrapper_of(*pages)) < 1000


def plain_length(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


def test_alignment():
    assert matched(list("abcd"), list("abcd")) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert matched(list("axb"), list("ayb")) == [(0, 0), (2, 2)]
    assert matched([], list("ab")) == []
    draw = random.Random(3)
    for _ in range(300):
        a, b = ("".join(draw.choices("abcd", k=draw.randint(0, 30))) for _ in range(2))
        pairs = matched(list(a), list(b))
        assert all(a[i] == b[j] for i, j in pairs) and len(pairs) == plain_length(a, b)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_alignment_of_long_lists(monkeypatch):
    draw = random.Random(4)
    a, b = (draw.choices("abcdefgh", k=4000) for _ in range(2))
    pairs = matched(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and len(pairs) > 2000
    monkeypatch.setattr("retailprep.llm.wrapper.MOST_CELLS", 10_000)
    cut = matched(a, b)
    assert all(a[i] == b[j] for i, j in cut) and len(pairs) > len(cut) > 0.8 * len(pairs)


def test_alignment_of_longest_lists():
    """The common part is the longest at any size: of 400 million comparisons, and of lists that share no more than a third."""
    size = 20_000
    around = [(k + size // 3) % size for k in range(size)]
    pairs = matched(list(range(size)), around)
    assert all(k == around[j] for k, j in pairs) and len(pairs) == size - size // 3
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))
    apart = [k if k % 3 == 0 else -k for k in range(size)]
    assert len(matched(list(range(size)), apart)) == len(range(0, size, 3))
