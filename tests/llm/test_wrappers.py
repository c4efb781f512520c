"""Main texts: what is left out, how blocks are read, what a host's pages have in common."""

import random
import tracemalloc
from functools import cache

import pytest

from helioledger.llm import wrappers

PAGES = "page_id long, url string, html string, text string, host int"


def texts(html):
    return [t for _, t in wrappers.main_blocks(html)]


def test_blocks_and_references():
    html = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var t="</p><p>no</p>";</script></head>
    <body class="has-sidebar"><header><h1>no</h1></header><nav><ul><li><a href="/">no</a></ul></nav><!-- <p>no --><div class="ad">no</div>
    <article><h1> A &amp;  B &copy;\n C </h1><p><b>one<br>two <i>th</i>ree<p>four</b></p>five<ul><li>six<li>seven</ul>
    <table><tr><td>eight<td>nine</table><form><p>no</p></form><aside>no</aside><div id="cookie-notice"><p>no</p></div>
    <section class="comments"><p>no</p></section><pre>ten\n\n  eleven</pre><p hidden>no</p><button>no</button>&#x41;&#66;</article><footer>no</footer></body></html>"""
    assert texts(html) == ["A & B © C", "one two three", "four", "five", "six", "seven", "eight", "nine", "ten eleven", "AB"]
    assert texts("<div><p>a</div>b<p>c") == ["a", "b", "c"]
    assert texts("<article><p>cut <b>off") == ["cut off"] and texts("") == texts(None) == texts("<p> \n") == []
    assert texts("no tags &lt;b&gt; at all") == ["no tags <b> at all"] and texts("<p>a</p></div></article><p>b") == ["a", "b"]


def test_tree_matching():
    def leaf(text, number):
        return ("#", number, text, [])

    a = ("", -1, "", [("p", -1, "", [leaf("x", 0)]), ("h1", -1, "", [leaf("t", 1)]), ("p", -1, "", [leaf("y", 2)])])
    b = ("", -1, "", [("h1", -1, "", [leaf("s", 0)]), ("p", -1, "", [leaf("z", 1)]), ("p", -1, "", [leaf("y", 2)])])
    weight, pairs = wrappers.match(a, b)
    assert pairs == [(2, 2)] and weight == 1 + 2 + 4
    assert wrappers.match(a, ("div", -1, "", []))[0] == 0


def page(n, host="h.example", extra=""):
    rng = random.Random(n)
    body = "".join(f"<p>{' '.join(rng.choice('abcdefgh') * 3 for _ in range(9))} {n}</p>" for _ in range(rng.randrange(1, 6)))
    main = texts(f"<article>{body}</article>")
    return f"http://{host}/{n}", f"<article><p>Welcome here</p><h1>Title {n}</h1>{extra}{body}<p class=more>Read more</p></article>", "\n".join([f"Title {n}", *main])


def test_templates_go_and_content_stays(spark):
    rows, want = [], {}
    for n in range(12):
        url, html, main = page(n)
        rows.append((n, url, html))
        want[n] = main
    rows += [(50, "http://h.example/odd", "<article><p>odd</p></article>")]
    want[50] = "odd"
    for n in (60, 61):  # too few different pages on a host, though one has many copies
        url, html, main = page(n, "few.example")
        rows += [(n, url, html)] * 4
        want[n] = f"Welcome here\n{main}\nRead more"
    rows += [(70, None, page(1)[1]), (71, "http://u@h.example:80/x", None), (None, "", "<p>p"), (73, "http://h.example/", "x" * 100_000)]
    want |= {70: f"Welcome here\n{page(1)[2]}\nRead more", 71: "", None: "p", 73: "x" * 100_000}
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)
    got = wrappers.extract(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n_chars) == (want[r.page_id], len(want[r.page_id])), r.page_id


def test_empty(spark):
    assert wrappers.extract(spark.createDataFrame([], PAGES)).collect() == []
    assert wrappers.host_of("HTTP://User@Www.Example.org:81/a") == "www.example.org" and wrappers.host_of("a/b") == "" == wrappers.host_of(None)


def test_template_and_text_outside_of_articles(spark):
    rng = random.Random(5)
    rows, want = [], {}

    def words():
        return " ".join(rng.choice("abcdefgh") * 3 for _ in range(12))

    for n in range(10):  # no article at all: the alignment alone tells
        main = [f"{words()} {n}", f"{words()} {n}"]
        rows.append((n, f"http://plain.example/{n}", f"<div class=top><p>Welcome</p></div><div class=text><p>{main[0]}</p><p>{main[1]}</p></div><div>All rights</div>"))
        want[n] = "\n".join(main)
    for n in range(20, 30):  # a teaser is the only article
        main = f"{words()} {n} {words()}"
        rows.append((n, f"http://teaser.example/{n}", f"<div>Welcome</div><div class=text><p>{main}</p></div><article><p>Read this, too</p></article>"))
        want[n] = main
    rows.append((40, "http://alone.example/", "<div><p>The whole story</p></div><article>teaser</article>"))
    want[40] = "The whole story\nteaser"
    for n in range(50, 58):  # two layouts on one host, each with its own template
        main = f"{words()} {n}"
        rows.append((n, f"http://two.example/{n}", f"<section class=shop><p>Buy now</p><p>{main}</p></section>"))
        rows.append((n + 10, f"http://two.example/{n + 10}", f"<div class=news><p>Daily paper</p><p>{main} {main}</p></div>"))
        want |= {n: main, n + 10: f"{main} {main}"}
    got = {r.page_id: r.text for r in wrappers.extract(spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)).collect()}
    assert got == want


def test_links_beside_an_article():
    assert texts("<article><p>The story is here</article><div><a href=/>Next</a></div><p>and here") == ["The story is here", "and here"]
    assert texts("<article><a href=/>Next</a></article><div><a name=x>The story</div><p>and <b>more</b>") == ["Next", "The story", "and more"]


def test_names_of_layouts_lose_nothing():
    story = "<nav>menu</nav><article><p>The story</p></article><div class='ad'>no</div>"
    for opening in (
        "<div class='page has-sidebar'>", "<div id='content-sidebar-wrap'>", "<div class='content no-comments'>", "<div class='widget-content'>",
        "<div class='right-sidebar'>", "<div class=widget>", "<form action=/>", "<div role=dialog>",
    ):
        closing = "</form>" if "form" in opening else "</div>"
        assert texts(f"{opening}{story}{closing}") == ["The story"], opening
    for opening in ("<div class=widget>", "<form>", "<div id=social>"):  # without an article, but with most of the text
        assert texts(f"{opening}<p>The long story of it all</p></div></form><p>end") == ["The long story of it all", "end"]
    for named in ("class=ad", "class='x site-footer'", "id=ad_3", "class=sidebar-left", "role=search", "class='comments-area'"):
        assert texts(f"<p>The long story of it all</p><div {named}>no</div>") == ["The long story of it all"]
    assert texts("<article>The story</article><section class=comments><article>no</article></section>") == ["The story"]


def plain_match(a, b):
    """The weight of the best alignment, tried in all ways: a child is left out on either side, or the two first are paired."""
    if a[0] != b[0]:
        return 0
    if a[1] >= 0:
        return 3 if a[2] == b[2] else 1

    @cache
    def best(i, j):
        if i == len(a[3]) or j == len(b[3]):
            return 0
        return max(best(i + 1, j), best(i, j + 1), plain_match(a[3][i], b[3][j]) + best(i + 1, j + 1))

    return 1 + best(0, 0)


def random_tree(rng, depth, counter):
    if depth == 0 or rng.random() < 0.3:
        counter[0] += 1
        return ("#", counter[0] - 1, rng.choice("xyz"), [])
    return (rng.choice("pq"), -1, "", [random_tree(rng, depth - 1, counter) for _ in range(rng.randrange(0, 5))])


def leaves(node):
    return {node[1]: node[2]} if node[1] >= 0 else {k: v for child in node[3] for k, v in leaves(child).items()}


@pytest.mark.parametrize("table", [0, 5, 10_000])
def test_matching_of_random_trees(monkeypatch, table):
    monkeypatch.setattr(wrappers, "TABLE_PAIRS", table)
    rng = random.Random(table)
    for _ in range(400):
        a, b = (("", -1, "", [random_tree(rng, 3, counter) for _ in range(rng.randrange(0, 6))]) for counter in ([0], [0]))
        weight, pairs = wrappers.match(a, b)
        assert weight == plain_match(a, b)
        mine, other = leaves(a), leaves(b)
        assert all(mine[i] == other[j] for i, j in pairs)
        pairs.sort()
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_pages_of_very_many_blocks_need_little_memory():
    def page_of(n, seed):
        rng = random.Random(seed)
        items = "".join(f"<p>{rng.random()}</p>" if i % 100 else f"<p>rule {i}</p>" for i in range(n))
        return wrappers.tree(wrappers.main_blocks(f"<article><p>Welcome</p>{items}<p>The end</p></article>"))

    a, b = page_of(20_000, 1), page_of(20_000, 2)
    tracemalloc.start()
    weight, pairs = wrappers.match(a, b)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert weight == 2 + 20_002 * 2 + 202 * 2 and len(pairs) == 202 and most < 50 << 20


def test_hints_count_at_any_depth():
    for depth in (10, 120, 3000):
        html = "<div>" * depth + "<nav><p>menu</p></nav><p>The story</p><div class=ad>no</div><footer>no</footer>" + "</div>" * depth
        assert texts(html) == ["The story"], depth
        assert texts("<div>" * depth + "<article><p>The long story</p></article><p><a href=/>Next</a></p>") == ["The long story"], depth
