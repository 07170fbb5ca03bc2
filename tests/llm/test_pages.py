from collections import Counter

import pytest

from ratingloom.llm import wrappers
from ratingloom.llm.dom import folded, match, parse
from ratingloom.llm.queries import op6_wrappers

PAGE = (
    '<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body><header class="site">Site</header>'
    "<nav><ul><li>Menu</ul></nav><div class='x{n}'>Welcome to our pages</div>"
    "<article><h1>{title}</h1><p>{one}<p>{two}&amp; caf&eacute;&nbsp;<br>au  lait<div class=ad>Buy</div><p>Share this page</p></article>"
    '<section id="comments"><p>nice {n}</p></section><aside>More</aside><footer>&copy; {n}</footer><script>var a="<p>";</script></body></html>'
)


def page(n: int) -> str:
    return PAGE.replace("{n}", str(n)).replace("{title}", f"Title {n}").replace("{one}", f"First part {n} " * 9).replace("{two}", f"second {n * n} " * 7)


def wanted(n: int, shared: bool) -> str:
    lines = [f"Title {n}", (f"First part {n} " * 9).strip(), (f"second {n * n} " * 7) + "& café au lait"]
    return "\n".join(lines + ["Share this page"] * shared)


def test_template_text_goes_and_slots_stay(spark):
    rows = [(n, f"https://U@Big.example:80/{n}", page(n)) for n in range(30)] + [(99, "http://one.example/x", page(99))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in wrappers.extract_pages(pages).collect()}
    for n in range(30):
        assert found[n].text == wanted(n, shared=False)
        assert found[n].n_chars == len(found[n].text)
    # one page alone can't tell its template text
    assert found[99].text == wanted(99, shared=True)


def test_odd_pages(spark):
    rows = [
        (1, None, None), (2, "http://a.b/", ""), (3, "nothing", "plain text &lt;3"), (4, "http://a.b/1", "<p>cut off <b"), (4, "http://a.b/1", "<p>cut off <b"),
        (None, "http://a.b/2", "<!-- open comment <p>no"), (5, "http://a.b/3", "<p>" + "word " * 50_000 + "</p>"), (6, "http://a.b/4", "<nav>only a menu</nav>"),
        (7, "http://a.b/5", "<div>" * 300 + "deep" + "</div>" * 300),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, template string")
    found = wrappers.extract_pages(pages)
    texts = sorted((r.page_id or 0, r.text) for r in found.collect())
    assert texts == [(0, ""), (1, ""), (2, ""), (3, "plain text <3"), (4, "cut off"), (4, "cut off"), (5, ("word " * 50_000).strip()), (6, ""), (7, "deep")]
    assert wrappers.extract_pages(pages.limit(0)).count() == 0


def test_large_templates_are_joined(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "SENT_BYTES", -1)
    pages = spark.createDataFrame([(n, "http://a.b/", page(n)) for n in range(8)], "page_id long, url string, html string")
    assert {r.text for r in wrappers.extract_pages(pages).collect()} == {wanted(n, False) for n in range(8)}


def brute(a, b):
    """Simple tree matching without shortcuts."""
    if a.key != b.key:
        return 0
    one, two = a.elements(), b.elements()
    best = [[0] * (len(two) + 1) for _ in range(len(one) + 1)]
    for i, x in enumerate(one):
        for j, y in enumerate(two):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute(x, y))
    return 1 + best[-1][-1]


@pytest.mark.parametrize("one, two", [
    ("<p>a<p>b", "<p>a"), ("<div><p>a</div><ul><li>x<li>y</ul>", "<ul><li>x</ul><div><b>z</b><p>a</div>"), ("<table><tr><td>a<td>b<tr><td>c</table>", "<table><tr><td>a</table>"),
])
def test_matching_is_the_largest(one, two):
    assert match(parse(one), parse(two))[0] == brute(parse(one), parse(two))
    assert folded(parse("<p>1<p>2<p>3<p>4"), 2).elements()[-1].children == ["2"]


def test_pages_of_the_data(spark, small_data):
    import re
    from html import unescape
    source = {r.page_id: r.html for r in spark.read.parquet(f"{small_data}/pages.parquet").collect()}
    for r in op6_wrappers(spark, small_data).collect():
        body = source[r.page_id].partition("<article>")[2]
        end = body.rfind("</article>")
        body = body[:end] if end >= 0 else re.sub(r"<[^>]*$", "", body)
        blocks = (" ".join(unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n".join(b for b in blocks if b)


def extracted(spark, pages):
    """Texts by page id of one host's pages."""
    rows = [(k, f"http://h.example/{k}", html) for k, html in enumerate(pages)]
    given = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    return {r.page_id: r.text for r in wrappers.extract_pages(given).collect()}


def words(n: int, k: int = 0) -> str:
    return " ".join(f"w{(n * 7919 + k * 104729 + i * 31) % 99991}" for i in range(30))


def test_template_texts_are_counted_over_all_pages(spark):
    """Copies with the lowest hash don't hide a host's template, nor do they make one; a layout with
    few of the pages has its own."""
    story = "<body><div class=top>Our daily news from all parts</div><article><p>{}</p><p>Write to the editor</p></article></body>"
    other = "<body><article class=long><h2>{}</h2><div>{}</div><div class=legal>All figures without warranty</div></article></body>"
    plain = [story.format(words(n)) for n in range(60)]
    # which page has the lowest hash depends on Spark's hash
    hashes = spark.createDataFrame([(k, x) for k, x in enumerate(plain)], "k long, html string").selectExpr("k", "xxhash64(html) h").collect()
    lowest = min(hashes, key=lambda r: r.h).k
    rare = [other.format(words(n, 5), words(n, 6)) for n in range(5)]
    found = extracted(spark, plain + [plain[lowest]] * 200 + rare)
    assert all(found[n] == words(n) for n in range(60))
    assert all(found[60 + k] == words(lowest) for k in range(200))
    assert all(found[260 + n] == f"{words(n, 5)}\n{words(n, 6)}" for n in range(5))


def test_shared_lines_of_long_runs_go(spark):
    pages = []
    for n in range(20):
        own = [f"<p>{words(n, k)}</p>" for k in range(4 + n % 5)]
        own.insert(4, "<p>Read this on paper too</p>")
        pages.append("<body><article>" + "".join(own) + "<p>Share this page</p></article></body>")
    found = extracted(spark, pages)
    assert all(found[n] == "\n".join(words(n, k) for k in range(4 + n % 5)) for n in range(20))


def test_cells_with_common_values_stay(spark):
    rows = ["".join(f"<tr><td>{words(n, k)}</td><td>{('Yes', 'No')[(n >> k) % 2]}</td></tr>" for k in range(5)) for n in range(32)]
    found = extracted(spark, [f"<body><article><table>{r}</table></article></body>" for r in rows])
    assert all(found[n].split("\n") == [x for k in range(5) for x in (words(n, k), ("Yes", "No")[(n >> k) % 2])] for n in range(32))


def test_all_open_varying_text_is_content(spark):
    """Without an article nothing but shut and constant parts goes, on hosts and lone pages."""
    page = "<body><nav>Menu</nav><div class=story><div class=lead><p>{}</p></div><div class=text><p>{}</p><p>{}</p></div></div><div class=footer>End</div></body>"
    pages = [page.format(words(n, 1), words(n, 2), words(n, 3)) for n in range(9)]
    wanted_texts = ["\n".join(words(n, k) for k in (1, 2, 3)) for n in range(9)]
    found = extracted(spark, pages)
    assert [found[n] for n in range(9)] == wanted_texts
    assert extracted(spark, pages[:1]) == {0: wanted_texts[0]}


def test_pages_with_more_than_their_host_keep_it(spark):
    one = "<body><div class=a><p>{}</p><p>{}</p></div><div class=b></div></body>"
    pages = [one.format(words(n, 1), words(n, 2)) for n in range(11)]
    pages.append(pages[0].replace("<div class=b>", f"<div class=b><p>{words(99)}</p>").replace(words(0, 1), words(98)))
    assert extracted(spark, pages)[11] == "\n".join([words(98), words(0, 2), words(99)])


def test_pages_of_any_depth(spark):
    """Five thousand elements inside one another, and pages that close none of them."""
    deep = "<div>" * 5000 + "<p>story {0} of a deep page</p>" + "</div>" * 5000
    pages = [deep.format(n) for n in range(6)]
    pages.append("<nav>menu" + "<b>" * 3000 + "more menu" + "</b>" * 3000 + "</nav><article>text<ul>" + "<li><ul>" * 2000 + "end")
    found = extracted(spark, pages)
    assert [found[n] for n in range(6)] == [f"story {n} of a deep page" for n in range(6)]
    assert found[6] == "text\nend"


def test_templates_are_learned_from_every_page(spark, monkeypatch):
    """Each different page of a host is in one group that templates are learned from, and groups
    stay near SAMPLE_PAGES however many pages the host has."""
    fitted = []
    map_groups = wrappers.map_groups
    monkeypatch.setattr(wrappers, "map_groups", lambda table, keys, *a: fitted.append((table, keys)) or map_groups(table, keys, *a))
    rows = [(n, "http://many.example/", page(n)) for n in range(100)] + [(n, "http://few.example/", page(n)) for n in range(100, 105)]
    rows += [(200, "http://many.example/", page(0)), (201, "http://many.example/", "")]
    given = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in wrappers.extract_pages(given).collect()}
    table, keys = fitted[-1]
    learned = table.collect()
    assert sorted(r.html for r in learned) == sorted({html for _, _, html in rows if html})
    assert max(Counter(tuple(r[k] for k in keys) for r in learned).values()) <= 2 * wrappers.SAMPLE_PAGES
    assert all(found[n] == wanted(n, shared=False) for n in range(105)) and found[200] == found[0] and found[201] == ""
