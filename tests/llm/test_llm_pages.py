import math

import pytest

from barflow.llm.site_style_tree import Page, extract, importances, main_text, place, site_of

PAGES = "page_id bigint, url string, html string, text string, n_chars string"
NOTHING = lambda node: None


def text_of(html):
    return main_text(html, "http://a.example/", NOTHING)[0]


@pytest.fixture(scope="module")
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "old", "old") for r in rows], PAGES).repartition(3)


@pytest.mark.parametrize("html, want", [
    ("<p>One<p>Two &amp; <b>three</b>", "One\nTwo & three"),
    ("<article><h1>T</h1><p><b>a<br><p>b</p></article><footer>f</footer>", "T\na\nb"),
    ("<nav>menu</nav><main>x <i>y</i>z</main><aside>s</aside>", "x yz"),
    ("<body><header>Site</header><article><header><h1>Title</h1></header><p>t</article>", "Title\nt"),
    ("<div class='cookie-notice'>c</div><div id=comments><p>hi</div><p>text", "text"),
    ("<script>var a='</p>';</script><style>p{}</style><p>a<script>b</script>c", "ac"),
    ("<form><p>Name</p><input></form><ul><li>one<li>two</ul>", "one\ntwo"),
    ("<!-- <p>no --><p title='a > b'>yes</p><![CDATA[x]]>", "yes"),
    ("<p>unclosed <b>bold<p>next &eacute;&#x41;&nope;", "unclosed bold\nnext éA&nope;"),
    ("<p>a\n\t  b&nbsp;c</p>", "a b c"),
    ("<div hidden>h</div><div style='display: none'>n</div><p>v", "v"),
    ("<div role=navigation>n</div><div class='adBanner'>n</div><div class='shadow'>s", "s"),
    ("a < b and 1 <2", "a < b and 1 <2"), ("<p title=\"open>x", "x"), ("<<p>>y", "<\n>y"),
    ("<SCRIPT>x</SCRIPT><P>Up</P>", "Up"), ("", ""), (None, ""), ("   ", ""),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1\n2\n3"),
    ("<html class='no-menu'><body class='with-sidebar'><p>in</p></body></html>", "in"),
])
def test_main_text_of_a_page(html, want):
    assert text_of(html) == want


def test_deep_and_long_pages():
    assert text_of("<div>" * 20_000 + "deep") == "deep"
    assert len(text_of("<p>" + "word " * 300_000)) == 5 * 300_000 - 1


def test_sites():
    assert [site_of(u) for u in ("http://A.example:80/x", None, "", "no scheme", "http://[bad/")] == ["a.example", "", "", "", ""]


def site(n, host="h.example", first=0):
    return [(first + i, f"http://{host}/{i}", (
        f"<div class=top><span>Welcome</span></div><div><p>Story {i} has its own words number {i * 7}</p>"
        + "".join(f"<p>Paragraph {k} of page {i} says {i * k}.</p>" for k in range(2 + i % 4))
        + "</div><div class=end>Read more of our news</div>")) for i in range(n)]


def test_branches_that_a_site_repeats_are_removed(pages):
    rows = site(20) + [(100, "http://other.example/", site(1)[0][2])]
    out = {r.page_id: r for r in extract(pages(rows)).collect()}
    for i in range(20):
        assert "Welcome" not in out[i].text and "Read more" not in out[i].text
        assert out[i].text.startswith(f"Story {i} has") and out[i].n_chars == len(out[i].text)
        assert len(out[i].text.split("\n")) == 3 + i % 4
    assert out[100].text.startswith("Welcome\nStory 0") and out[100].n_removed == 0  # one page shows no repetition


def test_copied_pages_stay_whole(pages):
    rows = [(i, "http://c.example/x", "<p>Head<p>The same long article text on every page of this site") for i in range(12)]
    assert {r.text for r in extract(pages(rows)).collect()} == {"Head\nThe same long article text on every page of this site"}


def test_pages_may_meet_their_nodes_in_a_join(pages):
    rows = site(15) + site(9, "two.example", 50) + [(70, None, None), (71, "http://h.example/1", ""), (None, None, "<p>x"), (0, *site(1)[0][1:])]
    key = lambda df: sorted((str(tuple(r)) for r in df.collect()))
    sent, joined = extract(pages(rows)), extract(pages(rows), sent_nodes=0)
    assert sent.columns[:4] == ["page_id", "url", "text", "n_chars"] and sent.count() == len(rows)
    assert key(sent) == key(joined)
    assert {r.page_id: r.text for r in sent.collect()}[70] == ""
    assert extract(pages([])).count() == 0


def test_importances_are_entropies(pages):
    rows = site(8)
    found = {r.node: (r.layout, r.content) for r in importances(pages(rows)).collect()}
    nodes, styles, contents = {}, {}, {}
    for _, url, html in rows:
        n, s, c = place(Page(html), site_of(url))
        for a, b, x in zip(n, s, c):
            nodes.setdefault(a, set()).add(url)
            styles.setdefault(a, {}).setdefault(b, set()).add(url)
            if x is not None:
                contents.setdefault(a, {}).setdefault(x, []).append(url)
    shared = {a for a, u in nodes.items() if len(u) >= 5}
    assert set(found) == shared
    entropy = lambda counts, m: -sum(c / sum(counts) * math.log(c / sum(counts), m) for c in counts)
    for a in shared:
        m = len(nodes[a])
        assert found[a][0] == pytest.approx(max(0, entropy([len(u) for u in styles[a].values()], m)), abs=1e-9)
        if a in contents:
            each = [entropy([u.count(x) for x in set(u)], m) for u in contents[a].values()]
            assert found[a][1] == pytest.approx(1 - sum(each) / len(each))
        else:
            assert found[a][1] is None
