import pytest

from starpipe.llm.html_text import main_blocks, main_texts, parse, style_tree

SCHEMA = "page_id long, url string, html string, text string"


def text_of(html):
    return "\n".join(text for _, text in main_blocks(parse(html)))


def test_article_without_what_surrounds_it():
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body class="no-sidebar"><header><h1>Site</h1></header>'
        '<div id="cookieNotice">We use cookies</div><nav><ul><li>Home</ul></nav><div class="content sidebar-left"><main>'
        "<h1>Title &amp; more&nbsp;x</h1><article class='post'><p>One <a href=x>link</a>\n two<br>three<p>Four"
        "<ul><li>a<li>b</ul><table><tr><td>c1<td>c2</table><pre>x\n  y</pre><div class='ad'>buy</div>"
        "<form><p>mail<input></form><blockquote>q</blockquote><script>if(a<b){'</p>'}</script><!-- c --></article>"
        "<section class=comments><article><p>nice</p></article></section><aside>side</aside></main></div><footer>foot</footer>"
    )
    assert text_of(page) == "Title & more x\nOne link two three\nFour\na\nb\nc1\nc2\nx y\nq"


@pytest.mark.parametrize(("html", "text"), [
    (None, ""), ("", ""), ("plain &lt;text", "plain <text"), ("<p>a<p>b", "a\nb"),
    ("<div>a<span>b</span>c<div>d</div>e</div>", "abc\nd\ne"), ("<article>unclosed <b>bold", "unclosed bold"),
    ("<nav>x</nav>y", "y"), ("</div></p>z<br/>q", "z q"), ("<p>" + "w " * 300_000, ("w " * 300_000).strip()),
])
def test_odd_pages(html, text):
    assert text_of(html) == text


def test_same_branch_on_every_page_of_a_host_goes(make):
    def page(i, aside="Read our terms"):
        return f"<article><h1>Title {i}</h1><div class=x7>{aside}</div><p>Body of {i}</p><p>More</p></article>"

    rows = [(i, f"http://a.com/{i}", page(i), "clash") for i in range(8)]
    rows += [(100 + i, "http://copies.com/x", page(0), None) for i in range(8)]
    rows += [(200 + i, f"http://b.com/{i}", page(i, f"own {i}"), None) for i in range(8)]
    rows += [(300, None, page(0), None), (None, "http://a.com/9", None, None)]
    got = {r["page_id"]: r for r in main_texts(make(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert got[3]["text"] == "Title 3\nBody of 3\nMore" and got[3]["n_chars"] == len(got[3]["text"])
    assert got[100]["text"] == "Title 0\nRead our terms\nBody of 0\nMore"
    assert got[203]["text"] == "Title 3\nown 3\nBody of 3\nMore"
    assert got[300]["text"] == got[100]["text"] and got[None]["text"] == ""
    assert main_texts(make([], SCHEMA)).count() == 0


def test_importance(make):
    rows = [("h", f"<article><p>{i}</p><div class=a>same</div><h2>{i % 2}</h2></article>") for i in range(16)]
    nodes = {r["node"]: r for r in style_tree(make(rows, "host string, html string")).collect()}
    assert nodes["article p"]["importance"] == pytest.approx(1)
    assert nodes["article div.a"]["importance"] == pytest.approx(0)
    assert nodes["article h2"]["importance"] == pytest.approx(0.25)
    assert nodes["article p"]["pages"] == 16


@pytest.mark.parametrize("page", [
    '<article id="how-to-share-files"><p>text</p></article>', '<div id="post-social-security-reform"><p>text</p></div>',
    '<article class="post comments-open">text</article>', '<main class="content with-social-bar">text</main>',
    '<div class="entry has-related">text</div>', '<p>text</p><div class="social-share-bar">x</div><p class="ads">y</p>',
    '<div id="relatedPosts2" class="related">x</div>text', '<main class="promo">text</main>',
])
def test_one_word_of_a_name_discards_nothing(page):
    assert text_of(page) == "text"


def test_same_text_in_unnamed_boxes_goes(make):
    def page(i):
        return f"<body><div>Home News</div><div>Text of {i}</div><p>Body {i}</p><p>Read our terms</p><div>Imprint</div></body>"

    rows = [(i, f"http://a.com/{i}", page(i), None) for i in range(20)]
    rows += [(100 + i, f"http://few.com/{i}", page(i), None) for i in range(4)]
    got = {r["page_id"]: r["text"] for r in main_texts(make(rows, SCHEMA)).collect()}
    assert got[7] == "Text of 7\nBody 7"
    assert got[101] == "Home News\nText of 1\nBody 1\nRead our terms\nImprint"
