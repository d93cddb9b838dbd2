"""Extraction: planted articles, template blocks of a host, broken pages, tree matching."""

import re
import html as h

from docksense.llm.html_extract import Page, extract, simple_tree_matching
from docksense.llm.queries import op3_html_extract


def brute(source):
    """For the test tables' markup: the paragraphs and headings of the article."""
    m = re.search(r"<article>(.*?)(?:</article>|\Z)", source or "", re.S)
    if not m:
        return ""
    parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", m[1]))
    return "\n\n".join(x for x in (" ".join(h.unescape(p).split()) for p in parts) if x)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op3_html_extract(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.url == pages[r.page_id].url and r.n_chars == len(r.text)
        assert r.text == brute(pages[r.page_id].html)


FRAME = """<!doctype html><HTML><head><title>x</title><script>if (a<b) "</p>"</script></head><body class="has-sidebar">
<div id="top-menu"><a href=/>Home</a></div><header><h2>Site</h2></header>{body}<div class='comments'><p>reader says {i}</p></div>
<footer>(c) {i}</footer></body></html>"""


def test_constant_blocks_are_template(spark):
    rows = []
    for i in range(12):
        body = f"<div class=post><h1>Title {i}</h1><p>Unique &amp; text {i}&nbsp; a <b>b</b>c<br>d</p><p>Follow us for more.</p></div>"
        rows.append((i, "https://a.example/x", FRAME.format(body=body, i=i)))
    copies = [(100 + i, "http://b.example/", FRAME.format(body="<article><p>Same story.</p><p>Told again.</p></article>", i=i)) for i in range(30)]
    odd = [(200, None, None), (201, "not a url", ""), (202, "http://c.example", "plain < text &lt;b&gt; &#233; &bogus; &am"),
           (203, "http://c.example", "<article><p>one<p>two <i>in</i>line<ul><li>x<li>y</ul><form><p>no</p></form><div class=\"ad-box\">no</div> tail <p"),
           (204, "http://c.example", "<div>" * 5000 + "deep" + "</div>" * 5000), (None, "http://c.example", "<p>null id</p>"),
           (205, "http://c.example", "<p title=\"a>b\">quoted</p><p title='open>rest</p>"), (206, "http://c.example", "<!-- <p>no</p> --><main>yes</main>")]
    df = spark.createDataFrame([(*r, "k") for r in rows + copies + odd], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in extract(df).collect()}
    for i in range(12):
        assert got[i] == f"Title {i}\n\nUnique & text {i} a bc d"
    assert {got[100 + i] for i in range(30)} == {"Same story.\n\nTold again."}
    assert got[200] == got[201] == "" and got[202] == "plain < text <b> é &bogus; &am"
    assert got[203] == "one\n\ntwo inline\n\nx\n\ny\n\ntail" and got[204] == "deep" and got[None] == "null id"
    assert got[205].startswith("quoted") and got[206] == "yes"
    assert extract(df.limit(0)).count() == 0


def test_small_hosts_have_templates(spark):
    # an unmarked block that is the same on all pages of a host of 2 and of 3; one page alone shows no constant
    page = "<body><div class=post><h1>Title {i}</h1><p>Text {i}.</p></div><div class=box><p>Join our club.</p></div></body>"
    hosts = {"one": [0], "two": [1, 2], "three": [3, 4, 5]}
    rows = [(i, f"http://{name}.example/{i}", page.format(i=i)) for name, ids in hosts.items() for i in ids]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == "Title 0\n\nText 0.\n\nJoin our club."
    for i in range(1, 6):
        assert got[i] == f"Title {i}\n\nText {i}."


def extracted(spark, rows):
    return {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_articles_keep_what_they_share(spark):
    shared = [f"Paragraph {k} of the story, the same in both editions." for k in range(10)]
    rows, want = [], {}

    def put(page_id, host, blocks, element="article", box=True):
        inside = "".join(f"<{t}>{x}</{t.split(' ')[0]}>" for t, x in blocks)
        tail = "<div class=box><p>Join our club.</p></div>" if box else ""
        rows.append((page_id, f"http://{host}.example/{page_id}", f"<body><{element}>{inside}</{element.split(' ')[0]}>{tail}</body>"))
        want[page_id] = "\n\n".join(x for _, x in blocks)

    # two editions of one article on a host of two pages, marked as an article or not
    for i, edition in enumerate(("First edition.", "Second edition.")):
        blocks = [("h1", "The heading"), *(("p", x) for x in shared), ("p", edition)]
        put(i, "editions", blocks)
        put(10 + i, "plain", blocks, "div class=post", box=False)
    # more editions than it takes for a sentence among others to be template
    for i in range(8):
        put(20 + i, "many", [("h1", "The heading"), *(("p", x) for x in shared), ("p", f"Edition {i}.")], "div class=post", box=False)
    # a byline on all pages of a host, and one sentence that the only two articles share
    for i in range(9):
        put(40 + i, "byline", [("h1", f"Title {i}"), ("p class=byline", "By Jane Doe"), ("p", f"What happened on day {i}.")])
    for i in range(2):
        put(60 + i, "sentence", [("h1", f"Title {i}"), ("p", f"What happened on day {i}."), ("p", "More tomorrow.")])
        put(70 + i, "unmarked", [("h1", f"Title {i}"), ("p", f"What happened on day {i}."), ("p", "More tomorrow.")], "div class=post")
    assert extracted(spark, rows) == want


def test_unmarked_lists_are_template(spark):
    """A list with several texts in one slot, the same on both pages of a host; cards whose text does not vary."""
    page = "<body><div class=links><ul><li>One<li>Two<li>Three</ul></div><article class=card><h2>Card</h2></article>" \
           "<article><p>Only on page {i} is this text to be found.</p></article></body>"
    got = extracted(spark, [(i, "http://l.example/", page.format(i=i)) for i in range(2)])
    assert got == {i: f"Only on page {i} is this text to be found." for i in range(2)}


def test_attribute_names_are_exact():
    # words in quoted values, in addresses and in data-* names are no attributes
    for kept in ('<div style="overflow:hidden">text</div>', '<div title="the hidden valley">text</div>',
                 '<div data-id="comment-12">text</div>', '<div><a href="/a?id=login">text</a></div>',
                 "<div data-role=navigation x-hidden data-class='sidebar'>text</div>", '<div title = "a id=login hidden>text</div>'):
        assert [t for _, t in Page(kept).candidates()] == ["text"], kept
    for dropped in ("<div hidden>text</div>", '<div title="x"HIDDEN=""class=a>text</div>', "<div id = 'comments'>text</div>",
                    '<div style="a:b" role=navigation>text</div>', "<p><a href=/a?b=c aria-hidden=true>text</a></p>"):
        assert Page(dropped).candidates() == [], dropped


def texts(source):
    return [t for _, t in Page(source).candidates()]


def test_wrappers_keep_the_article():
    article = "<article><div class=\"article-header\"><h1>Headline</h1></div><p>Story of the day.</p></article>"
    for wrapper in ("content-sidebar-wrap", "layout has-sidebar", "sidebar", "page-header-wrap", "has-comments", "comments-open"):
        aside = "<div class=sidebar><p>Much longer text beside the story, of no use to it at all.</p></div>"
        for inside, outside in ((aside, ""), ("", aside)):
            assert texts(f'<body><div class="{wrapper}">{article}{inside}</div>{outside}</body>') == ["Headline", "Story of the day."], wrapper
    # without an article, an element around most of the text is a wrapper
    plain = '<div class="post-header"><h1>Headline</h1></div><div class=post><p>Story of the day.</p></div>'
    for wrapper in ("content-sidebar-wrap", "layout has-sidebar", "two-column-sidebar"):
        assert texts(f'<div class="{wrapper}">{plain}<div class="left-sidebar">Menu</div></div>') == ["Headline", "Story of the day."]


def test_class_words_still_rule_out():
    post = "<div class=post><p>A story.</p></div>"
    reader = "<div id=comments><article class=comment><p>Much more text by a reader, who goes on and on.</p></article></div>"
    assert texts(post + reader) == texts(f"<article><p>A story.</p></article>{reader}") == ["A story."]
    assert texts(post + "<div class=ad-box>Buy</div><div class=sidebar><article>More</article></div>") == ["A story."]
    assert texts(f"<article>{post}<div class=share>Share</div><div class=related><article>Other</article></div></article>") == ["A story."]
    assert texts(f"<div class=site-header><h1>Site</h1></div>{post}") == ["A story."]


def test_teaser_cards(spark):
    # cards that vary stay beside the main text, cards that are the same on all pages go
    cards = "".join(f"<article class=card><h2>Card {k}</h2></article>" for k in "abc")
    page = "<body>{top}<div class=text><p>The main text of page {i} lies in a plain element.</p></div>{cards}</body>"
    rows = [(i, "http://x.example/", page.format(i=i, top="", cards=cards)) for i in range(4)]
    rows += [(10 + i, "http://y.example/", page.format(i=i, top='<div class="content-sidebar-wrap">', cards=f"</div>{cards}")) for i in range(4)]
    rows += [(20, "http://z.example/", page.format(i=20, top="", cards=cards))]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i in range(4):
        assert got[i] == got[10 + i] == f"The main text of page {i} lies in a plain element."
    assert got[20] == "The main text of page 20 lies in a plain element.\n\nCard a\n\nCard b\n\nCard c"


def test_tree_matching():
    a = Page("<body><nav>x</nav><div class=m><h1>t</h1><p>a</p></div><footer>f</footer></body>").skeleton()
    b = Page("<body><div class=m><p>a</p><h1>t</h1></div><aside>s</aside><footer>f</footer></body>").skeleton()
    match = simple_tree_matching(a, b)
    la = [""] + [x.split(" ")[1] for x in a.split("\n")]
    lb = [""] + [x.split(" ")[1] for x in b.split("\n")]
    assert all(la[i] == lb[j] for i, j in match.items())
    assert sorted(la[i] for i in match) in (["", "body", "div.m", "footer", "h1"], ["", "body", "div.m", "footer", "p"])
    assert simple_tree_matching(a, a) == {i: i for i in range(len(la))}
