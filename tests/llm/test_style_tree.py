import re
from html import unescape

import pytest

from marquee.llm.html import parse
from marquee.llm.style_tree import extract, main_text, noise, style_tree

CASES = {
    "<article><h1>A &amp; B</h1><p>One<b>two</b> three\n\t four<br>five<p>six</article>": "A & B Onetwo three four five six",
    "<nav>menu</nav><header>Site</header><main><p>x</p><aside>s</aside></main><footer>f</footer>": "x",
    "<body class='with-sidebar'><div class='page has-sidebar'><header><h1>Site</h1></header><div id='sidebar'>s</div><div><h1>T</h1><p>t</p></div></div>": "T t",
    "<article><header><h1>T</h1></header><p>t</p><div class='share-buttons'>s</div><section id=comments><article class=comment><p>c</p></article></section></article>": "T t",
    "<article><p>a<span class='ad'>buy <span>now</span></span>b</p><form>f</form><!-- c --><script>var t='</p>';</script><style>p{}</style></article>": "ab",
    "<ul><li>one<li>two</ul><table><tr><td>1<td>2<tr><td>3</table>": "one two 1 2 3",
    "<p>1 < 2 &lt; 3 &am &copy; &#x41;&nbsp; z</p>": "1 < 2 < 3 &am © A z",
    "": "", "no markup  at all": "no markup at all", "<p>open <b>bold <i>x": "open bold x", "<div><p>a</div></p></div>b": "a b",
    "<div class='cookie-notice'>c</div><p title='a>b' data-x=\"</p>\">t</p>": "t", "<!-- open <p>t</p>": "", "<article></article><p>t</p>": "t",
}


@pytest.mark.parametrize("html", CASES)
def test_extract(html):
    assert extract(html, set()) == CASES[html]


def page(i, host="h.example", note="Sign up today and never miss a story", tag="div class='x7'"):
    return (i, f"https://{host}/p/{i}", f"<body><article><h1>Title {i}</h1><p>Words of page {i}.</p><{tag}>{note}</{tag.split()[0]}><p>More {i}.</p><p>The end.</p></article></body>")


def test_repeated_branch_is_cut(spark):
    rows = [page(i) for i in range(30)] + [page(i, "few.example") for i in range(30, 34)]
    rows += [page(i, "own.example", f"Fact {i}") for i in range(40, 60)]
    same = "<body><div class='a'><p>All the same.</p></div></body>"
    rows += [(i, f"http://same.example/{i}", same) for i in range(70, 90)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, host int")
    text = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    assert text[3] == "Title 3 Words of page 3. More 3. The end."  # the note is the same on 30 pages; "The end." is in a content node
    assert "Sign up" in text[31]  # too few pages to tell
    assert "Fact 41" in text[41]
    assert text[70] == "All the same."  # cutting would leave nothing


def test_importances_against_the_definition(spark):
    import math

    pages = spark.createDataFrame([page(i, note=f"note {i % 2}") for i in range(16)], "page_id long, url string, html string")
    tree = style_tree(pages).collect()
    assert len(tree) == 4 and all(r["pages"] == 16 for r in tree)
    values = sorted(r["importance"] for r in tree)
    note = 1 - math.log(8) / math.log(16)  # two texts on 8 pages each
    paragraph = 1 - 1 / 33  # 32 texts of one page, and one of all 16
    assert math.isclose(values[0], note) and any(math.isclose(v, paragraph) for v in values) and math.isclose(values[-1], 1)
    mean = (16 * note + 48 * paragraph + 16) / 80
    assert any(math.isclose(v, 0.9 * mean) for v in values)  # the article has one presentation
    assert noise(style_tree(pages)).collect()[0]["cut"] is not None


def test_missing_values(spark):
    rows = [(1, None, "<p>a</p>"), (2, "no host", "<p>b</p>"), (3, "http://h/", None), (None, "http://h/", ""), (3, "http://h/", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((str(r["page_id"]), r["text"]) for r in main_text(pages).collect()) == [("1", "a"), ("2", "b"), ("3", ""), ("3", ""), ("None", "")]
    assert main_text(pages.limit(0)).collect() == []


def test_given_pages(spark):
    """The given pages hold an article of a heading and paragraphs, without nested elements that declare a role."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    text = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert text[r["page_id"]] == " ".join(b for b in blocks if b)


def test_deep_page():
    html = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert extract(html, set()) == "deep" and parse(html).children


WHOLE = {
    "<main><h1>Title</h1><p>Lead</p><article><p>body</p></article></main>": "Title Lead body",
    "<header>Site</header><div class='content'><h1>T</h1><p>story</p></div><article><header>teaser</header></article><nav>n</nav>": "T story teaser",
    "<nav>n</nav><form id='aspnetForm'><div><h1>T</h1><p>story</p></div><footer>f</footer></form>": "T story",
    "<nav>n</nav><form action='/'><div><p>a story without a title</p></div></form><p>more</p>": "a story without a title more",
    "<form><nav>n</nav><article><p>x</p></article></form>": "x",
    "<p>Long enough text of the page.</p><form>name</form>": "Long enough text of the page.",
    "<article><p>short</p><form>a newsletter with a longer text</form></article>": "short",
    "<nav>only a menu</nav><div hidden><p>h</p></div>": "only a menu",
}


@pytest.mark.parametrize("html", WHOLE)
def test_nothing_is_cut_before_the_tree(html):
    assert extract(html, set()) == WHOLE[html]


TOKENS = {
    "<div class='overflow-hidden'><article><h1>T</h1><p>story</p></article></div>": "T story",
    "<article class='overflow-hidden rounded'><h1>T</h1><p>story</p></article>": "T story",
    "<article><p class='hidden md:block'>wide</p><p class='hidden'>no</p><p>story</p></article>": "wide story",
    "<div class='content with-sidebar'><h2>T</h2><p>story</p></div><div class='sidebar'>s</div><p>x</p>": "T story x",
    "<article><section class='related-work'><h2>Related work</h2><p>a</p></section><div class='search-algorithms'>b</div><div class='related-links'>r</div></article>": "Related work a b",
    "<article><p>a <span class='notice'>notice</span> b</p><div class='site-notice'>n</div></article>": "a notice b",
    "<div class='promo'><p>A page whose whole story lies in an element with such a name.</p></div><p>x</p>": "A page whose whole story lies in an element with such a name. x",
    "<p>Some story.</p><div class='comment-list'><p>A comment that is much longer than the story itself.</p></div>": "Some story.",
}


@pytest.mark.parametrize("html", TOKENS)
def test_names_count_as_whole_tokens(html):
    assert extract(html, set()) == TOKENS[html]


def test_menu_without_a_telling_name_is_cut(spark):
    """Menus that repeat on a host's pages go by their importance alone; one's own lists stay."""
    menu = "<div class='q1'><ul class='k'>" + "".join(f"<li><a href='/{t}'>{t}</a></li>" for t in ("Home", "World", "Sport", "Shop")) + "</ul></div>"
    body = "<body>{menu}<div class='c'><h1>Title {i}</h1><p>Story of page {i}.</p><ul class='f'><li>Fact {i}</li><li>Fact two of {i}</li></ul></div></body>"
    rows = [(i, f"http://menu.example/{i}", body.format(menu=menu, i=i)) for i in range(25)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    assert all(text[i] == f"Title {i} Story of page {i}. Fact {i} Fact two of {i}" for i in range(25))
