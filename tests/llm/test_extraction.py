import html
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from weirgate.llm import extraction
from weirgate.llm.queries import QUERIES

LONG = "A paragraph with a fair amount of words, so that it is dense and counts as text of the page."


def test_query_against_the_markup_of_the_pages(spark, sf_dir):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = QUERIES["op5_main_text"](spark, sf_dir).collect()
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        found = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id].html, re.S)
        blocks = re.split(r"</?(?:p|h1|br|article)\b[^>]*>", found[1] if found else "")
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        assert r.text == "\n".join(t for t in texts if t)
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><header>Site</header><div class=content><h1>Title</h1><p>{LONG}<p>Short.<p>{LONG}</div><footer>f</footer>", f"Title\n{LONG}\nShort.\n{LONG}"),
        (f"<main><p>{LONG}</p><div class='cookie-notice'>{LONG}</div><section id=comments><p>{LONG}</p></section></main>", LONG),
        (f"<article><p>a &amp; b&nbsp;&lt;c&gt; &#233; {LONG}</p><form>q<input></form><script>x<p>y</script><style>p{{}}</style></article>", f"a & b <c> é {LONG}"),
        (f"<article><header><h1>Title</h1></header><p>{LONG}</p><aside>{LONG}</aside></article><article class=teaser>t</article>", f"Title\n{LONG}"),
        (f"<div class='content with-sidebar noMenu'><p>{LONG}</p></div><div class='left-sidebar'><p>{LONG}</p></div>", LONG),
        (f"<article><ul><li>one {LONG}<li>two</ul><table><tr><td>x<td>y</table><pre>a\n  b</pre></article>", f"one {LONG}\ntwo\nx\ny\na b"),
        (f"<article><p class=ad>no<p>{LONG}<p hidden>no</article><nav>n", LONG),
        (f"<body><div><ul><li><a href=a>Home</a><li><a href=b>News</a><li><a href=c>More</a></ul></div><div><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG}\n{LONG}"),
        (f"<article><p>{LONG} <a href=x>link</a> end.</p></article>", f"{LONG} link end."),
        ("<article><p>Unclosed <b>text &am", "Unclosed text &am"),
        ("", ""), (None, ""), ("plain words", "plain words"), ("<nav>only</nav>", ""), ("<![if x]><p>ok<![endif]>", "ok"),
    ],
)
def test_pages_by_hand(page, text):
    assert extraction.main_text(page) == text


MENU = "<div><ul><li><a href=a>Home</a><li><a href=b>News</a><li><a href=c>More</a></ul></div>"
MANY = "".join(f"<p>{LONG}</p>" for _ in range(9))
MANY_LINES = "\n".join([LONG] * 9)


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div id=page><h1>Title</h1><p>{LONG} Lead.</p><div class=entry>{MANY}</div></div>", f"Title\n{LONG} Lead.\n{MANY_LINES}"),
        (f"<body>{MENU}<div><h1>Title</h1></div><div><div class=entry>{MANY}</div></div>{MENU}", f"Title\n{MANY_LINES}"),
        (f"<body>{MENU}<div><h1>Title</h1><div>By me</div></div>{MENU}<div>{MANY}</div><div><h2>Second</h2><p>{LONG} 2</p><p>Short.</p></div>{MENU}", f"{MANY_LINES}\nSecond\n{LONG} 2\nShort."),
        (f"<body><div><p>{LONG} 1</p></div>{MENU}<div>Short.</div><div>{MANY}</div><div>Imprint</div>", f"{LONG} 1\nShort.\n{MANY_LINES}"),
    ],
)
def test_pages_without_an_article_element(page, text):
    assert extraction.main_text(page) == text


SOURCES = "<ul><li><a href=a>One</a><li><a href=b>Two</a><li><a href=c>Three</a></ul>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article><h2 id=related-work>Related work</h2><p>{LONG}</p><section id=search-results><p>{LONG} 2</p></section><section id=comment-on-method><p>{LONG} 3</p></section></article>", f"Related work\n{LONG}\n{LONG} 2\n{LONG} 3"),
        (f"<body><div class='post category-social'><h1>Title</h1><p>{LONG}</p></div>", f"Title\n{LONG}"),
        (f"<body><div class=sidebar-left><h1>Title</h1><p>{LONG}</p><p id=social>{LONG} 2</p><div class=sidebar><p>Away</p></div></div>", f"Title\n{LONG}\n{LONG} 2"),
        (f"<body><div class=comments><p>{LONG}</p></div>", LONG),
        (f"<body><div class=sidebar>{MANY}</div><article><h1>Title</h1><p>Short.</p><div class='share widget'><p>{LONG}</p></div></article>", f"Title\nShort.\n{LONG}"),
        (f"<article><p>{LONG}</p><div class=post-comments>{MANY}</div><div id=ad-slot-3><p>ad</p></div><div class='left sidebar2'>{LONG}</div></article>", LONG),
        (f"<article><p>{LONG}</p>{SOURCES}<p>{LONG} 2</p><h2>Sources</h2>{SOURCES}</article>", f"{LONG}\nOne\nTwo\nThree\n{LONG} 2\nSources\nOne\nTwo\nThree"),
        (f"<article><p>a {LONG} <span class=share>x</span> b</p>{SOURCES}</article>", f"a {LONG}\nb"),
    ],
)
def test_names_and_links_inside_articles(page, text):
    assert extraction.main_text(page) == text


def test_smoothing_and_threshold():
    assert extraction.smoothed([3.0] * 7) == pytest.approx([3.0] * 7)
    assert extraction.smoothed([0.0, 0.0, 9.0, 0.0, 0.0])[2] == max(extraction.smoothed([0.0, 0.0, 9.0, 0.0, 0.0]))
    assert 2 < extraction.threshold([1.0, 1.2, 0.8, 9.0, 10.0, 11.0]) < 9


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + f"<p>{LONG}" + "</div>" * 20_000
    assert extraction.main_text(deep) == LONG
    many = "<article>" + f"<p><b>{LONG}<br>" * 5_000
    assert extraction.main_text(many) == "\n".join([LONG] * 5_000)


def test_odd_tables(spark):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (3, "u", f"<p>{LONG}", "x"), (3, "u", f"<p>{LONG}", "x"), (None, "u", "<p>b", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("_html", F.lit("mine"))
    found = extraction.extract_main_text(pages)
    assert found.columns == ["page_id", "url", "_html", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in found.collect()) == [(0, "b", 1), (1, "", 0), (2, "", 0), (3, LONG, len(LONG)), (3, LONG, len(LONG))]
    assert extraction.extract_main_text(pages.limit(0)).count() == 0


@pytest.mark.parametrize("page, lines", [
    ("<div></div>" + "<p><b>xxxxx</b></p>" * 11 + "<div></div>", 11),
    ("<div></div><article>" + "<p><b>xxxxx</b></p>" * 11 + "</article><div></div>", 11),
    ("<main>" + "<p><b>xxxxx</b></p>" * 7 + "</main>", 7),
    ("<p>one</p>", 1),
    ("<p><a href='x'>only</a></p>" * 2, 2),
])
def test_lines_of_one_density(page, lines):
    assert len(extraction.main_text(page).split("\n")) == lines


def test_pages_that_end_inside_markup():
    start = time.perf_counter()
    for bit in ("<!--", "<a ", '<a href="', "<![", "<?", "</", "<", "<!-- -", "<![CDATA["):
        assert extraction.main_text("<p>The text.</p>" + bit * 20_000).split("\n")[0] == "The text."
    assert time.perf_counter() - start < 20
    assert extraction.main_text("<p>The text.</p><!-- " + "<p>hidden</p>" * 9) == "The text."
    assert extraction.main_text("<p>first</p><script>if (a<!--b) {}</script><p>second</p>") == "first\nsecond"


def test_several_articles():
    one, two = "word " * 64, "tale " * 60
    page = f"<main><article><p>{one}</p></article><article><p>{two}</p></article><article><p>A card.</p></article></main>"
    assert extraction.main_text(page) == f"{one.strip()}\n{two.strip()}"


def test_random_markup_never_fails():
    bits = (
        "<div> </div> <p> </p> <article> </article> <main> </main> <a_href='x'> </a> <h1> </h1> <li> <ul> </ul> <b> </b> xxxxx"
        " word_word_word <br> <!-- --> <script> </script> <table><tr><td> </td></table> <div_class='comments'> <nav> </nav> &amp; <"
        " > <section_id='ad'> </section> <template> </template> <! <![CDATA[ ]]> <? =\" '"
    ).replace("_", "\0").split(" ")
    random_ = random.Random(4)
    for _ in range(4000):
        page = "".join(random_.choice(bits).replace("\0", " ") for _ in range(random_.randint(1, 40)))
        assert isinstance(extraction.main_text(page), str)
