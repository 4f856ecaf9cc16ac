import html
import re

from conftest import SMALL

from lakeops.llm import pages

SCHEMA = "page_id long, url string, html string"


def texts(spark, rows):
    return {r["page_id"]: r["text"] for r in pages.main_text(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_given_pages(spark):
    """The given pages have one article of simple blocks each."""
    df = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r["page_id"]: r for r in pages.main_text(df).collect()}
    rows = df.collect()
    assert len(found) == len(rows)
    for r in rows:
        inside = re.search(r"<article>(.*)</article>", r["html"], re.DOTALL)[1]
        parts = re.split(r"</?(?:p|h1|br|li|ul)\b[^>]*>", inside)
        plain = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts)
        assert found[r["page_id"]]["text"] == "\n".join(p for p in plain if p)
        assert found[r["page_id"]]["n_chars"] == len(found[r["page_id"]]["text"])


def test_everything_but_the_article_goes(spark):
    page = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
      <nav><a href=x>Home</a></nav><div class="cookie-notice">We use cookies</div><main><article>
      <h1>Head &amp; &lt;line&gt;</h1><p>One <b>bold</b>
         two<script>var a = "</p>";</script></p><p>Three &eacute;&#233; <button>Share</button>more</p>
      <div class="ad">Buy</div><form><p>Mail</p></form><ul><li>a<li>b</ul><section id="comments"><p>First!</p></section>
      </article></main><aside>Other</aside><footer>&copy; x</footer></body></html>"""
    assert texts(spark, [(1, "http://a/b", page)])[1] == "Head & <line>\nOne bold two\nThree éé more\na\nb"


def test_boilerplate_of_hosts_without_articles(spark):
    menu = "start news sport culture travel weather contact imprint privacy help"
    rows = [
        (i, f"https://one.example/{i}", f"<body><div>{menu}</div><div>{i} is the number of this page</div></body>")
        for i in range(30)
    ]
    rows += [(100, "https://two.example/", rows[0][2]), (101, None, rows[1][2]), (0, rows[0][1], rows[0][2])]
    found = texts(spark, rows)
    assert all(found[i] == f"{i} is the number of this page" for i in range(30))
    # The only pages of their hosts share nothing with another page there.
    assert found[100].startswith(menu) and found[101].startswith(menu)


def test_odd_pages(spark):
    rows = [(1, "x", None), (2, "x", ""), (3, None, "no markup at all"), (4, "x", "<p>open <b>never closed"),
            (5, "x", "<p>cut off <a hre"), (6, "x", "a < b and c > d"), (7, "x", "<!-- <p>no</p> --><p>yes</p>"),
            (8, "x", "<script>while(1)"),
            (10, "x", "<p title=it's>don't</p>"), (11, "x", """<p a="x>y" b='>' c=">>>">in</p>"""), (12, "x", '<p a="x>y'), (9, "x", "<p>" + "long " * 50000)]
    found = texts(spark, rows)
    assert found == {1: "", 2: "", 3: "no markup at all", 4: "open never closed", 5: "cut off", 6: "a < b and c > d",
                     7: "yes", 8: "", 10: "don't", 11: "in", 12: "y", 9: ("long " * 50000).strip()}
    assert pages.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_articles_inside_what_looks_outside(spark):
    text, menu = "<h1>Head</h1><p>The text of the page.</p>", "<nav>Menu</nav>"
    held = [
        f'<body class="no-sidebar has-header">{menu}<article>{text}</article></body>',
        f'<html id="header"><body class="sidebar">{menu}<article>{text}</article></body></html>',
        f'<body>{menu}<main class="with-sidebar" id="menu">{text}</main></body>',
        f'<body>{menu}<article class="comment-status-open">{text}</article></body>',
        f'<body><form action="x">{menu}<div>Search</div><article>{text}</article></form></body>',
        f'<body><form action="x">{menu}<div role="main">{text}</div></form></body>',
        f'<body><div class="header sidebar">{menu}<article>{text}</article></div></body>',
        f'<body><app-page class="widget">{menu}<article>{text}</article></app-page></body>',
        f'<body><x class="widget">{menu}<main>{text}</main></x></body>',
        f'<body><main><div class="sidebar"><article>{text}</article></div></main></body>',
        f'<body><form>{menu}<div>{text}</div></form></body>',
        f'<body><app-page class="sidebar">{menu}{text}<div class="ad">Buy</div></app-page></body>',
    ]
    found = texts(spark, [(i, f"http://h{i}/", page) for i, page in enumerate(held)])
    assert found == {i: "Head\nThe text of the page." for i in range(len(held))}


def test_articles_that_are_not_the_page(spark):
    own = "<article><p>Own</p><div class='comments'><article>First!</article></div></article>"
    teaser = "<article>Other</article>"
    rows = [(1, "http://a/", f"{own}<div class='related'>{teaser}</div>"), (2, "http://b/", f"{own}<aside>{teaser}</aside>"),
            (3, "http://c/", f"<p>Own</p><aside>{teaser}</aside>")]
    assert texts(spark, rows) == {1: "Own", 2: "Own", 3: "Own"}


def test_copies_and_quotes_on_hosts_without_articles(spark):
    menu = "start news sport culture travel weather contact imprint privacy help"
    copy = "one long text that stands under two addresses of its host with different menus around"
    quote = "as they said we shall fight on the beaches and never surrender at all"
    page = "<body><div>{}</div><div>{}</div></body>"
    rows = [(i, f"http://a/{i}", page.format(menu, f"{i} is the number of this page")) for i in range(20)]
    rows += [(20, "http://a/20", page.format(menu, copy)), (21, "http://a/21", page.format(f"{menu} home", copy))]
    rows += [(i, f"http://a/{i}", page.format(menu, f"{i} says {quote} and ends")) for i in (22, 23)]
    rows += [(30 + i, f"http://two/{i}", page.format(m, copy)) for i, m in enumerate(("Up", "Down"))]
    found = texts(spark, rows)
    assert found[20] == copy and found[21] == f"home\n{copy}"
    assert all(found[i] == f"{i} is the number of this page" for i in range(20))
    assert all(found[i] == f"{i} says {quote} and ends" for i in (22, 23))
    assert found[30].endswith(copy) and found[31].endswith(copy)


def test_blocks_do_not_run_into_each_other(spark):
    page = "<div>menu</div><p>Page {} text is here</p><div>Copyright 2024 Us</div>"
    found = texts(spark, [(i, f"http://a/{i}", page.format(i)) for i in range(9)])
    assert found == {i: f"Page {i} text is here" for i in range(9)}


def test_hosts_of_two_pages(spark):
    page = "<div>Start News Imprint</div><p>{}</p><div>Copyright by the owner of this small site, all rights</div>"
    rows = [(1, "http://a/1", page.format("The first text here")), (2, "http://a/2", page.format("And the second text"))]
    assert texts(spark, rows) == {1: "The first text here", 2: "And the second text"}


def test_the_host_decides_inside_articles_too(spark, monkeypatch):
    """A notice that stands outside the article on most pages and inside it on one."""
    notice = "Subscribe to our newsletter and never miss a story from us again"
    line = "This line of more than eight words stands in every single article here"
    outside = "<article><p>Text {}</p><p>" + line + "</p></article><div>" + notice + "</div>"
    rows = [(i, f"http://a/{i}", outside.format(i)) for i in range(6)]
    rows += [(6, "http://a/6", f"<article><p>Text 6</p><p>{notice}</p><p>{line}</p></article>")]
    assert texts(spark, rows) == {i: f"Text {i}\n{line}" for i in range(7)}
    monkeypatch.setattr(pages, "PAGES", 100)
    assert texts(spark, rows)[6] == f"Text 6\n{notice}\n{line}"
