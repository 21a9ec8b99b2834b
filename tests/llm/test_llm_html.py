"""Main text on hosts with several layouts, from copied pages, past odd markup and inside misleading wrappers."""

from pulsegrid.llm import html

MENU = "<nav><ul><li><a href=/>Home</a><li><a href=/all>All</a></ul></nav>"


def texts(spark, pages):
    df = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html.extract(df).orderBy("page_id").collect()]


def body(i):
    return f"Text {i} about " + " ".join(f"thing{i}x{k}" for k in range(30))


def test_layouts_of_one_host(spark):
    pages = [(f"http://a.example/{i}", f"<body>{MENU}<article><p>{body(i)}</p></article></body>") for i in range(4)]
    pages += [(f"http://a.example/{i}", f"<body>{MENU}<main><p>{body(i)}</p></main></body>") for i in range(4, 7)]
    pages += [(f"http://a.example/{i}", f"<body>{MENU}<div><div class=text><p class=t>{body(i)}</p></div></div></body>") for i in range(7, 10)]
    # pages without a host have nothing to do with each other
    pages += [(None, f"<body><article><p>{body(10)}</p></article></body>"), ("not a url", f"<body><div><p class=u>{body(11)}</p></div></body>")]
    assert texts(spark, pages) == [body(i) for i in range(12)]


def test_copies_are_no_template(spark):
    copied = f"<body>{MENU}<div><p>{body(0)}</p></div></body>"
    block = f"<body>{MENU}<div><p>{body(1)}</p></div><section><p>{body(2)}</p></section></body>"
    pages = [("http://b.example/1", copied)] * 5
    pages += [("http://c.example/1", block)] * 3 + [(f"http://c.example/{i}", f"<body>{MENU}<div><p>{body(i)}</p></div></body>") for i in range(3, 6)]
    # constant on distinct pages all the same
    legal = "<div class=legal><p>All rights reserved by us and everyone else, for ever.</p></div>"
    pages += [(f"http://d.example/{i}", f"<body><div><p>{body(i)}</p></div>{legal}</body>") for i in range(4)]
    assert texts(spark, pages) == [body(0)] * 5 + [body(1) + " " + body(2)] * 3 + [body(i) for i in range(3, 6)] + [body(i) for i in range(4)]


def test_odd_markup():
    def read(page):
        return [t for t in html.tokens(page) if t[0] == "#"], "".join(t for _, t, _ in html.tokens(page))

    for odd in ("</3>", "</>", "</ p>", "<svg width=5 />", "<svg/>", "<b title=it's>", '<b title=5">', "<b title='a>b' x=\"c>d\">", "<b title=a\"b'c>", "<b =x = y'>",
                "<!-->", "<!--->", "<!-- a > b -->", "<b title='it>"):
        for rest in ("", " it is", " \"quoted\"" if '"' not in odd else " plain"):
            assert read(f"<p>one {odd}two{rest}<p>three")[1] == f"one two{rest}three", (odd, rest)
    assert read("<p title=it's>one</p><p>it's two</p>")[1] == "oneit's two"
    assert read("<p>one <svg><path d=x /></svg>two")[1] == "one two"
    # only what no '>' follows is cut off
    assert read("<p>one</p>two <p cla")[1] == read("<p>one</p>two <a href='x")[1] == read("<p>one</p>two </3 x")[1] == "onetwo"
    assert read("<p>1 < 3 & more")[1] == "1 < 3 & more"
    page = "<p>x</p>" + "<a b=\"c\" d='e' f=g" * 20_000
    assert read(page)[1] == "x"


def test_misleading_wrappers(spark):
    side = "<div class=sidebar><p>Side words</p></div><div class='site-comments'><p>Reader says</p></div>"
    layouts = ["<div class='content-sidebar-wrap'><article><p>{}</p></article>" + side + "</div>",
               "<div class='page has-sidebar'><article class='post no-comments'><p>{}</p></article>" + side + "</div>",
               "<main id=skip-target><p>{}</p></main>" + side,
               "<div class=search><main><p>{}</p></main></div>" + side,
               "<form action=x><div><p>{}</p></div>" + side + "</form>",
               "<form action=x><article><p>{}</p></article>" + side + "</form>",
               "<div class=sidebar-layout><div><p>{}</p></div></div>" + side,
               "<article><div class='share-body'><p>{}</p></div><div class=related><p>Other</p></div></article>",
               # what is beside an article stays out, however long it is
               "<article><p>{}</p><div class=comments><p>" + "Reader says more. " * 100 + "</p></div></article><div class=related><article><p>Card</p></article></div>",
               "<div class=text><p>{}</p></div><div class=comments-container><p>Reader says</p></div><form><p>Name</p></form>"]
    pages = [(f"http://h{k}.example/{i}", "<body>" + MENU + layout.format(body(i)) + "</body>") for k, layout in enumerate(layouts) for i in range(4)]
    got = texts(spark, pages)
    assert [(k // 4, t) for k, t in enumerate(got) if t != body(k % 4)] == []


def test_articles_that_are_not_the_text(spark):
    """Comments and cards in article elements beside the text, and titles in headers of articles."""
    def title(i):
        return f"Title {i} of thing"

    layouts = ["<main><h1>{t}</h1><p>{b}</p><section id=comments><article class=comment><p>Reader {i} says hi</p></article></section></main>",
               "<main><h1>{t}</h1><p>{b}</p><div class=cards><article><p>Teaser card {i}</p></article></div></main>",
               "<article><h1>{t}</h1><p>{b}</p></article><section class=more><article><p>Other story {i}</p></article></section>",
               "<article><header class='entry-header'><h1>{t}</h1></header><p>{b}</p></article>",
               "<article><div class='article-header'><h1>{t}</h1></div><p>{b}</p></article>",
               "<div class=content><div class='post-header'><h1>{t}</h1></div><p>{b}</p></div><div class='site-header'><p>Site {i}</p></div>",
               "<main><article><h1>{t}</h1><p>{b}</p></article><article class=comment><p>Reader {i}</p></article></main>",
               "<h1>{t}</h1><p>{b}</p><div class=cards><article><p>Teaser card {i}</p></article></div>"]
    pages = [(f"http://j{k}.example/{i}", "<body>" + MENU + layout.format(t=title(i), b=body(i), i=i) + "</body>") for k, layout in enumerate(layouts) for i in range(4)]
    got = texts(spark, pages)
    assert [(k // 4, t) for k, t in enumerate(got) if t != title(k % 4) + " " + body(k % 4)] == []


def test_several_articles_make_one_text(spark):
    page = "<main>" + "".join("<article class=a{k}><h2>Part {i} {k}</h2><p>{b}</p></article>".replace("{k}", str(k)) for k in range(3)) + "</main>"
    pages = [(f"http://k.example/{i}", "<body>" + MENU + page.replace("{i}", str(i)).replace("{b}", body(i)) + "</body>") for i in range(4)]
    assert texts(spark, pages) == [" ".join(f"Part {i} {k} {body(i)}" for k in range(3)) for i in range(4)]
