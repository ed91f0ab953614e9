"""Main text of pages."""

from pyspark.sql import functions as F

from tessera.llm import html_text as H

LONG = "Main text goes on and on. " * 8

PAGE = f"""<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var a="</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href=1>One</a></li></ul></nav><div class="cookie-notice">We use cookies {LONG}</div>
<article><h1>Title &amp; more</h1><p>{LONG}<b>bo</b>ld<br>x&nbsp;y<p>unclosed <!-- no --><aside>aside {LONG}</aside><div class="ad">buy {LONG}</div>
<table><tr><td>c1<td>c2</table><form><p>name</p></form><p>tail</p></article>
<section id="comments"><p>{LONG}</p></section><footer>&copy; f</footer></body></html>"""


def test_article_page():
    assert H.main_text(PAGE) == " ".join(f"Title & more {LONG} bold x y unclosed c1 c2 tail".split())


def test_page_without_article():
    page = f"<div><ul><li><a href=x>link one</a></li><li><a href=y>link two</a></li></ul><div class='sidebar'>{LONG}</div><div><p>{LONG}</p><p>short</p></div><div>" + "<br>" * 6 + "<p>far small print</p></div></div>"
    assert H.main_text(page) == " ".join(f"{LONG} short".split())


def test_odd_pages():
    assert H.main_text("") == ""
    assert H.main_text("plain") == "plain"
    assert H.main_text("<p>hi") == "hi"
    assert H.main_text("<p>a < b and c > d &lt;p&gt; &#233;") == "a < b and c > d <p> é"
    assert H.main_text("<ul><li><a href=a>only links here</a></ul>") == ""
    assert H.main_text("<script>if(a<b){'</p>'}") == ""
    assert H.main_text("<article>" + "<div>" * 5000 + "deep" + "</div>" * 5000 + "</article>") == "deep"
    assert H.main_text("<!-- never closed <p>x") == ""
    words = "w " * 300_000
    assert H.main_text(f"<article><p>{words}</p></article>") == words.strip()


def test_labels_in_one_word():
    assert H.main_text(f"<article><div class=cookieBanner>c</div><div id='sidebarRight'>s</div><div class='shared column'>{LONG}</div></article>") == LONG.strip()


def test_only_hiding_attributes_hide():
    for shown in ('style="overflow:hidden"', 'style="overflow-x: hidden"', 'data-state="not hidden"', 'aria-hidden="false"', "hidden=until-found", 'title="display:none"', 'data-style="display:none"'):
        assert H.main_text(f"<article><div {shown}><p>{LONG}</p></div></article>") == LONG.strip(), shown
    for gone in ("hidden", "hidden=''", "HIDDEN=hidden", 'aria-hidden="true"', 'style="color:red; DISPLAY : none !important"', "style=display:none"):
        assert H.main_text(f"<article><div {gone}><p>gone</p></div><p>{LONG}</p></article>") == LONG.strip(), gone


def test_labels_never_take_the_article():
    for around in ('class="content-with-sidebar"', 'id=page class="no-sidebar"', 'class="related-work"', 'class="site-header"'):
        assert H.main_text(f"<body><div {around}><article><p>{LONG}</p></article></div></body>") == LONG.strip(), around
        assert H.main_text(f"<body><div {around}><main><p>{LONG}</p></main></div></body>") == LONG.strip(), around
    for own in ('class="post has-comments"', "class=comments", "id=related-1"):
        assert H.main_text(f"<article {own}><p>{LONG}</p></article>") == LONG.strip(), own
    assert H.main_text(f"<div class=related-work><p>{LONG}</p></div><p>x</p>").startswith(LONG.strip())
    for label in ("main-nav", "siteFooter", "sidebarRight", "comments", "cookie-notice", "top-ads", "ADS"):
        for body in (f"<div class='{label}'><p>gone {LONG}</p></div>", f"<div id='{label}'><article>gone</article></div>"):
            assert H.main_text(f"<article><p>{LONG}</p></article>{body}") == LONG.strip(), label
            assert H.main_text(f"<article><p>{LONG}{LONG}</p>{body}</article>") == f"{LONG}{LONG}".strip(), label


def test_short_blocks_without_article():
    """Short blocks in elements of their own, split by adverts or far off in the same container, stay."""
    ad = "<div class=ad>" + "<p>buy now</p>" * 9 + "</div>"
    short = ["Subheading", "- Yes, they said.", "- No!", "The end."]
    text = f"{LONG} Subheading - Yes, they said. - No! The end.".replace("  ", " ")
    for between in ("", "<div></div>" * 5, ad, "<hr>", "<script>x</script><aside><p>a</p><p>b</p><p>c</p><p>d</p></aside>"):
        wrapped = between.join(f"<div><div><p>{x}</p></div></div>" for x in [LONG, *short])
        assert H.main_text(f"<body>{wrapped}</body>") == text, between
    links = "<ul>" + "<li><a href=x>another page</a></li>" * 9 + "</ul>"
    assert H.main_text(f"<body><div><h2>Head</h2>{links}<p>{LONG}</p>{links}<p>end</p></div><div>{links}<p>x</p><p>y</p></div></body>") == f"Head {LONG}end"


def test_window_sums_decide_inside_and_outside_articles():
    cards = "".join(f"<article><p>card {i}</p></article>" for i in range(3))
    body = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    assert LONG + LONG.strip() in H.main_text(f"<body>{body}{cards}</body>")
    teasers = "".join(f"<article><p>{LONG}</p></article>" for _ in range(4))
    prose = "<div>" + f"<p>{LONG}</p>" * 3 + "</div>"  # most of the text is in teasers, yet the body stays
    assert len(H.main_text(f"<body>{prose}{teasers}</body>")) == 7 * len(LONG) - 1
    links = "<ul>" + "<li><a href=x>another page</a></li>" * 9 + "</ul>"
    page = f"<body><p>tagline</p><article><h1><a href=y>Title</a></h1><p>{LONG}</p>{links}<p>end</p></article><p>small print</p></body>"
    assert H.main_text(page) == f"Title {LONG}end"
    assert H.main_text("<article><p>short</p></article>") == "short"


def test_rows(spark):
    rows = [(1, "u", PAGE, "own"), (1, "u", PAGE, "own"), (None, None, None, None), (2, "v", "", "own")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = H.extract_text(pages, out_col="main")
    assert got.columns == ["page_id", "url", "html", "text", "main"]
    assert sorted((r["page_id"] or 0, r["main"]) for r in got.collect()) == sorted([(1, H.main_text(PAGE)), (1, H.main_text(PAGE)), (0, ""), (2, "")])
    assert H.extract_text(pages.where(F.lit(False))).count() == 0
