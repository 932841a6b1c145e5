from ebbtide.llm import blocks

P = "A sentence with enough words to be read as a paragraph of the text."


def test_article_without_its_surroundings():
    page = f"""<!DOCTYPE html><html><head><title>No</title><style>p{{}}</style><script>var a="<p>no</p>"</script></head><body>
      <header><nav><ul><li><a href="/a">Home</a></li></ul></nav></header><div class="cookie-banner">We use cookies</div>
      <!-- <p>no</p> --><article><header><h1>Title &amp; more</h1></header><p>One<br>two  <b>three</b>
      <p>&lt;four&gt;&nbsp;five<aside>Related</aside><div class="ad-slot"><p>Buy now</p></div>
      <figure><figcaption>Seen</figcaption></figure><form><label>Mail</label><input></form>
      <section id="comments"><p>Nice post</p></section></article><div class="sidebar"><p>{P}</p></div>
      <footer>&copy; nobody</footer></body></html>"""
    assert blocks.main_text(page) == "Title & more\nOne two three\n<four> five\nSeen"


def test_nothing_around_an_article_takes_it_away():
    inner = f"<h1>Title</h1><p>{P}</p><p>He said no.</p><p>{P} {P}</p>"
    want = f"Title\n{P}\nHe said no.\n{P} {P}"
    side = f'<div class="sidebar"><p>{P}</p></div><nav><ul><li><a href=a>Home</a></li></ul></nav>'
    for page in (
        f'<div class="layout has-sidebar"><article>{inner}</article></div>{side}',
        f'<div id="content-sidebar-wrap"><article>{inner}</article>{side}</div>',
        f'<article class="post category-social tag-alert">{inner}</article>{side}',
        f'<article class="post comments-open">{inner}</article>{side}',
        f'<form id="aspnetForm" action="/"><article>{inner}</article>{side}</form>',
        f'<div class="related"><main><div class="post-header"><h1>Title</h1></div>{inner[14:]}</main></div>{side}',
        f'<article><div class="post-header"><h1>Title</h1></div>{inner[14:]}</article>{side}',
        f'<article>{inner}</article><section id="comments"><ol class="comment-list"><li class="comment"><article class="comment-body"><p>{(P + " ") * 30}</p></article></li></ol></section>',
        f'<form id="aspnetForm" action="/"><div id="page">{inner}</div>{side}</form>',
        f'<div id="content-sidebar-wrap"><div class="content">{inner}</div>{side}</div>',
    ):
        assert blocks.main_text(f"<html><body class='sidebar-left'>{page}</body></html>") == want, page


def test_short_blocks_follow_their_neighbours():
    page = f'<div><p>{P} {P}</p><p>He said no.</p><p>Why?</p><p>{P} {P}</p><p><a href="/">More</a></p></div><div class="ad"><p>Buy.</p></div>'
    assert blocks.main_text(page) == f"{P} {P}\nHe said no.\nWhy?\n{P} {P}"


def test_class_words():
    for token, place in (
        ("comment-list", "comment"), ("comments-area", "comment"), ("comments-open", None), ("has-sidebar", None), ("sidebar", "side"),
        ("site-footer", "frame"), ("banner-ad", "advert"), ("ad-slot", "advert"), ("shadow", None), ("cookie-banner", "frame"), ("", None),
        ("widget-2", "side"), ("headerless", None), ("category-news", None), ("-", None),
    ):
        assert blocks.place_of(token) == place, token


def test_time_grows_with_the_page():
    import time

    def seconds(page):
        start = time.perf_counter()
        blocks.Page(page)
        return time.perf_counter() - start

    for piece in ('<div class="a"><p>x', "<object>x", "<b><p>x", "<span>x</i>"):
        blocks.Page(piece * 10)
        assert seconds(piece * 20_000) < 12 * max(seconds(piece * 4_000), 0.01)


def test_page_without_article():
    page = f'<div id="menu"><a href=x>Home</a> <a href=y>About</a></div><div><h1>A title of the page</h1><p>{P}</p><p>{P} {P}</p></div><div id=footer>me</div>'
    assert blocks.main_text(page) == f"A title of the page\n{P}\n{P} {P}"


def test_cut_and_broken_markup():
    assert blocks.main_text("<article><h1>T</h1><p>one &am") == "T\none &am"
    assert blocks.main_text("<article><p>a<script>never closed <p>b") == "a"
    assert blocks.main_text("<article><p>a <b>b</p><p>c</b> d</article") == "a b\nc d"
    assert blocks.main_text('<article><p title="a>b">x < y</p>') == "x < y"


def test_documents(spark):
    rows = [(1, "u", "<article><p>x"), (1, "u", "<article><p>x"), (2, None, None), (3, "", ""), (None, "v", "<p></p>"), (4, "w", "<article><p>" + "é " * 200_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, main string")
    got = sorted((r["__row"]["page_id"] or 0, r["main"]) for r in blocks.extract_pages(pages).collect())
    assert got == [(0, ""), (1, "x"), (1, "x"), (2, ""), (3, ""), (4, ("é " * 200_000).strip())]
    assert blocks.extract_pages(pages.limit(0)).count() == 0


def test_tree_fits_its_table():
    pages = [blocks.Page(p) for p in blocks.labelled_pages()]
    right = total = 0
    for page in pages:
        said = blocks.classifier().predict(page.numbers) >= 0.5
        right += sum(int(s) == y for s, y in zip(said, page.labels))
        total += len(page.labels)
    assert right / total > 0.97
    unseen = [blocks.Page(p) for p in blocks.labelled_pages(60, seed=8)]
    said = [int(s) == y for p in unseen for s, y in zip(blocks.classifier().predict(p.numbers) >= 0.5, p.labels)]
    assert sum(said) / len(said) > 0.95
