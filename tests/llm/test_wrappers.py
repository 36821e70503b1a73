from __future__ import annotations

from stateloom.llm.dom import folded, matching, merge, parsed, read, written
from stateloom.llm.wrappers import extract, induce, shape_and_blocks

PAGES = "page_id long, url string, html string, host string, text string"


def texts(spark, rows):
    frame = spark.createDataFrame([(*r, "h", "t") for r in rows], PAGES)
    return {r.page_id: (r.text, r.n_chars) for r in extract(frame, induce(frame)).collect()}


def test_reader_tolerates_soup():
    shape, where, blocks = shape_and_blocks("<body><!-- a<p>b --><script>if(a<b){'</p>'}</script><p>One <b>two<br>three<p class='Ad x'>buy<div title='a>b'>&lt;x&gt; &am &copy\n\n y</div></i>tail")
    assert blocks == ["One two", "three", "buy", "<x> &am © y", "tail"]
    assert written(parsed(shape)) == shape and shape.count("p.ad.x") == 1
    for page in ("", "<", "<p", "<script>x", "<!--", "</p></p>", "<div>" * 5000 + "deep", "a" * 300_000, "<p>" * 20_000):
        shape_and_blocks(page)


def test_simple_tree_matching_and_merge():
    a, b = (folded(read(x)[0]) for x in ("<div><h1>t</h1><ul><li>1<li>2</ul><p>x</p></div>", "<div><ul><li>1</ul><table></table><p>x<p>y</div>"))
    size, pairs = matching(a, b)
    assert size == len(pairs) == 5  # page, div, ul, li, p
    assert written(merge(a, b)) == "0 page\n1 div\n2 h1\n2 ul\n3 li\n2 table\n2 p"


def test_article_without_its_surroundings(spark):
    page = (
        "<html><head><title>T</title></head><body><nav><ul><li>Menu {n}</ul></nav><div class='ad'>Buy {n}</div><article><h1>Title {n}</h1><p>First  part\n{n}."
        "<aside>See also</aside><p>Second &amp; last.<form>Name</form><section class='comments'><p>me too</p></section></article><footer>(c)</footer></body></html>"
    )
    found = texts(spark, [(n, "http://a.b/x", page.replace("{n}", str(n))) for n in range(4)] + [(9, None, page.replace("{n}", "9"))])
    for n in (0, 1, 2, 3, 9):
        want = f"Title {n}\nFirst part {n}.\nSecond & last."
        assert found[n] == (want, len(want))


def test_slots_that_vary_are_content_where_nothing_names_it(spark):
    page = "<div class='top'><p>Site name</p></div><div class='c'><h2>Head {n}</h2><p>Body text number {n} goes here.</p><span>Read more</span><h3>Always the same</h3></div><div>Legal</div>"
    found = texts(spark, [(n, "https://x.org/", page.replace("{n}", str(n))) for n in range(5)])
    assert found[3][0] == "Head 3\nBody text number 3 goes here."


def test_copies_of_one_page_lose_nothing(spark):
    page = "<body><article><h1>Same</h1><p>Text of all copies.</p></article></body>"
    found = texts(spark, [(n, "https://x.org/", page) for n in range(5)] + [(7, "https://x.org/", None), (8, "https://x.org/", "")])
    assert found[0][0] == found[4][0] == "Same\nText of all copies." and found[7] == found[8] == ("", 0)


def test_empty_table(spark):
    frame = spark.createDataFrame([], PAGES)
    assert extract(frame, induce(frame)).count() == 0


def test_pages_without_article_on_a_host_with_articles(spark):
    article = "<body><div class='head'>Site</div><article><h1>Title {n}</h1><p>Part {n}.</article></body>"
    plain = "<body><div class='head'>Site</div><div class='text'><p>Plain text {n}.</p></div></body>"
    for url in ("https://x.org/", None):
        found = texts(spark, [(n, url, (article if n % 2 else plain).replace("{n}", str(n))) for n in range(8)])
        assert found[1][0] == "Title 1\nPart 1." and found[2][0] == "Plain text 2."


def test_both_parts_of_a_text_in_two_siblings(spark):
    page = "<div class='intro'><p>A long beginning of number {n} with most words</p></div><div class='more'><p>And its end {n}</p></div><div class='legal'><p>Legal</p></div>"
    found = texts(spark, [(n, "https://x.org/", page.replace("{n}", str(n))) for n in range(5)])
    assert found[2][0] == "A long beginning of number 2 with most words\nAnd its end 2"


def test_names_that_only_contain_a_menus_name_set_nothing_aside(spark):
    page = (
        "<body class='single no-sidebar'><div id='page' class='has-header-image'><div class='site-footer'><p>Foot {n}</p></div>"
        "<div class='content with-sidebar'>BODY</div></div></body>"
    )
    article = page.replace("BODY", "<article class='post comment-open'><p>Text {n}.</p><ol class='comment-list'><li><article class='x'><p>me too {n}</p></article></ol></article>")
    widget = page.replace("BODY", "<div class='widget'><article><p>Text {n}.</p></article></div>")
    for url, html in (("https://a.org/", article), ("https://b.org/", widget), ("https://c.org/", page.replace("BODY", "<p>Text {n}.</p>"))):
        found = texts(spark, [(n, url, html.replace("{n}", str(n))) for n in range(4)])
        assert found[2][0] == "Text 2."


def test_void_elements_within_a_line_end_no_block():
    _, _, blocks = shape_and_blocks("<p>a <img src=x class=ad> b<input>c<meta itemprop=y> d<br>e<hr>f</p>")
    assert blocks == ["a bc d", "e", "f"]


def test_class_words_of_what_surrounds_a_text(spark):
    dropped = ["share-buttons", "related-posts", "newsletter-signup", "post-comments", "user-comments", "disqus_thread", "social-icons", "cookie-message"]
    stay = ["post-header", "comment-open", "article-body", "no-comments-here", "post"]
    parts = "".join(f"<div class='{c}'><p>{c} {{n}}</p></div>" for c in dropped + stay)
    page = f"<body><article><p>Text {{n}}.</p>{parts}</article></body>"
    found = texts(spark, [(n, "https://x.org/", page.replace("{n}", str(n))) for n in range(4)])
    assert found[1][0] == "\n".join(["Text 1.", *[f"{c} 1" for c in stay]])
