import random

from tidemark.llm import html as ht

PAGE = """<!DOCTYPE html><html lang=en><head><title>T</title><style>p{}</style><script>var a="</p><article>";</script></head><body class="has-sidebar">
<header class="site"><a href="/">Home</a></header><nav><ul><li><a href=x>One</a><li><a href=y>Two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site to improve your visit, please accept them now.</p></div>
<div id="wrap"><aside><p>Side words that are long enough to matter in this little test page.</p></aside>
<article class="post"><h1>The&nbsp;title &amp; more</h1><p><b>First   line<br>goes on.</b><p>Second &lt;one&gt; paragraph has several words in it.
<div class="ad">Buy this now</div><ul><li>item <i>one</i></li><li>item two</li></ul><form><input name=q><button>Send</button>Your name</form>
<p>Last words here.</p></article><section id="comments"><p>Reader says a lot of things here, more than the article does, really a great many words of no use.</p></section></div>
<!-- x <p>hidden</p> --><footer><p>&copy; all rights</p></footer></body></html>"""
TEXT = "The title & more\n\nFirst line goes on.\n\nSecond <one> paragraph has several words in it.\n\nitem one\n\nitem two\n\nLast words here."


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://h/{i}", p, "x") for i, p in rows], "page_id bigint, url string, html string, text string")


def test_article_of_a_full_page(spark):
    weights = ht.learn(pages(spark, [(1, PAGE)]))
    assert ht.main_text(PAGE, weights) == TEXT
    assert ht.main_text(PAGE, {}) == TEXT
    (r,) = ht.extract(pages(spark, [(1, PAGE)]), weights).collect()
    assert (r.page_id, r.url, r.text, r.n_chars) == (1, "http://h/1", TEXT, len(TEXT))


def test_content_region_without_article_elements(spark):
    body = "".join(f"<p>Paragraph {i} holds a good number of plain words for the reader.</p>" for i in range(5))
    page = f"<body><div><a href=1>A</a><a href=2>B</a><a href=3>C</a></div><div>{body}</div><table><tr><td><a href=4>D</a></td><td><a href=5>E</a></td></tr></table></body>"
    got = ht.main_text(page, ht.learn(pages(spark, [(1, PAGE)])))
    assert got.split("\n\n") == [f"Paragraph {i} holds a good number of plain words for the reader." for i in range(5)]


def test_best_region_equals_brute_force():
    rng = random.Random(15)
    for _ in range(200):
        s = [rng.choice([-3, -1, 1, 2]) for _ in range(rng.randrange(12))]
        a, b = ht.best_region(s)
        best = max((sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=0)
        assert (sum(s[a : b + 1]) if b >= a else 0) == max(best, 0)


def test_words_score_positive_and_tags_negative(spark):
    w = ht.learn(pages(spark, [(1, PAGE), (2, None), (3, "<article>a</article><article>b</article>")]))
    assert w["word"] > 0 and w["link"] > 0 and all(v < 0 for k, v in w.items() if k not in ("word", "link"))


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "<p></p><script>x"), (4, "plain < text & more"), (4, "plain < text & more"), (5, "<div class=ad><article>kept text"), (None, "<p " * 3000), (7, "word " * 30000)]
    got = {(r.page_id, r.text, r.n_chars) for r in ht.extract(pages(spark, rows), {}).collect()}
    assert {(1, "", 0), (2, "", 0), (3, "", 0), (4, "plain < text & more", 19), (5, "kept text", 9)} <= got
    assert any(p == 7 and n == 5 * 30000 - 1 for p, _, n in got)
    assert ht.extract(pages(spark, []), {}).collect() == [] and ht.learn(pages(spark, []))["word"] > 0


def test_left_out_elements_end_without_an_end_tag():
    for page in (
        "<article><p>one<p hidden>x<p>real text<p>more</article>",
        "<article><p>one<p hidden>x<div>real text</div><p>more</article>",
        "<article><p>one<p><span hidden>x<p>real text<p>more</article>",
        "<article><p>one<ul><li hidden>x <p>x<li>real text</ul><p>more</article>",
        "<article><p>one<ul><li hidden>x <ul><li>x<li>x</ul></ul><p>real text<p>more</article>",
        "<article><p>one<dl><dt hidden>x<dd>real text</dl>more</article>",
        "<article><p>one<table><tr hidden><td>x<td>x<tr><td hidden>x<td>real text</table>more</article>",
        "<article><p>one<table><tr><td hidden><table><tr><td>x</table>x</table><p>real text<p>more</article>",
        "<article><p>one<div><div hidden>x <div>x</div></div>real text</div><p>more</article>",
        "<article><p>one<div><div hidden>x <p>x</div><p>real text<p>more</article>".replace("<p>x</div>", "<p>x</div></div>"),
        "<main><article><p>one<div hidden>x</article><p>real text<p>more</main>",
        "<html><head><title>x</title><meta charset=utf-8><body><article><p>one<p>real text<p>more</article>",
    ):
        assert ht.main_text(page, {}).split("\n\n") == ["one", "real text", "more"], page


def test_raw_end_tags_are_found_on_the_page_itself():
    page = "<article><p>" + "\u0130" * 30 + "<script>x</script>real text<SCRIPT>y</Script >more</article>"
    assert ht.main_text(page, {}).split("\n\n") == ["\u0130" * 30, "real text", "more"]


def test_names_inside_an_article():
    long = "word " * 120
    for part, text in (
        ('<h2 class="section-header">Kept head</h2>', "Kept head"),
        ('<h1 class="article-header">Kept title</h1>', "Kept title"),
        ('<div class="article-header"><h1>Kept title</h1></div>', "Kept title"),
        ('<p class="related">Kept words</p>', "Kept words"),
        ('<pre><code>x = 1 <span class="hljs-comment"># kept</span></code></pre>', "x = 1 # kept"),
        ('<pre><div class="token comment"># kept</div></pre>', "# kept"),
        (f'<div class="with-sidebar"><p>{long}</p></div>', long.strip()),
        (f'<div class="with-sidebar"><div class="ad">Buy</div><p>{long}</p><div class="share">Share</div></div>', long.strip()),
        (f'<div class="related"><p><a href=x>{long}</a></p><p>few words</p></div>', ""),
        (f'<section class="comments"><p>{long}</p></section>', ""),
        ('<div class="related"><p>few words</div>', ""),
        (f'<div class="promo"><div hidden>{long}</div><div class="ad">{"word " * 60}</div>{"word " * 60}</div>', ""),
    ):
        page = f"<body><article><p>one</p>{part}<p>two</p></article></body>"
        assert ht.main_text(page, {}) == "\n\n".join(x for x in ("one", text, "two") if x), part
    assert ht.main_text("<article><p>one<div class=ad>x</article><p>out", {}) == "one"
