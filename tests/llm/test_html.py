from collections import defaultdict

from affinity.llm import html_main as H


def text_of(page):
    return H.main_text(H.page_blocks(page), set())[0]


def test_structure():
    page = ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p><article>';</script></head><body>"
            "<nav><ul><li>Menu</ul></nav><!-- <p>no</p> --><div class='ad'>Buy</div><header>Site</header>"
            "<article><h1>Head &amp; more</h1><p><b>One<br>two  \n three<p>4 &lt; 5 &nbsp;x</p><aside>side</aside>"
            "<form>mail <input name=a></form><ul><li>a<li>b</ul><div class=\"comments\"><p>nice post</p></div></article>"
            "<footer>&copy; me</footer>")
    assert text_of(page) == "Head & more\nOne two three\n4 < 5 x\na\nb"


def test_pages_without_an_article_and_broken_markup():
    assert text_of("<p>one<p>two<div id=sidebar>no</div>three") == "one\ntwo\nthree"
    assert text_of("a < b <p>c</p") == "a < b\nc"
    assert text_of("") == "" and text_of("<script>alert(1)") == "" and text_of("<!-- open") == ""
    assert text_of("<main>x<div role=navigation>n</div>y</main><p>z") == "x\ny"
    assert text_of("<div hidden>h</div><div aria-hidden=true>i</div><p>k</p>") == "k"


def brute_covered(pages, min_pages, share):
    """Positions of tokens repeated on enough pages of a host, by all windows."""
    at = defaultdict(set)
    streams = {i: H.outside_tokens(H.page_blocks(h or "")) for i, h in pages}
    for i, t in streams.items():
        for k in range(max(len(t) - H.MIN_TOKENS + 1, 1 if t else 0)):
            at[tuple(t[k:k + H.MIN_TOKENS])].add(i)
    out = {}
    for i, t in streams.items():
        hit = set()
        for k in range(max(len(t) - H.MIN_TOKENS + 1, 1 if t else 0)):
            if len(at[tuple(t[k:k + H.MIN_TOKENS])]) >= max(min_pages, share * len(pages)):
                hit |= set(range(k, min(k + H.MIN_TOKENS, len(t))))
        out[i] = hit
    return out


def test_boilerplate_of_a_host(spark):
    note = "we use biscuits on this site please agree with all of them"
    rows = [(i, "http://h.example/p", f"<p>{note}</p><p>start{i} own text{i} of page{i * 7} here now ok{i}</p>") for i in range(20)]
    rows += [(100, "http://other.example/", f"<p>{note}</p>"), (101, None, "<p>no url</p>"), (102, "odd", None), (103, "x", "")]
    rows += [(200, "http://h.example/q", f"<p>lead {note} tail</p>"), (200, "http://h.example/q", f"<p>lead {note} tail</p>")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in H.extract_main(df).collect()}
    assert H.extract_main(df).count() == len(rows)
    for i in range(20):
        assert got[i]["text"] == f"start{i} own text{i} of page{i * 7} here now ok{i}"
    assert got[100]["text"] == note and got[101]["text"] == "no url" and got[102]["text"] == "" and got[103]["n_chars"] == 0
    assert got[200]["text"] == "lead tail"
    host = [(r[0], r[2]) for r in rows if r[1] and "//h." in r[1]][:21]
    want = brute_covered(host, 3, 0.1)
    assert all(got[i]["n_boilerplate"] == len(want[i]) for i, _ in host)


def test_shared_passages_stay_in_articles(spark):
    body = "the same long passage that every single article of this host carries whole"
    df = spark.createDataFrame([(i, "http://h.example/", f"<nav>go</nav><article><p>{body}</p></article>") for i in range(30)],
                               "page_id long, url string, html string")
    assert {r["text"] for r in H.extract_main(df).collect()} == {body}


def test_long_page_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a/", "<div>" * 3000 + "<p>w x</p>" * 30_000)], "page_id long, url string, html string")
    assert H.extract_main(df).first()["text"] == "\n".join(["w x"] * 30_000)
    assert H.extract_main(df.limit(0)).collect() == []


def test_words_after_boilerplate_stay(spark):
    """Blocks that begin alike after a repeated block keep their first words, and words
    before one their last; a short block goes when a repeated stretch holds it whole."""
    note = "we use biscuits on this site please agree with all of them"
    rows = [(i, "http://h.example/p", f"<p>ends {i} own last words</p><p>{note}</p><p>Home</p><p>About us</p>"
                                      f"<p>own text number {i} of page {i * 7} here now ok</p>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in H.extract_main(df).collect():
        i = r["page_id"]
        assert r["text"] == f"ends {i} own last words\nown text number {i} of page {i * 7} here now ok"
        assert r["n_boilerplate"] == 15
    rows = [(i, "http://h.example/p", f"<p>{note}</p><p>own text number {i} of page {i * 7} here now ok</p>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in H.extract_main(df).collect()} == {
        i: f"own text number {i} of page {i * 7} here now ok" for i in range(20)}


def test_short_streams():
    blocks = [("open", "a b"), ("chrome", "c"), ("open", "d")]
    assert H.main_text(blocks, {0}) == ("", 4)
    blocks = [("open", "a b c d e f g"), ("open", "h i"), ("open", "j k l m n o")]
    assert H.main_text(blocks, {2}) == ("a b c d e f g\nh i\nj k l m n o", 0)
    assert H.main_text(blocks, {4}) == ("a b c d e f g\nj k l m n o", 2)
    assert H.main_text(blocks, {1}) == ("a\nh i\nj k l m n o", 6)


def test_boilerplate_of_a_large_host(spark):
    """A hundred pages are enough where a tenth of the host is more."""
    note = "we use biscuits on this site please agree with all of them"
    rows = [(i, "http://h.example/p", (f"<p>{note}</p>" if i < 100 else "") + f"<p>own{i}</p>") for i in range(1200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in H.extract_main(df).collect()} == {i: f"own{i}" for i in range(1200)}


def test_inline_chrome_leaves_the_block_whole():
    assert text_of("<p>text <span class=\"ad\">BUY NOW</span> more text</p>") == "text more text"
    assert text_of("<article><p>text<button>Go</button>more <a class='share' href=x>Share</a>text</p></article>") == "text more text"
    assert text_of("<article><p>a <span class=ad>x</p><p>b</p></article>") == "a\nb"


def test_chrome_around_articles():
    assert text_of("<div class='post'><p>The main story.</p></div><div class='comments'><article><p>First!</p></article></div>"
                   ) == "The main story."
    assert text_of("<nav><article>teaser</article></nav><article>own</article>") == "own"
    assert text_of("<main><p>story</p></main><article>teaser</article>") == "story"
    assert text_of("<form id=f><div>x</div><article>own <input><select><option>1</select></article></form>") == "own"
    assert text_of("<div class='has-sidebar'><main>own</main></div><div hidden><main>no</main></div>") == "own"


def test_articles_about_vague_words():
    for mark in ("class=discussion", "class='social'", "class=notice", "id=search", "class='related-work'"):
        assert text_of(f"<article><p>a</p><section {mark}><p>b</p></section></article>") == "a\nb"
        assert text_of(f"<p>a</p><section {mark}><p>b</p></section>") == "a"
    assert text_of("<article><p>a</p><div role=search>find</div><div class=comments>c</div></article>") == "a"


def test_the_host_table_decides_blocks_in_doubt(spark):
    note = "please accept the terms of this site before you go on"
    rows = [(i, "http://h.example/p", f"<article><p>own {i}</p><div class=notice><p>{note}</p></div>"
                                      f"<div class=notice><p>single notice of page {i} only here</p></div></article>") for i in range(5)]
    rows.append((9, "http://o.example/p", f"<article><p>own 9</p><div class=notice><p>{note}</p></div></article>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: (r["text"], r["n_boilerplate"]) for r in H.extract_main(df).collect()}
    assert got == {9: (f"own 9\n{note}", 0), **{i: (f"own {i}\nsingle notice of page {i} only here", 11) for i in range(5)}}


def test_odd_attributes():
    assert text_of("<p title=\"5\" tall\">a</p><p class=x>b \"c\"</p>") == "a\nb \"c\""
    assert text_of("<p title='a > b'>c</p><p title=\"x class=ad\">d</p><p data-x class = 'ad'>e</p>") == "c\nd"
    assert text_of("<b><p>one</b> two</p>") == "one two"


def test_time_is_linear_in_tags():
    assert text_of("<p>" + "<i>x</b> " * 100_000) == " ".join(["x"] * 100_000)
    assert text_of("<div>" + "<i>" * 100_000 + "<h1>y</h1>" * 50_000) == "\n".join(["y"] * 50_000)
    assert text_of("<p>" + "<i>" * 50_000 + "</p><li>" * 50_000 + "z") == "z"
