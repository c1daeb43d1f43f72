import random

from cases import stored

from restock.llm import main_text as mt

PAGES = "page_id long, url string, html string"


def texts(spark, tmp_path, pages):
    rows = mt.extracted(stored(spark, tmp_path, pages, PAGES, "pages")).collect()
    assert all(row.n_chars == len(row.text) for row in rows)
    return {row.page_id: row.text for row in rows}


ARTICLE = (
    '<!DOCTYPE html><html><head><title>no</title><style>p{{margin:0}}</style><script>var t="</p><p>no";</script></head><body>'
    '<nav><ul><li><a href="/no">no</a></li></ul></nav><header>no</header><div class="cookie-notice">no</div><!-- no <p>no</p> -->'
    '<div class="ad">no</div><form><p>no</p></form>{article}<aside><p>no</p></aside><section id="comments"><article><p>no</p></article></section>'
    "<footer>no &copy;</footer></body></html>"
)


def test_declared_content(spark, tmp_path):
    article = (
        "<article><header><h1>A &amp; B</h1></header><p>one\n <b>two</b>three<br>four<p>five &lt;p&gt; &#233;&nbsp;x"
        '<ul><li>six</li></ul><div class="share">no</div><p hidden>no</p><p style="display: none">no</p>a < b</article>'
    )
    pages = [(1, "http://x.org/1", ARTICLE.format(article=article))]
    assert texts(spark, tmp_path, pages) == {1: "A & B one twothree four five <p> é x six a < b"}


def test_pages_cut_off(spark, tmp_path):
    whole = ARTICLE.format(article="<article><h1>Title</h1><p>first <b>bold<br><p>second</p></article>")
    pages = [(i, "http://x.org/", whole[:i]) for i in range(len(whole))]
    for i, text in texts(spark, tmp_path, pages).items():
        inner = whole[:i].partition("<article>")[2]
        assert text in "Title first bold second" and (text != "") == (len(inner) > len("<h1>"))


def test_repeated_passages_of_declared_content_stay(spark, tmp_path):
    line = "a passage of many words that all pages of the host share in full"
    pages = [(i, "http://x.org/", f"<article><p>{line}</p><p>own {i}</p></article>") for i in range(5)]
    assert texts(spark, tmp_path, pages) == {i: f"{line} own {i}" for i in range(5)}


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))


def test_repeats_of_a_host_go_where_no_content_is_declared(spark, tmp_path):
    rng = random.Random(3)
    menu, note = words(rng, 12), words(rng, 30)
    own = [words(rng, 40) for _ in range(20)]
    pages = [(i, f"http://h{i % 2}.org/{i}", f"<div>{menu}</div><div>{own[i]}</div><div>{note}</div>") for i in range(20)]
    pages += [(100, "http://alone.org/", f"<div>{menu}</div><div>{own[0]}</div>")]
    pages += [(100, "http://alone.org/", f"<div>{menu}</div><div>{own[0]}</div>")]
    found = texts(spark, tmp_path, pages)
    assert all(found[i] == own[i] for i in range(20))
    # One page, even if its row repeats, repeats nothing.
    assert found[100] == f"{menu} {own[0]}"


def test_repeats_judge_open_blocks_beside_declared_content(spark, tmp_path):
    rng = random.Random(5)
    top, bottom, side = words(rng, 9), words(rng, 14), words(rng, 8)
    own = [words(rng, 40) for _ in range(12)]
    body = "<div>{}</div><article><p>teaser {}</p></article><div>{}</div><div class='ad'>{}</div><div>{}</div>"
    pages = [(i, f"http://x.org/{i}", body.format(top, i, own[i], side, bottom)) for i in range(12)]
    assert texts(spark, tmp_path, pages) == {i: f"teaser {i} {own[i]}" for i in range(12)}


def test_declared_content_of_other_pages_is_a_repeat_beside_declared_content(spark, tmp_path):
    """An unmarked list of other articles goes; a page that declares nothing keeps the article it shows again."""
    rng = random.Random(8)
    own = [words(rng, 40) for _ in range(6)]
    starts = [" ".join(text.split()[:15]) for text in own]
    body = "<article><p>{}</p></article><div>{}</div>"
    pages = [(i, f"http://x.org/{i}", body.format(own[i], starts[i - 1])) for i in range(6)]
    pages += [(6, "http://x.org/print/2", f"<div>{own[2]}</div>"), (7, "http://y.org/", body.format("alone", starts[0]))]
    expected = {i: own[i] for i in range(6)} | {6: own[2], 7: f"alone {starts[0]}"}
    assert texts(spark, tmp_path, pages) == expected


def test_names_like_windows():
    rng = random.Random(4)
    tokens = [rng.choice("ab") for _ in range(300)]
    found = mt.names(tokens).tolist()
    windows = [tuple(tokens[i : i + mt.LENGTH]) for i in range(len(tokens) - mt.LENGTH + 1)]
    assert len(found) == len(windows) and len(set(zip(found, windows, strict=True))) == len(set(found)) == len(set(windows))
    assert mt.names(["a"]).size == 0


def test_odd_pages(spark, tmp_path):
    pages = [
        (1, None, None), (2, "", ""), (3, "no address", "plain text  only"), (4, "http://u:p@X.org:80/", "<p>a</p><p>a</p>"),
        (None, "http://x.org", "<article>no id</article>"), (5, "http://x.org", "<article class='comment'>x</article>"),
        (6, "http://x.org", "<article>" + "<p>long</p>" * 20000), (7, "http://x.org", "</div></p><article></div>in</article>"),
        (8, "x", '<div title="a > b" class=main-content>t</div><p title="'),
    ]
    found = texts(spark, tmp_path, pages)
    assert [found[i] for i in (1, 2, 3, 4, None, 5, 7, 8)] == ["", "", "plain text only", "a a", "no id", "", "in", "t"]
    assert found[6].count("long") == 20000


def test_empty_table(spark, tmp_path):
    assert texts(spark, tmp_path, []) == {}
