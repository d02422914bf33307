import re
from html import unescape

import pytest

from paylens.llm import html_text as M
from paylens.llm.labelled_pages import MARK, labelled_pages


@pytest.fixture(scope="module")
def tree():
    return M.train()


def test_tree_learns_its_table(tree):
    right = n = 0
    for html in labelled_pages():
        blocks, has_main = M.page_blocks(html)
        right += sum(k == b.text.startswith(MARK) for b, k in zip(blocks, tree.predict(M.features(blocks, has_main))))
        n += len(blocks)
    assert right >= 0.998 * n


@pytest.mark.parametrize("first", [1, 5, 30, 80, 300])
@pytest.mark.parametrize("rest", [1, 5, 30, 80, 300])
def test_lengths_do_not_decide_inside_and_outside_an_article(tree, first, rest):
    words = lambda n, w: " ".join([w] * n)
    text, other = words(first, "text"), words(rest, "other")
    for before, after in (("", ""), (f"<nav><a>{other}</a></nav>", ""), (f"<header>{other}</header>", f"<footer>{other}</footer>"),
                          ("", f"<div class='sidebar'>{other}</div>"), (f"<div class='ad'>{other}</div>", f"<p>{other}</p>")):
        html = f"{before}<article><h1>{words(4, 'head')}</h1><p>{text}</p><p>{words(3, 'end')}</p><form>{other}</form></article>{after}"
        assert M.extract(html, tree) == f"head head head head\n\n{text}\n\nend end end"


@pytest.mark.parametrize("opening, closing", [
    ('<body class="has-sidebar">', "</body>"), ('<div class="has-sidebar">', "</div>"), ('<div style="overflow:hidden">', "</div>"),
    ('<div class="post comments-open">', "</div>"), ('<div title="hidden gems">', "</div>"), ('<div class="no-search header-fixed">', "</div>"),
    ("<div data-hidden=no aria-hidden=false>", "</div>")])
def test_wrappers_that_tell_a_state_leave_the_article(tree, opening, closing):
    words = [" ".join(["text"] * n) for n in (4, 60, 3, 31)]
    html = f"{opening}<nav><a href=x>menu</a></nav><article>{''.join(f'<p>{w}</p>' for w in words)}</article><footer>end</footer>{closing}"
    assert M.extract(html, tree) == "\n\n".join(words)


@pytest.mark.parametrize("attribute", ["hidden", "HIDDEN=''", "class='x hidden'", "aria-hidden=true", "style='color:red; display : none'"])
def test_hidden_parts_go(tree, attribute):
    assert M.extract(f"<article><p>one two</p><div {attribute}><p>{'not seen ' * 20}</p></div></article>", tree) == "one two"


def test_link_densities_decide_where_no_element_announces_the_text(tree):
    """Same lengths, same tags: what is inside links goes, and short blocks go with their neighbours."""
    used = set(re.findall(r"[a-z_]+(?= <=)", tree.rules()))
    assert "density" in used and used & {"density_before", "density_after"}
    words = lambda n, w: " ".join([w] * n)
    for n in (36, 50, 70):
        linked, text = f"<p><a href=x>{words(n, 'link')}</a></p>", [words(n, "text"), words(9, "short"), words(n + 3, "more")]
        html = f"{linked * 2}{''.join(f'<p>{t}</p>' for t in text)}{linked}<p>{words(9, 'label')}</p>{linked * 3}"
        assert M.extract(html, tree) == "\n\n".join(text)


def test_pages_equal_their_articles(spark, sf_dir):
    from paylens.llm.queries import op6_html_text

    pages = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    out = op6_html_text(spark, sf_dir).collect()
    assert len(out) == len(pages)
    for r in out:
        url, html = pages[r.page_id]
        article = re.search(r"<article>(.*)</article>", html, re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", " ", p)).split()) for p in re.split(r"</?(?:p|h1)>", article)]
        assert (r.url, r.text, r.n_chars) == (url, want := "\n\n".join(p for p in parts if p), len(want))


@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<!-- only a comment", ""), ("<script>var a = '<p>x</p>'", ""),
    ("<article><p>a &amp;amp; b&nbsp;&#8364;  \n c</p><p></p><p> </p><p>d</article>", "a &amp; b € c\n\nd"),
    ("<ARTICLE><P CLASS='x>y'>One<BR>line<p>Two</ARTICLE><footer>no</footer>", "One line\n\nTwo"),
    ("<article><p>be<b>fo</b>re <i>it</i></p><aside><p>not this</p></aside>after</article>", "before it\n\nafter"),
    ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article><header><h1>Title</h1></header><p>a</p></article>", "Title\n\na"),
    ("<nav><a href=x>menu</a></nav><article>main<style>p{}</style></article></div></p>", "main"),
    ("<article><p>text</p><div class='comments'><p>" + "words of a reader " * 20 + "</p></div></article>", "text"),
])
def test_small_pages(tree, html, text):
    assert M.extract(html, tree) == text


def test_no_page_breaks_the_reader(tree):
    for html in ("<" * 5000, "<p" * 3000, "<a href='" + "x" * 10_000, "<div>" * 3000 + "deep", "</p>" * 100, "&#xD800;&#0;&bogus;", "\x00<\x00p>"):
        assert isinstance(M.extract(html, tree), str)


def test_very_long_page_is_whole(tree):
    paragraphs = [f"paragraph {i}" for i in range(50_000)]
    html = "<article>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</article>"
    assert M.extract(html, tree) == "\n\n".join(paragraphs)


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int"
    rows = [(1, None, None, "x", 1), (None, "u", "<article>a</article>", None, 2), (2, "", "", "", 3), (2, "", "", "", 3)]
    out = M.main_text(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, out), key=str) == [(1, None, "", 0), (2, "", "", 0), (2, "", "", 0), (None, "u", "a", 1)]
    assert M.main_text(spark.createDataFrame([], schema)).collect() == []
