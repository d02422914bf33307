"""The small labelled table from which the block classifier is trained.

Pages of common shapes, written for this purpose. A block of main text begins with ``MARK``. Words are placeholders, as only
their number counts; every shape comes with several lengths, so that neither a short paragraph nor a long advert is
known by its length alone.
"""

from __future__ import annotations

MARK = "§"

_FILLER = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def _words(n: int) -> str:
    return " ".join(_FILLER[i % len(_FILLER)] for i in range(n))


def _main(n: int) -> str:
    return f"{MARK}{_words(n)}"


def _links(n: int, each: int = 1, tag: str = "li") -> str:
    return "".join(f'<{tag}><a href="/x">{_words(each)}</a></{tag}>' for _ in range(n))


def _article(lengths: list[int]) -> str:
    return f"<h1>{_main(6)}</h1>" + "".join(f"<p>{_main(n)}</p>" for n in lengths)


#: Variants of every shape. A variant has its own lengths of paragraphs and of what is not main text.
VARIANTS = 24


def _lengths(k: int) -> list[int]:
    """Two to eight paragraphs of 1 to 97 words, and now and then a long one."""
    return [1 + (37 * k + 53 * j + k * j * j) % 97 for j in range(2 + k % 7)] + [300] * (k % 5 == 2)


def _shapes(lengths: list[int], k: int) -> list[str]:
    """One page of every shape; ``k`` varies the length of what is not main text."""
    text, long, nav = _article(lengths), _words(2 + 29 * k % 83), f"<nav><ul>{_links(3 + k % 6)}</ul></nav>"
    return [
        f'<html><body>{nav}<div class="ad">{long}</div><article>{text}</article><footer>&copy; site &middot; {long}</footer></body></html>',
        f'<html><body><header><p>{_words(3)}</p>{nav}</header><main>{text}</main><aside><h2>{_words(2)}</h2><p>{long}</p></aside>'
        f'<footer><p>{long}</p></footer></body></html>',
        f'<html><body><div id="header"><a href="/">{_words(2)}</a></div><ul class="menu">{_links(6)}</ul><div class="content">{text}'
        f'<div class="ads"><p>{long}</p></div></div><div class="sidebar"><p>{long}</p><ul>{_links(4, 3)}</ul></div>'
        f'<div id="footer"><p>{_words(9)}</p></div></body></html>',
        f'<html><body><div class="cookie-notice"><p>{long}</p><button>{_words(1)}</button></div><article>{text}'
        f'<section id="comments"><h3>{_words(2)}</h3><div class="comment"><p>{long}</p></div><div class="comment"><p>{_words(25)}</p></div>'
        f'</section></article><section class="comments"><p>{long}</p></section></body></html>',
        f'<html><body>{nav}<article>{text}<form><label>{_words(4)}</label><p>{long}</p></form><aside><p>{long}</p></aside>'
        f'<ul class="related">{_links(4, 6)}</ul></article><div class="newsletter"><p>{long}</p></div></body></html>',
        f'<html><body><div role="navigation">{_links(5, 1, "span")}</div><div class="post"><div class="entry">{text}'
        f'<ul><li>{_main(9)}</li><li>{_main(2)}</li></ul><blockquote>{_main(20)}</blockquote></div></div>'
        f'<div class="comments"><p>{long}</p></div><div class="promo">{long}</div></body></html>',
        # no element says where the main text is: word counts and link densities must tell
        f'<html><body><div><ul>{_links(7)}</ul></div><div><p>{_main(32 + 11 * k % 70)}</p><p>{_main(40 + 13 * k % 50)}</p><p>{_main(30 + 7 * k % 60)}</p></div>'
        f'<div><ul>{_links(3, 2)}</ul></div><div>{_words(4)}</div></body></html>',
        f'<html><body><table><tr>{_links(4, 1, "td")}</tr></table><p>{_main(35 + 5 * k)}</p><p>{_main(31 + 17 * k % 60)}</p>'
        f'<p><a href="/y">{_words(8)}</a> {_words(2)}</p><p>{_words(3)}</p></body></html>',
        f'<html><body><header class="site">{long}</header><main><article>{text}<p>{_main(12)} <a href="/z">{_words(4)}</a></p></article>'
        f'<div class="share">{_links(3, 1, "span")}</div></main><div hidden><p>{long}</p></div></body></html>',
        f'<html><body><div class="banner"><p>{long}</p></div><div id="main"><h2>{_main(4)}</h2><p>{_main(50)}<br>{_words(5)}</p>'
        f'<table><tr><td>{_main(2)}</td><td>{_main(1)}</td></tr></table></div><div class="popup"><p>{long}</p></div>'
        f'<div class="search"><form>{_words(2)}</form></div></body></html>',
        f'<html><body><div class="main-menu">{_links(5)}<p>{long}</p></div><article><header><h1>{_main(7)}</h1></header>{text}'
        f'<nav class="pagination">{_words(5)}</nav><div class="article-notice"><p>{long}</p></div><footer><p>{long}</p></footer></article>'
        f'<div class="content-footer"><p>{long}</p></div><p>{_words(2 + k % 9)}</p></body></html>',
        f'<html><body><div class="main-header"><p>{long}</p></div><div class="page-body"><main>{text}<div class="sidebar">{long}</div>'
        f'<div style="display:none">{long}</div></main></div><div class="footer">{_words(7)}</div></body></html>',
        f'<html><body><article><p>{_main(1 + 19 * k % 70)}</p>{text}<p><a href="/z">{_main(1 + k % 12)}</a></p><ul><li><a href="/z">{_main(2)}</a></li><li>{_main(3)}</li></ul></article>'
        f'<div class="sidebar"><p>{long}</p></div></body></html>',
        f'<html><body><main><header><h1>{_main(5)}</h1></header><p><a href="/z">{_main(2)}</a></p><p>{_main(1 + 31 * k % 88)}</p><p hidden>{long}</p></main><p>{long}</p></body></html>',
        f'<html><body>{nav}<article><p><a href="/q">{_main(5)}</a></p>{text}</article><div class="advert"><p>{long}</p></div></body></html>',
        # no element says so here either, and lengths do not tell: long runs of links, short paragraphs, labels between lists of links
        f'<html><body><p><a href="/a">{_words(20 + 29 * k % 83)}</a> {_words(2)}</p><p>{_main(36 + 13 * k % 70)}</p><p>{_main(3 + k % 17)}</p>'
        f'<p>{_main(30 + 7 * k % 90)} <a href="/b">{_words(4)}</a></p><p>{_main(2 + 5 * k % 19)}</p><p>{_main(33 + 17 * k % 60)}</p>'
        f'<p><a href="/a">{_words(31 + 17 * k % 71)}</a></p><p>{_words(3 + k % 17)}</p>{_links(4, 25 + k, "p")}</body></html>',
        f'<html><body>{_links(3, 22 + 2 * k, "div")}<div>{_words(20 + 5 * k % 31)}</div>{_links(2, 24 + k, "div")}<div>{_main(34 + 11 * k % 70)}</div>'
        f'<div>{_main(4 + k % 13)}</div><div>{_main(32 + 19 * k % 80)}</div>{_links(3, 28 + k, "div")}</body></html>',
        # states of the page on wrappers of the article, and hidden parts inside
        f'<html><body class="has-sidebar single-post"><div class="{_STATES[k % len(_STATES)]}"><article>{text}<div aria-hidden="true">{long}</div>'
        f'</article></div><div class="sidebar"><p>{long}</p></div></body></html>',
        f'<html><body class="no-header"><div style="overflow:hidden" title="hidden gems">{nav}<main>{text}</main><div class="hidden">{long}</div></div></body></html>',
    ]


_STATES = ("has-sidebar", "post comments-open", "no-search header-fixed", "with-nav", "content without-footer", "is-popup-open")


def labelled_pages() -> list[str]:
    return [page for k in range(VARIANTS) for page in _shapes(_lengths(k), k)]
