from __future__ import annotations

import time

import pytest

from monthmill.llm import html_text as h

TEXT = "The river rose slowly over three days and then fell again."
REST = "<div class='cookie-notice'>We use cookies here</div><nav><a href='/'>home</a></nav><footer>(c) all rights</footer>"


def text(html):
    return h.main_text(h.blocks(html), [])


@pytest.mark.parametrize(
    "html",
    [
        f'<body class="no-sidebar"><div><p>{TEXT}</p></div>{REST}',
        f'<body class="home has-sidebar"><div><p>{TEXT}</p></div>{REST}',
        f'<body class="single-post comments-open"><div><p>{TEXT}</p></div>{REST}',
        f'<body class="nav-fixed"><div><p>{TEXT}</p></div>{REST}',
        f'<body class="menu search sidebar"><div><p>{TEXT}</p></div>{REST}',
        f'<body><article class="has-share"><p>{TEXT}</p></article>{REST}',
        f'<body><main class="page with-menu"><p>{TEXT}</p></main>{REST}',
        f'<body><main class="search"><p>{TEXT}</p></main>{REST}',
        f'<body><div id="search"><article><p>{TEXT}</p></article></div>{REST}',
        f'<body><div id="search"><div class="post"><p>{TEXT}</p></div></div>{REST}',
        f'<body><div class="wrapper sidebar"><div><p>{TEXT}</p></div></div>{REST}',
        f'<html class="overlay"><body><div class="page"><p>{TEXT}</p></div>{REST}',
        f'<body><article><p>{TEXT}</p><section id="comments"><article class="comment"><p>Well said, and thanks to the writer.</p></article></section></article>{REST}',
        f'<body><article><p>{TEXT}</p></article><div id="comments"><article><p>A long comment of a reader about the river.</p></article></div>{REST}',
        f'<body><article><p>{TEXT}</p></article><div class="sidebar"><p>Popular: ten more tales</p></div><div class="related"><p>Read on</p></div>{REST}',
        f'<body><article><p>{TEXT}</p></article><div class="login"><p>Sign in here please</p></div>{REST}',
    ],
)
def test_the_article_and_nothing_else(html):
    assert text(html) == TEXT


def test_formulas_stay():
    assert text("<article><p>x <math><mi>E</mi>=<mi>mc</mi></math> y</p></article>") == "x E=mc y"


@pytest.mark.parametrize("html", ["<nav>only</nav>", "<div class='cookie-notice'>We use cookies</div>", "<form><p>a</p></form>", "<!-- never closed <p>x</p>", "<p><!--", "<footer><div class='sidebar'>x</div></footer>"])
def test_no_article(html):
    assert text(html) == ""


def test_comments_that_are_not_closed():
    assert text("<p>a</p><!-- b <p>c</p>") == "a" and text("<p>a</p> b <!-- c") == "a b"
    assert text("<p>a<!-- x --> b<!----> c<!--> d --> e</p>") == "a b c e"


BROKEN = {
    "tags that are not closed": "<a " * 350_000,
    "tags closed at last": "<a " * 350_000 + ">x",
    "nested containers": "<div>" * 100_000 + "x",
    "nested and closed": "<div>" * 100_000 + "x" + "</div>" * 100_000,
    "text at every depth": "<div>x" * 50_000,
    "inline elements": "<b>" * 100_000 + "x" + "<p>y" * 1000,
    "scripts that are not closed": "<p>x<script>" * 50_000,
    "comments that are not closed": "<!-" * 100_000 + "<!--" * 100_000,
    "signs": "<" * 500_000 + ">" * 500_000,
}


@pytest.mark.parametrize("name", list(BROKEN))
def test_broken_pages_take_time_in_proportion(name):
    start = time.perf_counter()
    h.main_text(h.blocks(BROKEN[name]), [])
    assert time.perf_counter() - start < 8


def test_deep_containers_keep_their_text():
    assert text("<div>" * 5000 + f"<p>{TEXT}</p>" + "</div>" * 5000) == TEXT
