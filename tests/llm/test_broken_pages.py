"""Page text: broken markup in linear time, readers' comments, headlines and formulas."""

import time

import pytest

from tidemark.llm.line_blocks import main_text

ARTICLE = "<p>" + "word " * 60 + "</p>"
WANT = ("word " * 60).strip()
SIZE = 1_000_000

BROKEN = [
    "<a ", "<b>", "<div class=ad>", "a < b and <i ", '<a "', '<a ""', '<p class="x" ', "<b><p>", "<a name=x>t",
    "<a href=x>t", "</i>", "<b></i>x", "<!-- ", "<script>x", "<math>", "<table><tr><td>x", "<h1><b>x</p>", "<! x",
]


@pytest.mark.parametrize("part", BROKEN)
@pytest.mark.parametrize("tail", ["", '">"'])
def test_time_grows_with_the_page(part, tail):
    """Four times the page takes about four times as long; a square would take sixteen times."""

    def seconds(size):
        page = part * (size // len(part)) + tail
        begin = time.process_time()
        main_text(page)
        return time.process_time() - begin

    small = min(seconds(SIZE // 4) for _ in range(2))
    assert seconds(SIZE) < 8 * small + 0.5


def test_long_class_names():
    begin = time.process_time()
    assert main_text("<div class='" + "ad-" * 200_000 + f"open'>{ARTICLE}</div>") == WANT
    assert main_text("<div class='" + "social-" * 100_000 + f"science'>{ARTICLE}</div>") == WANT
    assert time.process_time() - begin < 10


COMMENTS = "".join(f"<article class='comment'><p>{'reply ' * 90}{k}</p></article>" for k in range(9))


@pytest.mark.parametrize(
    "page",
    [
        f"<article>{ARTICLE}</article>{COMMENTS}",
        f"<article>{ARTICLE}</article><div class='comment-list'>{COMMENTS}</div>",
        f"<article>{ARTICLE}<div class='comments-section'><p>{'reply ' * 900}</p></div></article>",
        f"<main>{ARTICLE}<section id=comments><h2>Replies</h2><ol class='commentlist'><li>{'reply ' * 900}</ol></section></main>",
        f"<div class=post>{ARTICLE}</div><div id='disqus_thread'><p>{'reply ' * 900}</p></div>",
        f"<article>{ARTICLE}</article><article class='comment depth-1 even'><header>Ann</header><p>{'reply ' * 300}</p></article>",
    ],
)
def test_readers_comments_go_at_any_length(page):
    assert main_text(f"<html><body>{page}</body></html>") == WANT


@pytest.mark.parametrize("name", ["post comments-open", "has-comments content", "article no-comments", "content with-comments"])
def test_names_that_only_go_with_comments(name):
    assert main_text(f"<div class='{name}'>{ARTICLE}</div>") == WANT
    assert main_text(f"<article class='{name}'>{ARTICLE}</article>") == WANT


def test_headline_in_the_articles_header():
    head = "<header><h1>Head <em>line</em></h1><p>By Ann</p></header>"
    assert main_text(f"<header>Site</header><article>{head}{ARTICLE}</article>") == f"Head line\n\nBy Ann\n\n{WANT}"
    assert main_text(f"<article><header class='site-header'>Menu</header>{ARTICLE}</article>") == WANT


def test_formulas_and_noscript_stay_in_their_line():
    page = "<article><p>Let <math><mrow><mi>q</mi><mo>=</mo><mn>2</mn></mrow></math> be <noscript>seen</noscript>.</p></article>"
    assert main_text(page) == "Let q=2 be seen."
    assert main_text(f"<noscript>Please switch it on.</noscript><article>{ARTICLE}</article>") == WANT


def test_a_quote_that_is_never_closed():
    page = f"<article><p>one <a title=\"x>two</a> three</p>{ARTICLE}</article>"
    assert main_text(page) == f"one two three\n\n{WANT}"
    assert main_text("<article><p>a < b and c > d <3 & <i") == "a < b and c > d <3 & <i"
    assert main_text("<p>text <!-- never closed <p>more") == "text"
