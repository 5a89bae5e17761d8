"""Pages of which a class or one long line must not hide the text."""

import time

import pytest

from tabularium.llm.text_density import main_text

TEXT = "<p>The first paragraph of the text.</p><p>The second one is about as long.</p>"
WANT = "The first paragraph of the text. The second one is about as long."


@pytest.mark.parametrize("name", ["site has-sidebar", "no-comments", "elementor-widget-container", "social-science", "widget", "social"])
@pytest.mark.parametrize("inner", ["<article>%s</article>", "<main>%s</main>", "<div>%s</div>"])
def test_wrappers_do_not_hide(name, inner):
    side = '<div class="sidebar-left"><p>Popular posts</p></div><div class="cookie-notice">We use cookies</div>'
    for attribute in ("class", "id"):
        assert main_text(f'<body><div {attribute}="{name}">{side}{inner % TEXT}</div></body>') == WANT


def test_marked_parts_beside_an_article_stay_hidden():
    more = "<article><p>Another post, of which only the beginning stands here.</p></article>" * 9
    page = '<div class="widget"><article>%s</article></div>' % TEXT
    assert main_text(f'<article>{TEXT}</article><div class="related">{more}</div>') == WANT
    assert main_text(f'<div>{TEXT}</div><div class="related">{more[:72]}</div>') == WANT
    assert main_text(page + '<section id="comments"><article class="comment">' + "reader " * 5 + "</article></section>") == WANT


def test_one_long_paragraph_hides_no_short_ones():
    short = [f"Short paragraph {i} of the page." for i in range(12)]
    lines = [*short[:6], "word " * 4000 + "end", *short[6:]]
    assert main_text("<body><div>" + "".join(f"<p>{x}</p>" for x in lines) + "</div></body>") == " ".join(lines)


@pytest.mark.parametrize("page", [
    "<article><p>" * 20_000 + "x", "<div>" * 20_000 + "</section>" * 20_000 + "x", "<p><article>" + "<div>" * 20_000 + "<p>t</p>" * 20_000,
    "<div><p>" * 20_000 + "</div>" * 20_000 + "x", "<b>" * 20_000 + "<div>" + "</b>" * 20_000 + "x", "<div class='ad'>" * 20_000 + "<main>x"])
def test_deep_pages_take_a_time_in_proportion(page):
    began = time.process_time()
    assert isinstance(main_text(page), str)
    assert time.process_time() - began < 5
