"""Class names and ids that hold a noise word but are no noise, and noise names on what wraps the page."""

import pytest

from quiremill.llm import html_text

BODY = "Main words here. " * 20
KEPT = BODY.strip() + " And an end."


@pytest.mark.parametrize("name", ["post has-sidebar", "no-sidebar", "related-work", "search-results", "legal-text", "discussion", "widget", "page-header sidebar"])
def test_wrapper_stays(name):
    html = f"<body><div class='{name}'><div class=sidebar>menu</div><p>{BODY}</p><p>And an end.</p></div></body>"
    assert html_text.main_text(html) == KEPT


@pytest.mark.parametrize("name", ["related-work", "discussion", "search-results"])
def test_section_stays(name):
    assert "A section that counts." in html_text.main_text(f"<body><div><p>{BODY}</p><section id={name}><p>{'A section that counts. ' * 10}</p></section></div></body>")


@pytest.mark.parametrize("name", ["sidebar", "ad", "x ad y", "cookie-notice", "site-footer", "page-header", "comment-list", "sidebar-left", "main-nav", "ad-slot-2", "nav_menu"])
def test_noise_goes(name):
    assert html_text.main_text(f"<body><div class='{name}'><p>{'Noise words. ' * 10}</p></div><div><p>{BODY}</p><p>And an end.</p></div></body>") == KEPT


def test_long_comments_of_a_short_article_go():
    assert html_text.main_text(f"<body><article><p>Short.</p></article><div class=comments><p>{'I disagree. ' * 40}</p></div></body>") == "Short."
