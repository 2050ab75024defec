"""Class words that don't decide alone, and heads that end without a tag."""

from __future__ import annotations

import pytest

from ledgerloom.llm import main_text

PROSE = [f"Paragraph {i} of the article, which has some length, commas, and words enough to count as prose." for i in range(6)]
ARTICLE = "".join(f"<p>{p}</p>" for p in PROSE)
WANT = "\n".join(PROSE)
LINKS = "".join(f"<li><a href=/{i}>Another story {i}, with a title</a></li>" for i in range(8))


@pytest.mark.parametrize(
    "page",
    [
        f"<body><nav>n</nav><div class='elementor-widget elementor-widget-text-editor'>{ARTICLE}</div></body>",
        "<body>" + "".join(f"<div class='elementor-widget elementor-widget-text-editor'><p>{p}</p></div>" for p in PROSE) + "</body>",
        f"<body><article class='sharing-enabled'>{ARTICLE}</article></body>",
        f"<body><article class='comments-open'>{ARTICLE}</article></body>",
        f"<body><div class=search>{ARTICLE}</div><p class=copyright>(c) us</p></body>",
        f"<body><div class='hidden md:block'>{ARTICLE}</div></body>",
        f"<body><div id=promo>{ARTICLE}</div><div class=promo-box><p>Buy now.</p></div></body>".replace("promo-box", "notice"),
        f"<body><div class='sidebar-right'><article>{ARTICLE}</article></div></body>",
        f"<body><app-main class=widget>{ARTICLE}</app-main></body>",
        f"<body><main class=overlay>{ARTICLE}</main></body>",
    ],
)
def test_soft_words_dont_cut_the_article(page):
    assert main_text.main_text(page) == WANT


@pytest.mark.parametrize(
    "beside",
    [
        "<div class=cookie-notice>We use cookies, as all do.</div>", f"<div class=related><ul>{LINKS}</ul></div>", "<div class='share'>Tell others of this.</div>",
        "<div class=widget><p>A short one, of few words.</p></div>", "<div id=comments>" + "<p>Bad, bad, bad, and a long comment of a reader, too.</p>" * 20 + "</div>",
        "<div class=comments-area>" + "<p>Bad, bad, bad, and a long comment of a reader, too.</p>" * 4 + "</div>", "<div class=reader-comments><article class=comment-body><p>Bad, bad, bad.</p></article></div>", "<div class=ad>Buy, buy, buy.</div>", "<div class=site-footer>We, the firm.</div>",
    ],
)
def test_what_stands_beside_goes(beside):
    assert main_text.main_text(f"<body><div>{ARTICLE}{beside}</div></body>") == WANT


def test_words_inside_a_paragraph():
    page = f"<body><div>{ARTICLE}<p>Last words, and more of them.<span class=share-count>12 shares</span> The end.</p></div></body>"
    assert main_text.main_text(page) == WANT + "\nLast words, and more of them. The end."


@pytest.mark.parametrize("start", ["<html><head><title>T</title><meta charset=utf-8>", "<head><style>p{}</style>", "<head><script>x</script></head>", "<html><head><link rel=x></head><body>", "<head><head><title>T</title>"])
def test_heads_end_without_a_tag(start):
    assert main_text.main_text(f"<!DOCTYPE html>{start}<article>{ARTICLE}</article>") == WANT
    assert main_text.main_text(f"{start}Some plain text.") == "Some plain text."
