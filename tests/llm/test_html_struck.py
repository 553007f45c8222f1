"""Which attributes strike a part of a page."""
import pytest

from reelhouse.llm.op9_html import main_text

TEXT = "This is a sentence of the article."
SHOWN = ['class="overflow-hidden"', 'style="overflow:hidden"', 'title="the hidden room"', "data-x='hidden'",
         'data-state="display:none"', 'aria-hidden="false"', 'hidden="until-found"', "data-hidden=true",
         'title="an open hidden', "id=overflow-hidden", 'style="--display:none"', 'aria-label="aria-hidden=true"']
GONE = ["hidden", 'hidden=""', "class=x hidden", 'HIDDEN="hidden"', 'style="color:red; DISPLAY : none"',
        "style=display:none", 'aria-hidden="true"', "aria-hidden = true", 'class="a sidebar"', "id=comments",
        'class="related-posts"']


@pytest.mark.parametrize("name", ["div", "section", "p", "span"])
def test_hidden_is_an_attribute(name):
    for attributes in SHOWN:
        page = f"<article><p>A</p><{name} {attributes}>{TEXT}</{name}></article>"
        assert main_text(page) == f"A\n\n{TEXT}", attributes
    for attributes in GONE:
        assert main_text(f"<article><p>A</p><{name} {attributes}>{TEXT}</{name}></article>") == "A", attributes


def test_link_to_a_hidden_place():
    for link in ('href="/hidden-gems"', "href=/hidden-gems", 'href="/a" title="hidden"'):
        assert main_text(f"<article><p>See <a {link}>the gems</a> of it.</p></article>") == "See the gems of it."


@pytest.mark.parametrize("tag", ["article", "main"])
def test_parts_around_the_article(tag):
    for attributes in [*SHOWN, 'class="no-sidebar"', 'class="page-header wide"', "id=search-results"]:
        for name in ("div", "section"):
            page = f"<body><{name} {attributes}><{tag}><p>{TEXT}</p></{tag}></{name}></body>"
            assert main_text(page) == TEXT, (attributes, name)
    assert main_text(f"<body><div hidden><{tag}><p>{TEXT}</p></{tag}></div></body>") == ""


def test_whole_tokens_in_an_article():
    page = """<article><div class="article-header"><h1>Head</h1></div><p id="search-for-words">One</p>
<div class="notice-board">Two</div><div class="share">Share</div><section id="comments">C</section></article>"""
    assert main_text(page) == "Head\n\nOne\n\nTwo"
    outside = f'<body><div class="left-sidebar"><p>{TEXT * 9}</p></div><div><p>{TEXT * 3}</p></div></body>'
    assert main_text(outside) == TEXT * 3
    cards = f'<body><p>{TEXT * 3}</p><div class="more-related"><article>Card</article></div></body>'
    assert main_text(cards) == TEXT * 3
