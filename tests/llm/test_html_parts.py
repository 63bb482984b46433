"""Marked parts, elements inside a line, deep and broken pages; generated pages against their known article."""

import random
import time

import pytest

from cardwarden.llm.html_extract import main_text

T = "A story text, long, and with marks. "


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class=story><p>{T}</p></div><div class=comments><p>{T * 6}</p></div>", T.strip()),
        (f"<article><p>{T}</p><div class='user-comments'><p>{T * 2}</p></div></article>", T.strip()),
        (f"<div class=cookie-banner><p>{T * 3}</p></div><div><p>Own text, real.</p></div>", "Own text, real."),
        (f"<div id=c><p>{T}</p></div><ol class=commentlist><li><article><p>{T * 4}</p></article></ol>", T.strip()),
        (f"<div><p>{T}</p></div><div class=responses><p>{T * 4}</p></div>", T.strip()),
        (f"<div class=widget><article><p>{T * 3}</p></article></div><p>Home</p>", (T * 3).strip()),
        (f"<div class=comments><p>{T}</p></div>", ""),
        ("<p>x <button>Share</button> y</p>", "x y"),
        ("<p>a <span class=share>Share it</span> b <svg><title>t</title></svg>c <span hidden>no</span>d</p>", "a b c d"),
        ("<p>one</p><!-- open <p>two</p>", "one"),
        ("<p>one <![CDATA[a < b]]> two", "one a < b two"),
    ],
)
def test_parts(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        "<div><p>x, y." * 80_000, "<a " * 300_000, "<b>" * 50_000 + "<div></div>" * 50_000,
        "<div>" * 50_000 + "<li>a" * 50_000, "</b>" * 200_000, "<p>x<a href=y>" * 70_000,
    ],
)
def test_linear_on_broken_pages(page):
    start = time.process_time()
    main_text(page)
    assert time.process_time() - start < 20


def _words(dice, n):
    return " ".join("".join(dice.choice("abcdefghij") for _ in range(dice.randint(3, 8))) for _ in range(n))


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages(seed):
    """Pages put together of an article and parts around it; the article's blocks are known as they are written."""
    dice = random.Random(seed)
    blocks, body = [_words(dice, 5)], []
    body.append(f"<h1>{blocks[0]}</h1>")
    for _ in range(dice.randint(3, 9)):
        words = f"{_words(dice, dice.randint(25, 60))}, {_words(dice, 12)}."
        kind = dice.choice(["plain", "bold", "inline", "section", "list"])
        blocks.append(words)
        body.append(
            {
                "plain": f"<p>{words}</p>", "list": f"<ul><li>{words}</ul>", "section": f"<section><p>{words}</section>",
                "bold": "<p>" + words.replace(",", "<b>,</b>", 1), "inline": f"<p>{words.replace(',', '<button>Go</button>,', 1)}</p>",
            }[kind]
        )
    noise = _words(dice, 200) + ", " + _words(dice, 90) + "."
    others = [
        f"<nav><a href=x>{_words(dice, 4)}</a></nav>", f"<div class='cookie-notice'><p>{noise}</p></div>",
        f"<aside><p>{noise}</p></aside>", f"<div id=sidebar><p>{_words(dice, 30)}</p></div>", f"<script>{noise}</script>",
    ]
    comments = f"<section class='{dice.choice(['comments', 'user-comments', 'commentlist'])}'><p>{noise * 3}</p></section>"
    wrapped = dice.choice(["<article>{}</article>", "<main><article>{}</article></main>", "<div class=story>{}</div>"])
    inner = "".join(body) + (comments if dice.random() < 0.4 else "")
    page = "<html><body>" + "".join(dice.sample(others, 3)) + wrapped.format(inner) + comments + f"<footer>{noise}</footer></body></html>"
    assert main_text(page) == "\n\n".join(blocks)
