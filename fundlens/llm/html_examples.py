"""The labelled table of the block classifier: small pages with known text blocks.

Words of text blocks start with ``T``, all others with ``x``. The pages follow the
usual layouts; lengths and the parts that come up are drawn with fixed seeds, alike for
parts of every kind, so that a length alone says little about an unlinked block.
"""

from __future__ import annotations

import random

LENGTHS = (1, 2, 3, 5, 8, 12, 18, 25, 40, 70, 120, 200)
LAYOUTS, PAGES = 9, 100


def _words(n: int, word: str) -> str:
    return " ".join([word] * n)


def _page(number: int, layout: int) -> str:
    draw = random.Random(number * LAYOUTS + layout)

    def text(least: int = 0) -> str:
        return _words(max(least, draw.choice(LENGTHS)), "Tword")

    def other(least: int = 0) -> str:
        return _words(max(least, draw.choice(LENGTHS)), "xword")

    def few(word: str) -> str:
        return _words(draw.randint(1, 4), word)

    def links(n: int, longest: int = 3) -> str:
        return "<ul>" + "".join(f'<li><a href="/{i}">{_words(draw.randint(1, longest), "xword")}</a></li>' for i in range(n)) + "</ul>"

    paragraphs = "".join(f"<p>{text()}</p>" for _ in range(draw.randint(1, 5)))
    mixed = f'<p>{text(8)} <a href="/m">{few("Tword")}</a> {text(5)}</p>'
    listed = f"<ul><li>{text()}</li><li>{text()}</li></ul>"
    nav, footer, advert = f"<nav>{links(draw.randint(1, 8))}</nav>", f"<footer>{other()}</footer>", f'<div class="ad">{other()}</div>'
    notice = f'<div class="cookie-notice">{other()}</div>'
    comments = f'<section id="comments"><h3>{few("xword")}</h3><p>{other()}</p><p>{other()}</p><p>{other(25)}</p></section>'
    form = f"<form>{few('xword')}<input></form>"
    hinted = f'<div class="side-by-side"><p>{text(5)}</p><p>{text(8)}</p></div><p class="social">{text(8)}</p>'
    aside = f"<aside><h3>{few('xword')}</h3>{links(5, 15)}<p>{other()}</p></aside>"
    sidebar = f'<div id="sidebar"><p>{other()}</p>{links(5, 6)}</div>'
    related = f'<div class="related"><h3>{few("xword")}</h3>{links(5, 15)}</div>'
    linked = f'<p><a href="/y">{few("xword")}</a> <a href="/z">{few("xword")}</a></p>'
    title = f'<a href="/t">{text(3)}</a>' if draw.random() < 0.5 else text()
    first, last = (mixed, paragraphs) if draw.random() < 0.5 else (paragraphs, mixed)

    def some(*parts: str) -> str:
        """Each part half of the time, in any order."""
        return "".join(part for part in draw.sample(parts, len(parts)) if draw.random() < 0.5)

    share = f'<div class="social">{some("<p>" + few("xword") + "</p>")}{links(4)}</div>'
    widget = f'<div class="widget"><p>{other()}</p>{some(links(3), other())}</div><div class="banner">{other()}</div>'
    if layout == 0:
        return f"<body>{some(nav, advert)}<article><h1>{title}</h1>{first}{listed}{last}</article>{some(footer, nav, comments)}</body>"
    if layout == 1:
        head = f"<header>{other()}</header>"
        return f"<body>{some(head, nav)}<main><h1>{title}</h1>{first}{some(advert, share)}{last}</main>{some(aside, form, comments, footer, nav, widget)}</body>"
    if layout == 2:
        menu, foot = f'<div class="menu">{links(draw.randint(1, 8))}</div>', f'<div class="footer">{other()}</div>'
        return f'<body>{some(notice, menu)}<div class="content"><h2>{title}</h2>{first}{last}</div>{some(sidebar, form, widget, foot)}</body>'
    if layout == 3:
        return f"<body>{some(links(8))}<h1>{text(5)}</h1><p>{text(12)}</p>{mixed}<p>{text(18)}</p>{some(links(6, 4), linked, footer)}</body>"
    if layout == 4:
        return f"<body>{some(nav)}<div><p>{text(8)}</p>{mixed}<p>{text(12)}</p></div>{some(comments, linked, related)}</body>"
    if layout == 5:
        return f"<body>{some(nav)}<article>{some(hinted)}<h1>{title}</h1>{some(share)}{first}{hinted}{last}{some(share, advert, related)}</article>{some(footer, nav)}</body>"
    if layout == 6:
        menu, foot = f"<div class='menu'>{links(draw.randint(1, 8))}</div>", f"<div class='footer'>{other()}</div>"
        return f"<body><form>{some(menu, notice)}<h1>{text(5)}</h1><p>{text(12)}</p>{mixed}<p>{text(18)}</p>{some(foot, related)}</form></body>"
    if layout == 7:
        return f"<body>{some('<h1>' + text() + '</h1>')}<p>{text()}</p>{some('<p>' + text(12) + '</p>', '<p>' + text() + '</p>')}</body>"
    return f'<body>{some(nav, notice)}<div class="post">{some(hinted)}<h2>{title}</h2>{some(hinted, share, listed)}{first}{hinted}{last}{some(share)}</div>{some(widget, comments, footer)}</body>'


EXAMPLES = [_page(number, layout) for number in range(PAGES) for layout in range(LAYOUTS)]
