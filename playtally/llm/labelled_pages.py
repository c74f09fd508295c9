"""Labelled pages on which the extraction model is trained.

Each layout is a page in which ``[c]`` marks an element that starts content and
``[x]`` one that ends it (a menu, advert, form ... inside content); elements
between inherit. ``{s}``, ``{p}``, ``{t}`` and ``{l}`` stand for a sentence, a
paragraph, a short title and a list of links, filled with invented words from a
fixed seed, several times per layout.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

SEED = 7
COPIES = 12

_SYLLABLES = "an er the re on ti ou st en it is ar la mi no de su pa ko lu ver ge ist aux eau cion ado".split()

_LAYOUTS = (
    '<html><head><title>{t}</title></head><body><nav><ul>{l}</ul></nav><div class="ad">{s}</div>'
    '<article [c]><h1>{t}</h1><p>{p}</p><p>{p}</p><p><b>{p}</b></p></article><footer>&copy; {s}</footer></body></html>',
    '<html><body><nav><ul>{l}</ul></nav><div class="ad">{p}</div><article [c]><h1>{s}</h1><p><b>{s}</b></p></article>'
    '<footer>&copy; 2020 {s}</footer></body></html>',
    '<html><body><header class="site-header"><a href="/">{t}</a><div class="tagline">{s}</div><ul class="menu">{l}</ul>'
    '</header><main [c]><h1>{t}</h1><p>{p}</p><h2>{t}</h2><p>{p}</p><ul><li>{s}</li><li>{s}</li></ul><p>{s}</p></main>'
    '<aside class="sidebar"><h3>{t}</h3><ul>{l}</ul><p>{s}</p></aside><footer><p>{s}</p><ul>{l}</ul></footer></body></html>',
    '<html><body><div id="header"><div class="logo">{t}</div><div class="nav">{l}</div></div><div id="wrapper">'
    '<div id="content" [c]><h1>{t}</h1><div class="entry-content"><p>{p}</p><div class="advert" [x]><p>{s}</p></div>'
    '<p>{p}</p><blockquote>{s}</blockquote></div></div><div id="sidebar"><h4>{t}</h4><ul>{l}</ul></div></div>'
    '<div id="footer"><p>{s} <a href="/">{t}</a></p></div></body></html>',
    '<html><body><div class="cookie-notice"><p>{s}</p><button>{t}</button></div><div class="topbar">{l}</div>'
    '<div class="post" [c]><h2>{t}</h2><p>{p}</p><p>{p} <a href="/x">{t}</a> {s}</p><pre>{s}</pre></div>'
    '<section class="comments"><h3>{t}</h3><div class="comment"><p>{p}</p></div><div class="comment"><p>{s}</p></div>'
    '<form><label>{t}</label><textarea>{s}</textarea><button>{t}</button></form></section>'
    '<footer class="footer">{l}<p>{s}</p></footer></body></html>',
    '<html><body><header><nav>{l}</nav></header><article [c]><header><h1>{t}</h1></header><section><h2>{t}</h2><p>{p}</p>'
    '</section><section><p>{p}</p><figure><figcaption>{s}</figcaption></figure><table><tr><td>{s}</td><td>{t}</td></tr>'
    '</table></section><aside class="related" [x]><h3>{t}</h3><ul>{l}</ul></aside>'
    '<div class="share" [x]>{l}</div></article><div id="comments"><p>{s}</p><p>{p}</p></div></body></html>',
    '<html><body><div class="newsletter"><p>{p}</p><form><input><button>{t}</button></form></div>'
    '<div class="main"><div class="article-body" [c]><p>{p}</p><p>{p}</p><ol><li>{p}</li><li>{s}</li></ol></div>'
    '<div class="sponsored"><p>{p}</p></div></div><div class="copyright">{s}</div></body></html>',
    '<html><body><div role="navigation">{l}</div><div role="banner"><p>{s}</p></div><div role="main" [c]><h1>{t}</h1>'
    '<p>{p}</p><p>{s}</p><p>{p}</p></div><div role="complementary"><p>{p}</p></div><div role="contentinfo"><p>{s}</p>'
    '</div></body></html>',
    '<html><body><table><tr><td class="menu">{l}</td><td class="text" [c]><h1>{t}</h1><p>{p}</p><p>{p}</p></td></tr>'
    '</table><div class="banner"><a href="/ad">{s}</a></div><address>{s}</address></body></html>',
    '<html><body><div class="breadcrumbs">{l}</div><article class="story" [c]><h1>{t}</h1><p>{s}</p><div class="notice" [x]>'
    '<p>{s}</p></div><p>{p}</p><p>{p}</p><ul class="tags" [x]>{l}</ul></article><div class="related-posts"><ul>{l}</ul>'
    '</div><div class="popup"><p>{s}</p></div></body></html>',
    '<html><body><div><p>{s}</p><ul>{l}</ul></div><div [c]><h1>{t}</h1><p>{p}</p><p>{p}</p><p>{p}</p></div>'
    '<div><ul>{l}</ul></div></body></html>',
    '<html><body><div class="menu">{l}</div><h1 [c]>{t}</h1><p [c]>{p}</p><p [c]>{p}</p><p [c]>{s}</p>'
    '<div class="footer"><p>{s}</p></div></body></html>',
    '<p [c]>{p}</p><p [c]>{p}</p><p [c]>{s}</p>',
    '<html><body><div class="sidebar"><h3>{t}</h3><p>{p}</p><p>{s}</p></div><div class="notice">{s}</div>'
    '<div class="cookie">{p}</div><main [c]><h1>{t}</h1><p>{p}</p><div class="ad" [x]>{s}</div><p>{p}</p>'
    '<div class="subscribe" [x]>{p}</div><form [x]><label>{t}</label><p>{s}</p></form></main>'
    '<div class="comments"><p>{p}</p><p>{p}</p><p>{s}</p></div><div class="widget"><p>{p}</p></div></body></html>',
    '<html><body><nav>{l}</nav><article [c]><h1>{t}</h1><p>{p}</p><p>{t}.</p><p>{s}</p><p>{t}</p></article>'
    '<div class="reader-comments"><ul><li>{s}</li><li>{p}</li></ul></div><form class="search"><label>{s}</label></form>'
    '<footer>{s} &middot; {s}</footer></body></html>',
)


def _fill(layout: str, rng: random.Random) -> str:
    word = lambda: "".join(rng.choices(_SYLLABLES, k=rng.randint(1, 3)))
    title = lambda: " ".join(word() for _ in range(rng.randint(1, 6))).capitalize()
    sentence = lambda: " ".join(word() for _ in range(rng.randint(2, 14))).capitalize() + "."
    inline = lambda: rng.choice(('<a href="/x">{}</a>', "<b>{}</b>", "<em>{}</em>", "<a href='/y'>{}</a>")).format(title())
    make = {"{t}": title, "{s}": sentence,
            "{p}": lambda: " ".join(inline() if rng.random() < 0.2 else sentence() for _ in range(rng.randint(1, 7))),
            "{l}": lambda: "".join(f'<li><a href="/{word()}">{title()}</a></li>' for _ in range(rng.randint(3, 8)))}
    out, rest = [], layout
    while "{" in rest:
        at = rest.index("{")
        out += [rest[:at], make[rest[at:at + 3]]()]
        rest = rest[at + 3:]
    return "".join(out) + rest


def labelled_pages(copies: int = COPIES, seed: int = SEED) -> Iterator[str]:
    """Pages whose tags carry the marks ``[c]`` and ``[x]``."""
    rng = random.Random(seed)
    for layout in _LAYOUTS:
        for _ in range(copies):
            yield _fill(layout, rng)
