"""Labelled pages for the extraction model: layouts whose main parts carry `data-main`.

Each page puts the same kinds of parts in another place, under other tags and other names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

SENTENCE = "The river had risen during the night and the lower fields were under water."
SHORT = "A short line of the story."
LONG = " ".join([SENTENCE] * 4)

# Wrappers of the main text; some have no telling name, and the last is none at all.
WRAPPERS = [
    ("article", ""), ("main", ""), ("div", 'class="content"'), ("div", 'id="post-body"'), ("section", 'class="story"'),
    ("div", 'class="entry-content"'), ("div", 'class="articleText"'), ("div", 'role="main"'), ("td", 'class="text"'),
    ("div", ""), ("section", ""), ("div", 'class="c17"'), ("article", 'class="post"'), ("main", 'id="main"'), ("", ""),
    ("", ""), ("div", 'class="x1"'), ("section", 'id="s"'), ("", ""), ("div", ""),
]
BODIES = [
    f"<h1>The flood of the lower fields</h1><p>{LONG}</p><p>{SHORT}</p><p>{SENTENCE}</p>",
    f"<h1>Flood</h1><p>{SENTENCE}</p><h2>What came after</h2><p>{LONG}</p><ul><li>{SHORT}</li><li>{SENTENCE}</li></ul>",
    f"<h2>Water</h2><p>{LONG} <a href='/x'>See the map</a>.</p><blockquote><p>{SENTENCE}</p></blockquote><p>Be.</p>",
    f"<h1>Rain</h1><div>{LONG}</div><div>{SENTENCE}</div><pre>level 4 m</pre><table><tr><td>day</td><td>level</td></tr></table>",
    f"<h1>Notes</h1><p>{SHORT}</p>",
    f"<p>{SENTENCE}</p><ul><li>one thing</li><li>another</li></ul><p>Yes.</p><p>{LONG}</p>",
]
TOP = re.compile(r"<(h1|h2|p|div|ul|blockquote|pre|table)>")
# Parts around the main text or inside its wrapper.
BEFORE = [
    "<nav><ul><li><a href='/a'>Home</a></li><li><a href='/b'>News</a></li><li><a href='/c'>About us</a></li></ul></nav>",
    "<div class='menu'><a href='/a'>Home</a> <a href='/b'>News</a> <a href='/c'>Contact</a></div>",
    "<header><h1>The Daily Field</h1><p>News from the river since 1901.</p></header>",
    "<div id='header'><div class='logo'>The Daily Field</div><p>News of the day</p></div>",
    "<ul class='breadcrumbs'><li><a href='/'>Home</a></li><li>News</li></ul>",
    f"<div class='cookie-notice'><p>We use cookies. {SENTENCE}</p><button>Accept</button></div>",
    f"<div class='alert notice'>{SENTENCE}</div>",
    f"<div class='ad'>{SENTENCE}</div>",
    f"<div class='advert-box'><p>{SENTENCE}</p></div>",
    f"<div id='consent-banner' role='dialog'><p>{LONG}</p></div>",
    "<form action='/s'><label>Search</label><input name='q'><button>Go</button></form>",
]
AFTER = [
    f"<aside><h3>Related stories</h3><p>{SENTENCE}</p><p>{LONG}</p></aside>",
    f"<div class='sidebar'><h2>Popular</h2><p>{SENTENCE}</p><ul><li><a href='/1'>One</a></li></ul></div>",
    f"<div class='related-content'><h3>More</h3><p>{SENTENCE}</p></div>",
    f"<section class='comments'><h3>Comments</h3><div class='comment'><p>{LONG}</p></div><div class='comment'><p>{SENTENCE}</p></div></section>",
    f"<div id='comments'><ol><li><p>{SENTENCE}</p></li><li><p>{LONG}</p></li></ol></div>",
    f"<ul class='comment-list'><li><p>{SENTENCE}</p></li></ul>",
    f"<form class='newsletter'><p>{SENTENCE}</p><input type='email'><button>Subscribe</button></form>",
    f"<div class='newsletter-signup'><p>{SENTENCE}</p></div>",
    "<div class='share'><a href='#'>Share</a> <a href='#'>Post</a></div>",
    f"<div class='promo sponsored'><p>{LONG}</p></div>",
    "<footer>&copy; 2020 The Daily Field &middot; All rights reserved.</footer>",
    f"<footer><p>{SENTENCE}</p><p>&copy; The Daily Field</p></footer>",
    f"<div class='footer'><p>Copyright The Daily Field. {SENTENCE}</p></div>",
    f"<div id='site-footer'><p>{SENTENCE}</p><ul><li><a href='/i'>Imprint</a></li></ul></div>",
]


def labelled_pages() -> Iterator[str]:
    """Every wrapper with changing bodies and parts; in some pages the parts stand inside it."""
    n = 0
    for tag, named in WRAPPERS:
        for k in range(8):
            n += 1
            body = BODIES[n % len(BODIES)]
            before = [BEFORE[(n * 3 + i * (k + 1)) % len(BEFORE)] for i in range(1 + n % 3)]
            after = [AFTER[(n * 5 + i * (k + 2)) % len(AFTER)] for i in range(2 + n % 3)]
            inner = after.pop(0) if n % 2 else ""
            if tag:
                main = f"<{tag} {named} data-main='1'>{body}{inner}</{tag}>"
            else:
                main = TOP.sub(r"<\1 data-main='1'>", body) + inner
            if tag == "td":
                main = f"<table><tr>{main}</tr></table>"
            if n % 4 == 1 and tag != "td":
                main = f"<div class='row'><div class='col'>{main}</div></div>"
            if n % 3 == 0:
                main = f"<div class='wrapper'>{main}{after.pop()}</div>"
            yield f"<html><body>{''.join(before)}{main}{''.join(after)}</body></html>"
