"""Pages laid out at random, with the blocks that are main text: what the extractor's trees are fitted on.

Words are invented, so only structure can be learned. A layout draws where the main text stands, how it is marked up, what
surrounds it (menus, headers, footers, sidebars, notices, adverts, forms, comments) and how carelessly tags are closed.
"""

from __future__ import annotations

import html as markup
import random

LETTERS = "aeiounrstlmdcpgbéüñ"


def _words(r: random.Random, n: int) -> str:
    out = ["".join(r.choice(LETTERS) for _ in range(r.randint(1, 9))) for _ in range(n)]
    for i in range(len(out)):
        if i == 0 or out[i - 1][-1] in ".!?":
            out[i] = out[i].capitalize()
        if r.random() < 0.12:
            out[i] += r.choice(".,.,;?")
    return " ".join(out) + (r.choice(".!?.") if r.random() < 0.8 else "")


def _attrs(r: random.Random, names: list[str], often: float = 0.8) -> str:
    if r.random() > often:
        return ""
    name = r.choice(names)
    if r.random() < 0.3:
        name = r.choice(["", "site-", "page-", "l-", "js-"]) + name + r.choice(["", "-wrapper", "-box", "-2", "-inner"])
    return f' {r.choice(["class", "class", "id"])}="{name}"'


def _links(r: random.Random, n: int) -> str:
    items = [f'<a href="/{i}">{_words(r, r.randint(1, 4))}</a>' for i in range(n)]
    if r.random() < 0.7:
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    return r.choice([" ", " | ", "\n"]).join(items)


def _block(r: random.Random, wanted: set[str]) -> str:
    """A block of main text; its whole text goes to ``wanted``."""
    n = r.choice([1, 3, 8, 20, 45, 90, 160]) if r.random() < 0.8 else r.randint(1, 300)
    text = _words(r, n)
    kind = r.random()
    wanted.add(text)
    if kind < 0.62:
        body = markup.escape(text)
        cut = body.split(" ")
        if len(cut) > 4 and r.random() < 0.3:
            i = r.randint(1, len(cut) - 2)
            cut[i] = r.choice(["<b>{}</b>", "<em>{}</em>", '<a href="#">{}</a>', "<b>{}"]).format(cut[i])
        close = r.choice(["</p>", "</p>", "</p>", "<br>", "\n"])
        return f"<p>{' '.join(cut)}{close}"
    if kind < 0.72:
        return f"<h{(k := r.randint(2, 4))}>{markup.escape(text)}</h{k}>"
    if kind < 0.8:
        more = [_words(r, r.randint(1, 14)) for _ in range(r.randint(2, 6))]
        wanted.update(more)
        wanted.discard(text)
        return "<ul>" + "".join(f"<li>{x}</li>" for x in more) + "</ul>"
    if kind < 0.86:
        return f"<blockquote>{markup.escape(text)}</blockquote>"
    if kind < 0.9:
        return f"<pre>{markup.escape(text)}</pre>"
    if kind < 0.95:
        return f"<div>{markup.escape(text)}</div>"
    cells = [_words(r, r.randint(1, 5)) for _ in range(4)]
    wanted.update(cells)
    wanted.discard(text)
    return "<table>" + "".join(f"<tr><td>{a}</td><td>{b}</td></tr>" for a, b in (cells[:2], cells[2:])) + "</table>"


def _advert(r: random.Random) -> str:
    lines = r.choice([" ", "\n"]).join(_words(r, r.randint(2, 14)) for _ in range(r.randint(1, 3)))
    tag = r.choice(["div", "div", "div", "aside", "section", "p"])
    return f"<{tag}{_attrs(r, ['ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'banner-ad'], 1.0)}>{lines}</{tag}>"


def _notice(r: random.Random) -> str:
    tag = r.choice(["div", "section", "aside"])
    names = ["cookie-notice", "consent", "notice", "gdpr", "modal", "newsletter", "subscribe", "alert", "paywall"]
    return f"<{tag}{_attrs(r, names, 1.0)}><p>{_words(r, r.randint(5, 40))}</p><button>{_words(r, 1)}</button></{tag}>"


def _form(r: random.Random) -> str:
    return f"<form{_attrs(r, ['search', 'login', 'contact', 'signup'])}><label>{_words(r, 2)}</label><input><p>{_words(r, r.randint(2, 12))}</p></form>"


def _side(r: random.Random) -> str:
    tag = r.choice(["aside", "div", "section"])
    names = ["sidebar", "related", "widget", "popular", "recommended", "share", "tags", "author-bio", "trending"]
    body = "".join(f"<h3>{_words(r, 2)}</h3>" + (_links(r, r.randint(2, 8)) if r.random() < 0.6 else f"<p>{_words(r, r.randint(5, 60))}</p>") for _ in range(r.randint(1, 3)))
    return f"<{tag}{_attrs(r, names, 0.5 if tag == 'aside' else 1.0)}>{body}</{tag}>"


def _comments(r: random.Random) -> str:
    tag = r.choice(["section", "div", "ol", "ul", "article"])
    item = "li" if tag in ("ol", "ul") else r.choice(["div", "article", "p"])
    names = ["comments", "comment-list", "commentlist", "replies", "discussion", "disqus", "reader-comments"]
    inner = "".join(
        f"<{item}{_attrs(r, ['comment', 'reply', 'comment-body'], 0.6)}><b>{_words(r, 1)}</b> <p>{_words(r, r.randint(3, 70))}</p></{item}>" for _ in range(r.randint(1, 6))
    )
    return f"<{tag}{_attrs(r, names, 1.0)}><h3>{_words(r, 2)}</h3>{inner}</{tag}>"


def _menu(r: random.Random) -> str:
    tag = r.choice(["nav", "nav", "div", "ul"])
    body = _links(r, r.randint(2, 12)) if tag != "ul" else "".join(f'<li><a href="/">{_words(r, 2)}</a></li>' for _ in range(r.randint(2, 9)))
    return f"<{tag}{_attrs(r, ['nav', 'navbar', 'menu', 'breadcrumb', 'pagination'], 0.4 if tag == 'nav' else 1.0)}>{body}</{tag}>"


def _header(r: random.Random) -> str:
    tag = r.choice(["header", "div"])
    return f"<{tag}{_attrs(r, ['header', 'masthead', 'banner', 'topbar'], 0.4 if tag == 'header' else 1.0)}><h1>{_words(r, 2)}</h1><p>{_words(r, r.randint(2, 9))}</p>{_menu(r) if r.random() < 0.5 else ''}</{tag}>"


def _footer(r: random.Random) -> str:
    tag = r.choice(["footer", "footer", "div"])
    said = r.choice([f"&copy; {_words(r, 2)} &middot; {_words(r, r.randint(2, 30))}", f"<p>{_words(r, r.randint(3, 40))}</p>{_links(r, r.randint(2, 8))}"])
    return f"<{tag}{_attrs(r, ['footer', 'copyright', 'colophon', 'legal'], 0.4 if tag == 'footer' else 1.0)}>{said}</{tag}>"


def page(seed: int) -> tuple[str, set[str]]:
    """The markup of a page and the texts of its main blocks."""
    r = random.Random(seed)
    wanted: set[str] = set()
    title = _words(r, r.randint(1, 10))
    blocks = [_block(r, wanted) for _ in range(r.choice([0, 1, 2, 4, 8, 14, 25]))]
    if r.random() < 0.8 or not blocks:
        wanted.add(title)
        blocks.insert(0, f"<h1>{title}</h1>")
    for make, often in ((_advert, 0.25), (_side, 0.15), (_notice, 0.1), (_form, 0.1), (_menu, 0.08)):
        if r.random() < often:
            blocks.insert(r.randint(0, len(blocks)), make(r))
    body = "".join(blocks)
    names = ["content", "post", "entry-content", "story", "article-body", "post-body", "main-text"]
    shell = r.random()
    if shell < 0.45:
        main = f"<article{_attrs(r, names, 0.4)}>{body}{_comments(r) if r.random() < 0.1 else ''}</article>"
    elif shell < 0.6:
        main = f"<main><article>{body}</article></main>"
    elif shell < 0.7:
        main = f"<main{_attrs(r, names, 0.3)}>{body}</main>"
    elif shell < 0.85:
        main = f"<div{_attrs(r, names, 1.0)}>{body}</div>"
    elif shell < 0.93:
        main = f"<section{_attrs(r, names, 1.0)}><div>{body}</div></section>"
    else:
        main = f"<table><tr><td{_attrs(r, names, 0.7)}>{body}</td></tr></table>"
    before = [f(r) for f, often in ((_menu, 0.8), (_header, 0.4), (_notice, 0.25), (_advert, 0.5), (_form, 0.2), (_side, 0.2)) if r.random() < often]
    after = [f(r) for f, often in ((_side, 0.35), (_comments, 0.45), (_advert, 0.3), (_form, 0.2), (_menu, 0.15)) if r.random() < often]
    r.shuffle(before)
    r.shuffle(after)
    foot = _footer(r) if r.random() < 0.85 else ""
    inside = "".join(before) + main + "".join(after)
    if r.random() < 0.3:
        inside = f"<div{_attrs(r, ['wrapper', 'container', 'page', 'layout'])}>{inside}</div>"
    head = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
    return head + f"<body>{inside}{foot}" + ("</body></html>" if r.random() < 0.8 else ""), wanted
