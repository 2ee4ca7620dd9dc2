"""Labelled pages that the page model is trained on.

Each template is a page whose elements say with ``y`` whether they are content
or hold some (1) or not (0); elements without it are as their parent. ``{name}`` stands for
text of a kind, drawn anew for every page made from the template.
"""

import random
import re

_MENU = "nav menu navbar navigation breadcrumb breadcrumbs topbar toolbar pagination pager skip toc".split()
_HEAD = "header masthead branding logo site-title top hero".split()
_FOOT = "footer bottom copyright legal colophon site-info".split()
_SIDE = "sidebar aside widget rail related recommended trending popular more-stories tags archive author-box".split()
_ADS = "ad ads advert advertisement adsense sponsor sponsored promo promotion banner outbrain affiliate".split()
_NOTE = "cookie consent notice alert popup modal overlay gdpr warning message newsletter subscribe signup paywall".split()
_TALK = "comments comment comment-list discussion replies reply respond disqus reader-comments responses".split()
_SHARE = "share social sharing follow buttons byline meta post-meta".split()
_BODY = "content article post entry main story text body article-body post-content entry-content page-content".split()

_PARTS = {
    "menu": [
        '<nav class="{menu}" y="0"><ul><li><a href="#">{word}</a></li><li><a href="#">{word}</a></li><li><a href="#">{link}</a></li></ul></nav>',
        '<div class="{menu}" y="0"><a href="#">{word}</a> <a href="#">{word}</a> <a href="#">{word}</a></div>',
        '<ul id="{menu}" y="0"><li><a href="#">{word}</a></li><li><a href="#">{word}</a></li></ul>',
        '<nav y="0"><a href="#">{word}</a><a href="#">{word}</a></nav>',
    ],
    "head": [
        '<header class="{head}" y="0"><h1>{link}</h1><p>{line}</p></header>',
        '<div id="{head}" y="0"><div>{link}</div></div>',
        '<header y="0"><a href="#">{link}</a><p>{line}</p></header>',
    ],
    "foot": [
        '<footer y="0">{line}</footer>',
        '<footer class="{foot}" y="0"><p>{line}</p><ul><li><a href="#">{word}</a></li></ul></footer>',
        '<div class="{foot}" y="0"><p>{line} <a href="#">{word}</a></p></div>',
    ],
    "side": [
        '<aside class="{side}" y="0"><h3>{link}</h3><p>{line}</p></aside>',
        '<aside y="0"><p>{line}</p></aside>',
        '<div class="{side}" y="0"><h4>{word}</h4><ul><li><a href="#">{line}</a></li><li><a href="#">{line}</a></li></ul></div>',
        '<section id="{side}" y="0"><h2>{link}</h2><p>{line}</p></section>',
    ],
    "ads": [
        '<div class="{ads}" y="0">{line}</div>',
        '<div class="{ads}" y="0"><p>{line}</p><a href="#">{link}</a></div>',
        '<section class="{ads}" y="0"><h3>{link}</h3><p>{para}</p></section>',
        '<p class="{ads}" y="0">{line}</p>',
    ],
    "note": [
        '<div class="{note}" y="0">{line} <button>{word}</button></div>',
        '<div id="{note}" role="alert" y="0"><p>{line}</p></div>',
        '<p class="{note}" y="0">{line}</p>',
        '<form class="{note}" y="0"><label>{link}</label><input><button>{word}</button></form>',
    ],
    "talk": [
        '<section class="{talk}" y="0"><h2>{word}</h2><article class="{talk}"><p>{para}</p></article><article><p>{line}</p></article></section>',
        '<div id="{talk}" y="0"><div class="{talk}"><p>{para}</p></div><div class="{talk}"><p>{line}</p></div></div>',
        '<ol class="{talk}" y="0"><li>{para}</li><li>{line}</li></ol>',
        '<ul class="{talk}" y="0"><li><p>{para}</p></li></ul>',
    ],
    "share": ['<div class="{share}" y="0"><a href="#">{word}</a> <a href="#">{word}</a></div>', '<ul class="{share}" y="0"><li><a href="#">{word}</a></li></ul>'],
    "text": [
        "<p>{para}</p>",
        "<p>{line}</p>",
        "<p>{word}</p>",
        "<p>{para} <a href='#'>{link}</a> {line}</p><p>{para}</p>",
        "<h2>{link}</h2><p>{para}</p>",
        "<ul><li>{line}</li><li>{para}</li></ul>",
        "<ol><li>{line}</li><li>{word}</li></ol>",
        "<blockquote><p>{line}</p></blockquote>",
        "<pre>{line}</pre>",
        "<table><tr><th>{word}</th><td>{line}</td></tr><tr><td>{word}</td><td>{word}</td></tr></table>",
        "<figure><img><figcaption>{line}</figcaption></figure>",
        "<div>{para}</div>",
        "<section><h3>{link}</h3><p>{para}</p></section>",
        "<dl><dt>{word}</dt><dd>{line}</dd></dl>",
    ],
}
_FRAMES = [
    '<body>[out]<article y="1"><h1>{link}</h1>[in]</article>[out]</body>',
    '<body>[out]<article y="1"><h1>{line}</h1><p>{line}</p></article>[out]</body>',
    '<body>[out]<article y="1"><h2>{link}</h2>[in]</article>[out]</body>',
    '<body>[out]<main y="1"><h1>{line}</h1>[in]</main>[out]</body>',
    '<body>[out]<main y="1"><article><header><h1>{link}</h1></header>[in]</article>[mid]</main>[out]</body>',
    '<body><div y="0">[out]</div><div class="{body}" y="1"><h1>{line}</h1>[in]</div>[out]</body>',
    '<body>[out]<div id="{body}" y="1"><h2>{link}</h2><div class="{body}">[in]</div></div><div y="0">[out]</div></body>',
    '<body><div class="wrapper">[out]<div class="container"><section class="{body}" y="1">[in]</section></div>[out]</div></body>',
    '<body><table><tr><td y="0">[out]</td><td class="{body}" y="1"><h1>{link}</h1>[in]</td></tr></table>[out]</body>',
    '<body>[out]<div y="1"><h1>{line}</h1>[in]</div>[out]</body>',
]
_CLASSES = {
    "menu": _MENU, "head": _HEAD, "foot": _FOOT, "side": _SIDE, "ads": _ADS,
    "note": _NOTE, "talk": _TALK, "share": _SHARE, "body": _BODY,
}
_LENGTHS = (1, 1, 1, 2, 3, 5, 9, 20)  # of articles, in parts
_AROUND = ("menu", "head", "foot", "side", "ads", "note", "talk", "share")


def _words(drawn: random.Random, least: int, most: int) -> str:
    made = ["".join(drawn.choices("aeinorst", k=drawn.randint(2, 9))) for _ in range(drawn.randint(least, most))]
    return " ".join(made)


def _filled(part: str, drawn: random.Random) -> str:
    def text(match: re.Match) -> str:
        kind = match[1]
        if kind in _CLASSES:
            return drawn.choice(_CLASSES[kind])
        if kind == "word":
            return _words(drawn, 1, 2)
        if kind == "link":
            return _words(drawn, 2, 7)
        if kind == "line":
            return _words(drawn, 4, 16).capitalize() + drawn.choice(["", ".", "."])
        end = "." if drawn.random() < 0.9 else ""  # some texts have no sentences
        return " ".join(_words(drawn, 5, 20).capitalize() + end for _ in range(drawn.randint(2, 8)))

    return re.sub(r"\{(\w+)\}", text, part)


def labelled_pages(number: int = 800, seed: int = 2) -> list[str]:
    """``number`` labelled pages, the same for the same ``seed``."""
    drawn = random.Random(seed)
    pages = []
    for place in range(number):
        def some(match: re.Match) -> str:
            if match[1] == "in":
                parts = [drawn.choice(_PARTS["text"][:2] if drawn.random() < 0.6 else _PARTS["text"]) for _ in range(drawn.choice(_LENGTHS))]
                for kind in ("ads", "side", "share", "talk", "note"):
                    if drawn.random() < 0.15:
                        parts.insert(drawn.randint(1, len(parts)), drawn.choice(_PARTS[kind]))
            else:
                kinds = [k for k in _AROUND if drawn.random() < (0.35 if match[1] == "out" else 0.15)]
                parts = [drawn.choice(_PARTS[k]) for k in kinds]
            return "".join(parts)

        frame = re.sub(r"\[(\w+)\]", some, _FRAMES[place % len(_FRAMES)])
        pages.append(f"<html><head><title>x</title></head>{_filled(frame, drawn)}</html>")
    return pages
