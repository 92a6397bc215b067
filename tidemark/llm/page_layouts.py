"""Labelled pages for training: layouts drawn at random, whose blocks are known to be main text or not.

A page is a sequence of regions. Each region kind has several ways of being
marked up (elements, class words, or nothing but its wording) and neutral class
words are strewn over all of them, so that a model has to learn what tells
regions apart. Articles hold noise (adverts, notices, sharing, related links) in
their middle, and comments look like paragraphs. Words are invented.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

#: Class words that say nothing.
NEUTRAL = [
    "wrapper", "container", "row", "col", "inner", "box", "block", "section", "page", "site", "layout", "grid", "clearfix", "left",
    "right", "top", "bottom", "block", "wide", "full", "group", "item", "unit", "part",
]
MAIN_WORDS = [
    "content", "main", "article", "post", "entry", "story", "body", "text", "post-body", "article-body", "entry-content", "main-content",
    "post-content", "story-text", "prose", "markdown",
]

#: Kinds of regions that are no main text: the elements they occur in, their class words, and sayings they repeat.
OTHER = {
    "menu": (
        ["nav", "nav", "div", "ul", "header", "menu"],
        [
            "nav", "menu", "navbar", "navigation", "main-nav", "site-nav", "top-menu", "breadcrumb", "breadcrumbs", "pagination", "pager",
            "toolbar", "tabs", "post-nav", "toc",
        ],
        ["Home", "About", "Contact", "Products", "Blog", "Next", "Previous", "Menu", "Start", "Accueil", "Inicio", "Kontakt", "Login", "Sign in"],
    ),
    "header": (
        ["header", "header", "div"],
        [
            "header", "masthead", "site-header", "topbar", "banner", "branding", "logo", "page-header", "tagline",
        ],
        ["Welcome to our site", "Your daily source", "Search", "Sign in", "Skip to content"],
    ),
    "footer": (
        ["footer", "footer", "div"],
        [
            "footer", "site-footer", "copyright", "legal", "colophon", "page-footer", "footer-content", "imprint",
        ],
        ["© 2024", "All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "Impressum", "Contact us", "Mentions légales", "Aviso legal"],
    ),
    "sidebar": (
        ["aside", "aside", "div", "section"],
        [
            "sidebar", "side", "aside", "widget", "widgets", "rail", "secondary", "related", "related-posts", "recommended", "popular",
            "trending", "tags", "archive", "read-more",
        ],
        ["Related articles", "Most read", "Popular posts", "Recent posts", "Archives", "Tags", "You may also like", "Read more", "Lire aussi"],
    ),
    "advert": (
        ["div", "div", "aside", "section", "ins", "p"],
        [
            "ad", "ads", "advert", "advertisement", "adv", "sponsor", "sponsored", "promo", "promoted", "promotion", "banner", "ad-slot",
            "adsense", "commercial",
        ],
        ["Advertisement", "Sponsored", "Anzeige", "Publicité", "Publicidad", "Buy now", "Special offer", "Limited offer", "Save today"],
    ),
    "notice": (
        ["div", "div", "section", "dialog", "aside", "p"],
        [
            "notice", "cookie", "cookies", "cookie-banner", "consent", "gdpr", "alert", "popup", "modal", "overlay", "message",
            "notification", "paywall", "cookie-notice", "disclaimer",
        ],
        ["We use cookies", "Accept all", "Accept", "This site uses cookies to improve your experience.", "Please enable JavaScript", "OK", "Cookie settings"],
    ),
    "form": (
        ["form", "form", "form", "div"],
        [
            "form", "search", "newsletter", "subscribe", "signup", "login", "contact-form", "register", "search-form", "subscription",
        ],
        ["Subscribe", "Your name", "Your e-mail", "Submit", "Search", "Sign up for our newsletter", "Send", "Password", "Newsletter", "Subscribe to our newsletter"],
    ),
    "share": (
        ["div", "ul", "section"],
        [
            "share", "sharing", "social", "social-links", "share-buttons", "follow", "tools",
        ],
        ["Share", "Tweet", "Share this", "Follow us", "Print", "Facebook", "E-mail", "Partager", "Teilen"],
    ),
    "comments": (
        ["section", "div", "div", "ol", "aside"],
        [
            "comments", "comment", "comment-list", "responses", "replies", "discussion", "comments-area", "reader-comments", "disqus",
            "comment-content", "respond", "reviews",
        ],
        ["Comments", "3 comments", "Reply", "Leave a comment", "Leave a reply", "Kommentare", "Commentaires", "says:", "12 responses", "Report"],
    ),
}


@dataclass
class LabelledPage:
    """``html`` and, per block in page order, whether it is main text."""

    html: str
    labels: list[bool]


class Layouts:
    """Draws pages from one seed."""

    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        syllables = [c + v for c in [*"bcdfghlmnprstvwz", "th", "st"] for v in [*"aeioué", "ü", "en", "er", "ion"]]
        self.words = ["".join(self.rng.choices(syllables, k=self.rng.choice([1, 2, 2, 3, 3]))) for _ in range(30000)]
        self.out: list[str] = []
        self.labels: list[bool] = []

    def phrase(self, n: int) -> str:
        return " ".join(self.rng.choices(self.words, k=n))

    def sentences(self, n: int) -> str:
        """Some ``n`` words; not all sentences are well formed."""
        said = []
        while n > 0:
            k = min(n, self.rng.randint(2, 18))
            words = self.phrase(k)
            if k > 6 and self.rng.random() < 0.5:
                words = words.replace(" ", ", ", 1)
            said.append(words.capitalize() + self.rng.choice([".", ".", ".", ".", "!", "?", ":", ""]))
            n -= k
        return self.rng.choice([" ", " ", " ", "\n", " &amp; ", " | ", " 1234 "]).join(said)

    def attributes(self, words: list[str], chance: float) -> str:
        """Class and id: one of ``words`` by chance, and neutral ones."""
        names = self.rng.sample(NEUTRAL, self.rng.choice([0, 0, 0, 1, 2]))
        where = self.rng.choice(["class", "class", "class", "id"])
        if self.rng.random() < chance:
            names.insert(self.rng.randint(0, len(names)), self.rng.choice(words))
        return f' {where}="{" ".join(names)}"' if names else ""

    def block(self, element: str, inside: str, main: bool, attributes: str = "") -> None:
        end = "" if element in ("p", "li") and self.rng.random() < 0.15 else f"</{element}>"
        self.out.append(f"<{element}{attributes}>{inside}{end}")
        self.labels.append(main)

    def length(self) -> int:
        return self.rng.choice([1, 2, 3, 6, 12, 25, 40, 60, 100, 160])

    def paragraph(self, main: bool) -> None:
        said = self.sentences(self.length())
        if self.rng.random() < 0.2:
            said = f'{said} <a href="/{self.rng.choice(self.words)}">{self.phrase(2)}</a> {self.phrase(3)}'
        if self.rng.random() < 0.2:
            said = self.rng.choice(["<b>{}</b>", "<b>{}<br>", "<em>{}</em>", "<span>{}</span>"]).format(said)
        self.block("p", said, main)

    def other(self, kind: str) -> None:
        """A region of a kind that is no main text."""
        rng = self.rng
        elements, words, sayings = OTHER[kind]
        element = rng.choice(elements)
        plain = element in ("div", "section", "ul", "ol", "p", "ins")
        names = self.attributes(words, 1.0 if plain else 0.5)
        if element in ("p", "ins"):
            self.block("p" if element == "p" else "div", rng.choice([rng.choice(sayings), self.sentences(self.length())]), False, names)
            return
        self.out.append(f"<{element}{names}>")
        listed = kind in ("menu", "share") or kind in ("sidebar", "footer") and rng.random() < 0.5
        if listed:
            inner = element in ("ul", "ol", "menu")
            self.out.append("" if inner else "<ul>")
            for _ in range(rng.randint(2, 8)):
                said = rng.choice([rng.choice(sayings), self.phrase(rng.choice([1, 1, 2, 4]))])
                self.block("li", rng.choice([f'<a href="/{rng.choice(self.words)}">{said}</a>'] * 4 + [said]), False)
            self.out.append("" if inner else "</ul>")
        elif kind == "comments":
            for _ in range(rng.randint(1, 5)):
                box = "li" if element == "ol" else rng.choice(["div", "article", "div"])
                self.out.append(f"<{box}{self.attributes(words, 0.6)}>")
                if rng.random() < 0.6:
                    self.block(rng.choice(["h4", "div", "p"]), f"{self.phrase(2)} {rng.choice(sayings)}", False)
                self.paragraph(False)
                self.out.append(f"</{box}>")
        else:
            deep = rng.random() < 0.3
            self.out.append(f"<div{self.attributes(words + MAIN_WORDS[:2], 0.7)}>" if deep else "")
            for _ in range(rng.randint(1, 4)):
                said = rng.choice([rng.choice(sayings), rng.choice(sayings), self.phrase(rng.randint(1, 6)), self.sentences(self.length())])
                self.block(rng.choice(["p", "div", "h3"]), said, False)
            if kind == "footer":
                self.block("p", f"&copy; {self.phrase(1)} &middot; {self.sentences(rng.randint(1, 12))}", False)
            self.out.append("</div>" if deep else "")
        self.out.append(f"</{element}>")

    def bare_text(self, kind: str) -> None:
        """Text that stands directly in a region's element."""
        elements, words, sayings = OTHER[kind]
        element = self.rng.choice([e for e in elements if e not in ("ul", "ol", "p", "ins", "menu")])
        said = self.rng.choice([self.sentences(self.length()), f"{self.rng.choice(sayings)} {self.sentences(self.rng.randint(1, 15))}"])
        if kind == "footer":
            said = f"&copy; {self.phrase(1)} &middot; {said}"
        self.block(element, said, False, self.attributes(words, 1.0 if element in ("div", "section") else 0.3))

    def article(self) -> None:
        rng = self.rng
        way = rng.choice(["article"] * 4 + ["main", "main>article", "div>article", "div", "div", "section", "nothing", "table", "div>div"])
        opened = []
        for element in [] if way == "nothing" else ["table", "tr", "td"] if way == "table" else way.split(">"):
            named = element in ("div", "section") or rng.random() < 0.4
            self.out.append(f"<{element}{self.attributes(MAIN_WORDS, 0.9 if named else 0.0) if element not in ('table', 'tr') else ''}>")
            opened.append(element)
        if rng.random() < 0.85:
            headed = rng.random() < 0.25
            self.out.append(f"<header{self.attributes(['entry-header', 'article-header', 'post-header'], 0.5)}>" if headed and opened else "")
            self.block(rng.choice(["h1", "h1", "h1", "h2"]), self.phrase(rng.randint(1, 12)).capitalize(), True)
            self.out.append("</header>" if headed and opened else "")
        for _ in range(rng.randint(1, 12)):
            draw = rng.random()
            if draw < 0.72:
                self.paragraph(True)
            elif draw < 0.78:
                self.block(rng.choice(["h2", "h3", "h4"]), self.phrase(rng.randint(1, 7)).capitalize(), True)
            elif draw < 0.83:
                self.out.append(kind := rng.choice(["<ul>", "<ol>"]))
                for _ in range(rng.randint(2, 5)):
                    self.block("li", self.sentences(rng.choice([1, 3, 8, 20])), True)
                self.out.append(kind.replace("<", "</"))
            elif draw < 0.86:
                self.block(rng.choice(["blockquote", "pre", "div"]), self.sentences(self.length()), True)
            elif draw < 0.88:
                self.out.append("<table><tr>")
                for _ in range(rng.randint(2, 4)):
                    self.block(rng.choice(["td", "th"]), self.phrase(rng.randint(1, 4)), True)
                self.out.append("</tr></table>")
            elif draw < 0.9:
                self.out.append("<figure><img src='x.png'>")
                self.block("figcaption", self.sentences(rng.choice([3, 8])), True)
                self.out.append("</figure>")
            else:
                self.noise(["advert", "notice", "sidebar", "share", "form", "menu"])
        if rng.random() < 0.25:
            self.noise(["comments", "share", "sidebar", "form"])
        self.out.extend(f"</{e}>" for e in reversed(opened))

    def noise(self, kinds: list[str]) -> None:
        kind = self.rng.choice(kinds)
        if self.rng.random() < 0.3 and kind not in ("menu", "share", "comments"):
            self.bare_text(kind)
        else:
            self.other(kind)

    def page(self) -> LabelledPage:
        rng = self.rng
        self.out, self.labels = ["<!DOCTYPE html><html><head><title>", self.phrase(4), "</title><style>p{margin:0}</style></head>"], []
        self.out.append(f"<body{self.attributes(['home', 'single', 'post', 'article', 'page'], 0.3)}>")
        wrapped = rng.random() < 0.4
        self.out.append(f"<div{self.attributes(['content', 'main', 'page'], 0.4)}>" if wrapped else "")
        for _ in range(rng.choice([0, 1, 2, 2, 3, 4])):
            self.noise(["header", "menu", "menu", "notice", "advert", "form"])
        if rng.random() < 0.25:
            self.noise(["sidebar", "menu"])
        if rng.random() < 0.97:
            self.article()
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            self.noise(["comments", "comments", "sidebar", "advert", "form", "share", "menu"])
        if rng.random() < 0.85:
            self.noise(["footer"])
        self.out.append("</div>" if wrapped else "")
        self.out.append("</body></html>" if rng.random() < 0.9 else "")
        return LabelledPage("".join(self.out), self.labels)


def labelled_pages(n: int, seed: int) -> list[LabelledPage]:
    """``n`` pages; equal arguments give equal pages."""
    layouts = Layouts(seed)
    return [layouts.page() for _ in range(n)]
