"""Labelled pages for training: laid out in the common ways, with made-up words.

The pages of a corpus carry no labels. These do, because it is known where each block was put: `labelled_pages`
gives pages with the texts of their article. Layouts vary in elements, in the names of classes and ids, and in
where things stand; the words carry no meaning, so that only layout and the make of the text can be learnt.
"""

from __future__ import annotations

import random

#: Words that name parts of pages, by what the part is.
NAMES = {
    "nav": "nav navbar navigation menu menubar topnav mainmenu links breadcrumb breadcrumbs skip toc pager pagination tabs",
    "header": "header masthead banner top topbar site brand logo branding title",
    "footer": "footer foot bottom copyright legal colophon imprint credits",
    "side": "sidebar side aside widget rail secondary related recommended popular trending more teaser promo complementary archive tags",
    "ad": "ad ads advert adverts advertisement advertising sponsor sponsored sponsors promo promotion promoted banner",
    "notice": "cookie cookies consent notice notices gdpr privacy alert popup modal overlay message newsletter warning disclaimer",
    "form": "form search searchbox login signup subscribe register contact feedback newsletter",
    "comments": "comment comments commentlist discussion replies reply respond disqus thread responses reader readers reactions",
    "share": "share sharing social buttons toolbar follow like print actions",
    "article": "article content post entry story body text main maincontent hentry single page prose copy primary",
}
NAMES = {k: v.split() for k, v in NAMES.items()}
#: Names that say nothing.
PLAIN = "wrap wrapper container row col inner outer block box section grid clearfix module item left center".split()
SYLLABLES = "ka lo mi ren ta sel vo ni dra pe sho tun el ar is ond un ger thi qua".split()


class _Page:
    def __init__(self, seed: int) -> None:
        self.rng = random.Random(seed)
        self.article: list[str] = []
        self.style = self.rng.choice(("plain", "plain", "plain", "signs", "capitals"))

    def word(self) -> str:
        w = "".join(self.rng.choice(SYLLABLES) for _ in range(self.rng.randint(1, 4)))
        if self.style == "signs":
            w += self.rng.choice(("%%%", "###", "***", "", "$$$"))
        return w.upper() + "!!" if self.style == "capitals" else w

    def phrase(self, least: int, most: int) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(least, most))).capitalize()

    def prose(self, most: int = 6) -> str:
        return " ".join(self.phrase(1, 18) + self.rng.choice("..,?") for _ in range(self.rng.randint(1, most)))

    def named(self, kind: str) -> str:
        """Attributes that name an element of a kind."""
        words = [self.rng.choice(NAMES[kind])] + self.rng.sample(PLAIN, self.rng.randint(0, 1))
        self.rng.shuffle(words)
        where = self.rng.choice(("class", "class", "id"))
        return f' {where}="{self.rng.choice((" ", "-", "_")).join(words)}"'

    def plain(self) -> str:
        return f' class="{self.rng.choice(PLAIN)}"' if self.rng.random() < 0.5 else ""

    def part(self, kind: str, tag: str, inside: str) -> str:
        """An element that its tag, its name or both give away."""
        if tag == "div" or self.rng.random() < 0.4:
            return f"<{tag}{self.named(kind)}>{inside}</{tag}>"
        return f"<{tag}{self.plain()}>{inside}</{tag}>"

    def link(self) -> str:
        return f'<a href="/{self.rng.randint(1, 999)}">{self.phrase(1, 3)}</a>'

    def menu(self) -> str:
        items = "".join(f"<li>{self.link()}</li>" for _ in range(self.rng.randint(2, 9)))
        return self.part("nav", self.rng.choice(("nav", "nav", "div")), f"<ul>{items}</ul>" if self.rng.random() < 0.8 else " | ".join(self.link() for _ in range(4)))

    def header(self) -> str:
        return self.part("header", self.rng.choice(("header", "div")), f"<{(t := self.rng.choice(('div', 'p', 'h1', 'h2')))}>{self.phrase(1, 5)}</{t}>" + (self.menu() if self.rng.random() < 0.5 else ""))

    def footer(self) -> str:
        words = self.rng.choice((f"&copy; {self.phrase(1, 4)} &middot; {self.prose(2)}", self.prose(2), f"Copyright {self.phrase(2, 5)}"))
        return self.part("footer", self.rng.choice(("footer", "footer", "div")), self.rng.choice((words, f"<p>{words}</p>")) + (self.menu() if self.rng.random() < 0.3 else ""))

    def ad(self) -> str:
        return f"<{(t := self.rng.choice(('div', 'div', 'aside', 'section')))}{self.named('ad')}>{self.rng.choice((self.prose(3), f'<p>{self.prose(2)}</p>', self.link()))}</{t}>"

    def notice(self) -> str:
        if self.rng.random() < 0.15:
            return f"<noscript>{self.rng.choice((self.prose(2), f'<p>{self.prose(2)}</p>'))}</noscript>"
        return f"<{(t := self.rng.choice(('div', 'div', 'section', 'p')))}{self.named('notice')}>{self.prose(3)}</{t}>"

    def side(self) -> str:
        inside = f"<h3>{self.phrase(1, 3)}</h3>" + "".join(self.rng.choice((f"<p>{self.prose(2)}</p>", f"<li>{self.link()}</li>")) for _ in range(self.rng.randint(1, 5)))
        return self.part("side", self.rng.choice(("aside", "div", "section")) if self.rng.random() < 0.9 else "div", inside) if self.rng.random() < 0.5 else f"<aside>{inside}</aside>"

    def form(self) -> str:
        inside = f"<label>{self.phrase(1, 4)}</label><input><button>{self.phrase(1, 2)}</button>" + (f"<p>{self.prose(2)}</p>" if self.rng.random() < 0.5 else "")
        return f"<form{self.named('form') if self.rng.random() < 0.5 else ''}>{inside}</form>"

    def share(self) -> str:
        return f"<div{self.named('share')}>{self.link()} {self.link()}</div>"

    def comments(self) -> str:
        tag = self.rng.choice(("div", "li", "article", "section", "p"))
        each = "".join(f"<{tag}{self.named('comments')}>{self.rng.choice(('', f'<b>{self.phrase(1, 2)}</b> '))}{self.prose(4) if tag == 'p' else f'<p>{self.prose(4)}</p>'}</{tag}>" for _ in range(self.rng.randint(1, 5)))
        outer = self.rng.choice(("section", "div", "ol", "aside"))
        return f"<{outer}{self.named('comments')}>" + (f"<h3>{self.phrase(1, 3)}</h3>" if self.rng.random() < 0.6 else "") + each + (self.form() if self.rng.random() < 0.3 else "") + f"</{outer}>"

    def kept(self, text: str) -> str:
        self.article.append(" ".join(text.split()))
        return text

    def body(self) -> str:
        """The article's blocks, here and there with a foreign block between them."""
        out = []
        if self.rng.random() < 0.85:
            out.append(f"<h1>{self.kept(self.phrase(2, 12))}</h1>")
        for _ in range(self.rng.randint(1, 14)):
            roll = self.rng.random()
            if roll < 0.68:
                text = self.kept(self.prose(8))
                inner = f"<b>{text}" if self.rng.random() < 0.15 else text
                out.append(f"<p>{inner}" + self.rng.choice(("</p>", "</p>", "</p>", "<br>", "")))
            elif roll < 0.76:
                out.append(f"<h{(n := self.rng.randint(2, 4))}>{self.kept(self.phrase(1, 6))}</h{n}>")
            elif roll < 0.83:
                out.append("<ul>" + "".join(f"<li>{self.kept(self.phrase(1, 12))}</li>" for _ in range(self.rng.randint(1, 5))) + "</ul>")
            elif roll < 0.87:
                out.append(f"<blockquote>{self.kept(self.prose(3))}</blockquote>")
            elif roll < 0.9:
                out.append(f"<figure><img><figcaption>{self.kept(self.phrase(3, 10))}</figcaption></figure>")
            elif roll < 0.92:
                out.append("<table><tr>" + "".join(f"<td>{self.kept(self.phrase(1, 3))}</td>" for _ in range(4)) + "</tr></table>")
            elif roll < 0.94:
                out.append(f"<div>{self.kept(self.prose(5))}</div>")
            else:
                out.append(self.rng.choice((self.ad, self.share, self.side, self.notice, self.form))())
        return "".join(out)

    def main(self) -> str:
        roll = self.rng.random()
        inside = self.body()
        if roll < 0.4:
            return f"<article{self.plain()}>{inside}</article>"
        if roll < 0.55:
            return f"<main{self.plain()}>{inside}</main>"
        if roll < 0.9:
            return f"<{(t := self.rng.choice(('div', 'div', 'section', 'td')))}{self.named('article')}>{inside}</{t}>"
        return f"<div{self.plain()}>{inside}</div>"

    def html(self) -> str:
        before = [f for f in (self.header, self.menu, self.notice, self.ad, self.menu, self.form, self.side) if self.rng.random() < 0.4]
        after = [f for f in (self.share, self.side, self.comments, self.form, self.ad, self.notice, self.menu) if self.rng.random() < 0.4]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        parts = [f() for f in before] + [self.main()] + [f() for f in after] + ([self.footer()] if self.rng.random() < 0.85 else [])
        body = "".join(parts)
        if self.rng.random() < 0.4:
            body = f"<div{self.plain()}>{body}</div>"
        return f"<!DOCTYPE html><html><head><title>x</title></head><body>{body}" + self.rng.choice(("</body></html>", ""))


def labelled_pages(n: int, seed: int = 1) -> list[tuple[str, list[str]]]:
    """`n` pages as HTML, each with the texts of its article's blocks."""
    pages = []
    for i in range(n):
        page = _Page(seed * 100_003 + i)
        pages.append((page.html(), page.article))
    return pages
