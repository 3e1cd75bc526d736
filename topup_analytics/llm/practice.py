"""Practice pages: texts of the corpus set in page layouts whose main text is known.

Raw pages carry no labels. So the extractor learns from pages that are built here from the texts of a
bounded sample of pages: an article in one of many usual mark-ups, among menus, headers, footers, sidebars,
notices, adverts, forms, comments and share lists in theirs, with names, without names, in any order.
"""

from __future__ import annotations

import html
from random import Random

from topup_analytics.llm.dom import WORDS_OF

#: Stands at the start of every block of main text.
MARK = ""
_AFFIXES = ["", "", "", "site-", "page-", "main-", "js-", "c-", "block_", "the-"]
_FILLERS = ["wrapper", "row", "col-md-8", "grid", "inner", "box", "clearfix", "x1"]

#: Articles have so many parts, in these shares.
_LENGTHS = [1, 2, 3, 4, 6, 9, 14, 40, 160]
_SHARES = [20, 20, 12, 12, 12, 12, 12, 4, 2]


class Layout:
    """One practice page."""

    def __init__(self, rng: Random, texts: list[str]):
        self.rng = rng
        self.words = [w for t in texts for w in t.split()] or ["text"]
        self.texts = [t for t in texts if t] or ["text"]

    def some(self, least: int, most: int) -> str:
        """A few words in a row, as they stand in the page."""
        n = self.rng.randint(least, most)
        at = self.rng.randrange(max(1, len(self.words) - n))
        return html.escape(" ".join(self.words[at : at + n]))

    def name(self, group: str) -> str:
        """An attribute that names a part of the page, or nothing."""
        word = self.rng.choice(WORDS_OF[group].split())
        value = self.rng.choice(_AFFIXES) + word + self.rng.choice(["", "", "", "-list", "Box", "-1", " x"])
        return f' {self.rng.choice(["class", "class", "class", "id", "role"])}="{value}"'

    def plain(self) -> str:
        """An attribute that says nothing, or none."""
        return self.rng.choice(["", "", f' class="{self.rng.choice(_FILLERS)}"', f' id="n{self.rng.randrange(99)}"', ' style="margin:0"'])

    def pick(self, *options) -> str:
        return self.rng.choice(options)()

    def links(self, least: int = 2, most: int = 9) -> list[str]:
        return [f'<a href="/{self.some(1, 1)}">{self.some(1, 4)}</a>' for _ in range(self.rng.randint(least, most))]

    def link_list(self, attributes: str = "") -> str:
        return f"<ul{attributes}>" + "".join(f"<li>{a}</li>" for a in self.links()) + "</ul>"

    # What is not main text.

    def menu(self) -> str:
        return self.pick(
            lambda: f"<nav{self.plain()}>{self.link_list()}</nav>",
            lambda: f"<nav>{self.link_list()}</nav>",
            lambda: f"<div{self.name('menu')}>{self.rng.choice([' ', ' | ', ' &middot; ']).join(self.links())}</div>",
            lambda: self.link_list(self.name("menu")),
            lambda: f"<div{self.plain()}>{self.link_list(self.plain())}</div>",
            lambda: f"<div{self.plain()}>{' '.join(self.links())}</div>",
        )

    def header(self) -> str:
        inner = f"<div{self.name('header')}>{self.some(1, 4)}</div>" if self.rng.random() < 0.5 else f"<a href='/'>{self.some(1, 3)}</a>"
        if self.rng.random() < 0.25:
            inner = f"<h1{self.plain()}>{self.some(1, 4)}</h1>" + inner * self.rng.randint(0, 1)
        inner += f"<p>{self.some(2, 12)}</p>" if self.rng.random() < 0.4 else ""
        inner += self.menu() if self.rng.random() < 0.6 else ""
        return self.pick(lambda: f"<header{self.plain()}>{inner}</header>", lambda: f"<div{self.name('header')}>{inner}</div>")

    def footer(self) -> str:
        inner = self.pick(
            lambda: f"&copy; {self.some(1, 3)} &middot; {self.some(3, 30)}",
            lambda: f"<p>&copy; {self.some(2, 8)}</p>{self.link_list()}",
            lambda: f"<p>{self.some(3, 25)}</p>",
            lambda: f"{' '.join(self.links())}<p>{self.some(3, 40)}</p>",
        )
        return self.pick(
            lambda: f"<footer{self.plain()}>{inner}</footer>",
            lambda: f"<footer>{inner}</footer>",
            lambda: f"<div{self.name('footer')}>{inner}</div>",
            lambda: f"<div{self.plain()}>&copy; {self.some(2, 12)}</div>",
        )

    def advert(self) -> str:
        inner = self.pick(lambda: self.some(2, 40), lambda: f"<p>{self.some(3, 60)}</p>", lambda: f"<h3>{self.some(2, 5)}</h3><p>{self.some(5, 50)}</p>{self.links(1, 1)[0]}")
        tag = self.rng.choice(["div", "div", "div", "aside", "ins", "section", "p", "span"])
        inner = self.some(2, 40) if tag in ("p", "span", "ins") else inner
        return f"<{tag}{self.name('advert')}>{inner}</{tag}>"

    def notice(self) -> str:
        inner = self.pick(lambda: self.some(4, 40), lambda: f"<p>{self.some(6, 60)} {self.links(1, 1)[0]}</p><button>{self.some(1, 2)}</button>")
        return f"<{(tag := self.rng.choice(['div', 'div', 'section', 'aside', 'dialog']))}{self.name('notice')}>{inner}</{tag}>"

    def form(self) -> str:
        inner = f"<label>{self.some(1, 4)} <input name=q></label>" * self.rng.randint(1, 3)
        inner += f"<p>{self.some(2, 25)}</p>" if self.rng.random() < 0.5 else ""
        inner += f"<textarea>{self.some(1, 5)}</textarea>" if self.rng.random() < 0.3 else ""
        whole = f"<form{self.rng.choice([self.plain(), self.name('form')])}>{inner}<button>{self.some(1, 2)}</button></form>"
        return self.pick(lambda: whole, lambda: f"<div{self.name('form')}><h3>{self.some(1, 4)}</h3><p>{self.some(3, 20)}</p>{whole}</div>")

    def side(self) -> str:
        parts = [lambda: f"<h3>{self.some(1, 4)}</h3>{self.link_list()}", self.advert, lambda: f"<p>{self.some(5, 60)}</p>", self.form, lambda: f"<h4>{self.some(1, 4)}</h4><p>{self.some(5, 40)}</p>"]
        inner = "".join(self.rng.choice(parts)() for _ in range(self.rng.randint(1, 4)))
        return self.pick(lambda: f"<aside{self.plain()}>{inner}</aside>", lambda: f"<div{self.name('side')}>{inner}</div>", lambda: f"<aside{self.name('side')}>{inner}</aside>")

    def comments(self) -> str:
        def one() -> str:
            body = f"<p>{self.some(3, 70)}</p>" if self.rng.random() < 0.7 else self.some(3, 70)
            by = self.rng.choice(["", f"<b>{self.some(1, 2)}</b> ", f"<cite>{self.some(1, 2)}</cite>", f"<h4>{self.some(1, 2)}</h4>"])
            return by + body

        tag, attributes = self.rng.choice([("div", ""), ("div", self.name("comment")), ("article", self.name("comment")), ("li", "")])
        inner = "".join(f"<{tag}{attributes}>{one()}</{tag}>" for _ in range(self.rng.randint(1, 6)))
        inner = f"<ol>{inner}</ol>" if tag == "li" else inner
        head = f"<h3>{self.some(1, 3)}</h3>" if self.rng.random() < 0.6 else ""
        form = self.form() if self.rng.random() < 0.4 else ""
        return f"<{(outer := self.rng.choice(['div', 'section', 'section', 'aside']))}{self.name('comment')}>{head}{inner}{form}</{outer}>"

    def share(self) -> str:
        return self.pick(lambda: f"<div{self.name('share')}>{' '.join(self.links(2, 5))}</div>", lambda: self.link_list(self.name("share")), lambda: f"<div{self.name('share')}>{self.some(1, 4)}</div>")

    def related(self) -> str:
        inner = f"<h3>{self.some(1, 4)}</h3>{self.link_list()}"
        return self.pick(lambda: f"<div{self.name('side')}>{inner}</div>", lambda: f"<section{self.name('side')}>{inner}</section>", lambda: f"<aside>{inner}</aside>")

    # Main text.

    def inline(self) -> str:
        """The inside of a block of main text."""
        whole = html.escape(self.rng.choice(self.texts)) if self.rng.random() < 0.5 else self.some(1, 90)
        if self.rng.random() < 0.3:
            words = whole.split(" ")
            at = self.rng.randrange(len(words))
            tag, attributes = self.rng.choice([("a", ' href="/x"'), ("b", ""), ("em", ""), ("span", self.plain()), ("a", f' href="/{words[at]}"{self.plain()}')])
            words[at] = f"<{tag}{attributes}>{words[at]}</{tag}>"
            whole = " ".join(words)
        return MARK + whole

    def part(self) -> str:
        """A block, or a few, of main text."""
        return self.rng.choice([self.paragraph] * 14 + [self.linked, self.list, self.list, self.quote, self.figure, self.table, self.bare, self.heading, self.heading])()

    def paragraph(self) -> str:
        return self.pick(*[lambda: f"<p>{self.inline()}</p>"] * 6, lambda: f"<p><b>{self.inline()}<br>", lambda: f"<p{self.plain()}>{self.inline()}</p>", lambda: f"<p>{self.inline()}", lambda: f"<div{self.plain()}>{self.inline()}</div>")

    def linked(self) -> str:
        """A block of main text that is mostly, or all, links."""
        links = [f'<a href="/{self.some(1, 1)}">{self.some(1, 9)}</a>' for _ in range(self.rng.randint(1, 4))]
        return self.pick(lambda: f"<p>{MARK}{', '.join(links)}</p>", lambda: f"<p>{MARK}{self.some(1, 8)} {', '.join(links)}.</p>", lambda: f"<p>{links[0].replace('>', '>' + MARK, 1)}</p>")

    def heading(self) -> str:
        return f"<h{(n := self.rng.randint(2, 4))}>{MARK}{self.some(1, 8)}</h{n}>" + self.paragraph()

    def list(self) -> str:
        tag = self.rng.choice(["ul", "ol"])
        return f"<{tag}>" + "".join(f"<li>{MARK}{self.some(1, 30)}</li>" for _ in range(self.rng.randint(1, 6))) + f"</{tag}>"

    def quote(self) -> str:
        return self.pick(lambda: f"<blockquote>{self.inline()}</blockquote>", lambda: f"<blockquote><p>{self.inline()}</p></blockquote>", lambda: f"<pre>{self.inline()}</pre>")

    def figure(self) -> str:
        return f'<figure><img src="/x.png" alt="{self.some(1, 4)}"><figcaption>{MARK}{self.some(1, 20)}</figcaption></figure>'

    def table(self) -> str:
        row = lambda: "<tr>" + "".join(f"<td>{MARK}{self.some(1, 4)}</td>" for _ in range(3)) + "</tr>"
        return "<table>" + "".join(row() for _ in range(self.rng.randint(1, 4))) + "</table>"

    def bare(self) -> str:
        return f"<div>{self.inline()}<br><br>{MARK}{self.some(3, 60)}</div>"

    def article(self) -> str:
        title = f"<h1>{MARK}{self.some(1, 12)}</h1>"
        head = self.rng.choice([title] * 7 + ["", f"<header>{title}</header>", f"<h2>{MARK}{self.some(1, 10)}</h2>"])
        head += f'<p class="byline">{MARK}{self.some(1, 6)}</p>' if self.rng.random() < 0.15 else ""
        parts = [self.part() for _ in range(self.rng.choices(_LENGTHS, _SHARES)[0])]
        for foreign, chance in ((self.advert, 0.25), (self.share, 0.2), (self.related, 0.2), (self.form, 0.1), (self.notice, 0.1), (self.comments, 0.1), (self.side, 0.1)):
            if self.rng.random() < chance:
                parts.insert(self.rng.randint(0, len(parts)), foreign())
        if self.rng.random() < 0.3:
            parts.append(self.pick(lambda: f"<footer>{self.some(2, 12)}</footer>", lambda: f"<footer{self.plain()}><p>{self.some(2, 20)}</p></footer>"))
        inner = head + "".join(parts)
        if self.rng.random() < 0.3:
            inner = f"<div{self.rng.choice([self.plain(), self.name('content')])}>{inner}</div>"
        return self.pick(
            *[lambda: f"<article>{inner}</article>"] * 3,
            lambda: f"<article{self.rng.choice([self.plain(), self.name('content')])}>{inner}</article>",
            lambda: f"<main{self.plain()}>{inner}</main>",
            lambda: f"<main><article>{inner}</article></main>",
            *[lambda: f"<div{self.name('content')}>{inner}</div>"] * 2,
            lambda: f"<section{self.name('content')}>{inner}</section>",
            *[lambda: f"<div{self.plain()}>{inner}</div>"] * 2,
            lambda: f"<section>{inner}</section>",
            *[lambda: inner] * 2,
        )

    def html(self) -> str:
        chance = lambda p, part: part() if self.rng.random() < p else ""
        rng = self.rng
        if rng.random() < 0.06:
            alone = self.pick(self.article, self.article, self.paragraph, lambda: MARK + self.some(1, 200), lambda: f"{MARK}{self.some(1, 60)}<br>{self.some(1, 60)}")
            return self.pick(lambda: f"<html><head><title>{self.some(1, 9)}</title></head><body>{alone}</body></html>", lambda: alone)
        before = [chance(0.25, self.notice), chance(0.45, self.header), chance(0.75, self.menu), chance(0.15, self.form), chance(0.5, self.advert)]
        if rng.random() < 0.3:
            rng.shuffle(before)
        middle = [self.article()] + ([self.side()] if rng.random() < 0.45 else [])
        if rng.random() < 0.3:
            middle.reverse()
        if rng.random() < 0.06:
            cells = [self.pick(self.menu, self.side, lambda: "<br>".join(self.links()), lambda: " ".join(self.links())), *middle[:1]]
            middle = [f"<table{self.plain()}><tr>{''.join(f'<td{self.plain()}>{c}</td>' for c in cells)}</tr></table>"]
        middle += [chance(0.4, self.comments), chance(0.25, self.related), chance(0.15, self.share)]
        inside = "".join(middle)
        if rng.random() < 0.4:
            inside = f"<div{self.plain()}>{inside}</div>"
        after = [chance(0.15, self.advert), chance(0.1, self.form), chance(0.85, self.footer), chance(0.1, self.notice)]
        whole = "".join(before) + inside + "".join(after)
        if rng.random() < 0.25:
            whole = f"<div{self.plain()}>{whole}</div>"
        return f"<html><head><title>{self.some(1, 9)}</title></head><body>{whole}</body></html>"
