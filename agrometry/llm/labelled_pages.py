"""Labelled web pages to train the extraction on: layouts of many kinds, with made-up words, from a rule and a seed.

A mark before a text says that its block is main text.
"""

from __future__ import annotations

import random

KEEP = "\x01"

# Usual names of page parts.
_MAIN = ("<article>", "<main>", '<div class="content">', '<div id="content">', '<div class="post entry">', '<section class="article-body">', '<div class="story text">', '<div role="main">')
_PARTS = {
    "menu": ("<nav>", '<div class="menu">', '<ul class="nav navigation">', '<div class="breadcrumb breadcrumbs">', '<div role="navigation">'),
    "header": ("<header>", '<div class="header masthead">', '<div id="top" class="site-header logo">', '<div role="banner">'),
    "footer": ("<footer>", '<div class="footer copyright">', '<div id="footer">', '<div role="contentinfo">'),
    "side": ("<aside>", '<div class="sidebar widget">', '<div id="sidebar">', '<div class="related recommended popular">', '<div class="share social follow">'),
    "advert": ('<div class="ad">', '<div class="ads advert advertisement">', '<div class="sponsored promo banner">', '<div id="ad">'),
    "notice": ('<div class="cookie consent">', '<div class="notice alert">', '<div class="popup modal newsletter subscribe">', "<dialog>"),
    "form": ("<form>", '<form class="search login">', "<fieldset>"),
    "comments": ('<div class="comments">', '<section id="comments" class="comment replies">', '<ul class="comment-list discussion">'),
}
_SYLLABLES = "an be ci do er fa gi ha in jo ka le mo no or pa qui ra si ta un ve wo xi ya zu".split()


def _close(tag: str) -> str:
    return f"</{tag[1:].split()[0].rstrip('>')}>"


class _Writer:
    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def words(self, least: int, most: int) -> str:
        pick = self.draw
        return " ".join("".join(pick.choices(_SYLLABLES, k=pick.randint(1, 4))) for _ in range(pick.randint(least, most)))

    def sentence(self, least: int = 5, most: int = 25) -> str:
        return self.words(least, most).capitalize() + self.draw.choice(".!?..")

    def part(self, kind: str) -> str:
        pick = self.draw
        tag = pick.choice(_PARTS[kind])
        if kind in ("menu", "side") and pick.random() < 0.8:
            items = "".join(f'<li><a href="/x">{self.words(1, 4)}</a></li>' for _ in range(pick.randint(2, 7)))
            inner = items if tag.startswith("<ul") else f"<ul>{items}</ul>"
        elif kind == "footer":
            inner = f"&copy; {self.words(1, 3)} &middot; {self.sentence()}"
        elif kind == "form":
            inner = f"<label>{self.words(1, 3)}</label><input name=q><button>{self.words(1, 2)}</button><p>{self.sentence()}</p>"
        elif kind == "comments":
            inner = f"<h3>{self.words(1, 3)}</h3>" + "".join(
                f'<div class="comment"><b>{self.words(1, 2)}</b><p>{self.sentence()} {self.sentence()}</p></div>' for _ in range(pick.randint(1, 4))
            )
        elif kind == "header":
            inner = f"<a href=/>{self.words(1, 3)}</a><p>{self.words(2, 6)}</p>"
        else:
            inner = pick.choice((self.sentence(), f"<p>{self.sentence()}</p>", f"<h4>{self.words(1, 3)}</h4><p>{self.sentence()}</p><a href=/y>{self.words(1, 3)}</a>"))
        return tag + inner + _close(tag)

    def main(self) -> str:
        pick = self.draw
        tag = pick.choice(_MAIN)
        title = f"<h1>{KEEP}{self.words(3, 9)}</h1>"
        blocks = [f"<header>{title}</header>" if pick.random() < 0.15 else title]
        for _ in range(pick.randint(1, 9)):
            kind = pick.random()
            if kind < 0.62:
                text = " ".join(self.sentence() for _ in range(pick.randint(1, 5)))
                blocks.append(pick.choice(("<p>{}</p>", "<p>{}</p>", "<p><b>{}<br>", "<div>{}</div>")).format(KEEP + text))
            elif kind < 0.7:
                blocks.append(f"<h2>{KEEP}{self.words(1, 6)}</h2>")
            elif kind < 0.78:
                items = "".join(f"<li>{KEEP}{self.sentence(2, 9)}</li>" for _ in range(pick.randint(2, 5)))
                blocks.append(f"<ul>{items}</ul>")
            elif kind < 0.83:
                blocks.append(f"<blockquote>{KEEP}{self.sentence()}</blockquote>")
            elif kind < 0.87:
                cells = "".join(f"<td>{KEEP}{self.words(1, 3)}</td>" for _ in range(4))
                blocks.append(f"<table><tr>{cells}</tr></table>")
            elif kind < 0.9:
                blocks.append(f"<pre>{KEEP}{self.words(3, 9)}</pre>")
            elif kind < 0.93:
                blocks.append(f"<p>{KEEP}{self.sentence()} <a href=/z>{self.words(1, 3)}</a> {self.words(2, 9)}.</p>")
            else:
                blocks.append(self.part(pick.choice(("advert", "side", "form", "notice", "menu", "comments"))))
        return tag + "".join(blocks) + _close(tag)

    def page(self) -> str:
        pick = self.draw
        before = [self.part(k) for k in ("header", "menu", "notice", "advert", "side") if pick.random() < 0.5]
        after = [self.part(k) for k in ("comments", "side", "advert", "form", "footer", "notice") if pick.random() < 0.5]
        body = "".join([*before, self.main(), *after])
        if pick.random() < 0.3:
            body = f'<div class="page wrapper container">{body}</div>'
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{body}</body></html>"


def pages(count: int = 240) -> list[str]:
    return [_Writer(seed).page() for seed in range(count)]
