"""Main text of web pages by a linear-chain conditional random field.

The leaf blocks of a page in order are the chain. A block's features are the tags of its
ancestors, hints in their class, id and role, and its text: length, share of links, end.
The field has a weight for each feature and for each pair of neighbouring labels; it is
trained by gradient steps on the likelihood of labelled pages (forward and backward sums),
and pages are decoded by Viterbi.

The labelled pages are written by a small grammar: articles in the wrappers that sites use,
among menus, headers, footers, sidebars, notices, adverts, forms and reader comments, with
made-up words, so that the field learns structure and not a vocabulary. ``TRAINING_PAGES``
bounds them, whatever the size of the table; training takes seconds on the driver.

Defined results: NULL or empty html and pages without main text give an empty text; blocks
are joined by one line break in order of the page; repeated rows each have their result;
other columns are ignored.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from salestide.llm.dom import Block, read_page
from salestide.llm.rows import named

TRAINING_PAGES = 400
EPOCHS = 6
#: Blocks in a page that hold a label each: 0 for the frame of the page, 1 for main text.
OTHER, MAIN = 0, 1

# Words in class, id and role that hint at what an element is for.
HINTS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs pagination pager toc tabs",
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner teaser",
    "comment": "comment comments commentlist reply replies respond discussion disqus reviews",
    "foot": "footer foot bottom copyright legal colophon",
    "head": "header masthead top logo branding topbar",
    "side": "sidebar side aside widget widgets rail related recommended popular trending",
    "notice": "cookie cookies consent notice alert gdpr popup modal overlay privacy banner",
    "form": "form search login signup subscribe newsletter contact",
    "share": "share sharing social tags meta byline author date",
    "main": "article content main post entry story body text page",
}
HINT_OF = {word: group for group, words in HINTS.items() for word in words.split()}


def features(blocks: list[Block]) -> list[list[str]]:
    """Names of the features of each block."""
    made = []
    for block in blocks:
        words = block.text.count(" ") + 1
        length = "1-3" if words < 4 else "4-9" if words < 10 else "10-24" if words < 25 else "25-"
        links = "0" if not block.linked else "some" if block.linked < 0.6 else "most"
        found = ["any", f"leaf:{block.leaf}"]
        found += [f"in:{tag}" for tag in block.inside]
        found += [f"hint:{hint}" for hint in block.names]
        found += [f"words:{length}", f"links:{links}"]
        if block.text[-1] in ".!?:;\"'":
            found.append("ends a sentence")
        if "©" in block.text:
            found.append("copyright sign")
        made.append(found)
    return made


@dataclass
class Field:
    """Weights of features for MAIN, and of label pairs."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: list[list[float]] = field(default_factory=lambda: [[0.0, 0.0], [0.0, 0.0]])

    def scores(self, page: list[list[str]]) -> list[float]:
        return [sum(self.weights.get(name, 0.0) for name in found) for found in page]

    def decode(self, page: list[list[str]]) -> list[int]:
        """The most probable labels, by Viterbi."""
        best, back = [0.0, 0.0], []
        for at, score in enumerate(self.scores(page)):
            step, come = [0.0, 0.0], [0, 0]
            for label in (OTHER, MAIN):
                own = score if label == MAIN else 0.0
                if at == 0:
                    step[label] = own
                    continue
                through = [best[before] + self.pairs[before][label] for before in (OTHER, MAIN)]
                come[label] = int(through[1] > through[0])
                step[label] = own + max(through)
            best = step
            back.append(come)
        labels, label = [], int(best[1] > best[0])
        for come in reversed(back):
            labels.append(label)
            label = come[label]
        return labels[::-1]

    def expected(self, page: list[list[str]]) -> tuple[list[float], list[list[list[float]]]]:
        """Chances of MAIN at each block and of each label pair at each step."""
        own = [(0.0, score) for score in self.scores(page)]
        forward = [list(own[0])]
        for score in own[1:]:
            last = forward[-1]
            forward.append(
                [score[y] + _log_sum(last[0] + self.pairs[0][y], last[1] + self.pairs[1][y]) for y in (0, 1)]
            )
        backward = [[0.0, 0.0]]
        for score in reversed(own[1:]):
            after = backward[-1]
            backward.append(
                [
                    _log_sum(*[self.pairs[x][y] + score[y] + after[y] for y in (0, 1)])
                    for x in (0, 1)
                ]
            )
        backward.reverse()
        total = _log_sum(*forward[-1])
        main = [math.exp(f[1] + b[1] - total) for f, b in zip(forward, backward)]
        steps = [
            [
                [
                    math.exp(forward[t][x] + self.pairs[x][y] + own[t + 1][y] + backward[t + 1][y] - total)
                    for y in (0, 1)
                ]
                for x in (0, 1)
            ]
            for t in range(len(own) - 1)
        ]
        return main, steps


def _log_sum(a: float, b: float) -> float:
    high = max(a, b)
    return high + math.log1p(math.exp(min(a, b) - high))


def train(pages: list[tuple[list[list[str]], list[int]]], epochs: int = EPOCHS, seed: int = 3) -> Field:
    """A field fitted by AdaGrad steps, one page at a time, with a little shrinking."""
    made, squares, order = Field(), {}, list(pages)
    chance = random.Random(seed)

    def step(key, gradient: float, value: float) -> float:
        squares[key] = squares.get(key, 1e-6) + gradient * gradient
        return value + 0.3 * gradient / math.sqrt(squares[key])

    for _ in range(epochs):
        chance.shuffle(order)
        for page, labels in order:
            if not page:
                continue
            main, steps = made.expected(page)
            gradients: dict[str, float] = {}
            for found, label, p in zip(page, labels, main):
                for name in found:
                    gradients[name] = gradients.get(name, 0.0) + (label == MAIN) - p
            for name, gradient in gradients.items():
                value = made.weights.get(name, 0.0)
                made.weights[name] = step(name, gradient - 0.002 * value, value)
            for x in (0, 1):
                for y in (0, 1):
                    seen = sum(a == x and b == y for a, b in zip(labels, labels[1:]))
                    gradient = seen - sum(s[x][y] for s in steps)
                    made.pairs[x][y] = step((x, y), gradient, made.pairs[x][y])
    return made


class Grammar:
    """Writes pages with a label for each block: main text is between marks."""

    def __init__(self, seed: int):
        self.chance = random.Random(seed)

    def words(self, least: int, most: int) -> str:
        letters = ["".join(self.chance.choices("abcdefghilmnoprstuvz", k=self.chance.randint(2, 9)))
                   for _ in range(self.chance.randint(least, most))]
        return " ".join(letters).capitalize()

    def sentence(self) -> str:
        end = self.chance.choices([".", "!", "?", ""], [8, 1, 1, 1])[0]
        return self.words(*self.chance.choice([(1, 3), (4, 12), (10, 60)])) + end

    def pick(self, *some: str) -> str:
        return self.chance.choice(some)

    def name(self, group: str) -> str:
        return self.chance.choice(HINTS[group].split())

    def links(self) -> str:
        item = lambda: f'<li><a href="/{self.words(1, 1)}">{self.words(1, 4)}</a></li>'
        return "<ul>" + "".join(item() for _ in range(self.chance.randint(2, 6))) + "</ul>"

    def frame(self, kind: str) -> str:
        """Something that is not main text."""
        tag = self.pick("div", "section", "div")
        attr = f'{self.pick("class", "id")}="{self.name(kind)}"' if kind in HINTS else ""
        some = "".join(f"<p>{self.sentence()}</p>" for _ in range(self.chance.randint(1, 3)))
        if kind == "menu":
            return self.pick(f"<nav>{self.links()}</nav>", f"<{tag} {attr}>{self.links()}</{tag}>")
        if kind == "head":
            inner = self.pick(f"<h1>{self.words(1, 4)}</h1>", f"<p>{self.sentence()}</p>", self.links())
            return self.pick(f"<header>{inner}</header>", f"<{tag} {attr}>{inner}</{tag}>")
        if kind == "foot":
            inner = self.pick("&copy; ", "") + self.sentence()
            inner = self.pick(inner, f"<p>{inner}</p>", inner + self.links())
            return self.pick(f"<footer>{inner}</footer>", f"<{tag} {attr}>{inner}</{tag}>")
        if kind == "side":
            inner = self.pick(some, f"<h3>{self.words(1, 4)}</h3>{self.links()}", self.sentence())
            return self.pick(f"<aside>{inner}</aside>", f"<{tag} {attr}>{inner}</{tag}>")
        if kind == "form":
            inner = f"<label>{self.words(1, 3)}</label><input><button>{self.words(1, 2)}</button>"
            inner += self.pick("", some, f"<select><option>{self.words(1, 1)}<option>{self.words(1, 1)}</select>")
            return f"<form {self.pick('', attr)}>{inner}</form>"
        if kind == "comment":
            one = lambda: self.pick(f"<li><b>{self.words(1, 2)}</b> <p>{self.sentence()}</p></li>", f"<p>{self.sentence()}</p>")
            inner = self.pick("", f"<h3>{self.words(1, 2)}</h3>") + "".join(one() for _ in range(self.chance.randint(1, 5)))
            return f"<{tag} {attr}>{self.pick(inner, f'<ol>{inner}</ol>')}</{tag}>"
        inner = self.pick(self.sentence(), some, f'<a href="#">{self.sentence()}</a>')
        return f"<{tag} {attr}>{inner}</{tag}>"

    def paragraph(self) -> str:
        text = self.sentence()
        if self.chance.random() < 0.2:
            text += f' <a href="/x">{self.words(1, 3)}</a> {self.words(2, 9)}.'
        kinds = [f"<p>{text}</p>", f"<p>{text}", f"<p><b>{text}<br>", f"<h2>{self.words(1, 7)}</h2>",
                 f"<ul><li>{text}</li><li>{self.sentence()}</li></ul>", f"<blockquote>{text}</blockquote>",
                 f"<div>{text}</div>", f"<pre>{text}</pre>", f"<table><tr><td>{self.words(1, 2)}</td><td>{text}</td></tr></table>"]
        return self.chance.choices(kinds, [12, 4, 2, 2, 1, 1, 1, 0.5, 0.5])[0]

    def page(self) -> tuple[str, list[int]]:
        """Html and the labels of its blocks."""
        mark, rate = "␞", self.chance.choice([0.0, 0.15])
        body = [f"<h1>{self.words(2, 9)}</h1>"] if self.chance.random() < 0.8 else []
        body += [self.paragraph() for _ in range(self.chance.choice([1, 3, 8, 20]))]
        main = "".join(_marked(part, mark) + (self.frame(self.pick("ad", "share", "form", "side")) if self.chance.random() < rate else "") for part in body)
        if self.chance.random() < 0.2:
            main += self.frame(self.pick("comment", "comment", "share", "side"))
        wrap = self.chance.choices(
            ["article", "main", f'div class="{self.name("main")}"', f'div id="{self.name("main")}"', "section", ""],
            [8, 3, 3, 2, 1, 1],
        )[0]
        close = f"</{wrap.split()[0]}>" if wrap and self.chance.random() < 0.8 else ""
        main = (f"<{wrap}>" if wrap else "") + main + close
        before = [k for k in ("menu", "head", "notice", "ad", "form", "menu") if self.chance.random() < 0.45]
        after = [k for k in ("side", "comment", "form", "ad", "notice", "foot", "foot") if self.chance.random() < 0.45]
        whole = "".join(map(self.frame, before)) + main + "".join(map(self.frame, after))
        html = f"<html><head><title>{self.words(2, 6)}</title></head><body>{whole}{self.pick('</body></html>', '')}"
        blocks = read_page(html, HINT_OF).blocks
        labels = [int(mark in block.text) for block in blocks]
        for block in blocks:
            block.text = " ".join(block.text.replace(mark, " ").split()) or "."
        return blocks, labels


def _marked(part: str, mark: str) -> str:
    """Puts the mark at the end of every run of text of the part."""
    out, inside = [], False
    for piece in part.replace("<", "\0<").replace(">", ">\0").split("\0"):
        inside = piece.startswith("<")
        out.append(piece if inside or not piece.strip() else f"{piece}{mark}")
    return "".join(out)


@lru_cache(maxsize=2)
def trained_field(pages: int = TRAINING_PAGES, seed: int = 11) -> Field:
    grammar = Grammar(seed)
    labelled = [grammar.page() for _ in range(pages)]
    return train([(features(blocks), labels) for blocks, labels in labelled])


def main_text(html: str | None, crf: Field) -> str:
    blocks = read_page(html, HINT_OF).blocks
    labels = crf.decode(features(blocks)) if blocks else []
    return "\n".join(block.text for block, label in zip(blocks, labels) if label == MAIN)


def _extract(crf: Field) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), crf) for html in batch.column("html")]
            made = [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
            columns = [batch.column("page_id"), batch.column("url"), *made]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    return extract


def extract_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` for every page."""
    rows = named(pages, page_id=page_id, url=url, html=html)
    kind = rows.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, url string, text string, n_chars long"
    return rows.mapInArrow(_extract(trained_field()), schema)
