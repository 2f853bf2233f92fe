"""Main text of HTML pages: a linear-chain conditional random field labels the DOM's leaf blocks, Viterbi decodes.

A leaf block is text between block-level tags; its features are the tags, classes and ids of its ancestors and simple
properties of its text (length, share of text in links, punctuation, share of capitals, digits). The field has two labels,
article and other. Its weights are trained here, by gradient ascent on the likelihood of labelled
pages: ``labelled_pages`` writes them from templates (layouts, class names and block kinds drawn with a
fixed seed), so a label is known for each block. Training is bounded by ``TRAIN_PAGES`` pages and happens once on the driver;
the weights, a few thousand numbers, travel with the tasks. Pages are then independent rows without any shuffle.

Text rules: scripts, styles, comments, controls, hidden parts, descriptions in drawings, annotations of formulas and the head are no
blocks; a form is an ancestor like others. The head ends at the first tag or text that can't stand in it, a list of options at the
next block. Character references are decoded;
white space inside a block becomes one space; blocks keep page order and are joined by a newline.
Null and empty pages and pages without article blocks give the empty text. Nothing is cut: very long pages
are handled whole. Repeated rows give the same text. Output columns replace input columns of the same name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TRAIN_PAGES = 400
EPOCHS = 30
BUCKETS = 1 << 12

# The roles of HTML elements.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SKIPPED_TAGS = frozenset("script style noscript template head title button select option textarea iframe canvas datalist input".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
SKIPPED_INSIDE = {"desc": "svg", "metadata": "svg", "annotation": "math", "annotation-xml": "math"}
CHOICES = frozenset("select datalist option optgroup".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK_TAGS - {"body", "html"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("article aside body div footer header main nav section table ul ol dl td th blockquote form figure".split())
SPACE = re.compile(r"\s+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
NAME = re.compile(r"[A-Za-z]+")


class Blocks(HTMLParser):
    """Leaf blocks of a page as (path of (tag, names), text, characters in links)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...], bool]] = []
        self.skipping = 0
        self.links = 0
        self.parts: list[str] = []
        self.link_chars = 0
        self.found: list[tuple[list[tuple[str, tuple[str, ...]]], str, int]] = []

    def flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            path = [(tag, names) for tag, names, _ in self.stack if tag in BLOCK_TAGS]
            self.found.append((path, text, min(self.link_chars, len(text))))
        self.parts, self.link_chars = [], 0

    def pop(self) -> None:
        tag, _, skipped = self.stack.pop()
        self.skipping -= skipped
        self.links -= tag == "a"

    def close_to(self, tags, scopes=SCOPES) -> None:
        """Ends the innermost open element of these tags, if no scope lies between."""
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in tags:
                while len(self.stack) > i:
                    self.pop()
                return
            if self.stack[i][0] in scopes:
                return

    def end_head(self) -> None:
        while any(t == "head" for t, _, _ in self.stack):
            self.pop()

    def handle_starttag(self, tag, attrs):
        if tag == "head" and any(t != "html" for t, _, _ in self.stack):
            return
        if tag == "body" or (tag not in HEAD_TAGS and self.stack and self.stack[-1][0] == "head"):
            self.end_head()
        if tag in BLOCK_TAGS:
            self.flush()
            if tag != "hr":
                while any(t in ("select", "datalist") for t, _, _ in self.stack) and self.stack[-1][0] in CHOICES:
                    self.pop()
        if tag in CLOSES_P:
            self.close_to({"p"})
        if tag in SIBLINGS:
            self.close_to(SIBLINGS[tag], SCOPES - {tag} - SIBLINGS[tag])
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID_TAGS:
            return
        given = {k: v or "" for k, v in attrs}
        names = tuple(x.lower() for k in ("class", "id", "role") for x in NAME.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", given.get(k, ""))))
        skipped = tag in SKIPPED_TAGS or any(t == SKIPPED_INSIDE.get(tag) for t, _, _ in self.stack) or "hidden" in given or given.get("aria-hidden") == "true" or bool(HIDDEN.search(given.get("style", "")))
        self.stack.append((tag, names, skipped))
        self.skipping += skipped
        self.links += tag == "a"

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS:
            self.flush()
        if any(t == tag for t, _, _ in self.stack):
            barrier = frozenset() if tag in BLOCK_TAGS else SCOPES
            self.close_to({tag}, barrier - {tag})

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self.end_head()
        if not self.skipping:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)


def blocks_of(html: str) -> list:
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.found


def _slot(text: str) -> int:
    h = 2166136261
    for b in text.encode():
        h = ((h ^ b) * 16777619) & 0xFFFFFFFF
    return h % BUCKETS


@lru_cache(maxsize=100_000)
def _path_slots(path: tuple) -> tuple[int, ...]:
    tags = [t for t, _ in path]
    said = {f"tag={t}" for t in tags} | {f"name={n}" for _, names in path for n in names}
    said |= {f"leaf={tags[-1]}" if tags else "leaf=", f"depth={min(len(tags), 8)}"}
    said |= {f"pair={a}>{b}" for a, b in zip(tags, tags[1:], strict=False)}
    return tuple(sorted({_slot(x) for x in said}))


def features(block) -> tuple[int, ...]:
    path, text, linked = block
    n = len(text)
    words = text.count(" ") + 1
    said = [
        "bias", f"words={min(words.bit_length(), 8)}", f"link={round(4 * linked / n)}", f"end={text[-1] if text[-1] in '.!?:;…»”' else ''}",
        f"stops={min(sum(text.count(c) for c in '.,;!?'), 6)}", f"mark={any(c in text for c in '©®|»›')}",
    ]
    return (*_path_slots(tuple(path)), *(_slot(x) for x in said))


def scores(blocks: list, emission: np.ndarray) -> np.ndarray:
    return np.array([emission[:, list(features(b))].sum(axis=1) for b in blocks])


def viterbi(unary: np.ndarray, transition: np.ndarray) -> list[int]:
    best, back = unary[0], []
    for row in unary[1:]:
        paths = best[:, None] + transition
        back.append(paths.argmax(axis=0))
        best = paths.max(axis=0) + row
    label = [int(best.argmax())]
    for step in reversed(back):
        label.append(int(step[label[-1]]))
    return label[::-1]


def train(pages: list[tuple[str, list[int]]], epochs: int = EPOCHS, rate: float = 0.15, decay: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Emission (label, feature) and transition weights that maximise the likelihood, by AdaGrad over the pages."""
    emission, transition = np.zeros((2, BUCKETS)), np.zeros((2, 2))
    seen_e, seen_t = np.full_like(emission, 1e-6), np.full_like(transition, 1e-6)
    data = []
    for html, labels in pages:
        found = blocks_of(html)
        if len(found) != len(labels):
            raise ValueError("a labelled page must have one label for each of its blocks")
        data.append(([np.array(features(b)) for b in found], np.array(labels)))
    rng = np.random.default_rng(0)
    for _ in range(epochs):
        for p in rng.permutation(len(data)):
            feats, labels = data[p]
            unary = np.array([emission[:, f].sum(axis=1) for f in feats])
            n = len(unary)
            alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
            alpha[0] = unary[0]
            for i in range(1, n):
                alpha[i] = unary[i] + np.logaddexp.reduce(alpha[i - 1][:, None] + transition, axis=0)
            for i in range(n - 2, -1, -1):
                beta[i] = np.logaddexp.reduce(transition + (unary[i + 1] + beta[i + 1])[None, :], axis=1)
            total = np.logaddexp.reduce(alpha[-1])
            error = -np.exp(alpha + beta - total)
            error[np.arange(n), labels] += 1
            grad_t = np.zeros((2, 2))
            for i in range(1, n):
                grad_t -= np.exp(alpha[i - 1][:, None] + transition + (unary[i] + beta[i])[None, :] - total)
                grad_t[labels[i - 1], labels[i]] += 1
            grad_e = np.zeros_like(emission)
            for f, g in zip(feats, error, strict=True):
                np.add.at(grad_e, (slice(None), f), g[:, None])
            used = np.unique(np.concatenate(feats))
            grad = grad_e[:, used] - decay * emission[:, used]
            seen_e[:, used] += grad**2
            emission[:, used] += rate * grad / np.sqrt(seen_e[:, used])
            seen_t += grad_t**2
            transition += rate * grad_t / np.sqrt(seen_t)
    return emission, transition


def labelled_pages(count: int = TRAIN_PAGES, seed: int = 1) -> list[tuple[str, list[int]]]:
    """Pages written from templates with a label (1: article) for each leaf block."""
    rng, wide = np.random.default_rng(seed), np.random.default_rng([seed, 1])
    pick = lambda *xs: xs[rng.integers(len(xs))]
    syllables = "an ber co den el fi gar ho in jo kel lo mi nor os pa qui ra sen tu ur ver wi ya zo th st er on re".split()
    word = lambda: "".join(pick(*syllables) for _ in range(rng.integers(1, 4)))
    chance = lambda p: rng.random() < p

    def words(lo, hi):
        return " ".join(word() for _ in range(rng.integers(lo, hi + 1)))

    def prose(lo=1, hi=7):
        style = rng.integers(12)
        out = []
        for _ in range(rng.integers(lo, hi + 1)):
            s = words(1, 18).capitalize()
            out.append(s + ("." if style != 0 else ""))
        text = " ".join(out)
        if style == 1:
            text = text.upper()
        if style == 2:
            text = " ".join(w + pick("%%%", "###", "***", "$$$", "&amp;&amp;&amp;") for w in text.split())
        if style == 3:
            text = " | ".join(text.split())
        if style == 4:
            text = " ".join([word()] * int(rng.integers(3, 40)))
        return text

    def attr(*names):
        return pick("", f' class="{pick(*names)}"', f' id="{pick(*names)}"', f' class="{pick(*names)} {word()}"')

    def named(*names):
        return pick(f' class="{pick(*names)}"', f' id="{pick(*names)}"', f' class="{word()} {pick(*names)}"')

    def links(n, tag="li"):
        return "".join(f'<{tag}><a href="/{word()}">{words(1, 2)}</a></{tag}>' for _ in range(n)), [0] * n

    def menu():
        html, labels = links(int(rng.integers(2, 9)))
        if chance(0.7):
            return f"<nav{attr('menu', 'navbar', 'main-nav')}><ul>{html}</ul></nav>", labels
        return f"<div{named('menu', 'nav', 'navigation', 'breadcrumb', 'topbar')}><ul>{html}</ul></div>", labels

    def boiler(names, tag="div", lo=1, hi=3, kinds=("p", "span", "")):
        n = int(rng.integers(lo, hi + 1))
        if kinds == ("",) or chance(0.35):
            return f"<{tag}{names}>{prose(1, 2)}</{tag}>", [0]
        inner = "".join(f"<p>{prose(1, 3)}</p>" for _ in range(n))
        return f"<{tag}{names}>{inner}</{tag}>", [0] * n

    def advert():
        return boiler(named("ad", "ads", "advert", "advertisement", "banner", "sponsored", "promo", "sponsor"), pick("div", "aside", "section"))

    def notice():
        return boiler(named("cookie", "notice", "consent", "newsletter", "subscribe", "popup", "alert", "gdpr", "modal", "cookie-banner", "signup"), pick("div", "section", "aside"))

    def sidebar():
        html, labels = links(int(rng.integers(2, 6)))
        names = named("sidebar", "related", "widget", "recommended", "trending", "popular", "more", "aside")
        tag = pick("aside", "aside", "div", "section")
        if chance(0.5):
            return f"<{tag}{names if tag != 'aside' or chance(0.4) else ''}><h3>{words(1, 3)}</h3><ul>{html}</ul></{tag}>", [0, *labels]
        return boiler(names if tag != "aside" or chance(0.4) else "", tag)

    def share():
        html, labels = links(int(rng.integers(2, 5)), pick("span", "li"))
        if "<span>" in html:
            labels = [0]
        return f"<div{named('share', 'social', 'tags', 'meta', 'byline', 'author', 'toolbar')}>{html}</div>", labels

    def comments():
        n = int(rng.integers(1, 5))
        shape = pick("li", "div", "article", "p")
        names = named("comments", "comment-list", "discussion", "replies", "responses", "reader-comments", "disqus")
        one = {"li": "<li><p>{}</p></li>", "div": '<div class="comment"><p>{}</p></div>', "article": '<article class="comment"><p>{}</p></article>', "p": "<p>{}</p>"}[shape]
        inner = "".join(one.format(prose(1, 3)) for _ in range(n))
        head, labels = (f"<h2>{words(1, 2)}</h2>", [0]) if chance(0.6) else ("", [])
        inner = f"<ol>{inner}</ol>" if shape == "li" else inner
        return f"<{(t := pick('section', 'div', 'aside'))}{names}>{head}{inner}</{t}>", [*labels, *[0] * n]

    def form():
        return f'<form action="/{word()}"><label>{words(1, 2)}</label><input name="q"><button>{word()}</button></form>', [0]

    def hidden():
        return pick(f"<script>var t='<p>{words(2, 5)}</p>';</script>", f"<style>.{word()}{{margin:0}}</style>", f"<!-- {words(1, 3)} -->", f"<noscript>{words(2, 5)}</noscript>"), []

    def body_blocks():
        out, labels = [], []
        for _ in range(int(rng.integers(0, 9))):
            kind = rng.integers(14)
            if kind < 7:
                out.append(f"<p>{prose()}" + pick("</p>", "</p>", "</p>\n", ""))
                labels.append(1)
                if out[-1][-1] not in ">\n":
                    out[-1] += "</p>" if chance(0.5) else ""
            elif kind == 7:
                out.append(f"<p><b>{prose(1, 2)}<br>" + pick("", "</b></p>"))
                labels.append(1)
                out.append(f"<p>{prose()}</p>")
                labels.append(1)
            elif kind == 8:
                out.append(f"<{(h := pick('h2', 'h3', 'h4'))}>{words(1, 6)}</{h}>")
                labels.append(1)
            elif kind == 9:
                n = int(rng.integers(2, 5))
                tag = pick("ul", "ol")
                out.append(f"<{tag}>" + "".join(f"<li>{prose(1, 2)}</li>" for _ in range(n)) + f"</{tag}>")
                labels += [1] * n
            elif kind == 10:
                out.append(f"<blockquote>{prose(1, 3)}</blockquote>")
                labels.append(1)
            elif kind == 11:
                out.append(f'<p>{prose(1, 3)} <a href="/{word()}">{words(1, 3)}</a> {prose(1, 2)}</p>')
                labels.append(1)
            elif kind == 12:
                out.append("<table><tr>" + "".join(f"<td>{words(1, 4)}</td>" for _ in range(3)) + "</tr></table>")
                labels += [1] * 3
            elif chance(0.6):
                html, extra = pick(advert, sidebar, share, form, hidden, notice)()
                out.append(html)
                labels += extra
        return out, labels

    pages = []
    for _ in range(count):
        parts, labels = [], []

        def add(part):
            parts.append(part[0])
            labels.extend(part[1])

        if chance(0.5):
            html, found = menu()
            logo = f"<div{attr('logo', 'brand')}>{words(1, 3)}</div>" if chance(0.7) else ""
            parts.append(f"<header{attr('site-header', 'masthead')}>{logo}{html}</header>" if chance(0.6) else f"<div{named('header', 'masthead', 'top')}>{logo}{html}</div>")
            labels += [*([0] if logo else []), *found]
        elif chance(0.9):
            add(menu())
        for maker, p in ((advert, 0.5), (notice, 0.3), (hidden, 0.4), (sidebar, 0.2), (form, 0.15)):
            if chance(p):
                add(maker())
        title = prose(1, 2)
        inner, own = body_blocks()
        head = f"<h1>{title}</h1>" if chance(0.9) else ""
        head = f"<header>{head}</header>" if head and chance(0.12) else head
        own = [*([1] if head else []), *own]
        if chance(0.15):
            html, extra = share()
            inner, own = [*inner, html], [*own, *extra]
        if chance(0.2):
            html, extra = comments()
            inner, own = [*inner, html], [*own, *extra]
        open_, close = pick(("<article>", "</article>"), ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"),
                            (f"<div{named('content', 'article', 'post', 'entry', 'story', 'article-body', 'post-content', 'main')}>", "</div>"),
                            (f"<article{named('post', 'entry', 'story')}>", "</article>"), (f"<section{named('content', 'article', 'post')}>", "</section>"))
        parts.append(f"{open_}{head}{''.join(inner)}{close}")
        labels += own
        for maker, p in ((comments, 0.35), (sidebar, 0.4), (advert, 0.25), (notice, 0.2), (share, 0.15), (form, 0.1)):
            if chance(p):
                add(maker())
        if chance(0.85):
            text = pick(f"&copy; {words(1, 3)} &middot; {prose(1, 1)}", prose(1, 2), f"&copy; {rng.integers(1999, 2030)} {words(1, 3)}")
            tag, names = pick(("footer", ""), ("footer", attr("site-footer", "bottom")), ("div", named("footer", "site-footer", "copyright", "legal")))
            parts.append(f"<{tag}{names}>{text}</{tag}>")
            labels.append(0)
        inside = "".join(parts)
        if wide.random() < 0.2:  # a form as wide as the page
            inside = f'<form method="post" action="/{title[:3].strip()}">{inside}</form>'
        pages.append((f"<!DOCTYPE html><html><head><title>{title}</title></head><body>{inside}" + pick("</body></html>", ""), labels))
    return [(h, x) for h, x in pages if len(blocks_of(h)) == len(x) and x]


@lru_cache(maxsize=1)
def trained() -> tuple[np.ndarray, np.ndarray]:
    return train(labelled_pages())


def main_text(html: str | None, emission: np.ndarray, transition: np.ndarray) -> str:
    found = blocks_of(html) if html else []
    if not found:
        return ""
    labels = viterbi(scores(found, emission), transition)
    return "\n".join(text for (_, text, _), label in zip(found, labels, strict=True) if label)


def extract(pages: DataFrame, html: str = "html", model: tuple[np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """pages without the html column, with ``text`` (string) and ``n_chars`` (long, code points)."""
    emission, transition = model or trained()
    kept = [c for c in pages.columns if c.lower() not in ("text", "n_chars", html.lower())]
    fields = [pages.schema[c] for c in kept]
    schema = T.StructType([*fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[kept].copy()
            out["text"] = [main_text(h, emission, transition) for h in frame[html]]
            out["n_chars"] = out["text"].map(len).astype("int64")
            yield out

    return pages.select(*kept, html).mapInPandas(run, schema)
