"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the page.

`blocks` walks the tags once and gives the leaf blocks: runs of text between block-level tags, with
references decoded and white space made one blank.  Each block has features of its ancestors (tags,
roles, words of classes and ids; of tags that aren't HTML's the NEAREST innermost elements) and of its text (length, share of linked characters, sentence
marks, place in the page).  The field is trained on labelled pages and decoded by Viterbi; the
blocks it labels as main text are joined by line breaks.

Scripts, styles, comments in the markup, page heads and the controls of forms hold no text, and
elements with the attribute hidden, aria-hidden="true" or style="display:none" hold none that is shown.
Defined results: a null or empty page has an empty text; pages of any length are walked whole, in time
linear in their length; broken markup never fails (stray ends are ignored, open tags end with the
page, and a start of RAW without its end takes no text with it, but for TO_END); a page without main text is empty; rows are independent, so repeated rows and ties need no
rule; other columns are kept as they are.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from html import unescape
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxodds.llm import labelled_pages

#: A tag, a comment, or another declaration.  Quoted values may hold ">", but no "<".
_TAG = re.compile(r"""<!--|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>"'<]++|"[^"<]*+"|'[^'<]*+'|["'])*+)>?|<[!?/][^>]*+>""")
#: An attribute with its value, which an open quote carries to the end, so that no value is read as a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]++)(?:\s*+=\s*+(?:"([^"]*+)"?|'([^']*+)'?|([^\s>]++)))?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\s*(?:!|;|$)", re.IGNORECASE)
_WORD = re.compile("[a-z]+")
_SENTENCE_END = re.compile(r"[.!?…:;][\"'”»)]*$")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark object q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr "
                   "annotation annotation-xml math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
                   "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover "
                   "none semantics noscript template iframe svg select button canvas".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
TO_END = frozenset("script style textarea title".split())       # unclosed, they hold the rest of the page
CLOSED = frozenset("noscript template iframe svg select button canvas".split())     # unclosed, they are open inline elements
RAW = TO_END | CLOSED
#: A start of the first ends an open one of the second, up to the nearest of the third.
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dd dt", ("dl",)), "dd": ("dd dt", ("dl",)), "tr": ("tr", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}
NEAREST = 64        # open elements that are looked at for tags not in TAGS, from the innermost
TAGS = frozenset("address article aside blockquote caption center col colgroup dd details dialog dir dl dt fieldset figcaption figure "
                 "footer form frame frameset h1 h2 h3 h4 h5 h6 head header hgroup label legend li main map menu nav noframes ol "
                 "optgroup option output p picture pre search section summary table tbody td tfoot th thead tr ul video audio".split())
#: Words in classes, ids and roles, by what they tell.
HINTS = {
    "ad": "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion promoted banner",
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager toc tabs topbar toolbar",
    "side": "sidebar aside side widget widgets complementary rail",
    "comment": "comment comments commentlist respond responses reply replies disqus discussion feedback",
    "foot": "footer foot bottom copyright contentinfo colophon legal",
    "head": "header top logo masthead branding site",
    "notice": "cookie cookies consent notice notification alert popup modal overlay warning message gdpr dialog",
    "form": "form subscribe newsletter signup login search register",
    "share": "share social sharing follow tags meta byline author date related recommended popular more links",
    "main": "article content post entry main story body text page",
}
_HINT = {w: k for k, words in HINTS.items() for w in words.split()}


class Open(NamedTuple):
    """What the open elements of a block tell."""
    tags: frozenset[str]
    hints: frozenset[str]
    own: str                        # the innermost block-level tag
    near: tuple[str, ...]           # the hints of the innermost element that has any


class Block(NamedTuple):
    text: str
    features: tuple[str, ...]


@cache
def _hints(attributes: str) -> tuple[str, ...]:
    """What classes, ids and roles tell, and "hidden" for an element that isn't shown."""
    found, hidden = set(), False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            found |= {_HINT[w] for w in _WORD.findall(value.lower()) if w in _HINT}
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            hidden = True
        elif name == "style" and _NOT_SHOWN.search(value):
            hidden = True
    return (*sorted(found), "hidden") if hidden else tuple(sorted(found))


def _raw_end(html: str, tag: str, at: int) -> int | None:
    """Where the content of a raw element that starts at `at` is over.  Those of TO_END last to the end of
    the page if they have no end tag; others have none, too, if one of their name starts before it."""
    start = "" if tag in TO_END else "?"
    m = re.compile(f"</{start}{tag}(?![a-zA-Z0-9:-])[^>]*>?", re.IGNORECASE).search(html, at)
    if tag in TO_END:
        return m.end() if m else len(html)
    return m.end() if m and html[m.start() + 1] == "/" else None


def leaves(html: str) -> list[tuple[str, int, Open]]:
    """(text, linked characters, open elements) of each leaf block, in page order."""
    out: list[tuple[str, int, Open]] = []
    places: dict[str, list[int]] = {}       # of the open elements of each tag; none is empty
    told: dict[str, int] = {}               # how many open elements have a hint; none is 0
    solid: list[int] = []                   # places of the block-level ones
    hinted: list[int] = []                  # and of those with hints
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, links, hidden, at = 0, 0, 0, 0
    never = set()                 # holds "-->" if no comment ends in the rest of the page

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                tags = (places.keys() & TAGS) | {t for t, _ in stack[-NEAREST:]}
                tags = frozenset(t for t in tags if t not in ("html", "body", "p", "div") and t not in INLINE)
                out.append((text, min(linked, len(text)),
                            Open(tags, frozenset(told), stack[solid[-1]][0] if solid else "none", stack[hinted[-1]][1] if hinted else ())))
            parts.clear()
        linked = 0

    def pop(depth: int) -> None:
        nonlocal links, hidden
        for name, hints in stack[depth:]:
            links -= name == "a"
            hidden -= "hidden" in hints
            places[name].pop()
            if not places[name]:
                del places[name]
            for h in hints:
                told[h] -= 1
                if not told[h]:
                    del told[h]
        del stack[depth:]
        for at_ in (solid, hinted):
            while at_ and at_[-1] >= depth:
                at_.pop()

    end = len(html)
    while at < end:
        m = _TAG.search(html, at)
        stop = m.start() if m else end
        if stop > at and not hidden:
            parts.append(html[at:stop])
            if links:
                linked += len(html[at:stop].strip())
        if not m:
            break
        at = m.end()
        if m.group(0) == "<!--":
            if "-->" in never or (closed := html.find("-->", at)) < 0:
                never.add("-->")      # unclosed: the mark itself goes, the rest is text
            else:
                at = closed + 3
            continue
        if not m.group(2):
            continue
        tag, attributes = m.group(2).lower(), m.group(3)
        if tag == "br":
            parts.append(" ")
            continue
        if tag in RAW and not m.group(1):
            if attributes.endswith("/"):
                continue
            over = _raw_end(html, tag, at)
            if over is not None:
                at = over
                continue
        if tag not in INLINE and tag not in VOID or tag == "hr":
            flush()
        if m.group(1):
            k = places[tag][-1] if tag in places else -1
            if k >= 0 and (tag not in INLINE or k > len(stack) - 200):      # a late end of an inline element closes no far blocks
                pop(k)
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            ends, within = CLOSES.get(tag, ("p", ()))
            k = max((places[t][-1] for t in ends.split() if t in places), default=-1)
            stop = solid[-1] if solid and ends == "p" else max((places[t][-1] for t in within if t in places), default=-1)
            if k >= 0 and k >= stop:
                pop(k)
        hints = _hints(attributes) if attributes and not attributes.isspace() else ()
        hidden += "hidden" in hints
        links += tag == "a"
        if not attributes.endswith("/"):
            places.setdefault(tag, []).append(len(stack))
            for h in hints:
                told[h] = told.get(h, 0) + 1
            if tag not in INLINE:
                solid.append(len(stack))
            if hints:
                hinted.append(len(stack))
            stack.append((tag, hints))
        else:
            links -= tag == "a"
            hidden -= "hidden" in hints
    flush()
    return out


def _described(text: str, linked: int, open_: Open, place: int, n: int) -> tuple[str, ...]:
    tags, hints, own, near = open_
    words = text.count(" ") + 1
    size = "1" if words == 1 else "2-4" if words < 5 else "5-11" if words < 12 else "12-29" if words < 30 else "30+"
    share = linked / len(text)
    link = "none" if not linked else "some" if share < 0.3 else "half" if share < 0.8 else "all"
    closed = bool(_SENTENCE_END.search(text))
    features = {f"in {t}" for t in tags} | {f"hint {h}" for h in hints} | {f"near {h}" for h in near}
    features |= {"bias", f"own {own}", f"words {size}", f"link {link}", f"closed {closed}", f"words {size} closed {closed}",
                 f"own {own} words {size}"}
    if "©" in text or "(c)" in text.lower():
        features.add("copyright")
    if place == 0 or place == n - 1:
        features.add("first" if place == 0 else "last")
    if not hints:
        features.add("no hint")
    if not tags:
        features.add("no tag")
    return tuple(sorted(features))


def blocks(html: str | None) -> list[Block]:
    found = leaves(html or "")
    return [Block(text, _described(text, linked, open_, k, len(found))) for k, (text, linked, open_) in enumerate(found)]


# ---- the field: labels 0 (other) and 1 (main) ------------------------------------------------------

class Field(NamedTuple):
    weights: dict[str, float]                 # of label 1 against label 0
    turn: tuple[float, float, float, float]   # from 0 to 0, 0 to 1, 1 to 0, 1 to 1


def training_blocks(html: str) -> list[tuple[Block, int]]:
    out = []
    for text, linked, open_ in (found := leaves(html)):
        mark = labelled_pages.MAIN if labelled_pages.MAIN in text else labelled_pages.OTHER
        bare = " ".join(text.replace(mark, "").split())
        out.append((Block(bare, _described(bare, min(linked, len(bare)), open_, len(out), len(found))),
                    int(mark == labelled_pages.MAIN)))
    return out


def train(pages: list[str], steps: int = 400, penalty: float = 0.5) -> Field:
    """Maximum likelihood with a squared penalty, by gradient steps over all pages at once."""
    known = [training_blocks(p) for p in pages]
    names = sorted({f for page in known for b, _ in page for f in b.features})
    number = {f: k for k, f in enumerate(names)}
    width = max(map(len, known))
    x = np.zeros((len(known), width, len(names)), np.float32)
    y = np.zeros((len(known), width), int)
    here = np.zeros((len(known), width), bool)
    for i, page in enumerate(known):
        for k, (b, label) in enumerate(page):
            x[i, k, [number[f] for f in b.features]] = 1
            y[i, k], here[i, k] = label, True
    both = here[:, 1:] & here[:, :-1]
    w, t = np.zeros(len(names)), np.zeros((2, 2))
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
    moment, square = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for step in range(1, steps + 1):
        e = np.zeros((*y.shape, 2))
        e[..., 1] = x @ w
        a = np.zeros_like(e)
        b = np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for k in range(1, width):
            a[:, k] = np.where(here[:, k, None], e[:, k] + np.logaddexp.reduce(a[:, k - 1, :, None] + t, 1), a[:, k - 1])
        for k in range(width - 2, -1, -1):
            b[:, k] = np.where(here[:, k + 1, None], np.logaddexp.reduce(t + (e[:, k + 1] + b[:, k + 1])[:, None, :], 2), 0)
        z = np.logaddexp.reduce(a[:, -1], 1)
        p = np.exp(a + b - z[:, None, None])[..., 1]
        pair = np.exp(a[:, :-1, :, None] + t + (e + b)[:, 1:, None, :] - z[:, None, None, None])
        gw = np.tensordot(np.where(here, y - p, 0), x, ((0, 1), (0, 1))) - penalty * w
        gt = seen - pair[both].sum(0) - penalty * t
        g = np.concatenate([gw, gt.ravel()])
        moment, square = 0.9 * moment + 0.1 * g, 0.99 * square + 0.01 * g * g
        move = 0.05 * (moment / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
        w, t = w + move[:-4], t + move[-4:].reshape(2, 2)
    return Field({f: round(float(v), 4) for f, v in zip(names, w, strict=True)}, tuple(round(float(v), 4) for v in t.ravel()))


def decode(field: Field, found: list[Block]) -> list[bool]:
    """The likeliest labels of a page's blocks (Viterbi)."""
    get, (t00, t01, t10, t11) = field.weights.get, field.turn
    back, other, main = [], 0.0, 0.0
    for k, b in enumerate(found):
        e = sum(get(f, 0.0) for f in b.features)
        if k:
            from_other = other + t00 >= main + t10, other + t01 >= main + t11
            other, main = (other + t00 if from_other[0] else main + t10), (other + t01 if from_other[1] else main + t11)
            back.append(from_other)
        main += e
    label = main > other
    labels = [label]
    for from_other in reversed(back):
        label = not from_other[label]
        labels.append(label)
    return labels[::-1] if found else []


@cache
def default_field() -> Field:
    return train(labelled_pages.pages())


def main_text(field: Field, html: str | None) -> str:
    found = blocks(html)
    return "\n".join(b.text for b, keep in zip(found, decode(field, found), strict=True) if keep)


def extracted(html: Column, field: Field | None = None) -> Column:
    field = field or default_field()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(field, p) for p in pages], dtype=object)

    return run(html)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """`pages` with `text`, which replaces any column of that name."""
    return pages.withColumn("text", extracted(F.col("html"), field))
