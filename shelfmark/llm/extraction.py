"""Main text of HTML pages by a linear-chain conditional random field over the DOM's leaf blocks.

A page is cut into leaf blocks, the runs of text between block tags. Each has binary features: tags, classes and ids
of its ancestors, and properties of its text. The field gives each sequence of labels (main text or not) a score
from the features and from the labels' neighbours; it is trained on labelled pages by maximum likelihood, with
the forward-backward recursion, and decoded by Viterbi's.

It is trained on pages of two kinds. A bounded sample of the pages at hand is labelled by a rule, see main_by_tags():
what an article element holds is main text, but for what stands inside in elements that say otherwise. In half of
them the article's own tag is hidden, so that the field learns the rest of the page too. Pages of a generator, with
words that carry no meaning, show layouts that the sample lacks.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Pages that the field is trained on, by default.
TRAINING_PAGES = 600
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Start tags that end an open element of these names, up to the nearest of the second ones.
CLOSES = {
    "p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol pre section table ul".split(), ("p",)),
}
SCOPES = frozenset("ul ol dl table div article section aside nav main body td th form blockquote".split())
#: Elements whose content is text up to their end tag, or to the end of the page; and those left out with all they hold.
RAW = frozenset("script style noscript iframe textarea noembed noframes".split())
HIDDEN = frozenset("template svg math select".split())
#: A tag by HTML's rules: values in quotes end there, others at white space or >. No match: the page ends inside it.
TAG = re.compile(r"<(/?+)([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+)|(?!\s*+=)))*+)>")
ATTRIBUTE = re.compile(r"(?<![^\s/\"'])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
TOKEN = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    features: list[str]


def _names(attributes: str) -> tuple[str, ...]:
    found = (x for m in ATTRIBUTE.finditer(attributes) for x in TOKEN.findall((m[2] or m[3] or m[4] or "").lower()))
    return tuple(dict.fromkeys(found))


class _Open:
    """The open elements, with what is asked of them at hand, so that no tag needs a walk over them."""

    def __init__(self, known: frozenset[str] | None):
        self.known = known
        self.stack: list[tuple[str, list[str]]] = []
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        #: Features of open elements, and how many have them.
        self.active: dict[str, int] = {}

    def push(self, name: str, attributes: str) -> None:
        features = [f"in={name}", *(f"named={x}" for x in _names(attributes))]
        if self.known is not None:
            features = [f for f in features if f in self.known]
        self.places.setdefault(name, []).append(len(self.stack))
        if name in SCOPES:
            self.scopes.append(len(self.stack))
        self.stack.append((name, features))
        for f in features:
            self.active[f] = self.active.get(f, 0) + 1

    def close(self, place: int) -> None:
        while len(self.stack) > place:
            name, features = self.stack.pop()
            self.places[name].pop()
            if name in SCOPES:
                self.scopes.pop()
            for f in features:
                self.active[f] -= 1
                if not self.active[f]:
                    del self.active[f]

    def end(self, name: str) -> None:
        if self.places.get(name):
            self.close(self.places[name][-1])

    def imply(self, name: str) -> None:
        """Closes what a start tag of this name ends."""
        place = max((self.places[x][-1] for x in CLOSES.get(name, ()) if self.places.get(x)), default=-1)
        if place >= 0 and place >= (self.scopes[-1] if self.scopes else -1):
            self.close(place)


def blocks(page: str, known: frozenset[str] | None = None) -> list[Block]:
    """Leaf blocks that hold text, in page order. Character references are decoded, white space is single spaces. known: features
    that count, if not all. Takes time in proportion to the page, however broken it is."""
    out: list[Block] = []
    held = _Open(known)
    parts: list[str] = []
    linked, link_from, size = 0, -1, 0

    def end() -> None:
        nonlocal linked, link_from, size
        text = " ".join("".join(parts).split())
        if link_from >= 0:
            linked, link_from = linked + size - link_from, 0
        if text:
            out.append(Block(text, _features(text, held, linked / max(1, size))))
        parts.clear()
        linked, size = 0, 0

    def say(low: int, high: int) -> None:
        nonlocal size
        if high > low:
            parts.append(html.unescape(page[low:high]))
            size += high - low

    closing: dict[str, re.Pattern | None] = {}

    def after(name: str, at: int) -> int:
        """Where the next end tag of this name is over; -1 if there is none."""
        if name not in closing:
            closing[name] = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I)
        found = closing[name] and closing[name].search(page, at)
        if not found:
            closing[name] = None  # nor is there one further on
        return page.find(">", found.end()) + 1 or len(page) if found else -1

    at = 0
    while True:
        i = page.find("<", at)
        if i < 0:
            say(at, len(page))
            break
        mark = page[i + 1 : i + 3]
        if mark[:1] in ("!", "?") or (mark[:1] == "/" and not mark[1:].isascii()) or (mark[:1] == "/" and not mark[1:].isalpha()):
            if mark == "/":  # a page that ends in </
                say(at, len(page))
                break
            say(at, i)
            stop, skip = ("-->", 4) if page.startswith("<!--", i) else (">", 2)
            j = i + 4 if page.startswith(("<!-->", "<!--->"), i) else page.find(stop, i + skip)
            if j < 0:
                break
            at = page.find(">", j) + 1
            continue
        if not (mark[:1] == "/" or (mark[:1].isalpha() and mark[:1].isascii())):
            say(at, i + 1)  # a lone <
            at = i + 1
            continue
        say(at, i)
        m = TAG.match(page, i)
        if not m:
            break  # the page ends inside a tag
        at = m.end()
        name, ends = m[2].lower(), bool(m[1])
        if not ends and name in RAW:
            at = after(name, at)
            if at < 0:
                break
            continue
        if not ends and name in HIDDEN and not m[3].endswith("/"):
            j = after(name, at)
            at = at if j < 0 else j
            continue
        if name in INLINE:
            if name == "a":
                if ends and link_from >= 0:
                    linked, link_from = linked + size - link_from, -1
                elif not ends:
                    link_from = size
            elif name in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        end()
        if ends:
            held.end(name)
            continue
        held.imply(name)
        if name not in VOID and not m[3].endswith("/"):
            held.push(name, m[3])
    end()
    if out:
        out[0].features.append("first")
        out[-1].features.append("last")
    if any(not WRAPPED.isdisjoint(b.features) for b in out):
        for b in out:
            if WRAPPED.isdisjoint(b.features):
                b.features.append(BESIDES)
    return out


#: Features of blocks in an element that is there for main text, and of all other blocks of pages that have one.
WRAPPED, BESIDES = frozenset(("in=article", "in=main")), "besides"


def _features(text: str, held: _Open, linked: float) -> list[str]:
    words = text.count(" ") + 1
    found = [f"words{min(6, words.bit_length())}", f"links{round(linked * 2)}", f"end{text[-1] if text[-1] in '.!?:;' else ''}"]
    if "©" in text:
        found.append("copyright")
    if held.stack:
        found.append(f"leaf={held.stack[-1][0]}")
    return found + list(held.active)


# --- labels by rule ---------------------------------------------------------------------------------------------

#: Pages of a table that are labelled by main_by_tags(), and their greatest length.
SAMPLED_PAGES, SAMPLED_CHARS = 200, 200_000
#: What an article may hold that is no part of its text: tags and names.
NOT_MAIN = frozenset("in=nav in=aside in=footer in=form".split())


def main_by_tags(features: list[str]) -> int:
    """1 for a block in an article element, unless it is in a menu, a sidebar, a footer or a form inside it, or in an element
    with a name of NOISE."""
    noise = {f"named={x}" for _, names in NOISE.values() for x in names}
    return int("in=article" in features and not NOT_MAIN.intersection(features) and not noise.intersection(features))


def labelled_sample(pages: DataFrame, column: str = "html", most: int = SAMPLED_PAGES, longest: int = SAMPLED_CHARS) -> list[tuple[list[list[str]], list[int]]]:
    """(features of each block, labels) of at most `most` pages that have an article element and are no longer than `longest`,
    chosen by a hash of the page; every second has the article's tag hidden. Null pages are left out. No more than
    these pages come to the driver."""
    share = min(1.0, 2 * most / max(1, pages.count()))
    own = pages.select(F.col(f"`{column}`").alias("html"))
    chosen = F.shiftrightunsigned(F.xxhash64("html"), 33) < int(share * (1 << 31))
    # in the order of the hash, so that the sample doesn't hang on partitions
    some = own.filter(F.col("html").contains("<article") & (F.length("html") <= longest) & chosen).orderBy(F.xxhash64("html"), "html").limit(most)
    out = []
    for i, row in enumerate(some.collect()):
        found = [b.features for b in blocks(row["html"])]
        labels = [main_by_tags(f) for f in found]
        out.append(([[x for x in f if i % 2 == 0 or x not in ("in=article", BESIDES)] for f in found], labels))
    return out


# --- generated pages --------------------------------------------------------------------------------------------

#: Names that wrap articles, and what surrounds them.
MAIN_NAMES = "content article post entry story body text main single".split()
NOISE = {
    "menu": ("nav", "menu navbar navigation nav breadcrumb breadcrumbs topbar links toc".split()),
    "header": ("header", "header masthead branding logo top".split()),
    "footer": ("footer", "footer copyright legal colophon bottom".split()),
    "sidebar": ("aside", "sidebar widget related recent popular tags share social".split()),
    "notice": ("div", "notice cookie consent banner alert popup modal newsletter subscribe".split()),
    "advert": ("div", "ad ads advert advertisement sponsor sponsored promo promotion".split()),
    "form": ("form", "search login signup contact".split()),
    "comments": ("section", "comments comment replies reply disqus discussion".split()),
}
#: Places of what surrounds an article: before it, after it, or inside.
BEFORE, AFTER, INSIDE = ("header", "menu", "notice", "advert", "form", "sidebar"), ("sidebar", "advert", "comments", "form", "menu", "footer"), ("advert", "sidebar", "comments", "form")


def labelled_page(seed: int) -> tuple[str, list[tuple[str, int]]]:
    """A page, and the text and label (1: main) of each of its blocks."""
    rng = random.Random(seed)
    labels: list[tuple[str, int]] = []

    def words(low: int, high: int, stop: str = ".") -> str:
        some = ["".join(rng.choice(("ka", "lo", "mi", "ter", "un", "es", "do", "ri", "na", "v")) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return " ".join(some).capitalize() + stop

    def said(tag: str, text: str, label: int, link: bool = False) -> str:
        labels.append((text, label))
        inner = f'<a href="/{len(labels)}">{text}</a>' if link else text
        return f"<{tag}>{inner}" + ("" if tag in ("p", "li") and rng.random() < 0.3 else f"</{tag}>")

    def wrapped(tag: str, names: list[str], inside: str) -> str:
        name = rng.choice(names)
        mark = rng.choice((f' class="{name}"', f' id="{name}"', f' class="{rng.choice("abcdxyz")}{rng.randint(1, 9)} {name}"'))
        return f"<{tag}{mark}>{inside}</{tag}>"

    def noise(kind: str) -> str:
        tag, names = NOISE[kind]
        many = kind in ("menu", "sidebar", "comments")
        rows = []
        for _ in range(rng.randint(1, 7) if many else rng.randint(1, 2)):
            stop = rng.choice(("", ".", ".", "!", "?"))
            copyright = "© " if kind == "footer" and rng.random() < 0.7 else ""
            text = copyright + words(1, 3 if kind == "menu" else 40 if kind in ("comments", "notice") else 14, stop)
            rows.append(said("li" if kind == "menu" else rng.choice(("p", "div", "span" if len(rows) == 0 else "p")), text, 0, kind == "menu" or rng.random() < 0.2))
        inside = "".join(rows)
        if kind == "menu":
            inside = f"<ul>{inside}</ul>"
        how = rng.random()
        return f"<{tag}>{inside}</{tag}>" if how < 0.4 and tag != "div" else wrapped(tag if how < 0.7 else "div", names, inside)

    def some(kinds: tuple[str, ...], share: float) -> str:
        return "".join(noise(k) for k in kinds if rng.random() < share)

    head = said("title", words(2, 9, ""), 0)
    bare = rng.random() < 0.12  # no element around the article, and little besides
    top = some(BEFORE, 0.1 if bare else 0.4)
    title = said("h1", words(1, 12, ""), 1) if rng.random() < 0.9 else ""
    if title and rng.random() < 0.2:
        title = f"<header>{title}</header>"
    body = ""
    for _ in range(rng.choice((1, 2, 3, 5, 8, 14))):
        tag = rng.choices(("p", "h2", "li", "blockquote", "pre", "td", "links"), (80, 6, 5, 4, 2, 3, 4))[0]
        if tag == "links":  # a list of the article's own
            body += "<ul>" + "".join(said("li", words(1, 6, rng.choice(("", "."))), 1, rng.random() < 0.8) for _ in range(rng.randint(1, 4))) + "</ul>"
            continue
        text = words(1, rng.choice((2, 8, 30, 90)), rng.choice((".", ".", ".", "", "!", "?")))
        if rng.random() < 0.08:  # it may speak of rights and years
            at = rng.randint(0, len(text.split()))
            text = " ".join([*text.split()[:at], "©", str(rng.randint(1900, 2030)), *text.split()[at:]])
        part = said(tag, text, 1)
        body += f"<ul>{part}</ul>" if tag == "li" else f"<table><tr>{part}</tr></table>" if tag == "td" else part
        if rng.random() < 0.05:
            body += noise(rng.choice(INSIDE[:2]))
    inner = title + body + some(INSIDE, 0.08)
    how = rng.random()
    article = inner if bare else f"<article>{inner}</article>" if how < 0.45 else f"<main>{inner}</main>" if how < 0.58 else f"<div>{inner}</div>" if how < 0.7 else wrapped(rng.choice(("div", "section", "article", "main")), MAIN_NAMES, inner)
    after = ""
    if how < 0.58 and not bare and rng.random() < 0.25:  # what readers say, in a list without a name
        after = "<ul>" + "".join(said("li", words(2, 30, rng.choice((".", "!", "?", ""))), 0) for _ in range(rng.randint(1, 5))) + "</ul>"
    page = f"<!DOCTYPE html><html><head>{head}<style>p{{}}</style></head><body>{top}{article}{after}{some(AFTER, 0.05 if bare else 0.45)}</body></html>"
    return page, labels


# --- the field --------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    """weights: of each feature, its two labels'; moves: of a label after another; start: of the first label."""

    weights: dict[str, tuple[float, float]]
    moves: tuple[tuple[float, float], tuple[float, float]]
    start: tuple[float, float]

    @cached_property
    def known(self) -> frozenset[str]:
        return frozenset(self.weights)

    def decode(self, found: list[Block]) -> list[int]:
        """The sequence of labels of highest score (Viterbi); of equal ones, that with 0 where they differ last."""
        scores = []
        for b in found:
            own = [self.weights[f] for f in b.features if f in self.weights]
            scores.append((sum(x[0] for x in own), sum(x[1] for x in own)))
        if not scores:
            return []
        best = (scores[0][0] + self.start[0], scores[0][1] + self.start[1])
        back = []
        (m00, m01), (m10, m11) = self.moves
        for s0, s1 in scores[1:]:
            a, b, c, d = best[0] + m00, best[1] + m10, best[0] + m01, best[1] + m11
            back.append((int(b > a), int(d > c)))
            best = (max(a, b) + s0, max(c, d) + s1)
        label = int(best[1] > best[0])
        out = [label]
        for move in reversed(back):
            label = move[label]
            out.append(label)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], rounds: int = 120, penalty: float = 1e-3, rare: int = 3) -> Field:
    """The field of highest penalised likelihood for pages of (features of each block, labels)."""
    pages = [p for p in pages if p[0]]
    counts: dict[str, int] = {}
    for found, _ in pages:
        for names in found:
            for f in names:
                counts[f] = counts.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= rare))}
    longest = max((len(x) for _, x in pages), default=1)
    n, size = len(pages), len(index)
    use = [(p, t, index[f]) for p, (found, _) in enumerate(pages) for t, names in enumerate(found) for f in names if f in index]
    row, column = np.array([p * longest + t for p, t, _ in use], int), np.array([i for *_, i in use], int)
    mask, truth = np.zeros((n, longest)), np.zeros((n, longest, 2))
    for p, (_, labels) in enumerate(pages):
        mask[p, : len(labels)] = 1
        truth[p, np.arange(len(labels)), labels] = 1
    x = np.zeros(2 * size + 6)
    first, second = np.zeros(len(x)), np.zeros(len(x))
    seen_moves = np.einsum("pta,ptb->ab", truth[:, :-1], truth[:, 1:])
    for step in range(1, rounds + 1):
        w, moves, start = x[: 2 * size].reshape(size, 2), x[2 * size : -2].reshape(2, 2), x[-2:]
        scores = np.stack([np.bincount(row, w[column, y], n * longest) for y in (0, 1)], 1).reshape(n, longest, 2)
        ahead, behind = np.zeros((n, longest, 2)), np.zeros((n, longest, 2))
        ahead[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            new = np.logaddexp(ahead[:, t - 1, :1] + moves[0], ahead[:, t - 1, 1:] + moves[1]) + scores[:, t]
            ahead[:, t] = np.where(mask[:, t, None] > 0, new, ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            on = moves[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :]
            behind[:, t] = np.where(mask[:, t + 1, None] > 0, np.logaddexp(on[..., 0], on[..., 1]), 0)
        total = np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])
        own = np.exp(ahead + behind - total[:, None, None]) * mask[..., None]
        pair = np.exp(ahead[:, :-1, :, None] + moves + (scores + behind)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        error = (own - truth).reshape(-1, 2)
        slope = np.concatenate([
            np.stack([np.bincount(column, error[row, y], size) for y in (0, 1)], 1).ravel(),
            (pair.sum((0, 1)) - seen_moves).ravel(),
            (own[:, 0] - truth[:, 0]).sum(0),
        ]) / max(1, n) + penalty * x
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        x = x - 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    w = x[: 2 * size].reshape(size, 2)
    pair_of = lambda v: (float(v[0]), float(v[1]))
    return Field({f: pair_of(w[i]) for f, i in index.items()}, (pair_of(x[-6:-4]), pair_of(x[-4:-2])), pair_of(x[-2:]))


@lru_cache(maxsize=4)
def generated(pages: int = TRAINING_PAGES, seed: int = 1) -> list[tuple[list[list[str]], list[int]]]:
    """(features of each block, labels) of so many generated pages."""
    examples = []
    for i in range(pages):
        page, labels = labelled_page(seed * 1_000_003 + i)
        found = blocks(page)
        assert [b.text for b in found] == [t for t, _ in labels], "the generator and the parser must see the same blocks"
        examples.append(([b.features for b in found], [y for _, y in labels]))
    return examples


def trained(pages: DataFrame | None = None, column: str = "html") -> Field:
    """The field of generated pages, and of a sample of `pages` labelled by rule."""
    return train(generated() + (labelled_sample(pages, column) if pages is not None else []))


def main_text(page: str | None, field: Field) -> str:
    found = blocks(page or "", field.known)
    return "\n".join(b.text for b, y in zip(found, field.decode(found), strict=True) if y)


def extract(pages: DataFrame, field: Field | None = None, column: str = "html") -> DataFrame:
    """pages with text (main text, blocks joined by newlines; empty if there is none) and n_chars (its code points) in
    place of `column`. Own columns of these names are replaced, all others kept. Without a field, one is trained on a
    sample of the pages.

    Null and empty html have an empty text. Repeated rows are extracted each; very long and broken pages are taken
    whole, in time that follows their length. An empty table gives an empty one.
    """
    shared = pages.sparkSession.sparkContext.broadcast(field or trained(pages, column))
    kept = [c for c in pages.columns if c not in (column, "text", "n_chars")]
    place = len(kept)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            texts = [main_text(x, own) for x in b.column(place).to_pylist()]
            columns = [*b.columns[:place], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())]
            yield pa.record_batch(columns, names=names)

    # columns go by their places: a name may hold dots
    rows = pages.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), F.col(f"`{column}`").alias("html"))
    schema = T.StructType([*rows.schema.fields[:place], T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    names = schema.names
    return rows.mapInArrow(extracted, schema).toDF(*kept, "text", "n_chars")
