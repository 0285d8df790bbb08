"""A small HTML tree for use inside Arrow functions, and the searches that cards need.

Trees are built as the HTML standard says for the body of a page: implied ends, scopes, formatting that is opened again
after a block, the adoption of misnested formatting, and content of tables that belongs before them. Time is linear
in the page: at most DEPTH elements are open at once (those beyond are put beside each other) and at most FORMATS are opened
again. Comments, templates' own documents, framesets and the inside of svg and math are not treated apart.

All searches go in document order and include their start.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from html import unescape
from html.entities import html5

VOID = frozenset("area base basefont bgsound br col embed hr img input keygen link meta param source track wbr".split())
#: Fixed lists of the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer header hgroup main menu nav ol p search section summary ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
RAW = frozenset("iframe noembed noframes noscript script style xmp".split())
REPLACEABLE = frozenset("textarea title".split())
SPECIAL = BLOCK | HEADINGS | VOID | IN_HEAD | RAW | frozenset(
    "applet body button caption colgroup dd dt form frame frameset head html iframe li listing marquee object optgroup option plaintext pre select table tbody td textarea tfoot th thead tr".split()
) - {"optgroup", "option"}
IMPLIED = frozenset("dd dt li optgroup option p rb rp rt rtc".split())
SCOPE = frozenset("applet caption html marquee object table td template th".split())
SECTIONS = frozenset("tbody tfoot thead".split())
CELLS = frozenset(("td", "th"))
#: Elements that text and other elements do not lie in directly.
TABLE = SECTIONS | {"table", "tr"}
TABLE_STARTS = SECTIONS | CELLS | {"caption", "col", "colgroup", "tr"}
DEPTH, FORMATS = 512, 64
#: Elements that formatting isn't opened again for.
PLAIN = BLOCK | HEADINGS | (RAW - {"xmp"}) | frozenset("pre listing form li dd dt table hr plaintext param source track rb rp rt rtc".split())

_NAME = re.compile(r"[A-Za-z][^ \t\n\f/>]*")
_ATTRIBUTE = re.compile(r"[ \t\n\f/]*(?:(>)|([^ \t\n\f/>][^ \t\n\f/>=]*)(?:[ \t\n\f]*=[ \t\n\f]*(?:\"([^\"]*)(\"?)|'([^']*)('?)|([^ \t\n\f>]*)))?)")
_REFERENCE = re.compile(r"&(#[xX]?[0-9A-Fa-f]+;?|[A-Za-z][A-Za-z0-9]*;?)")


def _referred(m: re.Match) -> str:
    """What a reference in an attribute stands for: names without a semicolon count where no letter, digit or = follows."""
    if m[1][0] == "#":
        return unescape(m[0])
    return html5.get(m[1], m[0]) if m[1][-1] == ";" or m.string[m.end() : m.end() + 1] != "=" else m[0]


def markup_references(text: str) -> str:
    """Text with only the references decoded that stand for markup itself, as plain SQL can; all others stay as they are written."""
    return text.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&")


class Node:
    __slots__ = ("tag", "attributes", "parent", "children", "classes", "_places")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Node | None):
        self.tag, self.attributes, self.parent, self.children, self._places = tag, attributes, parent, [], None
        self.classes = frozenset(attributes["class"].split()) if "class" in attributes else frozenset()

    def walk(self) -> Iterator[Node]:
        todo: list = [self]
        while todo:
            node = todo.pop()
            yield node
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]

    def text(self) -> str:
        """All text below, without separators."""
        out, todo = [], [self]
        while todo:
            node = todo.pop()
            if isinstance(node, str):
                out.append(node)
            else:
                todo += reversed(node.children)
        return "".join(out)

    def has_class(self, token: str) -> bool:
        return token in self.classes

    def all(self, test: Callable[[Node], bool]) -> list[Node]:
        return [n for n in self.walk() if test(n)]

    def first(self, test: Callable[[Node], bool]) -> Node | None:
        return next((n for n in self.walk() if test(n)), None)

    def firsts(self, tokens: frozenset[str]) -> dict[str, Node]:
        """The first node of each of these classes, in one walk."""
        out: dict[str, Node] = {}
        for n in self.walk():
            for token in n.classes & tokens:
                out.setdefault(token, n)
            if len(out) == len(tokens):
                break
        return out

    def above(self, tag: str) -> Node | None:
        """The nearest ancestor of this name."""
        node = self.parent
        while node is not None and node.tag != tag:
            node = node.parent
        return node

    def later(self, token: str) -> Node | None:
        """The first later sibling of this class. Places of siblings are listed once: a finished tree doesn't change."""
        if self.parent is None:
            return None
        if self.parent._places is None:
            at: dict[int, int] = {}
            of: dict[str, list[int]] = {}
            for i, c in enumerate(self.parent.children):
                if isinstance(c, Node):
                    at[id(c)] = i
                    for t in c.classes:
                        of.setdefault(t, []).append(i)
            self.parent._places = at, of
        at, of = self.parent._places
        places = of.get(token, ())
        i = bisect_right(places, at[id(self)])
        return self.parent.children[places[i]] if i < len(places) else None


def of_class(token: str) -> Callable[[Node], bool]:
    return lambda n: n.has_class(token)


def of_tag(tag: str) -> Callable[[Node], bool]:
    return lambda n: n.tag == tag


class _Builder:
    def __init__(self):
        self.root = Node("", {}, None)
        self.html = Node("html", {}, self.root)
        self.root.children.append(self.html)
        self.head = self.body = self.form = None
        self.open = [self.html]
        self.count = Counter(("html",))
        #: Formatting that is opened again, in order; None where a cell, caption or object begins.
        self.formats: list[Node | None] = []
        self.strict = self.skip_newline = False

    # --- the stack of open elements

    def push(self, node: Node) -> None:
        self.open.append(node)
        self.count[node.tag] += 1

    def pop(self) -> Node:
        node = self.open.pop()
        self.count[node.tag] -= 1
        return node

    def in_scope(self, tags: frozenset[str] | set[str], more: frozenset[str] | set[str] = frozenset(), bounds: frozenset[str] = SCOPE) -> bool:
        count = self.count
        for t in tags:
            if count.get(t):
                break
        else:
            return False
        for node in reversed(self.open):
            if node.tag in tags:
                return True
            if node.tag in bounds or node.tag in more:
                return False
        return False

    def in_table_scope(self, *tags: str) -> bool:
        return self.in_scope(set(tags), bounds=frozenset(("html", "table", "template")))

    def imply_ends(self, but: str = "") -> None:
        while self.open[-1].tag in IMPLIED and self.open[-1].tag != but:
            self.pop()

    def pop_until(self, *tags: str) -> None:
        while self.pop().tag not in tags:
            pass

    def clear_to(self, *tags: str) -> None:
        while self.open[-1].tag not in tags and self.open[-1].tag != "html":
            self.pop()

    def clear_formats(self) -> None:
        while self.formats and self.formats.pop() is not None:
            pass

    def close_p(self) -> None:
        if self.in_scope({"p"}, {"button"}):
            self.imply_ends("p")
            self.pop_until("p")

    def mode(self) -> str:
        """The innermost open element that decides on what may come."""
        if not (self.count.get("table") or self.count.get("select")):
            return "body"
        for node in reversed(self.open):
            if node.tag in TABLE or node.tag in CELLS or node.tag in ("caption", "colgroup", "select"):
                return node.tag
        return "body"

    # --- the tree

    def place(self) -> tuple[Node, int | None]:
        """Where content goes: below the current node, or before the table that it must not lie in."""
        at = self.open[-1]
        if at.tag not in TABLE:
            return at, None
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == "table":
                table = self.open[i]
                if table.parent is not None and table.parent.children:
                    siblings = table.parent.children
                    return table.parent, next(k for k in range(len(siblings) - 1, -1, -1) if siblings[k] is table)
                return self.open[i - 1], None
        return at, None

    def add(self, tag: str, attributes: dict[str, str], here: bool = False) -> Node:
        """A new element; here: below the current node whatever that is."""
        parent, before = (self.open[-1], None) if here else self.place()
        node = Node(tag, attributes, parent)
        if before is None:
            parent.children.append(node)
        else:
            parent.children.insert(before, node)
        return node

    def insert(self, tag: str, attributes: dict[str, str], here: bool = False) -> Node:
        if len(self.open) >= DEPTH:
            self.pop()
        node = self.add(tag, attributes, here)
        self.push(node)
        return node

    def remove(self, node: Node) -> None:
        """Takes an element out of the stack, where it is there."""
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i] is node:
                del self.open[i]
                self.count[node.tag] -= 1
                return

    def reopen(self) -> None:
        """Opens formatting again that was closed by the end of a block around it."""
        if not self.formats or self.formats[-1] is None or any(self.formats[-1] is x for x in reversed(self.open)):
            return
        there = {id(n) for n in self.open}
        i = len(self.formats)
        while i > 0 and self.formats[i - 1] is not None and id(self.formats[i - 1]) not in there:
            i -= 1
        for k in range(i, len(self.formats)):
            self.formats[k] = self.insert(self.formats[k].tag, dict(self.formats[k].attributes))

    def add_format(self, node: Node) -> None:
        same = []
        for k in range(len(self.formats) - 1, -1, -1):
            other = self.formats[k]
            if other is None:
                break
            if other.tag == node.tag and other.attributes == node.attributes:
                same.append(k)
        if len(same) >= 3:
            del self.formats[same[-1]]
        elif len(self.formats) >= FORMATS:
            del self.formats[0]
        self.formats.append(node)

    def format_of(self, tag: str) -> Node | None:
        for node in reversed(self.formats):
            if node is None:
                return None
            if node.tag == tag:
                return node
        return None

    def adopt(self, tag: str) -> None:
        """The end of formatting that may be misnested: blocks that began in it take over what it held."""
        top = self.open[-1]
        if top.tag == tag:  # nothing is misnested
            if self.formats and self.formats[-1] is top:
                self.formats.pop()
                self.pop()
                return
            if not any(top is x for x in self.formats):
                self.pop()
                return
        for _ in range(8):
            node = self.format_of(tag)
            if node is None:
                self.end_other(tag)
                return
            at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i] is node), None)
            if at is None:
                self.drop_format(node)
                return
            if any(x.tag in SCOPE for x in self.open[at + 1 :]):
                return
            block = next((i for i in range(at + 1, len(self.open)) if self.open[i].tag in SPECIAL), None)
            if block is None:
                while self.pop() is not node:
                    pass
                self.drop_format(node)
                return
            furthest, above = self.open[block], self.open[at - 1]
            mark = next(i for i, x in enumerate(self.formats) if x is node)
            last, after = furthest, None
            for depth, i in enumerate(range(block - 1, at, -1), 1):
                inner = self.open[i]
                k = next((j for j, x in enumerate(self.formats) if x is inner), None)
                if k is not None and depth > 3:
                    del self.formats[k]
                    mark -= k < mark
                    k = None
                if k is None:
                    self.open.pop(i)
                    self.count[inner.tag] -= 1
                    continue
                copy = Node(inner.tag, dict(inner.attributes), None)
                self.formats[k] = self.open[i] = copy
                if last is furthest:
                    after = copy
                self.move(last, copy)
                last = copy
            if above.tag in TABLE:
                self.detach(last)
                parent, before = self.foster_of(above)
                last.parent = parent
                parent.children.insert(len(parent.children) if before is None else before, last)
            else:
                self.move(last, above)
            copy = Node(node.tag, dict(node.attributes), furthest)
            copy.children, furthest.children = furthest.children, [copy]
            for child in copy.children:
                if isinstance(child, Node):
                    child.parent = copy
            self.formats = [x for x in self.formats if x is not node]
            if after is not None:
                k = next(i for i, x in enumerate(self.formats) if x is after)
                self.formats.insert(k + 1, copy)
            else:
                self.formats.insert(min(mark, len(self.formats)), copy)
            self.open = [x for x in self.open if x is not node]
            k = next(i for i, x in enumerate(self.open) if x is furthest)
            self.open.insert(k + 1, copy)

    def foster_of(self, at: Node) -> tuple[Node, int | None]:
        kept, self.open = self.open, self.open[: next(i for i, x in enumerate(self.open) if x is at) + 1]
        try:
            return self.place()
        finally:
            self.open = kept

    @staticmethod
    def detach(node: Node) -> None:
        siblings = node.parent.children if node.parent is not None else []
        for k in range(len(siblings) - 1, -1, -1):
            if siblings[k] is node:
                del siblings[k]
                break

    def move(self, node: Node, parent: Node) -> None:
        self.detach(node)
        node.parent = parent
        parent.children.append(node)

    def drop_format(self, node: Node) -> None:
        self.formats = [x for x in self.formats if x is not node]

    # --- tokens

    def text(self, data: str) -> None:
        if self.skip_newline:
            self.skip_newline, data = False, data.removeprefix("\n")
        if not data:
            return
        if self.body is None:
            data = data.lstrip(" \t\n\f")
            if not data:
                return
            self.need_body()
        if self.open[-1].tag == "colgroup" and data.strip(" \t\n\f"):
            self.pop()
        at = self.open[-1]
        if (at.tag in TABLE or at.tag == "colgroup") and not data.strip(" \t\n\f"):
            at.children.append(data)
            return
        if at.tag not in ("select", "option", "optgroup"):
            self.reopen()
        parent, before = self.place()
        if before is None:
            parent.children.append(data)
        else:
            parent.children.insert(before, data)

    def need_body(self) -> None:
        if self.body is None:
            self.clear_to("html")
            if self.head is None:
                self.head = self.add("head", {}, True)
            self.body = self.insert("body", {}, True)

    def start(self, tag: str, attributes: dict[str, str], closed: bool) -> bool:
        """Whether the element holds raw text, which the caller reads."""
        self.skip_newline = False
        if tag in ("html", "body"):
            if tag == "body":
                self.need_body()
            node = self.html if tag == "html" else self.body
            for k, v in attributes.items():
                node.attributes.setdefault(k, v)
            node.classes = frozenset(node.attributes.get("class", "").split())
            return False
        if self.body is None:
            if tag == "head":
                if self.head is None:
                    self.head = self.insert("head", attributes, True)
                return False
            if tag in IN_HEAD and tag != "template":
                if self.head is None:
                    self.head = self.insert("head", {}, True)
                if self.open[-1] is not self.head:  # after the head's end: it belongs there all the same
                    self.push(self.head)
                return self.leaf(tag, attributes)
            self.need_body()
        if tag in ("head", "frame", "frameset"):
            return False
        if tag == "image":
            tag = "img"
        if tag in IN_HEAD and tag not in ("noscript", "noframes", "template"):
            return self.leaf(tag, attributes)
        mode = self.mode()
        if mode == "select":
            return self.start_in_select(tag, attributes)
        if mode == "colgroup" and tag != "col":
            self.pop_until("colgroup")
            return self.start(tag, attributes, closed)
        if mode != "body" and self.start_in_table(mode, tag, attributes):
            return False
        return self.start_in_body(tag, attributes, closed)

    def leaf(self, tag: str, attributes: dict[str, str]) -> bool:
        if tag in VOID:
            self.add(tag, attributes, True)
            return False
        self.insert(tag, attributes, True)
        return True

    def start_in_select(self, tag: str, attributes: dict[str, str]) -> bool:
        if tag in ("option", "optgroup", "hr"):
            if self.open[-1].tag == "option":
                self.pop()
            if tag != "option" and self.open[-1].tag == "optgroup":
                self.pop()
            self.add(tag, attributes, True) if tag == "hr" else self.insert(tag, attributes, True)
        elif tag in ("select", "input", "keygen", "textarea") or (tag in TABLE_STARTS | {"table"} and self.count["table"]):
            self.pop_until("select")
            return tag != "select" and self.start(tag, attributes, False)
        return False

    def start_in_table(self, mode: str, tag: str, attributes: dict[str, str]) -> bool:
        """Whether a start tag was dealt with by the rules of tables; cells, captions and groups of columns are ended by them."""
        if mode in CELLS or mode == "caption":
            if tag not in TABLE_STARTS:
                return False
            self.end_cell(mode)
            return self.start(tag, attributes, False) or True
        if mode == "colgroup":
            self.add(tag, attributes, True)
            return True
        if tag == "table":
            self.pop_until("table")
            return self.start(tag, attributes, False) or True
        if tag == "input" and attributes.get("type", "").lower() == "hidden":
            self.add(tag, attributes, True)
            return True
        if tag not in TABLE_STARTS:
            return False
        if mode == "tr":
            self.clear_to("tr")
            if tag in CELLS:
                self.insert(tag, attributes, True)
                self.formats.append(None)
                return True
            self.pop()
        elif mode in SECTIONS:
            self.clear_to(*SECTIONS)
            if tag == "tr" or tag in CELLS:
                self.insert("tr", attributes if tag == "tr" else {}, True)
                return tag == "tr" or self.start(tag, attributes, False) or True
            self.pop()
        else:
            self.clear_to("table")
            if tag in SECTIONS or tag in ("caption", "colgroup"):
                self.insert(tag, attributes, True)
                if tag == "caption":
                    self.formats.append(None)
                return True
            self.insert("colgroup" if tag == "col" else "tbody", {}, True)
        return self.start(tag, attributes, False) or True

    def end_cell(self, tag: str) -> None:
        self.imply_ends()
        self.pop_until(tag)
        self.clear_formats()

    def start_in_body(self, tag: str, attributes: dict[str, str], closed: bool) -> bool:
        if tag in TABLE_STARTS:
            return False
        if tag in BLOCK or tag in ("pre", "listing", "form", "xmp", "plaintext", "hr") or tag in HEADINGS or (tag == "table" and self.strict):
            if tag == "form" and self.form is not None:
                return False
            self.close_p()
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop()
        elif tag in ("li", "dd", "dt"):
            for node in reversed(self.open):
                if node.tag == tag or (tag != "li" and node.tag in ("dd", "dt")):
                    self.imply_ends(node.tag)
                    self.pop_until(node.tag)
                    break
                if node.tag in SPECIAL and node.tag not in ("address", "div", "p"):
                    break
            self.close_p()
        elif tag == "button" and self.in_scope({"button"}):
            self.imply_ends()
            self.pop_until("button")
        elif tag == "a" and (old := self.format_of("a")) is not None:
            self.adopt("a")
            self.drop_format(old)
            self.remove(old)
        elif tag in ("option", "optgroup") and self.open[-1].tag == "option":
            self.pop()
        elif tag in ("rb", "rp", "rt", "rtc") and self.in_scope({"ruby"}):
            self.imply_ends("" if tag in ("rb", "rtc") else "rtc")
        if tag not in PLAIN:
            self.reopen()
            if tag == "nobr" and self.in_scope({"nobr"}):
                self.adopt("nobr")
                self.reopen()
        if tag in VOID or (closed and (self.count["svg"] or self.count["math"] or tag in ("svg", "math"))):
            self.add(tag, attributes)
            return False
        node = self.insert(tag, attributes)
        if tag in FORMATTING:
            self.add_format(node)
        elif tag in ("applet", "marquee", "object"):
            self.formats.append(None)
        elif tag == "form":
            self.form = node
        self.skip_newline = tag in ("pre", "listing", "textarea")
        return tag in RAW or tag in REPLACEABLE or tag == "plaintext"

    def end(self, tag: str) -> None:
        self.skip_newline = False
        if self.body is None:
            if tag == "head" and self.open[-1] is self.head:
                self.pop()
                return
            if tag not in ("br", "p", "body", "html"):
                return
            self.need_body()
        if tag in ("html", "body", "head"):
            return
        mode = self.mode()
        if mode == "select":
            if tag == "select" or (tag in TABLE_STARTS | {"table"} and self.in_table_scope(tag)):
                self.pop_until("select")
                if tag != "select":
                    self.end(tag)
            elif tag in ("option", "optgroup") and tag in (self.open[-1].tag, self.open[-2].tag):
                self.pop_until(tag)
            return
        if mode != "body" and (tag in TABLE or tag in CELLS or tag in ("caption", "colgroup", "col")):
            self.end_in_table(mode, tag)
        elif tag in FORMATTING:
            self.adopt(tag)
        elif tag == "p":
            if not self.in_scope({"p"}, {"button"}):
                self.insert("p", {})
            self.close_p()
        elif tag == "br":
            self.start("br", {}, False)
        elif tag == "form":
            node, self.form = self.form, None
            if node is not None and self.in_scope({"form"}):
                self.imply_ends()
                self.remove(node)
        elif tag in HEADINGS:
            if self.in_scope(HEADINGS):
                self.imply_ends()
                self.pop_until(*HEADINGS)
        elif tag in BLOCK or tag in ("button", "pre", "listing", "li", "dd", "dt", "applet", "marquee", "object"):
            if self.in_scope({tag}, {"ol", "ul"} if tag == "li" else frozenset()):
                self.imply_ends(tag)
                self.pop_until(tag)
                if tag in ("applet", "marquee", "object"):
                    self.clear_formats()
        elif tag not in TABLE_STARTS and tag != "table":
            self.end_other(tag)

    def end_in_table(self, mode: str, tag: str) -> None:
        if tag == "col" or not self.in_table_scope(tag):
            return
        if mode in CELLS or mode == "caption":
            self.end_cell(mode)
            if tag != mode:
                self.end(tag)
            return
        self.pop_until(tag)

    def end_other(self, tag: str) -> None:
        if not self.count[tag]:
            return
        for node in reversed(self.open):
            if node.tag == tag:
                self.imply_ends(tag)
                while self.pop() is not node:
                    pass
                return
            if node.tag in SPECIAL:
                return


def _tag(page: str, at: int) -> tuple[dict[str, str], bool, int]:
    """Attributes (of repeated ones the first), whether the tag closes itself, and where it ends; -1 where the page ends in it."""
    attributes: dict[str, str] = {}
    while True:
        m = _ATTRIBUTE.match(page, at)
        if m is None:
            return attributes, False, -1
        end, name, double, closes, single, also_closes, plain = m.groups()
        if end:
            return attributes, "/" in m[0], m.end()
        at = m.end()
        if at >= len(page) or (double is not None and not closes) or (single is not None and not also_closes):
            return attributes, False, -1
        value = double if double is not None else single if single is not None else plain or ""
        attributes.setdefault(name.lower(), _REFERENCE.sub(_referred, value) if "&" in value else value)


def parse(page: str | None, decode: Callable[[str], str] = unescape) -> Node:
    """The tree of a page; null is an empty one. Its root has no name and holds the html element. decode: what makes text of
    markup's references in it; those in attributes are decoded by the standard."""
    builder = _Builder()
    page = (page or "").replace("\r\n", "\n").replace("\r", "\n").replace("\0", "")
    at, end, waiting = 0, len(page), []

    def said() -> None:
        if waiting:
            builder.text(decode("".join(waiting)))
            waiting.clear()

    while at < end:
        mark = page.find("<", at)
        if mark < 0 or mark == end - 1:
            waiting.append(page[at:])
            break
        if mark > at:
            waiting.append(page[at:mark])
        follows = page[mark + 1]
        if follows in "!?" or (follows == "/" and mark + 2 < end and not ("a" <= page[mark + 2].lower() <= "z")):
            if page.startswith("<!--", mark):
                short = next((n for n in (5, 6) if page[mark + 4 : mark + n] in (">", "->")), 0)
                close = page.find("-->", mark + 4)
                at = mark + short if short else close + 3 if close >= 0 else end
                continue
            close = page.find(">", mark)
            said()
            if page[mark : mark + 9].lower() == "<!doctype" and builder.body is None:
                builder.strict = True
            at = close + 1 if close >= 0 else end
            continue
        name = _NAME.match(page, mark + 1 + (follows == "/"))
        if name is None:
            waiting.append("<")
            at = mark + 1
            continue
        at = name.end()
        if page[at : at + 1] == ">":
            attributes, closed, at = {}, False, at + 1
        else:
            attributes, closed, at = _tag(page, at)
            if at < 0:  # what a page ends within is no tag
                break
        if waiting:
            said()
        tag = name[0].lower()
        if follows == "/":
            builder.end(tag)
        elif builder.start(tag, attributes, closed):
            close = None if tag == "plaintext" else re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.IGNORECASE).search(page, at)
            raw = page[at : close.start() if close else end]
            if builder.skip_newline:
                builder.skip_newline, raw = False, raw.removeprefix("\n")
            if raw:
                builder.open[-1].children.append(decode(raw) if tag in REPLACEABLE else raw)
            at = close.start() if close else end
            if close:
                builder.pop()
                at = _tag(page, close.end())[2]
                if at < 0:
                    break
    said()
    builder.need_body()
    return builder.root
