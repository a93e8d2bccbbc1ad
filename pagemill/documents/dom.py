"""A document tree of HTML, as lenient as pages need it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose start ends an open paragraph.
BLOCKS = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()
)
INLINE = frozenset("a abbr b big cite code em font i kbd label mark q s samp small span strike strong sub sup time tt u var".split())
#: An element's start ends these open elements, looked for up to the given borders.
ENDS: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    **dict.fromkeys(("li",), (frozenset(("li",)), frozenset(("ul", "ol", "menu", "table", "td", "th")))),
    **dict.fromkeys(("dt", "dd"), (frozenset(("dt", "dd")), frozenset(("dl", "table", "td", "th")))),
    **dict.fromkeys(("td", "th"), (frozenset(("td", "th")), frozenset(("tr", "table")))),
    **dict.fromkeys(("tr",), (frozenset(("tr", "td", "th", "caption")), frozenset(("table",)))),
    **dict.fromkeys(("thead", "tbody", "tfoot"), (frozenset(("thead", "tbody", "tfoot", "tr", "td", "th", "caption")), frozenset(("table",)))),
    **dict.fromkeys(("option", "optgroup"), (frozenset(("option",)), frozenset(("select", "optgroup")))),
}
#: Elements that an end tag of another kind doesn't reach across.
BORDERS = frozenset(("table", "td", "th", "caption", "button"))
TABLE_PARTS = frozenset("table thead tbody tfoot tr td th caption".split())


class Node:
    """An element (``tag``), or text (``tag`` is None); the root's tag is ''."""

    __slots__ = ("tag", "attrs", "children", "parent", "text")

    def __init__(self, tag: str | None, attrs: list[tuple[str, str | None]] | None = None, text: str = ""):
        self.tag, self.attrs, self.text = tag, attrs or [], text
        self.children: list[Node] = []
        self.parent: Node | None = None

    def add(self, child: Node) -> Node:
        child.parent = self
        self.children.append(child)
        return child

    def get(self, name: str) -> str:
        """The first attribute of that name, or ''."""
        return next((v or "" for k, v in self.attrs if k == name), "")

    def walk(self) -> Iterator[Node]:
        """The node and all below it, in document order."""
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            if n.children:
                stack += n.children[::-1]

    def all(self, *tags: str) -> Iterator[Node]:
        stack = self.children[::-1]
        while stack:
            n = stack.pop()
            if n.tag in tags:
                yield n
            if n.children:
                stack += n.children[::-1]

    def up(self, tag: str, levels: int) -> Node | None:
        n = self.parent
        while n is not None and levels > 0:
            if n.tag == tag:
                return n
            n, levels = n.parent, levels - 1
        return None

    def words(self) -> str:
        """All text below the node."""
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if n.tag is None:
                out.append(n.text)
            elif n.children:
                stack += n.children[::-1]
        return "".join(out)

    def replace(self, other: Node) -> None:
        if self.parent is not None:
            at = next(i for i, c in enumerate(self.parent.children) if c is self)
            self.parent.children[at], other.parent = other, self.parent
            self.parent = None

    def remove(self) -> None:
        if self.parent is not None:
            self.parent.children = [c for c in self.parent.children if c is not self]
            self.parent = None


class _Builder(HTMLParser):
    def __init__(self, scripting: bool):
        super().__init__(convert_charrefs=True)
        self.root = Node("")
        self.open = [self.root]
        self.scripting = scripting

    def _end_to(self, tags: frozenset[str], borders: frozenset[str]) -> None:
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                # the outermost of these within the borders
                while i > 1 and self.open[i - 1].tag in tags:
                    i -= 1
                del self.open[i:]
                return
            if tag in borders:
                return

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "head", "body") and any(n.tag == tag for n in self.open):
            return
        if tag in BLOCKS and any(n.tag == "p" for n in self.open):
            self._end_to(frozenset(("p",)), BORDERS)
        if tag in ENDS:
            self._end_to(*ENDS[tag])
        if tag == "a":
            self._end_to(frozenset(("a",)), BORDERS | BLOCKS)
        node = self.open[-1].add(Node(tag, attrs))
        if tag in VOID:
            return
        self.open.append(node)
        if tag == "noscript" and self.scripting:
            self.set_cdata_mode(tag)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID or tag in ("html", "body"):
            return
        for i in range(len(self.open) - 1, 0, -1):
            own = self.open[i].tag
            if own == tag:
                if tag in INLINE and any(n.tag in BLOCKS for n in self.open[i + 1 :]):
                    del self.open[i]
                else:
                    del self.open[i:]
                return
            if own in BORDERS and tag not in TABLE_PARTS:
                return

    def handle_data(self, data: str) -> None:
        top = self.open[-1]
        if top.children and top.children[-1].tag is None:
            top.children[-1].text += data
        else:
            top.add(Node(None, text=data))

    def unknown_decl(self, data: str) -> None:
        """Marked sections show nothing."""


def parse(markup: str, scripting: bool = True) -> Node:
    """The tree of ``markup``; with ``scripting`` what stands in noscript is one text."""
    b = _Builder(scripting)
    b.feed(markup.replace("\x00", "�"))
    b.close()
    return b.root


#: Fixed value: white space of Unicode.
SPACE = "\\t\\n\\v\\f\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_SPACE, _OUTER = re.compile(f"[{SPACE}]+"), re.compile(f"^[{SPACE}]+|[{SPACE}]+$")


def one_line(text: str) -> str:
    """White space collapsed and trimmed."""
    # Python's own notion of white space has four control characters more
    if "\x1c" not in text and "\x1d" not in text and "\x1e" not in text and "\x1f" not in text:
        return " ".join(text.split())
    return _SPACE.sub(" ", text).strip(" ")


def trim(text: str) -> str:
    return _OUTER.sub("", text) if text and (text[0] <= " " or text[-1] <= " " or text[0] > "~" or text[-1] > "~") else text
